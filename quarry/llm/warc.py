"""WARC archives with a two-level capture index.

``write_archive`` writes one gzip member per page into archive files, a file or
more per task. Of pages with one payload of some size the one with the largest
id is a response, the others are revisits that name it and hold no payload.

Captures are then sorted by their reversed-host URL key. A shard of the index
is a range of keys: a file of compressed blocks of lines, and a sparse directory
with the first key of every block. ``find_captures`` sends each wanted key to
the shards whose range holds it (binary search over the shards' first keys), finds
the blocks by binary search in the shard's directory, and reads these alone;
``read_records`` reads the byte ranges that the lines name.

Files are written under names of their own for each attempt of a task, and count
only once Spark has committed the rows that name them: a lost executor leaves
at most files that nothing points to. They are opened through pyarrow's file
systems (local or mounted folders, HDFS, S3, GCS).
"""

from __future__ import annotations

import hashlib
import json
import re
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import staged
from quarry.session import claimed, ensure_checkpoint_dir, ship_package

REVISIT_BYTES = 1000
"""Payloads of fewer bytes are never revisits."""
BLOCK_LINES = 1000
ARCHIVE_BYTES = 1 << 30
"""A task starts a new archive file beyond this size."""
READ_BYTES = 1 << 20
"""Read at once where records follow one another."""
BROADCAST_ROWS = 100_000
"""Repeated payloads are broadcast up to this number (some 10 MB), else joined by a shuffle."""
_OUT_BYTES = 4 << 20
_DATE = "2000-01-01T00:00:00Z"  # pages carry no time of capture
_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_HTTP = "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {}\r\n\r\n"

_WRITTEN = "key string, page_id long, archive string, at long, size long"
_SHARD = "shard string, lines long, first_key string, last_key string"
_RECORD = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"


def url_key(url: Column) -> Column:
    """Host labels reversed, then port, path and query: ``http://a.b.c/d?e`` is
    ``c,b,a)/d?e``. Fragment and user go; what is no such URL is its own key, null the empty one."""
    form = r"^[A-Za-z][A-Za-z0-9+.\-]*://(?:[^/?#@]*@)?([^/?#:]+)(:[0-9]+)?([^#]*)"
    host, port, rest = (F.regexp_extract(url, form, i) for i in (1, 2, 3))
    path = F.when(rest.startswith("/"), rest).otherwise(F.concat(F.lit("/"), rest))
    key = F.concat(F.array_join(F.reverse(F.split(F.lower(host), r"\.")), ","), port, F.lit(")"), path)
    return F.coalesce(F.when(url.rlike(form), key).otherwise(url), F.lit(""))


def open_at(uri: str) -> tuple[fs.FileSystem, str]:
    """File system and path of a folder as Spark names it."""
    local = re.sub(r"^file:(//)?(?=/)", "", uri)
    return (fs.LocalFileSystem(), local) if local.startswith("/") else fs.FileSystem.from_uri(uri)


def record(kind: str, name: str, fields: list[tuple[str, str]], block: bytes) -> bytes:
    """One WARC record as a gzip member of its own."""
    head = [("WARC-Type", kind), ("WARC-Record-ID", name), ("WARC-Date", _DATE), *fields, ("Content-Length", str(len(block)))]
    text = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in head) + "\r\n"
    packer = zlib.compressobj(6, wbits=31)
    return packer.compress(text.encode() + block + b"\r\n\r\n") + packer.flush()


def parse(member: bytes) -> tuple[dict[str, str], bytes]:
    """Fields (names in lower case) and block of a record."""
    raw = zlib.decompress(member, wbits=31)
    head, _, rest = raw.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    if not lines[0].startswith("WARC/"):
        raise ValueError("not a WARC record")
    fields = dict((k.lower(), v) for k, _, v in (line.partition(": ") for line in lines[1:]))
    size = int(fields["content-length"])
    if rest[size:] != b"\r\n\r\n":
        raise ValueError(f"record {fields.get('warc-record-id')} is cut short")
    return fields, rest[:size]


def _name(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(name: str | None) -> int | None:
    digits = (name or "").removeprefix("<urn:page:").removesuffix(">")
    return int(digits) if digits else None


def _field(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url or "")


class _Writer:
    """Files of one task, each of ``limit`` bytes or little more."""

    def __init__(self, root: str, stem: str, end: str, limit: float):
        self.files, self.root = open_at(root)
        self.stem, self.end, self.limit = f"{stem}-{TaskContext.get().partitionId():05d}-{uuid.uuid4().hex}", end, limit
        self.count, self.out, self.name, self.at = 0, None, "", 0

    def write(self, data: bytes) -> int:
        """Where ``data`` begins in the file ``name``."""
        if self.out is None or self.at >= self.limit:
            self.close()
            self.files.create_dir(self.root, recursive=True)
            self.name, self.at = f"{self.stem}-{self.count}{self.end}", 0
            self.out = self.files.open_output_stream(f"{self.root}/{self.name}", compression=None)
            self.count += 1
        at, self.at = self.at, self.at + len(data)
        self.out.write(data)
        return at

    def close(self) -> None:
        if self.out is not None:
            self.out.close()
            self.out = None


def _columns(rows: list[tuple], schema: str) -> pa.RecordBatch:
    kinds = {"long": pa.int64(), "string": pa.string()}
    cols = [field.split() for field in schema.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], kinds[k]) for i, (_, k) in enumerate(cols)], [n for n, _ in cols])


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    for batch in batches:
        for values in zip(*batch.columns, strict=True):
            yield tuple(v.as_py() for v in values)


def _write(root: str, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Archives of this task; yields where each page's record is."""
    out = _Writer(root, "pages", ".warc.gz", ARCHIVE_BYTES)
    for batch in batches:
        rows = []
        for key, page_id, url, html, digest, refers_to, refers_url, revisit in _rows([batch]):
            payload = b"" if revisit else html.encode()
            fields = [("WARC-Target-URI", _field(url)), ("Content-Type", "application/http; msgtype=response"), ("WARC-Payload-Digest", f"sha1:{digest}")]
            if revisit:
                fields += [("WARC-Profile", _PROFILE), ("WARC-Refers-To", _name(refers_to)), ("WARC-Refers-To-Target-URI", _field(refers_url))]
            member = record("revisit" if revisit else "response", _name(page_id), fields, _HTTP.format(len(payload)).encode() + payload)
            if out.out is None or out.at >= out.limit:
                out.write(record("warcinfo", f"<urn:uuid:{uuid.uuid4()}>", [("Content-Type", "application/warc-fields")], b"format: WARC File Format 1.1\r\n"))
            at = out.write(member)
            rows.append((key, page_id, out.name, at, len(member)))
        yield _columns(rows, _WRITTEN)
    out.close()


def _index(root: str, lines: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks and directory of one shard, whose captures come sorted."""
    out, directory, block, total, last = _Writer(root, "index", ".cdxj.gz", float("inf")), [], [], 0, None

    def flush():
        first = block[0][0]
        packer = zlib.compressobj(6, wbits=31)
        text = "".join(json.dumps({"key": k, "page": p, "archive": a, "at": o, "size": s}) + "\n" for k, p, a, o, s in block)
        data = packer.compress(text.encode()) + packer.flush()
        directory.append({"first": first, "last": block[-1][0], "at": out.write(data), "size": len(data)})
        block.clear()

    for row in _rows(batches):
        block.append(row)
        total, last = total + 1, row[0]
        if len(block) >= lines:
            flush()
    if block:
        flush()
    if total:
        out.close()
        with out.files.open_output_stream(f"{out.root}/{out.name}.directory", compression=None) as file:
            file.write("".join(json.dumps(entry) + "\n" for entry in directory).encode())
        yield _columns([(out.name, total, directory[0]["first"], last)], _SHARD)


@dataclass(frozen=True)
class Archive:
    """Folder of the archives and index files, and the index's shards (a row each)."""

    root: str
    shards: DataFrame


def write_archive(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    revisit_bytes: int = REVISIT_BYTES, block_lines: int = BLOCK_LINES,
) -> Archive:
    """Write a record per row of ``pages`` into the shared folder, and the index.

    Of records with equal payloads (the html in UTF-8; null is empty) of at
    least ``revisit_bytes`` those with the largest id are responses, the others revisits of it; null ids
    are smaller than all others, and a payload of null ids alone has responses
    only. Smaller payloads are all responses. Repeated rows are records of their
    own. A null url is empty. Other columns are not read. In a ``session.scratch``
    scope the archive goes with it.
    """
    spark = pages.sparkSession
    ship_package(spark)
    root = claimed(f"{ensure_checkpoint_dir(spark)}/llm/warc-{uuid.uuid4().hex}")
    url, html = F.col(url_col), F.coalesce(F.col(html_col), F.lit(""))
    rows = pages.select(
        url_key(url).alias("key"), F.col(id_col).cast("long").alias("page_id"), url.alias("url"), html.alias("html"), F.sha1(html).alias("digest")
    )
    large = F.octet_length("html") >= revisit_bytes
    same = rows.where(large).groupBy(F.col("digest").alias("digest_")).agg(
        F.max(F.struct("page_id", "url")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    same = staged(same.where((F.col("n") > 1) & F.col("first.page_id").isNotNull()).select("digest_", "first"), "warc-payloads")
    if same.count() <= BROADCAST_ROWS:
        same = F.broadcast(same)
    revisit = F.col("first").isNotNull() & ~F.col("page_id").eqNullSafe(F.col("first.page_id"))
    chosen = rows.join(same, large & (F.col("digest") == F.col("digest_")), "left").select(
        "key", "page_id", "url", F.when(revisit, "").otherwise(F.col("html")).alias("html"), "digest",
        F.col("first.page_id").alias("refers_to"), F.col("first.url").alias("refers_url"), revisit.alias("revisit"),
    )
    written = staged(chosen.mapInArrow(partial(_write, root), _WRITTEN), "warc-written")
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    sorted_ = written.repartitionByRange(tasks, "key", "page_id", "archive", "at").sortWithinPartitions("key", "page_id", "archive", "at")
    return Archive(root, staged(sorted_.mapInArrow(partial(_index, root, block_lines), _SHARD), "warc-shards"))


def _route(firsts: list[str], lasts: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each wanted key with the shards whose range holds it."""
    for batch in batches:
        found = [(k, n) for (k,) in _rows([batch]) for n in range(bisect_left(lasts, k), bisect_right(firsts, k))]
        yield _columns(found, "key string, shard long")


def _find(root: str, names: list[str], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines of the wanted keys, which come sorted by shard and key."""
    files, folder = open_at(root)
    shard, at, block, file, found = None, -1, [], None, []
    for key, number in _rows(batches):
        if number != shard:
            if file:
                file.close()
            shard, at = number, -1
            with files.open_input_stream(f"{folder}/{names[shard]}.directory", compression=None) as text:
                directory = [json.loads(line) for line in text.read().decode().splitlines()]
            firsts, lasts = [e["first"] for e in directory], [e["last"] for e in directory]
            file = files.open_input_file(f"{folder}/{names[shard]}")
        for n in range(bisect_left(lasts, key), bisect_right(firsts, key)):
            if n != at:  # a block is read once for all keys in it
                at, where = n, directory[n]
                text = zlib.decompress(file.read_at(where["size"], where["at"]), wbits=31).decode()
                block = [json.loads(line) for line in text.split("\n")[:-1]]
                keys = [line["key"] for line in block]
            lines = block[bisect_left(keys, key) : bisect_right(keys, key)]
            found += [(key, e["page"], e["archive"], e["at"], e["size"]) for e in lines]
            if len(found) > 10_000:
                yield _columns(found, _WRITTEN)
                found = []
    if file:
        file.close()
    yield _columns(found, _WRITTEN)


def find_captures(archive: Archive, wanted: DataFrame, url_col: str = "url") -> DataFrame:
    """``key, page_id, archive, at, size`` of every capture of the wanted urls.

    A url asked for repeatedly counts once; one without captures gives no row.
    """
    shards = archive.shards.orderBy("first_key", "last_key", "shard").collect()  # a row per shard: as many as the index had tasks
    names, firsts, lasts = ([r[c] for r in shards] for c in ("shard", "first_key", "last_key"))
    keys = wanted.select(url_key(F.col(url_col)).alias("key")).distinct()
    routed = keys.mapInArrow(partial(_route, firsts, lasts), "key string, shard long")
    near = routed.repartition(max(1, len(names)), "shard").sortWithinPartitions("shard", "key")
    return near.mapInArrow(partial(_find, archive.root, names), _WRITTEN)


def _read(root: str, payload: bool, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Records at the given places, which come sorted by archive and place."""
    files, folder = open_at(root)
    name, file, start, held, end, rows, load = None, None, 0, b"", -1, [], 0
    schema = _RECORD + (", payload string" if payload else "")
    for archive, at, size in _rows(batches):
        if archive != name:
            if file:
                file.close()
            name, file, held, end = archive, files.open_input_file(f"{folder}/{archive}"), b"", -1
        if at < start or at + size > start + len(held):
            start, held = at, file.read_at(max(size, READ_BYTES) if at == end else size, at)
        end = at + size
        fields, block = parse(held[at - start : end - start])
        body = block.partition(b"\r\n\r\n")[2]
        digest, kind = fields["warc-payload-digest"].removeprefix("sha1:"), fields["warc-type"]
        if kind == "response" and hashlib.sha1(body).hexdigest() != digest:
            raise ValueError(f"payload of {fields['warc-record-id']} in {archive} does not have its digest")
        whole = kind == "response"
        row = (_page(fields["warc-record-id"]), len(body) if whole else None, digest, kind, _page(fields.get("warc-refers-to")))
        rows.append((*row, body.decode()) if payload and whole else (*row, None) if payload else row)
        load += len(body) + 100 if payload else 100
        if load > _OUT_BYTES:
            yield _columns(rows, schema)
            rows, load = [], 0
    if file:
        file.close()
    yield _columns(rows, schema)


def read_records(archive: Archive, captures: DataFrame, payload: bool = True) -> DataFrame:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` and
    ``payload`` of the captures' records, read by byte range.

    A revisit has no payload of its own: bytes and payload are null (see
    ``with_sizes``). A record whose payload does not have its digest is an error.
    """
    places = captures.select("archive", "at", "size")
    tasks = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))  # by bytes to read: rows are few
    near = places.repartition(tasks, "archive", F.expr("at div 16777216")).sortWithinPartitions("archive", "at")
    return near.mapInArrow(partial(_read, archive.root, payload), _RECORD + (", payload string" if payload else ""))


def with_sizes(records: DataFrame) -> DataFrame:
    """``records`` with the payload bytes of revisits taken from the responses
    they refer to (null where that is not among ``records``)."""
    records = staged(records, "warc-records")
    asked = staged(records.where("record_type = 'revisit'").groupBy("refers_to", "payload_digest").agg(F.count(F.lit(1)).alias("n")), "warc-asked")
    whole = records.where("record_type = 'response'").select(F.col("page_id").alias("refers_to"), "payload_digest", F.col("payload_bytes").alias("bytes"))
    # One row per response that revisits name; written, so that AQE can split the revisits of a hot one.
    targets = staged(asked.join(whole, ["refers_to", "payload_digest"]).groupBy("refers_to", "payload_digest").agg(F.max("bytes").alias("bytes")), "warc-targets")
    out = records.join(targets, ["refers_to", "payload_digest"], "left")
    return out.withColumn("payload_bytes", F.coalesce("payload_bytes", "bytes")).select(*records.columns)
