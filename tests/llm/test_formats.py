"""Token alignment, centroid clustering and WARC archives against brute force."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import Counter
from functools import reduce

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from quarry.llm import alignment, pivots, queries, warc
from quarry.session import ensure_checkpoint_dir, scratch
from tests.llm.test_llm import AWKWARD, DOCS, docs_of

# --- alignment


def aligned_brute(rows):
    """Counts and groups of each row by the definition, over whole texts."""
    a = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    codes = {chr(c): c for c in [*range(33, 127), *range(161, 173), *range(174, 256)]}
    codes |= {chr(256 + n): c for n, c in enumerate(c for c in range(256) if c not in codes.values())}

    def bytes_b(i):
        return bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode()

    found = []
    for i, text in rows:
        raw = (" " + (text or "")).encode()
        x = a.encode(" " + (text or ""), add_special_tokens=False).ids
        y = b.encode(text or "")
        bx = [bytes(codes[c] for c in a.id_to_token(t)) for t in x]
        by = [bytes_b(t) for t in y]
        if not text or b"".join(bx) != raw or b"".join(by) != raw:
            found.append((i, [], [], [], []))
            continue
        ends_x, ends_y = np.cumsum([len(t) for t in bx]).tolist(), np.cumsum([len(t) for t in by]).tolist()
        links = [(s, t) for s, e in zip(x, ends_x) for t, f in zip(y, ends_y) if e == f] if len(x) < 300 else [
            (x[ends_x.index(e)], y[ends_y.index(e)]) for e in sorted(set(ends_x) & set(ends_y))
        ]
        groups, last = [], 0
        for e in sorted(set(ends_x) & set(ends_y)):
            groups.append(([s for s, z in zip(x, ends_x) if last < z <= e], [t for t, z in zip(y, ends_y) if last < z <= e]))
            last = e
        found.append((i, x, y, groups, links))
    counts = Counter(p for *_, links in found for p in links)
    best = {}
    for (_, t), n in counts.items():
        best[t] = max(best.get(t, 0), n)
    out = Counter()
    for i, x, y, groups, links in found:
        shown = ";".join(",".join(map(str, g)) + "|" + ",".join(map(str, h)) for g, h in groups)
        out[i, len(x), len(y), len(groups), len(links), sum(counts[p] == best[p[1]] for p in links), sum(counts[p] for p in links), shown] += 1
    return out


TEXTS = [
    "<|endoftext|> and <s> </s> <unk>", "piece ▁ sign", "  two  blanks ", "line\n\n break\t tab ", "été Ünï 中文 字 　 x", "a b   c",
    "don't we'll I'm 12345 6,7", "x" * 300, "ab " * 200, "\x00 \x07 z", " ", "😀 😀😀 ok",
]


@pytest.mark.parametrize("chunk", [1 << 16, 40, 7])
def test_alignment_against_brute_force(spark, chunk):
    rows = AWKWARD + [(500 + n, t) for n, t in enumerate(TEXTS)]
    got = alignment.cross_align(docs_of(spark, rows), chunk=chunk)
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
    assert Counter(tuple(r[c] for c in cols) for r in got.collect()) == aligned_brute(rows)


def test_alignment_of_an_empty_table(spark):
    assert alignment.cross_align(spark.createDataFrame([], DOCS)).collect() == []


def test_fragments_compose_in_any_order():
    aligner = alignment.Aligner(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    text = " ".join(t for _, t in AWKWARD[:40] if t) + " ".join(t for t in TEXTS if "▁" not in t)
    for chunk in (3, 11, 64):
        parts = [aligner.range(*r)[0] for r in alignment.ranges(text, chunk)]
        assert len(parts) > 20
        assert not all(p[0] for p in parts) or chunk > 3  # some ranges hold no common end
        whole = reduce(alignment.compose, parts)
        right = parts[-1]
        for p in reversed(parts[:-1]):
            right = alignment.compose(p, right)
        middle = alignment.compose(reduce(alignment.compose, parts[:17]), reduce(alignment.compose, parts[17:]))
        assert whole == right == middle
        assert alignment.close(whole[1], whole[2]) + whole[3] == next(aligner.texts([text]))[0]


def test_ranges_cover_a_text_once_with_little_overlap():
    rng = random.Random(5)
    for text in ["".join(rng.choices("ab é\n ", k=5000)), "x" * 3000, "x y " * 900 + "z" * 2000 + " q" * 500, " " * 4000]:
        parts = list(alignment.ranges(text, 100))
        assert sum(hi - lo for _, lo, hi in parts) == len(text.encode()) + 1
        assert b"".join((" " + t).encode()[lo:hi] for t, lo, hi in parts) == (" " + text).encode()
        assert sum(len(t) for t, _, _ in parts) <= 4 * len(text) + 100


def test_long_white_space_and_long_words_align():
    aligner = alignment.Aligner(alignment.BYTE_VOCABULARY, alignment.PIECE_VOCABULARY)
    for text in (" " * 200_000, "\n" * 100_000 + "x", "a" * 200_000):
        groups, pairs, n_a, n_b = next(aligner.texts([text]))
        assert n_a and n_b and groups.count(";") == len(pairs) // 4


def test_the_query_hashes_groups(spark):
    got = queries.op11_token_alignment(spark, "/root/testdata/sf0.001")
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    want = aligned_brute([tuple(r) for r in rows])
    digest = {(k[0], *k[1:7], hashlib.sha256(k[7].encode()).hexdigest() if k[7] else "") for k in want}
    cols = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    assert {tuple(r[c] for c in cols) for r in got.collect()} == digest


# --- clustering


def clusters_brute(rows, size, k, rounds):
    kept = [(i, [int(np.floor(256 * float(np.float64(x)))) for x in v]) for i, v in rows if v and len(v) == size and all(x is not None and np.isfinite(x) for x in v)]
    order = sorted(kept, key=lambda r: (hashlib.sha256(f"2:{r[0]}".encode()).hexdigest() if r[0] is not None else "~", r[0] or 0, r[1]))
    centroids = [list(v) for _, v in order[:k]]

    def place(v):
        return min((sum((x - y) ** 2 for x, y in zip(v, c)), n) for n, c in enumerate(centroids))

    for _ in range(rounds):
        at = [place(v)[1] for _, v in kept]
        for n in range(len(centroids)):
            mine = [v for (_, v), c in zip(kept, at) if c == n]
            if mine:
                centroids[n] = [sum(x) // len(mine) for x in zip(*mine)]
    at = [place(v) for _, v in kept]
    inertia = Counter()
    for d, n in at:
        inertia[n] += d
    return Counter((i, n, d, inertia[n], sum(inertia.values()), tuple(centroids[n])) for (i, _), (d, n) in zip(kept, at))


def vectors(seed, n=400, size=4):
    rng = np.random.default_rng(seed)
    rows = [(int(i), [float(np.float32(x)) for x in rng.normal(rng.integers(0, 4), 0.3, size)]) for i in range(n)]
    rows += [(7, rows[3][1]), (7, rows[3][1]), (None, rows[5][1]), (None, None), (900, None), (901, []), (902, [1.0] * (size - 1))]
    rows += [(903, [1.0, None, 2.0, 3.0]), (904, [1.0, float("nan"), 2.0, 3.0]), (905, [float("inf"), 0.0, 0.0, 0.0]), (906, [-0.001] * size)]
    return rows


VECTORS = "vec_id long, embedding array<float>, v int, pivots string, cluster string, x int"


@pytest.mark.parametrize(("k", "table"), [(5, 8), (12, 2), (1, 8), (3, 0)])
def test_clusters_against_brute_force(spark, k, table):
    rows = vectors(k)
    df = spark.createDataFrame([(i, v, 1, "p", "c", 2) for i, v in rows], VECTORS).repartition(3)
    got = pivots.cluster(df, size=4, k=k, rounds=3, pivots=table)
    cols = ("vec_id", "cluster", "distance", "cluster_inertia", "inertia")
    found = Counter((*(r[c] for c in cols), tuple(r.centroid)) for r in got.collect())
    assert found == clusters_brute(rows, 4, k, 3)


def test_clusters_of_few_equal_or_no_vectors(spark):
    same = spark.createDataFrame([(i, [0.5, 0.25, 0.0, -1.0], 1, "p", "c", 2) for i in range(9)], VECTORS)
    assert {(r.cluster, r.distance) for r in pivots.cluster(same, size=4, k=40).collect()} == {(0, 0)}
    assert pivots.cluster(same.limit(0), size=4).collect() == []
    assert pivots.cluster(same, size=64).collect() == []


def test_vectors_beyond_exact_sums_are_refused(spark):
    far = spark.createDataFrame([(1, [3e30, 0.0, 0.0, 0.0], 1, "p", "c", 2)], VECTORS)
    with pytest.raises(Exception, match="component beyond"):
        pivots.cluster(far, size=4).collect()


def test_any_distance_of_components_within_the_bound_fits_a_long():
    for size in (1, 4, 64, 1000):
        far = np.full((1, size), pivots.largest(size), dtype=np.int64)
        assert pivots.squares(far, -far[0]).tolist() == [size * (2 * pivots.largest(size)) ** 2]
    assert 64 * (2 * pivots.largest(64) + 2) ** 2 >= 1 << 63


def test_components_up_to_the_bound_keep_exact_distances(spark):
    top = pivots.largest(64) // 256
    rows = [(i, [sign * float(np.nextafter(np.float32(top), np.float32(0)))] * 64, 1, "p", "c", 2) for i, sign in ((1, 1), (2, -1), (3, 1))]
    got = {r.vec_id: (r.cluster, r.distance) for r in pivots.cluster(spark.createDataFrame(rows, VECTORS), size=64, k=2, rounds=1).collect()}
    assert got[1] == got[3] and got[1][0] != got[2][0] and {d for _, d in got.values()} == {0}


def test_bounds_of_far_pivots_lose_no_near_centroid():
    """Vectors on one line far from the pivots: bounds equal the distances, and rounding may not push them beyond."""
    rng = np.random.default_rng(1)
    for _ in range(50):
        size, away = int(rng.integers(2, 12)), int(rng.integers(1 << 25, 1 << 26))
        one = np.ones(size, dtype=np.int64)
        v, centroids = (away + rng.integers(0, 60, (n, 1)) * one for n in (300, 12))
        chosen = np.stack([-away * one, -(away // 3) * one])
        far, near = (np.sqrt(np.stack([pivots.squares(x, p) for p in chosen], axis=1).astype(float)) for x in (v, centroids))
        which, best, _ = pivots.nearest(v, far, centroids, near)
        every = ((v[:, None] - centroids[None]) ** 2).sum(axis=2)
        assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()


def test_pivots_spare_distances_where_vectors_lie_apart():
    rng = np.random.default_rng(3)
    centroids = rng.integers(-5000, 5000, (40, 4))
    v = centroids[rng.integers(0, 40, 2000)] + rng.integers(-20, 20, (2000, 4))
    chosen = pivots.spread(centroids, 8)
    far, near = (np.sqrt(np.stack([pivots.squares(x, p) for p in chosen], axis=1).astype(float)) for x in (v, centroids))
    which, best, exact = pivots.nearest(v, far, centroids, near)
    every = ((v[:, None] - centroids[None]) ** 2).sum(axis=2)
    assert (which == every.argmin(axis=1)).all() and (best == every.min(axis=1)).all()
    assert exact < 0.1 * every.size


# --- WARC


def records_brute(rows, least):
    out = Counter()
    by = {}
    for i, _, html in rows:
        by.setdefault(html or "", []).append(i)
    for i, _, html in rows:
        raw = (html or "").encode()
        first = max((x for x in by[html or ""] if x is not None), default=None)
        again = len(raw) >= least and first is not None and i != first
        out[i, len(raw), hashlib.sha1(raw).hexdigest(), "revisit" if again else "response", first if again else None] += 1
    return out


def pages(n=300):
    rng = random.Random(8)
    bodies = [f"<p>{b}é</p>" * rng.randrange(0, 40) for b in range(30)]
    hosts = ["http://a.example.com", "https://www.b.example.org:8443", "ftp://u@c.net", "http://a.example.com"]
    rows = [(i, rng.choice(hosts) + rng.choice(["", "/", f"/p/{i % 17}?q={i % 5}#f", "?x"]), rng.choice(bodies)) for i in range(n)]
    rows += [(5, "http://a.example.com/p", "x" * 200), (5, "http://a.example.com/p", "x" * 200), (None, None, None), (None, "odd url\r\n", "x" * 200), (9, "mailto:x", "")]
    rows += [(1000 + i, "http://hot.example.com/", "y" * 150) for i in range(200)]
    return rows


PAGES = "page_id long, url string, html string, key string, digest string, first int, at string"
COLS = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def pages_of(spark, rows):
    return spark.createDataFrame([(*r, "k", "d", 1, "a") for r in rows], PAGES).repartition(4)


def test_archive_reads_back_every_page(spark):
    rows = pages()
    df = pages_of(spark, rows)
    archive = warc.write_archive(df, revisit_bytes=100, block_lines=16)
    assert archive.shards.count() > 1
    records = warc.read_records(archive, warc.find_captures(archive, df.unionByName(df)))
    got = warc.with_sizes(records).collect()
    assert Counter(tuple(r[c] for c in COLS) for r in got) == records_brute(rows, 100)
    texts = Counter((r.page_id, r.payload) for r in got if r.record_type == "response")
    kept = records_brute(rows, 100)
    want = Counter()
    for i, _, html in rows:
        key = (i, len((html or "").encode()), hashlib.sha1((html or "").encode()).hexdigest(), "response", None)
        if key in kept:
            want[i, html or ""] += 1
    assert texts == want


def test_captures_of_some_urls(spark):
    rows = pages()
    archive = warc.write_archive(pages_of(spark, rows), revisit_bytes=100, block_lines=16)
    wanted = spark.createDataFrame([("http://hot.example.com/",), ("HTTP://HOT.example.com",), ("http://no.where/",), (None,)], "url string")
    ids = Counter(r.page_id for r in warc.find_captures(archive, wanted).collect())
    assert ids == Counter([*range(1000, 1200), None])


def test_archive_is_a_sequence_of_warc_records(spark):
    rows = pages(40)
    archive = warc.write_archive(pages_of(spark, rows), revisit_bytes=100)
    files, root = warc.open_at(archive.root)
    seen = Counter()
    for info in files.get_file_info(warc.fs.FileSelector(root)):
        if info.path.endswith(".warc.gz"):
            raw = files.open_input_file(info.path).read()
            while raw:
                member = zlib.decompressobj(31)
                text = member.decompress(raw)
                fields, block = warc.parse(raw[: len(raw) - len(member.unused_data)])
                assert text.startswith(b"WARC/1.1\r\n") and text.endswith(b"\r\n\r\n")
                assert "\r" not in fields.get("warc-target-uri", "") and int(fields["content-length"]) == len(block)
                seen[fields["warc-type"]] += 1
                raw = member.unused_data
    assert seen["response"] + seen["revisit"] == len(rows) and seen["revisit"] and seen["warcinfo"]


def test_a_damaged_payload_is_an_error(spark):
    archive = warc.write_archive(pages_of(spark, [(1, "http://a.b/", "z" * 3000)]))
    files, root = warc.open_at(archive.root)
    for info in files.get_file_info(warc.fs.FileSelector(root)):
        if info.path.endswith(".warc.gz"):
            raw, out = files.open_input_file(info.path).read(), b""
            while raw:
                member = zlib.decompressobj(31)
                text = member.decompress(raw).replace(b"zzz", b"yyy")
                packed = zlib.compressobj(6, wbits=31)
                out += packed.compress(text) + packed.flush()
                raw = member.unused_data
            with files.open_output_stream(info.path, compression=None) as file:
                file.write(out)
    url = spark.createDataFrame([("http://a.b/",)], "url string")
    with pytest.raises(Exception, match="digest|decompress|header|data"):
        warc.read_records(archive, warc.find_captures(archive, url)).collect()


def test_archive_of_no_pages(spark):
    none = pages_of(spark, pages(1)).limit(0)
    archive = warc.write_archive(none)
    assert warc.with_sizes(warc.read_records(archive, warc.find_captures(archive, none))).collect() == []


def test_url_keys(spark):
    urls = {
        "http://a.b.c/d?e#f": "c,b,a)/d?e", "HTTPS://U@Ex.COM:80": "com,ex:80)/", "http://x.y?q=1": "y,x)/?q=1", "mailto:a": "mailto:a", None: "",
    }
    df = spark.createDataFrame([(u,) for u in urls], "url string").select("url", warc.url_key(F.col("url")).alias("key"))
    assert {r.url: r.key for r in df.collect()} == urls


def test_archives_and_staged_tables_go_with_their_scope(spark):
    def held():
        files, root = warc.open_at(ensure_checkpoint_dir(spark) + "/llm")
        return {f.path for f in files.get_file_info(warc.fs.FileSelector(root, allow_not_found=True))}

    before = held()
    df = pages_of(spark, pages(20))
    with scratch(spark):
        archive = warc.write_archive(df)
        assert warc.with_sizes(warc.read_records(archive, warc.find_captures(archive, df))).count() == df.count()
        assert len(held()) > len(before) + 3
    assert held() == before
