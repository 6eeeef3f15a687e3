"""The registered queries of this subpackage: ``opN_<name>(spark, sf_dir)``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import alignment, chat, decontaminate, exact, licenses, lines, packing, pivots, quality, simhash, substring, toxicity, warc
from quarry.llm.common import table


def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash components of all documents: 4-word shingles, 4 bits."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=4, max_bits=4)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 4096 tokens."""
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark windows of ten words in all documents."""
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known licences in all documents."""
    return licenses.scan_licenses(table(spark, sf_dir, "documents"), licenses.known_licenses(spark))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without the windows of 35 words that also start elsewhere."""
    out = substring.substring_dedup(table(spark, sf_dir, "documents"), window=35)
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op6_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations repaired and rendered, a row per turn."""
    out = chat.format_chats(table(spark, sf_dir, "conversations"))
    return out.withColumn("rendered_sha256", F.sha2("rendered", 256)).drop("rendered")


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of all documents."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every document among identical texts."""
    return exact.exact_classes(table(spark, sf_dir, "documents")).drop("keep_rows")


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of all documents."""
    return quality.quality(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents without later repeats of three lines or more, or of one or two that have 35 words or more."""
    out = lines.line_dedup(table(spark, sf_dir, "documents"), run=3, long_words=35)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links of two tokenizers' tokens in all documents."""

    def digest(groups):
        return F.when(groups == "", "").otherwise(F.sha2(groups, 256))

    return alignment.cross_align(table(spark, sf_dir, "documents"), keep=digest).withColumnRenamed("groups", "groups_sha256")


def op12_centroid_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All vectors of 64 components in 40 clusters after 5 rounds."""
    out = pivots.cluster(table(spark, sf_dir, "embeddings"), size=64, k=40, rounds=5)
    shown = F.sha2(F.array_join(F.transform("centroid", lambda x: x.cast("string")), ","), 256)
    return out.withColumn("centroid_sha256", shown).drop("centroid")


def op13_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages written as WARC records, found by the index and read back."""
    pages = table(spark, sf_dir, "pages")
    archive = warc.write_archive(pages)
    return warc.with_sizes(warc.read_records(archive, warc.find_captures(archive, pages), payload=False))


QUERIES = {
    f.__name__: f
    for f in (
        op1_simhash_near_dedup,
        op2_packing,
        op3_decontamination,
        op4_license_scan,
        op5_substring_dedup,
        op6_chat_format,
        op7_toxicity,
        op8_exact_dedup,
        op9_quality,
        op10_line_dedup,
        op11_token_alignment,
        op12_centroid_clustering,
        op13_warc,
    )
}

def _clustering_sql(size: int, k: int, rounds: int) -> str:
    """Lloyd rounds over integers, one after the other."""

    def nearest(n: int) -> str:
        return f"""
        d{n} AS (
            SELECT vec_id, any_value(v) AS v, min(struct_pack(d := d, c := c)) AS best
            FROM (SELECT vec_id, v, c, list_sum(list_transform(list_zip(v, m), lambda p: (p[1] - p[2]) * (p[1] - p[2]))) AS d FROM v, c{n})
            GROUP BY vec_id)"""

    steps = [
        f"""
        v AS (
            SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE len(embedding) = {size} AND len(list_filter(embedding, lambda x: isfinite(x))) = {size}),
        c0 AS (
            SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v AS m FROM v
            QUALIFY row_number() OVER (ORDER BY sha256('2:' || vec_id)) <= {k})"""
    ]
    for n in range(rounds):
        steps += [
            nearest(n),
            f"""
        s{n} AS (
            SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY j) AS m
            FROM (SELECT best.c AS c, j, sum(v[j])::BIGINT AS s, count(*) AS n FROM d{n}, range(1, {size + 1}) AS dims(j) GROUP BY 1, 2)
            GROUP BY c),
        c{n + 1} AS (SELECT c, coalesce(s.m, o.m)::BIGINT[] AS m FROM c{n} o LEFT JOIN s{n} s USING (c))""",
        ]
    return "WITH " + ",".join([*steps, nearest(rounds)]) + f"""
        SELECT vec_id, best.c::INTEGER AS cluster, best.d::BIGINT AS distance,
               sum(best.d) OVER (PARTITION BY best.c)::BIGINT AS cluster_inertia, sum(best.d) OVER ()::BIGINT AS inertia,
               sha256(array_to_string(m, ',')) AS centroid_sha256
        FROM d{rounds} JOIN c{rounds} o ON o.c = best.c
    """


ORACLES = {
    "op12_centroid_clustering": _clustering_sql(64, 40, 5),
    "op13_warc": """
        WITH sized AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
        named AS (SELECT *, CASE WHEN n >= 1000 THEN max(page_id) OVER (PARTITION BY html) ELSE page_id END AS first FROM sized)
        SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
               CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first THEN first END AS refers_to
        FROM named
    """,
    "op8_exact_dedup": """
        SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
               doc_id = max(doc_id) OVER same AS kept, sha256(coalesce(text, '')) AS text_sha256
        FROM documents WINDOW same AS (PARTITION BY coalesce(text, ''))
    """,
    "op3_decontamination": r"""
        WITH texts AS (
            SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
        items AS (
            SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
        windows AS (
            SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM items WHERE len(w) > 0)),
        sizes AS (SELECT DISTINCT size FROM windows),
        places AS (
            SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS win
            FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM texts, sizes WHERE len(w) >= size)),
        hits AS (SELECT doc_id, i, size, item_id FROM places JOIN windows USING (size, win)),
        covered AS (
            SELECT doc_id, count(DISTINCT p) AS n_hit
            FROM (SELECT doc_id, unnest(range(i, i + size)) AS p FROM hits) GROUP BY doc_id),
        listed AS (
            SELECT doc_id, count(DISTINCT item_id) AS n_items, string_agg(DISTINCT item_id::VARCHAR, ',' ORDER BY item_id::VARCHAR) AS ids
            FROM hits GROUP BY doc_id)
        SELECT doc_id, coalesce(len(w), 0) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
               sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM texts LEFT JOIN covered USING (doc_id) LEFT JOIN listed USING (doc_id)
    """,
    "op4_license_scan": licenses.oracle_sql(),
    "op5_substring_dedup": r"""
        WITH texts AS (SELECT doc_id, coalesce(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), []) AS w FROM documents),
        windows AS (
            SELECT doc_id, s, sha256(array_to_string(w[s : s + 34], ' ')) AS win
            FROM (SELECT *, unnest(range(1, len(w) - 33)) AS s FROM texts WHERE len(w) >= 35)),
        twice AS (SELECT doc_id, s FROM windows QUALIFY count(*) OVER (PARTITION BY win) > 1),
        gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS p FROM twice),
        left_over AS (
            SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS kept
            FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS p FROM texts) ANTI JOIN gone USING (doc_id, p)
            GROUP BY doc_id)
        SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
        FROM texts LEFT JOIN left_over USING (doc_id)
    """,
    "op10_line_dedup": r"""
        WITH texts AS (
            SELECT doc_id, l, list_transform(l, lambda x: len(regexp_extract_all(x, '[^\x20\x09-\x0D]+'))) AS w
            FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents)),
        runs AS (
            SELECT doc_id, n, s, l[s : s + n - 1] AS run
            FROM (SELECT *, unnest(range(1, len(l) - n + 2)) AS s FROM texts, (VALUES (1), (2), (3)) AS sizes(n) WHERE len(l) >= n)
            WHERE n = 3 OR list_sum(w[s : s + n - 1]) >= 35),
        later AS (
            SELECT doc_id, n, s FROM runs QUALIFY row_number() OVER (PARTITION BY n, run ORDER BY doc_id, s) > 1),
        gone AS (SELECT doc_id, list(DISTINCT p) AS gone FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM later) GROUP BY doc_id)
        SELECT doc_id, coalesce(len(l), 0) AS n_lines, coalesce(len(gone), 0) AS n_removed,
               sha256(coalesce(array_to_string(list_transform(
                   list_filter(range(1, len(l) + 1), lambda i: NOT list_contains(coalesce(gone, []), i)), lambda i: l[i]), chr(10)), '')) AS kept_sha256
        FROM texts LEFT JOIN gone USING (doc_id)
    """,
}
