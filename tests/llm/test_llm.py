"""The operators against brute force on small tables with awkward rows."""

from __future__ import annotations

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import (
    chat,
    components,
    decontaminate,
    exact,
    golay,
    labelled,
    licenses,
    lines,
    packing,
    quality,
    simhash,
    substring,
    toxicity,
)

# Columns whose names clash with those the operators use themselves.
DOCS = "doc_id long, text string, _sha string, k1 string, fp int, _score double, text_sha256 int, kept string"


def docs_of(spark, rows, parts=3):
    """Rows (doc_id, text) with extra columns of clashing names."""
    full = [(i, t, "x", "y", 7, 0.5, 1, "z") for i, t in rows]
    return spark.createDataFrame(full, DOCS).repartition(parts)


def texts(seed: int, n: int = 60) -> list[str | None]:
    """Short texts from few words, with shared passages, copies, nulls and empties."""
    rng = random.Random(seed)
    vocabulary = ["the", "The", "of", "a,", "b.", "Été", "ß", "x1", "don't", "—", "zz"]
    passage = [f"p{i}" for i in range(45)]
    out: list[str | None] = [None, "", " \t\n", "a", passage and " ".join(passage)]
    while len(out) < n:
        words = rng.choices(vocabulary, k=rng.randrange(0, 30))
        if rng.random() < 0.4:
            a = rng.randrange(0, 20)
            words += passage[a : a + rng.randrange(5, 45)]
        if rng.random() < 0.3:
            words += ["loop", "loop"] * rng.randrange(0, 25)
        t = "".join(w + rng.choice([" ", "  ", "\n", "\t", " "]) for w in words)
        out += [t] * rng.choice([1, 1, 1, 2, 3])
    return out


AWKWARD = [*enumerate(texts(1)), (None, "a"), (None, "a"), (3, "a"), (None, None), (7, "same id, other text")]


def of(df, *cols):
    return Counter(tuple(r[c] for c in cols) for r in df.collect())


# --- exact dedup


def exact_brute(rows):
    by = defaultdict(list)
    for i, t in rows:
        by[t or ""].append(i)
    out = Counter()
    for i, t in rows:
        ids = by[t or ""]
        keep = max((x for x in ids if x is not None), default=None)
        out[i, keep, len(ids), hashlib.sha256((t or "").encode()).hexdigest()] += 1
    return out, by


@pytest.mark.parametrize("bucket_bytes", [400, 1 << 20])
def test_exact_classes(spark, monkeypatch, bucket_bytes):
    levels, plain = [], exact.staged
    monkeypatch.setattr(exact, "staged", lambda df, tag: levels.append(tag) or plain(df, tag))
    expected, by = exact_brute(AWKWARD)
    got = exact.exact_classes(docs_of(spark, AWKWARD), bucket_bytes=bucket_bytes).cache()
    assert ("grace-1" in levels) == (bucket_bytes == 400)  # full tables hand over to a next level
    assert of(got, "doc_id", "keep_id", "group_size", "text_sha256") == expected
    kept = got.where("kept").collect()
    assert len(kept) == len(by) and all(r.doc_id == r.keep_id for r in kept)


def test_exact_dedup_keeps_one_row_with_its_columns(spark):
    docs = docs_of(spark, AWKWARD)
    out = exact.exact_dedup(docs)
    assert out.columns == docs.columns
    rows = out.collect()
    _, by = exact_brute(AWKWARD)
    assert sorted(r.text or "" for r in rows) == sorted(by)
    assert all(r.doc_id == max((x for x in by[r.text or ""] if x is not None), default=None) for r in rows)


def test_content_table_compares_contents():
    table = exact.ContentTable(limit=10)
    assert [table.add(t)[0] for t in (b"aaaa", b"bbbb", b"aaaa", b"cccc", b"bbbb")] == [0, 1, 0, -1, 1]
    big = exact.ContentTable()
    many = [str(i % 3000).encode() for i in range(9000)]
    assert [big.add(t)[0] for t in many] == [i % 3000 for i in range(9000)]


# --- SimHash


def fingerprint_brute(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", t)
    if not w:
        return 0
    h = [xxhash.xxh64(" ".join(w[i : i + 4]).encode(), seed=42).intdigest() for i in range(max(1, len(w) - 3))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def component_brute(values, near):
    """Least index of each value's component."""
    root = list(range(len(values)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(values)):
        for j in range(i):
            if near(values[i], values[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(values))]


def near_rows(seed):
    rng = random.Random(seed)
    base = [" ".join(rng.choices([f"w{k}" for k in range(300)], k=120)) for _ in range(12)]
    out = texts(seed, 20)
    for b in base:
        for _ in range(rng.randrange(1, 9)):
            words = b.split()
            for _ in range(rng.randrange(0, 4)):
                words[rng.randrange(len(words))] = f"e{rng.randrange(9999)}"
            out.append(" ".join(words))
    return list(enumerate(out))


@pytest.mark.parametrize("seed", [1, 2])
def test_near_duplicates(spark, seed):
    rows = near_rows(seed)
    fps = [fingerprint_brute(t) for _, t in rows]
    least = component_brute(fps, lambda a, b: (a ^ b).bit_count() <= 4)
    got = of(simhash.near_duplicates(docs_of(spark, rows)), "doc_id", "fingerprint", "component_id")
    assert got == Counter((i, f"{fps[i]:016x}", least[i]) for i, _ in rows)
    kept = simhash.drop_near_duplicates(docs_of(spark, rows))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least))


def test_near_duplicates_null_and_repeated_ids(spark):
    rows = [(None, "a b c d e"), (None, "a b c d e"), (5, "a b c d e"), (5, "a b c d e"), (5, "q r s t u v w"), (None, None)]
    got = of(simhash.near_duplicates(docs_of(spark, rows)), "doc_id", "component_id")
    assert got == Counter({(None, 5): 2, (5, 5): 3, (None, None): 1})
    docs = docs_of(spark, rows)
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert of(kept, "doc_id", "text") == Counter({(5, "a b c d e"): 1, (5, "q r s t u v w"): 1, (None, None): 1})


def test_golay_keys_meet_within_four_bits():
    assert len(np.unique(golay.home(np.arange(1 << 23)))) == 1 << 12
    rng = random.Random(3)
    import pyarrow as pa

    for bits in range(1, 5):
        for _ in range(40):
            a = rng.getrandbits(64)
            b = a
            for k in rng.sample(range(64), bits):
                b ^= 1 << k
            pair = np.array([a, b], dtype=np.uint64).view(np.int64)
            t = pa.Table.from_batches(simhash._keys([pa.record_batch([pa.array(pair)], names=["fp"])])).to_pydict()
            keys = [{k for k, f in zip(t["key"], t["fp"], strict=True) if f == x} for x in pair]
            assert keys[0] & keys[1]


def test_dense_group_stays_linear():
    """A thousand fingerprints round one point give a tree of links."""
    rng = random.Random(5)
    fp = np.array(list({1 << rng.randrange(60) | 1 << rng.randrange(60) for _ in range(3000)}), dtype=np.uint64).view(np.int64)
    u, v = simhash._tree(fp, 4)
    assert len(u) == len(fp) - 1
    a, b = simhash._forest(u, v)
    assert len(a) == len(fp) - 1 and len(set(b.tolist())) == 1


def test_components_of_paths_and_stars(spark):
    rng = random.Random(4)
    edges = [(i, i + 1) for i in range(60)] + [(100, 100 + i) for i in range(1, 50)] + [(300, 300), (301, 302), (302, 301)]
    rng.shuffle(edges)
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = {i: 0 for i in range(1, 61)} | {100 + i: 100 for i in range(1, 50)} | {302: 301}
    assert {n: c for n, c in got.items() if n != c} == expected
    none = components.components(spark.createDataFrame([], "u long, v long"))
    assert none.count() == 0


# --- packing


def check_packing(rows, got, ids, window):
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in got:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append((r.offset, r.length, r.sequence_tokens))
    for doc, own in pieces.items():
        at = 0
        for r in sorted(own, key=lambda r: r.start):
            assert r.start == at and r.length > 0 and r.doc_tokens == len(ids[doc])
            at += r.length
            assert zlib.crc32(ids[doc][r.start : at].tobytes()) == r.ids_crc32
        assert at == len(ids[doc])
    assert set(pieces) == {i for i, _ in rows}
    for own in sequences.values():
        at = 0
        for offset, length, total in sorted(own):
            assert offset == at
            at += length
        assert at == total and (at == window or (at < window and at & (at - 1) == 0))


@pytest.fixture(scope="module")
def tokenizer():
    public = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    return Tokenizer.from_file(public.path(packing.VOCABULARY))


ODD_TEXTS = ["", "It's 2024, isn't it? ÉTÉ_été 99% ''' 's", "日本語 text", "é nfc", "<|endoftext|> x", "a\x1cb\x85c\xa0d", "!!'re" * 30, "ǅ ß ẞ İ"]


@pytest.mark.parametrize("window", [8, 64])
def test_packing_round_trip(spark, tokenizer, window):
    rows = list(enumerate([*texts(5, 80), *ODD_TEXTS, "long words " * 500]))
    ids = {i: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4") for i, t in rows}
    check_packing(rows, packing.pack_documents(docs_of(spark, rows), window=window).collect(), ids, window)


def test_word_cache_equals_the_tokenizer(tokenizer, monkeypatch):
    import public_tokenizers

    monkeypatch.setattr(packing, "CACHED_WORDS", 40)
    own = packing.WordTokenizer(public_tokenizers.path(packing.VOCABULARY))
    all_texts = [t or "" for t in texts(6, 50)] + ODD_TEXTS
    for at in range(0, len(all_texts), 7):
        some = all_texts[at : at + 7]
        expected = [np.array(tokenizer.encode(t, add_special_tokens=False).ids, dtype="<u4").tobytes() for t in some]
        assert own.encode(some) == expected


def test_sum_of_squares_choice_and_pouring():
    packer = packing.Packer(16, 0, max_open=6)
    rng = random.Random(8)
    docs = {}
    for doc in range(300):
        ids = np.arange(rng.randrange(1, 40), dtype="<u4").tobytes()
        docs[doc] = len(ids) // 4
        before = packer.levels.copy()
        packer.add((doc, len(ids) // 4), ids)
        assert packer.held <= 6 and packer.held == packer.levels.sum()
        size = (len(ids) // 4) % 16
        if size and before.sum() < 6 and packer.held >= before.sum():  # no pouring: the sum of squares is the least possible
            options = []
            for h in range(0, 17 - size):
                if h == 0 or before[h]:
                    n = before.copy()
                    n[h] -= h > 0
                    n[h + size] += h + size < 16
                    options.append(int((n**2).sum()))
            assert int((packer.levels**2).sum()) == min(options)
    packer.finish()
    lengths = Counter()
    for (doc, _), _, n, *_ in packer.done:
        lengths[doc] += n
    assert lengths == docs and not packer.open


def test_packing_of_no_documents(spark):
    assert packing.pack_documents(docs_of(spark, [])).count() == 0
    with pytest.raises(ValueError):
        packing.pack_documents(docs_of(spark, []), window=100)


# --- decontamination


def words_brute(text):
    t = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", t)


def contamination_brute(rows, items, span=10):
    windows = set()
    for item, text in items:
        w = words_brute(text)
        n = min(len(w), span)
        windows |= {(tuple(w[i : i + n]), item) for i in range(len(w) - n + 1) if n}
    out = Counter()
    for i, text in rows:
        w, hit, found = words_brute(text), set(), set()
        for win, item in windows:
            for s in range(len(w) - len(win) + 1):
                if tuple(w[s : s + len(win)]) == win:
                    hit |= set(range(s, s + len(win)))
                    found.add(item)
        names = sorted(str(x) for x in found if x is not None)
        out[i, len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)] += 1
    return out


RESULT = ("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


@pytest.mark.parametrize("broadcast_bytes", [decontaminate.BROADCAST_BYTES, 0])
def test_contamination(spark, monkeypatch, broadcast_bytes):
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", broadcast_bytes)
    passage = " ".join(f"p{i}" for i in range(45))
    items = [
        (1, passage), (2, "P3 p4, p5 p6 p7 p8 p9 p10 p11 p12 other words"), (10, "loop " * 14), (3, "the of"), (4, "ÉTÉ ß"), (5, "été ß"),
        (6, ""), (7, None), (None, "zz x1"), (2, "P3 p4, p5 p6 p7 p8 p9 p10 p11 p12 other words"), (8, "p1 p2 p3 p4 p5 p6 p7"),
    ]
    rows = [*AWKWARD, (100, "P3! P4? p5 p6 p7 p8 p9 P10 p11 p12 tail"), (101, "p3 p4 p5 p6 p7 p8 p9 p10 p11"), (102, "Été ß; the-OF")]
    bench = spark.createDataFrame([(i, t, "k") for i, t in items], "item_id long, text string, doc_id string")
    got = decontaminate.contamination(docs_of(spark, rows), bench)
    assert of(got, *RESULT) == contamination_brute(rows, items)
    kept = decontaminate.drop_contaminated(docs_of(spark, rows), bench)
    assert of(kept, "doc_id", "text") == Counter((i, t) for i, t in rows if not list(contamination_brute([(i, t)], items))[0][-1])


def test_contamination_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    got = decontaminate.contamination(docs_of(spark, [(1, "a b"), (2, None)]), none)
    assert of(got, *RESULT) == contamination_brute([(1, "a b"), (2, None)], [])
    some = spark.createDataFrame([(1, "a b")], "item_id long, text string")
    assert decontaminate.contamination(docs_of(spark, []), some).count() == 0


# --- licences


def test_license_scan(spark):
    known = [("L1", "Permission granted, sub-license it.\nUnder this licence."), ("L2", "One line licence!"), ("L3", "One line license")]
    rows = [
        (1, "Copyright (c) 2020 Someone\nPERMISSION granted -- sublicense it\n\n  under this License"),
        (2, "text\none LINE licence.\nmore\nOne line license"), (3, "One-line licence"), (4, None), (5, ""), (6, "Copyright 1999 x"),
        (7, "one line license and more"), (7, "one line license"), (7, "one line license"), (None, "x\n(C) me\none line licence"),
    ]
    table = spark.createDataFrame(known, "license_id string, text string")
    got = of(licenses.scan_licenses(docs_of(spark, rows), table), "doc_id", "whole_license", "line_licenses", "n_license_lines")
    assert got == Counter({
        (1, "L1", "", 0): 1, (2, None, "L2,L3", 2): 1, (3, "L2", "L2,L3", 1): 1, (4, None, "", 0): 1, (5, None, "", 0): 1,
        (6, None, "", 0): 1, (7, None, "", 0): 1, (7, "L2", "L2,L3", 1): 2, (None, None, "L2,L3", 1): 1,
    })
    assert licenses.scan_licenses(docs_of(spark, []), table).count() == 0
    none = licenses.scan_licenses(docs_of(spark, rows), spark.createDataFrame([], "license_id string, text string"))
    assert none.where("whole_license is not null or n_license_lines > 0").count() == 0


def test_license_files(spark, tmp_path):
    """Complete LICENSE files, with and without titles, by the registered query and its SQL."""
    import duckdb

    from quarry.llm import license_texts, queries

    mit = next(x for n, x in licenses.KNOWN if n == "MIT" and x.startswith("Permission"))
    bsd = next(x for n, x in licenses.KNOWN if n == "BSD-2-Clause")
    bsd_3 = bsd.replace("\nTHIS SOFTWARE IS", licenses.THIRD_CLAUSE)
    apache = license_texts.APACHE_2
    files = [
        ("MIT", f"MIT License\n\nCopyright (c) 2020 Someone\n\n{mit}"), ("MIT", f"The MIT License (MIT)\r\n\r\nCopyright © 2020 X\r\n\r\n{mit}\r\n"),
        ("BSD-2-Clause", f"BSD 2-Clause License\n\nCopyright (c) 2020, X\nAll rights reserved.\n\n{bsd}"),
        ("BSD-3-Clause", f"BSD 3-Clause License\n\nCopyright (c) 2020, X\n\n{bsd_3}"), ("BSD-3-Clause", re.sub(r"(?m)^\d\. ", "* ", bsd_3)),
        ("BSD-3-Clause", license_texts.BSD_3_REGENTS), ("Unlicense", license_texts.UNLICENSE), ("Unlicense", "The Unlicense\n" + license_texts.UNLICENSE),
        ("Apache-2.0", apache), ("Apache-2.0", apache.replace("[yyyy] [name of copyright owner]", "2020 Someone")),
        ("Apache-2.0", apache[: apache.index("APPENDIX")]), ("Apache-2.0", apache[apache.index("TERMS AND") :]),
        ("GPL-2.0", license_texts.GPL_2), ("GPL-3.0", license_texts.GPL_3), ("GPL-3.0", license_texts.GPL_3.replace("https:", "http:")),
        ("LGPL-2.1", license_texts.LGPL_21), ("LGPL-3.0", license_texts.LGPL_3), ("MPL-2.0", license_texts.MPL_2),
        (None, "MIT License"), (None, mit[: len(mit) // 2]), (None, license_texts.GPL_3[:20000]),
    ]
    path = str(tmp_path / "documents.parquet")
    spark.createDataFrame([(i, t) for i, (_, t) in enumerate(files)], "doc_id long, text string").write.parquet(path)
    names = ["doc_id", "whole_license", "line_licenses", "n_license_lines"]
    got = of(queries.op4_license_scan(spark, str(tmp_path)), *names)
    assert {(i, name) for i, name, *_ in got} == {(i, name) for i, (name, _) in enumerate(files)}
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{path}/*.parquet'")
    assert got == Counter(con.execute(f"SELECT {', '.join(names)} FROM ({queries.ORACLES['op4_license_scan']})").fetchall())


# --- substring dedup


def substring_brute(rows, window):
    all_words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[s : s + window]) for w in all_words for s in range(len(w) - window + 1))
    out = Counter()
    for (i, _), w in zip(rows, all_words, strict=True):
        gone = {s + k for s in range(len(w) - window + 1) if seen[tuple(w[s : s + window])] > 1 for k in range(window)}
        out[i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)] += 1
    return out


@pytest.mark.parametrize(("window", "seed"), [(2, 1), (5, 2), (6, 3), (35, 4), (35, 5)])
def test_substring_dedup(spark, window, seed):
    rows = [*enumerate(texts(seed)), (None, "a b c a b c a b c a b c"), (2, " ".join("ab" * 30)), (2, " ".join("ab" * 30))]
    got = of(substring.substring_dedup(docs_of(spark, rows), window=window), "doc_id", "n_words", "n_removed", "kept")
    assert got == substring_brute(rows, window)


@pytest.mark.parametrize(("window", "shortest"), [(9, 1), (12, 2), (35, 3), (35, 18)])
def test_substring_levels_do_not_change_the_result(spark, window, shortest):
    rng = random.Random(window)
    shared = [" ".join(rng.choices("abc", k=n)) for n in (3, 5, 9, 12, 20, 36, 70)]
    rows = [(i, " ".join(f"{rng.choice(shared)} u{rng.randrange(40)}" for _ in range(rng.randrange(9)))) for i in range(60)]
    rows += [(60, "a " * 90), (61, "a b " * 50), (61, "a b " * 50)]
    got = of(substring.substring_dedup(docs_of(spark, rows), window=window, shortest=shortest), "doc_id", "n_words", "n_removed", "kept")
    assert got == substring_brute(rows, window)


def test_substring_lengths_double_and_one_place_is_no_repeat(spark, monkeypatch):
    assert substring.ladder(35) == [18, 9] and substring.ladder(35, 3) == [18, 9, 5, 3] and substring.ladder(2) == [1]
    left = {}
    plain = substring.staged

    def spy(df, tag):
        out = plain(df, tag)
        left[tag] = out.count()
        return out

    monkeypatch.setattr(substring, "staged", spy)
    unique = [" ".join(f"{i}w{j}" for j in range(100)) for i in range(20)]
    part = " ".join(f"s{j}" for j in range(12))  # repeats at nine words, not at eighteen
    rows = list(enumerate([*unique, f"{unique[0]} x {part} y", f"{unique[1]} z {part} v {unique[2][:250]}"]))
    got = of(substring.substring_dedup(docs_of(spark, rows)), "doc_id", "n_words", "n_removed", "kept")
    assert got == substring_brute(rows, 35)
    assert left["substring-anchors"] > left["substring-level-9"] > left["substring-level-18"] > 0


def test_substring_dedup_of_no_documents(spark):
    assert substring.substring_dedup(docs_of(spark, [])).count() == 0


def test_substring_places_of_repeated_rows_are_a_set(spark, monkeypatch):
    plain = substring._cut

    def strict(window, batches):
        def looked_at():
            for batch in batches:
                for places in batch.column("whole").to_pylist():
                    assert places is None or len(places) == len(set(places))
                yield batch

        return plain(window, looked_at())

    monkeypatch.setattr(substring, "_cut", strict)
    rows = [(1, " ".join(f"w{i}" for i in range(40)))] * 30 + [(2, "other words")]
    got = of(substring.substring_dedup(docs_of(spark, rows), window=5), "doc_id", "n_words", "n_removed", "kept")
    assert got == substring_brute(rows, 5)


def test_word_hashes_over_blocks(monkeypatch):
    raw = ("longer words " * 50 + "x" * 300 + " é z\x1fq").encode()
    whole = substring.Words(raw).hashes()
    monkeypatch.setattr(substring, "_BLOCK", 64)
    assert (substring.Words(raw).hashes() == whole).all()
    assert substring.Words(raw).n == len(raw.split())
    assert len(set(whole.tolist())) == len(set(raw.split()))


# --- line dedup


def lines_brute(rows, run):
    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    first: dict = {}
    split = {k: k[2].split("\n") for k in order}
    for k in order:
        for s in range(len(split[k]) - run + 1):
            first.setdefault(tuple(split[k][s : s + run]), (k, s))
    out = Counter()
    for i, t in rows:
        if t is None:
            out[i, 0, 0, ""] += 1
            continue
        k = (i is None, i or 0, t)
        w = split[k]
        gone = {s + j for s in range(len(w) - run + 1) if first[tuple(w[s : s + run])] != (k, s) for j in range(run)}
        out[i, len(w), len(gone), "\n".join(x for j, x in enumerate(w) if j not in gone)] += 1
    return out


@pytest.mark.parametrize("run", [1, 2, 3, 5])
def test_line_dedup(spark, run):
    rng = random.Random(run)
    rows: list = [(None, None), (1, ""), (2, "\n\n\n\n\n\n"), (3, "a"), (3, "a"), (4, "a\na\na\na\na\na\na")]
    for i in range(5, 45):
        t = "\n".join(rng.choices(["a", "b", "", " ", "long line of words", "ß"], k=rng.randrange(0, 14)))
        rows += [(i, t)] * rng.choice([1, 1, 2])
    got = of(lines.line_dedup(docs_of(spark, rows), run=run), "doc_id", "n_lines", "n_removed", "kept")
    assert got == lines_brute(rows, run)
    assert lines.line_dedup(docs_of(spark, []), run=run).count() == 0


def test_line_dedup_of_long_lines(spark):
    """One line, or two lines together, of ``long_words`` words go although they are no run of three."""
    one, half = " ".join(f"w{i}" for i in range(6)), ["a b c", "d\te  f"]
    rows = [
        (1, one), (2, f"x\n{one}"), (2, f"x\n{one}"), (3, "\n".join([*half, "y"])), (4, "\n".join(["z", *half])), (5, "a b c"),
        (6, one[:-3]), (7, one[:-3]), (8, f"{one}\nq\n{one}"), (None, one), (9, None), (10, ""), (11, "\n".join(half * 3)),
    ]
    for i, text in enumerate(texts(12, 40)):
        rows.append((20 + i, text))

    order = sorted({(i is None, i or 0, t) for i, t in rows if t is not None})
    first: dict = {}
    split = {k: k[2].split("\n") for k in order}

    def runs(w):
        for size in (1, 2, 3):
            for s in range(len(w) - size + 1):
                if size == 3 or sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in w[s : s + size]) >= 6:
                    yield s, tuple(w[s : s + size])

    for k in order:
        for s, run in runs(split[k]):
            first.setdefault(run, (k, s))
    expected = Counter()
    for i, t in rows:
        k = (i is None, i or 0, t)
        w = split.get(k, [])
        gone = {s + j for s, run in runs(w) if first[run] != (k, s) for j in range(len(run))}
        expected[i, len(w), len(gone), "\n".join(x for j, x in enumerate(w) if j not in gone)] += 1
    assert expected[2, 2, 1, "x"] == 2 and expected[4, 3, 2, "z"] == 1 and expected[8, 3, 2, "q"] == 1 and expected[7, 1, 0, one[:-3]] == 1
    got = of(lines.line_dedup(docs_of(spark, rows), run=3, long_words=6), "doc_id", "n_lines", "n_removed", "kept")
    assert got == expected


def test_exact_dedup_refuses_more_buckets_than_ids_have_room_for(spark, monkeypatch):
    monkeypatch.setattr(exact, "BUCKET_BITS", 2)
    with pytest.raises(ValueError, match="bucket_bytes"):
        exact.exact_classes(docs_of(spark, [(i, f"text {i}") for i in range(50)]), bucket_bytes=8)


# --- chat formatting


def legal(roles):
    """Whether the sequence of roles is a closed legal conversation."""
    return re.fullmatch(r"(s?(ua)+)?", "".join(r[0] for r in roles)) is not None


def repair_brute(codes):
    """Least cost by trying every action: a path search over (turn, state, cost)."""
    best = {0: 0}
    for r in codes:
        new: dict = {}
        for s, c in best.items():
            for n in range(3):
                frontier = [(s, c)]
                for _ in range(n):
                    frontier = [(x, k + chat.INSERT) for y, k in frontier for x in chat.NEXT[y]]
                for y, k in frontier:
                    for x in chat.NEXT[y]:
                        cost = k + (0 if x == r else chat.NAME_UNKNOWN if r == 0 else chat.RELABEL)
                        new[x] = min(new.get(x, 10**9), cost)
            if s:
                cost = c + chat.MERGE + (0 if s == r else chat.NAME_UNKNOWN if r == 0 else chat.RELABEL)
                new[s] = min(new.get(s, 10**9), cost)
        best = new
    return min(c + chat.INSERT * len(chat.ENDS[s]) for s, c in best.items())


class Turn:
    """An output turn put together from its rows."""

    def __init__(self, rows):
        rows = sorted(rows, key=lambda r: r.segment)
        assert len({(r.conv_id, r.out_turn, r.role, r.cost) for r in rows}) == 1
        self.conv_id, self.out_turn, self.role, self.cost = rows[0].conv_id, rows[0].out_turn, rows[0].role, rows[0].cost
        self.actions = ",".join(r.actions for r in rows)
        self.n_source = sum(r.n_source for r in rows)
        self.rendered = "".join(r.rendered for r in rows)
        assert self.rendered.count(chat.OPEN) == self.rendered.count(chat.CLOSE) == 1


def turns_of(df):
    by = defaultdict(list)
    for r in df.collect():
        by[r.conv_id, r.out_turn].append(r)
    return [Turn(rows) for rows in by.values()]


def test_chat_repair(spark):
    rng = random.Random(9)
    names = {0: [None, "tool", ""], 1: ["system", " System "], 2: ["user", "human"], 3: ["assistant", "bot", "ASSISTANT"]}
    rows, expected, source = [], {}, Counter()
    for conv in [None, *range(40)]:
        codes = [rng.randrange(0, 4) if conv != 3 else 2 for _ in range(rng.randrange(1, 14))]
        for turn, c in enumerate(codes):
            rows.append((conv, turn, rng.choice(names[c]), rng.choice([None, "", "hi", f"x{turn}", "a <|im_end|> b"]), "extra"))
        expected[conv] = repair_brute(codes)
        source[conv] = len(codes)
    rng.shuffle(rows)
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, seg string")
    results = []
    for segment in (1, 3, 512):
        got = turns_of(chat.format_chats(table, segment=segment))
        by = defaultdict(list)
        for r in got:
            by[r.conv_id].append(r)
        assert set(by) == set(expected)
        for conv, own in by.items():
            own.sort(key=lambda r: r.out_turn)
            assert [r.out_turn for r in own] == list(range(len(own)))
            assert legal([r.role for r in own])
            assert {r.cost for r in own} == {expected[conv]}
            assert sum(r.n_source for r in own) == source[conv]
            assert all(r.rendered.startswith(f"<|im_start|>{r.role}\n") and r.rendered.count("<|im_end|>") == 1 for r in own)
            counts = Counter(a for r in own for a in r.actions.split(","))
            assert counts["merge"] + chat.INSERT * counts["insert"] <= expected[conv]
        results.append(sorted((str(r.conv_id), r.out_turn, r.role, r.cost) for r in got))
    assert chat.format_chats(table.limit(0)).count() == 0


def test_chat_ties_and_texts(spark):
    rows = [(1, 0, "user", "a"), (1, 0, "user", "a"), (1, None, "system", "s"), (1, 1, "assistant", None)]
    got = chat.format_chats(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")).orderBy("out_turn").collect()
    assert [(r.role, r.actions, r.rendered) for r in got] == [
        ("system", "keep", "<|im_start|>system\ns<|im_end|>\n"),
        ("user", "keep,merge", "<|im_start|>user\na\na<|im_end|>\n"),
        ("assistant", "keep", "<|im_start|>assistant\n<|im_end|>\n"),
    ]


def test_chat_segments_of_repeated_and_null_turns(spark, monkeypatch):
    """A segment has a bounded number of turns also where turns, or whole rows, repeat or are null."""
    rng, sizes, plain = random.Random(10), [], chat.staged

    def spy(df, tag):
        out = plain(df, tag)
        if tag == "chat-segments":
            sizes.extend(r.n for r in out.select(F.size("turns").alias("n")).collect())
        return out

    monkeypatch.setattr(chat, "staged", spy)
    names = {0: "tool", 1: "system", 2: "user", 3: "assistant"}
    numbers = {None: lambda: rng.randrange(2), 1: lambda: 0, 2: lambda: None, 3: lambda: rng.choice([None, 7])}
    rows = [(conv, number(), rng.randrange(4), rng.choice(["a", "b"])) for conv, number in numbers.items() for _ in range(70)]
    rows += [(4, 0, 2, "same")] * 60 + [(conv, 0, 2, "x") for conv in range(5, 30)]
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn or 0, names[role], text, role))
    table = spark.createDataFrame([(c, n, names[r], t) for c, n, r, t in rows], "conv_id long, turn long, role string, text string")
    got = defaultdict(list)
    for r in turns_of(chat.format_chats(table.repartition(5), segment=8)):
        got[r.conv_id].append(r)
    assert max(sizes) == 8 and sum(sizes) == len(rows) and sizes.count(8) >= 4 * 8 + 7
    assert set(got) == set(by)
    for conv, own in got.items():
        own.sort(key=lambda r: r.out_turn)
        assert [r.out_turn for r in own] == list(range(len(own))) and legal([r.role for r in own])
        assert {r.cost for r in own} == {repair_brute([x[-1] for x in sorted(by[conv])])}
        bodies = [r.rendered.removeprefix(f"<|im_start|>{r.role}\n").removesuffix("<|im_end|>\n") for r in own if r.n_source]
        assert "\n".join(bodies).split("\n") == [x[3] for x in sorted(by[conv])]


def test_chat_of_200000_turns_of_one_role(spark, monkeypatch):
    """Rows stay small however long a conversation is, and its null id too: a turn of all its texts goes over rows."""
    n, widest, plain = 200_000, [], chat.staged

    def spy(df, tag):
        out = plain(df, tag)
        if tag == "chat-runs":
            widest.append(out.agg(F.max(F.size("parts"))).first()[0])
        return out

    monkeypatch.setattr(chat, "staged", spy)
    turns = spark.range(2 * n, numPartitions=8).select(
        F.when(F.col("id") < n, 1).alias("conv_id"), (F.col("id") % n).alias("turn"), F.lit("user").alias("role"), F.lit("some text").alias("text")
    )
    out = chat.format_chats(turns).persist()
    assert len(widest) == 2 and max(widest) <= chat.FAN
    assert out.agg(F.max(F.length("rendered"))).first()[0] < 100 * chat.SEGMENT
    for conv in (1, None):
        own = out.where(F.col("conv_id").eqNullSafe(F.lit(conv).cast("long")))
        sums = own.groupBy("out_turn", "role").agg(F.sum("n_source").alias("n"), F.count(F.lit(1)).alias("rows")).orderBy("out_turn").collect()
        assert legal([r.role for r in sums]) and sum(r.n for r in sums) == n
        whole = Turn(own.where("out_turn = 0").collect())
        assert whole.n_source == n and whole.rendered.count("some text") == n
    out.unpersist()


# --- classifiers


def labelled_rows(seed, n=400):
    rng = random.Random(seed)
    common = [f"word{k}" for k in range(200)]
    docs, labels = [], []
    for i in range(n):
        words, bad = rng.choices(common, k=rng.randrange(5, 80)), rng.random() < 0.3
        if bad:
            for _ in range(4):
                words[rng.randrange(len(words))] = rng.choice(["grolsh", "vexnit", "murkwad"])
        docs.append((i, " ".join(words)))
        if rng.random() < 0.8:
            labels.append((i, int(not bad), int(bad)))
    return docs + [(None, None), (n, ""), (n + 1, None), (5, docs[5][1])], labels + [(None, 1, 1), (7, None, None), (10**6, 1, 0)]


@pytest.mark.parametrize(("module", "label", "folds", "fold"), [(toxicity, "toxic", 3, 1), (quality, "quality", 4, 2)])
def test_classifiers_on_held_out_rows(spark, module, label, folds, fold):
    docs, labels = labelled_rows(11)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    score = getattr(module, label if label == "quality" else "toxicity")
    got = score(docs_of(spark, docs), table).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in docs)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % folds == fold) for r in got)
    truth = {i: (t if label == "toxic" else q) for i, q, t in labels if q is not None}
    tested = [(r.score, truth[r.doc_id]) for r in got if r.held_out and r.doc_id in truth]
    good, bad = [s for s, y in tested if y], [s for s, y in tested if not y]
    auc = np.mean([(a > b) + (a == b) / 2 for a in good for b in bad])
    assert auc > 0.97
    # Held-out labels are not learned: turned round, they change nothing.
    turned = [(i, 1 - q, 1 - t) if q is not None and i is not None and zlib.crc32(str(i).encode()) % folds == fold else (i, q, t) for i, q, t in labels]
    again = score(docs_of(spark, docs), spark.createDataFrame(turned, "doc_id long, quality int, toxic int")).collect()
    assert sorted((str(r.doc_id), round(r.score, 6)) for r in got) == sorted((str(r.doc_id), round(r.score, 6)) for r in again)


def buckets_brute(text):
    """Hashes of the n-grams of a text, each n-gram by itself, with integers."""
    lowered, out, low = (text or "").lower(), set(), 0xFFFFFFFF
    for n in toxicity.ORDERS:
        for at in range(len(lowered) - n + 1):
            h = 0
            for c in lowered[at : at + n]:
                h = (h * 0x01000193 + ord(c)) & low
            h = ((h ^ (h >> 15)) * 0x85EBCA6B) & low
            out.add((h ^ (h >> 13)) % toxicity.BUCKETS)
    return out


def learnable(docs, labels, column, folds, fold):
    """Texts and labels that may be learned from, a row per document."""
    known = {}
    for row in labels:
        i, y = row[0], row[column]
        if i is not None and y is not None and zlib.crc32(str(i).encode()) % folds != fold:
            known[i] = max(known.get(i, 0), y)
    return [(t, known[i]) for i, t in docs if i in known], known


def sigmoid(z):
    return 1 / (1 + math.exp(-z))


def test_toxicity_against_brute_force(spark):
    docs, labels = labelled_rows(14)
    docs += [(1000, "Grolsh ÄÖ 日本語 MURKWAD vexnit"), (1001, "abc"), (1002, "abcd")]
    known, all_known = learnable(docs, labels, 2, toxicity.FOLDS, toxicity.FOLD)
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    n_features = 200
    model = toxicity.fit_model(docs_of(spark, docs), table, features=n_features)
    # The buckets and their ratios, counted in plain Python.
    pos, neg = (sum(1 for _, y in known if y == v) for v in (1, 0))
    held = {0: Counter(), 1: Counter()}
    for text, y in known:
        held[y].update(buckets_brute(text))

    def clear(b):
        p, q, both = held[1][b] / pos, held[0][b] / neg, (held[1][b] + held[0][b]) / (pos + neg)
        return (p - q) * (p - q) / (both * (1 - both) + 1 / (pos + neg))

    ranked = sorted({*held[0], *held[1]}, key=lambda b: (-round(clear(b), 12), b))
    edge = clear(ranked[n_features - 1])
    assert all(clear(b) >= edge - 1e-9 for b in model.buckets) and len(model.buckets) == n_features
    assert {b for b in ranked if clear(b) > edge + 1e-9} <= set(model.buckets)
    ratio = {b: math.log((held[1][b] + 1) / (pos + 2)) - math.log((held[0][b] + 1) / (neg + 2)) for b in model.buckets}
    # The weights are the least of the regression's loss: its slope, worked out here, is zero.
    beta = {b: w / ratio[b] if ratio[b] else 0.0 for b, w in zip(model.buckets, model.weights, strict=True)}
    odds = (sum(all_known.values()) + 0.5) / (sum(1 - y for y in all_known.values()) + 0.5)
    own = model.intercept - (math.log(odds) - math.log((pos + 0.5) / (neg + 0.5)))
    slope = Counter({b: toxicity.REGULARISATION * beta[b] for b in model.buckets})
    bias = 0.0
    for text, y in known:
        found = buckets_brute(text) & set(model.buckets)
        off = (sigmoid(own + sum(beta[b] * ratio[b] for b in found)) - y) / len(known)
        bias += off
        for b in found:
            slope[b] += off * ratio[b]
    assert abs(bias) < 1e-3 and max(map(abs, slope.values())) < 1e-3
    # Every score is the sum of the weights of the buckets that the text holds.
    weight = dict(zip(model.buckets, model.weights, strict=True))
    got = docs_of(spark, docs).select("doc_id", "text", toxicity.scorer(model)("text").alias("score")).collect()
    assert len(got) == len(docs)
    for r in got:
        assert r.score == pytest.approx(sigmoid(model.intercept + sum(weight.get(b, 0.0) for b in buckets_brute(r.text))), abs=1e-9)


def test_quality_against_brute_force(spark, monkeypatch):
    import zstandard

    made, curve = [], []
    plain, fit = quality._dictionary, quality.labelled.fit
    monkeypatch.setattr(quality, "_dictionary", lambda texts: made.append(plain(texts)) or made[-1])
    monkeypatch.setattr(quality.labelled, "fit", lambda *a: curve.append((a[0].collect(), a[1], fit(*a))) or curve[-1][2])
    docs, labels = labelled_rows(15)
    docs.append((1000, " ".join(f"word{k % 190} grolsh" for k in range(2000))))  # several blocks
    known, all_known = learnable(docs, labels, 1, quality.FOLDS, quality.FOLD)
    got = quality.quality(docs_of(spark, docs), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")).collect()
    good, bad = made

    def size(raw, dictionary):
        c = zstandard.ZstdCompressor(
            level=quality.LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary), write_content_size=False, write_dict_id=False
        )
        return sum(len(c.compress(raw[at : at + quality.BLOCK])) for at in range(0, len(raw), quality.BLOCK))

    def difference(text):
        raw = (text or "").encode()
        return (size(raw, bad) - size(raw, good)) / (size(raw, bad) + size(raw, good)) if raw else 0.0

    # The curve is fitted on learnable documents alone, none of them in a dictionary's half.
    ((rows, odds, ((weight,), intercept)),) = curve
    known_points = Counter((round(difference(t), 9), y) for t, y in known)
    points = Counter((round(float(r.features[0]), 9), int(r.y)) for r in rows)
    assert points <= known_points and 0.3 * len(known) < points.total() < 0.7 * len(known)
    pos = sum(n for (_, y), n in points.items() if y)
    assert odds == pytest.approx((sum(all_known.values()) + 0.5) / (sum(1 - y for y in all_known.values()) + 0.5))
    own = intercept - (math.log(odds) - math.log((pos + 0.5) / (points.total() - pos + 0.5)))
    off = [(n * (sigmoid(own + weight * d) - y), d) for (d, y), n in points.items()]
    assert abs(sum(o for o, _ in off)) < 1e-2 * len(off) and abs(sum(o * d for o, d in off)) < 1e-2 * len(off)
    texts_of = dict(docs)
    for r in got:
        if r.doc_id is not None:
            assert r.score == pytest.approx(sigmoid(intercept + weight * difference(texts_of[r.doc_id])), abs=1e-9)


@pytest.mark.parametrize("module", [toxicity, quality])
def test_classifiers_without_labels(spark, module):
    name = "toxicity" if module is toxicity else "quality"
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    got = getattr(module, name)(docs_of(spark, [(1, "a"), (2, None)]), none).collect()
    assert [(r.score, r.predicted) for r in got] == [(0.0, 0)] * 2
    assert getattr(module, name)(docs_of(spark, []), none).count() == 0


def test_drop_toxic_keeps_columns(spark):
    docs, labels = labelled_rows(12)
    table = docs_of(spark, docs)
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    kept = toxicity.drop_toxic(table, known)
    assert kept.columns == table.columns
    clean = {i for i, q, t in labels if t == 0 and i is not None} & {i for i, _ in docs}
    left = {r.doc_id for r in kept.collect()}
    assert len(clean & left) >= 0.98 * len(clean)


def test_features_of_a_long_text_come_from_all_of_it(monkeypatch):
    text = "abcdefgh " * 50 + "unusualending"
    whole = set(np.unique(np.concatenate(list(toxicity.buckets_of(text)))).tolist())
    monkeypatch.setattr(toxicity, "_STEP", 16)
    assert set(np.unique(np.concatenate(list(toxicity.buckets_of(text)))).tolist()) == whole


def test_sample_is_bounded_and_held_in(spark):
    _, labels = labelled_rows(13)
    rows, odds = labelled.sample(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"), "toxic", "doc_id", 3, 1, 20)
    got = rows.collect()
    assert Counter(r.y for r in got) == {0: 20, 1: 20} and 0 < odds < 1
    assert all(zlib.crc32(str(r.id).encode()) % 3 != 1 for r in got)
