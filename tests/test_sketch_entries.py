"""Entries of vectors in a batch, read as whole columns."""

import numpy as np
import pyarrow as pa

from quarry.operators import sketch_pca

_VECTOR = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])


def test_entries_are_read_by_column_and_not_by_row(monkeypatch):
    """every row of a batch was turned into Python lists, in each pass."""
    monkeypatch.setattr(sketch_pca, "_ENTRIES", 5)
    rng = np.random.default_rng(1)
    rows, want = [], []
    for i in range(40):
        if i % 4 == 3:
            x = rng.random(4)
            rows.append({"type": 1, "size": None, "indices": None, "values": x.tolist()})
            want.append((np.arange(4), x))
        else:
            at = np.sort(rng.choice(9, int(rng.integers(0, 4)), replace=False))
            x = rng.random(len(at))
            rows.append({"type": 0, "size": 9, "indices": at.tolist(), "values": x.tolist()})
            want.append((at, x))
    whole = pa.RecordBatch.from_arrays([pa.array(rows, _VECTOR)], ["v"])
    for batch, expected in ((whole, want), (whole.slice(3, 30), want[3:33]), (whole.slice(0, 0), [])):
        got, sizes = [], []
        for starts, cols, values in sketch_pca._sparse(batch):
            ends = [*starts[1:], len(cols)]
            got += [(cols[i:j], values[i:j]) for i, j in zip(starts, ends, strict=True)]
            sizes.append(len(cols))
            if len(starts) > 1:
                assert starts[-1] < 5  # a part ends with the row that fills it
        assert len(got) == len(expected)
        for (a, x), (b, y) in zip(got, expected, strict=True):
            assert a.tolist() == b.tolist() and x.tolist() == y.tolist()
        assert all(n >= 5 for n in sizes[:-1])


def test_reading_entries_takes_no_time_by_row():
    import time

    n = 2000
    at = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 300), pa.array(np.tile(np.arange(300, dtype=np.int32), n)))
    x = pa.ListArray.from_arrays(pa.array(np.arange(n + 1, dtype=np.int32) * 300), pa.array(np.ones(300 * n)))
    v = pa.StructArray.from_arrays([pa.array(np.zeros(n, np.int8)), pa.array(np.full(n, 300, np.int32)), at, x], fields=list(_VECTOR))
    batch, start = pa.RecordBatch.from_arrays([v], ["v"]), time.process_time()
    assert sum(len(c) for _, c, _ in sketch_pca._sparse(batch)) == 300 * n
    assert time.process_time() - start < 0.15  # 0.003 s; row by row it took 0.35 s
