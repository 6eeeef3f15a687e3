"""Checkpoint-folder rules: read from the session, local fallback only."""

import os

import pytest

from quarry.session import ensure_checkpoint_dir


class _Conf:
    def __init__(self, values):
        self.values = values

    def get(self, key, default=None):
        if key in self.values:
            return self.values[key]
        if default is None and not isinstance(self, _SparkConf):
            raise KeyError(key)
        return default


class _SparkConf(_Conf):
    pass


class _Context:
    def __init__(self, master, conf):
        self.master = master
        self._conf = _SparkConf(conf)
        self.dir = None

    def getCheckpointDir(self):
        return self.dir

    def getConf(self):
        return self._conf

    def setCheckpointDir(self, d):
        self.dir = d


class _Session:
    def __init__(self, master, conf=None):
        self.sparkContext = _Context(master, conf or {})
        self.conf = _Conf(conf or {})


def test_configured_folder_is_used():
    s = _Session("spark://cluster:7077", {"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
    assert ensure_checkpoint_dir(s) == "hdfs:///shared/ckpt"


def test_cluster_without_folder_is_an_error():
    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(_Session("spark://cluster:7077"))


def test_local_session_gets_a_temp_folder():
    d = ensure_checkpoint_dir(_Session("local[2]"))
    assert "quarry-ckpt-" in d


def test_real_session_has_a_folder(spark):
    assert ensure_checkpoint_dir(spark)


def test_submitted_sizes_are_kept(tmp_path):
    """Shuffle partitions and memory given at submit time survive build_session()."""
    import os
    import subprocess
    import sys

    code = (
        "from quarry.session import build_session; s = build_session('local[1]');"
        "print('GOT', s.conf.get('spark.sql.shuffle.partitions'), s.sparkContext.getConf().get('spark.driver.memory'))"
    )
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    args = "--conf spark.sql.shuffle.partitions=4000 --driver-memory 900m pyspark-shell"
    env = os.environ | {"PYSPARK_SUBMIT_ARGS": args, "PYTHONPATH": root}
    out = subprocess.run([sys.executable, "-c", code], env=env, capture_output=True, text=True, timeout=120, cwd=tmp_path)
    assert "GOT 4000 900m" in out.stdout, out.stderr[-500:]


def folders_of(spark):
    from quarry.session import ensure_checkpoint_dir

    root = ensure_checkpoint_dir(spark).removeprefix("file:")
    return {os.path.join(base, d) for part in ("tables", "models") for base, dirs, _ in os.walk(f"{root}/{part}") for d in dirs}


def test_scratch_folders_go_with_their_scope(spark):
    from quarry.operators import bitmaps, itemsets
    from quarry.session import scratch

    df = spark.createDataFrame([(["a", "b", "c"],), (["a", "b", "c"],), (["a"],)], "items array<string>")
    before = folders_of(spark)
    with scratch(spark):
        rows = [tuple(r) for r in bitmaps.frequent_triples(df, threshold=1).collect()]
        with scratch(spark):
            inner = itemsets.frequent_pairs(df, threshold=1).collect()
            inside = folders_of(spark)
        between = folders_of(spark)
    assert rows == [("a", "b", "c", 2)] and len(inner) == 3
    assert inside > between > before and folders_of(spark) == before


def test_scratch_folders_go_after_an_error_and_stay_without_a_scope(spark):
    from quarry.session import scratch, write_shared

    before = folders_of(spark)
    with pytest.raises(RuntimeError, match="stop"), scratch(spark):
        write_shared(spark.range(3), "lost")
        raise RuntimeError("stop")
    assert folders_of(spark) == before
    assert write_shared(spark.range(3), "kept").count() == 3 and len(folders_of(spark)) == len(before) + 1
