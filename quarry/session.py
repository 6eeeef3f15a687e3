"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# Settings every session of ours gets. Sizes (shuffle partitions, memory) are
# not among them: they are the submitter's, and a builder would override them.
DEFAULT_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    # Checkpoint files of DataFrames that are gone are deleted by the cleaner.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    master: str | None = None,
    shuffle_partitions: int | None = None,
    app_name: str = "quarry",
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with AQE on and the UI off.

    Shuffle partitions and memory stay as submitted unless passed here.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = dict(DEFAULT_CONF)
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra_conf or {})
    for key, value in conf.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    ensure_checkpoint_dir(spark)
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the reliable checkpoint folder, setting one only if unset.

    On a cluster ``spark.checkpoint.dir`` names a shared folder and is used as
    is. Only a local-mode session (tests) without one gets a fresh folder
    under the system temp directory; a cluster session without one is an
    error, since a machine-local folder would not survive executor loss.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        try:
            configured = spark.conf.get("spark.checkpoint.dir")
        except Exception:  # noqa: BLE001 - conf lookups raise on unknown keys
            configured = None
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a shared folder (e.g. on HDFS or object storage)")
        configured = tempfile.mkdtemp(prefix="quarry-ckpt-", dir=os.environ.get("TMPDIR", "/tmp"))
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def reliable(df, eager: bool = True):
    """Cut lineage with a reliable checkpoint in the shared folder.

    The input is persisted while the checkpoint is written, so the eager
    checkpoint computes it once (a bare checkpoint recomputes it to write).
    """
    from pyspark.storagelevel import StorageLevel

    ensure_checkpoint_dir(df.sparkSession)
    if not eager:
        return df.checkpoint(eager=False)
    held = df.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return held.checkpoint(eager=True)
    finally:
        held.unpersist()


_SCOPES: list[list[str]] = []


def claimed(path: str) -> str:
    """``path``, a folder about to be written, which the innermost ``scratch`` scope will delete."""
    if _SCOPES:
        _SCOPES[-1].append(path)
    return path


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """A scope that owns the folders that operators write in the shared folder on the way.

    At its end, also after an error, they are deleted. Results are plans over
    them, so they must be written or collected inside. Without a scope the folders
    stay: nobody can tell when the last plan that reads them is gone.
    """
    own: list[str] = []
    _SCOPES.append(own)
    try:
        yield
    finally:
        _SCOPES.remove(own)
        delete_shared(spark, *own)


def delete_shared(spark: SparkSession, *folders: str) -> None:
    """Deletes folders that an operator wrote on the way and that no plan reads any more."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    for folder in folders:
        at = jvm.org.apache.hadoop.fs.Path(folder)
        at.getFileSystem(conf).delete(at, True)


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder under the shared folder, to be written. The innermost ``scratch`` scope of this call will delete it."""
    return claimed(f"{ensure_checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}")


def write_shared(df: DataFrame, name: str, folder: str | None = None, by: tuple[str, ...] = ()) -> DataFrame:
    """Write ``df`` once as parquet under the shared folder and read it back.

    Cuts the lineage with one copy of the data, which any executor can read. In
    a ``scratch`` scope it goes with it. With ``folder`` it is written there, in folders by the columns ``by``.
    """
    spark = df.sparkSession
    path = folder or shared_folder(spark, name)
    df.write.partitionBy(*by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def write_united(frames: list[DataFrame], folder: str) -> None:
    """Adds the rows of all frames to ``folder``, closely packed, by the tasks that each frame has alone.

    Spark 4.1 puts partitions of a union's inputs together where all are dealt alike: frames of one task each would be one task.
    """
    spark, key = frames[0].sparkSession, "spark.sql.unionOutputPartitioning"
    while len(frames) > 1:  # in twos, for a plan of little depth
        frames = [a.union(b) for a, b in zip(frames[::2], frames[1::2], strict=False)] + frames[len(frames) // 2 * 2 :]
    before = spark.conf.get(key, None)
    spark.conf.set(key, "false")
    try:
        frames[0].write.mode("append").option("compression", "zstd").parquet(folder)
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def ship_package(spark: SparkSession) -> None:
    """Make ``quarry`` importable in the Python workers of this context.

    Operators that run Python inside tasks need the package on every executor; like ``--py-files``, the package is
    zipped once on the driver and registered with ``addPyFile``, which
    serves it to executors (and to local-mode workers) through Spark.
    """
    import zipfile

    sc = spark.sparkContext
    if getattr(sc, "_quarry_shipped", False):  # the mark goes with the context
        return
    pkg_dir = os.path.dirname(os.path.abspath(__file__))
    root = os.path.dirname(pkg_dir)
    fd, path = tempfile.mkstemp(prefix="quarry-pkg-", suffix=".zip")
    os.close(fd)
    with zipfile.ZipFile(path, "w", zipfile.ZIP_DEFLATED) as zf:
        for base, _dirs, files in os.walk(pkg_dir):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(base, name)
                    zf.write(full, os.path.relpath(full, root))
    sc.addPyFile(path)
    sc._quarry_shipped = True
