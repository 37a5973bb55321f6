"""Session defaults and the two ways this library cuts lineage.

A cluster names one folder that every executor can reach in ``spark.checkpoint.dir``. Whatever outlives a
stage goes there: never to a local folder, never to ``localCheckpoint``. Only where the setting is absent
(a laptop, a test) does the library pick a folder itself.
"""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def build_session(app: str = "marajo", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, UTC and skew handling on; ``conf`` overrides any default."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.showConsoleProgress": "false",
        "spark.python.sql.dataFrameDebugging.enabled": "false",  # a call site for each column makes wide plans slow
    } | conf
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints: that of the setting, else the context's own.

    Where neither is set, a local master gets a temporary folder, which goes when the process ends; on a cluster that
    would be another folder on every machine, so there it is an error.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get()
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="marajo-checkpoint-")
    atexit.register(shutil.rmtree, folder, ignore_errors=True)
    spark.sparkContext.setCheckpointDir("file://" + folder)
    return "file://" + folder


_WRITTEN: list[str] = []


def remember(path: str) -> str:
    """``path``, which :func:`discard_stashes` will delete; for folders of files that tasks write themselves."""
    _WRITTEN.append(path)
    return path


def written_so_far() -> int:
    """A mark for :func:`discard_stashes`."""
    return len(_WRITTEN)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def discard_stashes(spark: SparkSession, since: int = 0, keep: DataFrame | None = None) -> int:
    """Delete what this process has written to the shared folder, when its readers are done; returns how many tables and
    folders. ``since`` is a mark from before, ``keep`` a stashed frame that stays."""
    held = getattr(keep, "_stash", None)
    gone = [p for p in _WRITTEN[since:] if p != held]
    for path in gone:
        _delete(spark, path)
    _WRITTEN[since:] = [p for p in _WRITTEN[since:] if p == held]
    return len(gone)


def forget(df: DataFrame) -> None:
    """Delete one stashed frame's table; nothing may read it any more."""
    path = getattr(df, "_stash", None)
    if path in _WRITTEN:
        _delete(df.sparkSession, path)
        _WRITTEN.remove(path)


_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _set(spark: SparkSession, conf: dict[str, str]):
    before = {key: spark.conf.get(key, None) for key in conf}
    try:
        for key, value in conf.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def unfused(spark: SparkSession):
    """For the jobs inside: dozens of parsed columns, fused into one method, are too long for the JVM to compile, which then
    interprets them; column by column they are compiled."""
    return _set(spark, {"spark.sql.codegen.wholeStage": "false"})


def spread(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly over three tasks a core at least: for narrow rows in few files of which much is made."""
    tasks = 3 * df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(tasks) if df.rdd.getNumPartitions() < tasks else df


def stash(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and read it back: a compressed, column-prunable cut.

    The written table stands for all shuffles behind it, so this write alone runs under the setting that has Spark
    delete a query's shuffle files at its end; by default they stay until the driver collects its garbage.
    """
    spark = df.sparkSession
    path = f"{checkpoint_root(spark).rstrip('/')}/marajo-{name}-{uuid.uuid4().hex}"
    with _set(spark, {_CLEANUP: "true"}):
        df.write.option("compression", "zstd").parquet(remember(path))
    held = spark.read.schema(df.schema).parquet(path)
    held._stash = path
    return held


#: Rows (a key and at most a few hundred bytes) that may be sent to every executor.
BROADCAST_ROWS = 50_000


def small_side(df: DataFrame, name: str, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` written once and counted: marked for broadcast at ``limit`` rows or fewer, else left to a shuffled join."""
    from pyspark.sql import functions as F

    held = stash(df, name)
    return F.broadcast(held) if held.count() <= limit else held


def settle(df: DataFrame, before: DataFrame | None = None) -> DataFrame:
    """A small iterated table, written to the shared folder; ``before`` is the round that it was made of, which is deleted now."""
    held = stash(df, "settled")
    if before is not None:
        forget(before)
    return held
