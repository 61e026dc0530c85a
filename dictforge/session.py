"""Session settings and the shared scratch folder."""

from __future__ import annotations

import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Every setting here concerns plans, not one machine, so it also holds on a cluster.
PLAN_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # The seen-set of a stream grows without end; it belongs on disk, not on the heap.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def local_session(cpus: int | str = 8, shuffle_partitions: int = 8, **settings: str) -> SparkSession:
    """Session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("dictforge")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in {**PLAN_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


# Paths that this process has given out, until ``remove_staged``.
_GIVEN: list[str] = []


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder named by ``spark.checkpoint.dir``."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="dictforge-")
        spark.conf.set("spark.checkpoint.dir", base)
    _GIVEN.append(f"{base.rstrip('/')}/dictforge/{uuid.uuid4().hex}")
    return f"{_GIVEN[-1]}/{name}"


def remove_staged(spark: SparkSession) -> int:
    """Delete the folders that ``scratch_path`` gave to this process; the number of those that were there.

    Call it when no frame that reads them is used any more.
    """
    removed = 0
    while _GIVEN:
        path = spark._jvm.org.apache.hadoop.fs.Path(_GIVEN.pop())
        removed += bool(path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True))
    return removed


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as a table in the shared folder and read it back.

    The written table cuts the lineage and survives the loss of executors, and unlike an RDD
    checkpoint it keeps column pruning and filter pushdown for the passes that follow. What was shuffled
    for it is removed once it is written, as nothing reads that again.
    """
    path = scratch_path(df.sparkSession, name)
    with shuffles_removed(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove the shuffle files of the queries carried out inside, each when it ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)
