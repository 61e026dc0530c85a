"""Dictionary tables laid out by key, so that joins and lists by that key need no exchange."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictforge.operators.skew import MIN_HOT_ROWS, hot_keys
from dictforge.session import scratch_path

BUCKETS = 64


@dataclass(frozen=True)
class Bucketed:
    """A table in two parts: ``usual`` rows bucketed by ``key``, and the rows of its hot keys, dealt evenly."""

    key: str
    usual: DataFrame
    hot: DataFrame
    hot_keys: tuple

    @property
    def whole(self) -> DataFrame:
        return self.usual.unionByName(self.hot)


def write_bucketed(
    df: DataFrame, key: str, name: str, buckets: int = BUCKETS, path: str | None = None,
    hot: list | None = None, min_hot_rows: int = MIN_HOT_ROWS,
) -> Bucketed:
    """Write ``df`` bucketed and sorted by ``key`` as an external table below ``path``, by default in the shared folder.

    Rows of hot keys (``hot``, by default those a sketch finds) are kept apart, as a bucket is read by one task. Tables that
    shall be joined take the same ``buckets`` and the same ``hot``.
    """
    spark = df.sparkSession
    hot = hot_keys(df, key, min_hot_rows) if hot is None else hot
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    path = path or scratch_path(spark, name)
    table = f"{name}_{uuid.uuid4().hex}"
    placed = df.where(~is_hot).repartition(buckets, key)
    placed.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", f"{path}/usual").saveAsTable(table)
    df.where(is_hot).write.mode("overwrite").parquet(f"{path}/hot")
    return Bucketed(key, spark.table(table), spark.read.schema(df.schema).parquet(f"{path}/hot"), tuple(hot))


def register_bucketed(
    spark: SparkSession, path: str, schema: str, key: str, name: str, buckets: int, hot: list | tuple = ()
) -> Bucketed:
    """A table that ``write_bucketed`` wrote in another session, known to this one's catalog again."""
    table = f"{name}_{uuid.uuid4().hex}"
    spark.sql(
        f"CREATE TABLE {table} ({schema}) USING parquet CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS "
        f"LOCATION '{path}/usual'"
    )
    return Bucketed(key, spark.table(table), spark.read.schema(schema).parquet(f"{path}/hot"), tuple(hot))


def bucketed_dictionary(tables: dict[str, DataFrame], buckets: int = BUCKETS) -> dict[str, Bucketed]:
    """Meanings, extensions and links by ``MeaningId``; a meaning that is hot in one is kept apart in all three."""
    names = ("extensions", "extension_links")
    hot = sorted({k for name in names for k in hot_keys(tables[name], "MeaningId")})
    return {
        name: write_bucketed(tables[name], "MeaningId", name, buckets, hot=hot) for name in ("meanings", *names)
    }
