"""Records at positions: chunk files that keep their order, and an index of how many rows each file holds.

What is appended continues the numbering. A record at a position is read from its own file only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from dictforge.operators.skew import fits_broadcast
from dictforge.sources.readers import read_or_empty

INDEX = "append long, file_path string, begins long, rows long"
# Beyond so many files that hold a wanted position, all files are read instead of a list of them.
MAX_FILES = 1_000


def append_ordered(df: DataFrame, order: list[str], folder: str) -> int:
    """Append the rows of ``df`` in ``order`` behind those of ``folder``; the number of the append.

    The rows are range-partitioned, sorted and written; a file is counted by its footer. An append that was
    broken off before its index was written does not count, and the next one takes its place.
    """
    spark = df.sparkSession
    index = read_index(spark, folder)
    last = index.agg(F.max("append").alias("append"), F.max(F.col("begins") + F.col("rows")).alias("rows")).first()
    number, total = (last["append"] + 1, last["rows"]) if last["append"] is not None else (0, 0)
    path = f"{folder}/data/append={number}"
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)
    # Files of one write are named by the number of their partition.
    files = spark.read.schema(df.schema).parquet(path).select(F.col("_metadata.file_path").alias("file_path"))
    sizes = files.groupBy("file_path").agg(F.count("*").alias("rows"))
    # One row per file.
    before = Window.orderBy("file_path").rowsBetween(Window.unboundedPreceding, -1)
    begins = F.coalesce(F.sum("rows").over(before), F.lit(0)) + total
    sizes.select(
        F.lit(number).cast("long").alias("append"), "file_path", begins.cast("long").alias("begins"), "rows"
    ).write.mode("overwrite").parquet(f"{folder}/index/append={number}")
    return number


def read_index(spark: SparkSession, folder: str) -> DataFrame:
    """``(append, file_path, begins, rows)``: the position at which each file begins, and how many rows it has."""
    return read_or_empty(spark, f"{folder}/index/*", INDEX)


def numbered(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """All records with their position ``gidx``, by the place of a row in its file."""
    return _placed(_rows(spark, [f"{folder}/data/*"], schema), read_index(spark, folder))


def _rows(spark: SparkSession, paths: list[str], schema: str) -> DataFrame:
    return spark.read.schema(schema).parquet(*paths).select(
        "*", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.row_index").alias("_at")
    )


def _placed(rows: DataFrame, index: DataFrame) -> DataFrame:
    begins = index.select("file_path", "begins")
    begins = F.broadcast(begins) if fits_broadcast(begins) else begins
    return rows.join(begins, "file_path").withColumn("gidx", F.col("begins") + F.col("_at")).drop("file_path", "_at", "begins")


def files_of(index: DataFrame, positions: DataFrame) -> DataFrame:
    """``(gidx, file_path)``: the file that holds each position of ``positions`` (gidx).

    Files and positions are ordered together by range, and each position takes the last file that begins
    before it: inside its partition by a running maximum, across partitions by the last file of each.
    """
    marks = index.where("rows > 0").select(
        F.col("begins").alias("gidx"), F.lit(0).alias("kind"), F.struct("begins", "rows", "file_path").alias("f")
    )
    wanted = positions.select("gidx", F.lit(1).alias("kind"), F.lit(None).cast(marks.schema["f"].dataType).alias("f"))
    width = F.lit(1 << 20)
    both = marks.unionByName(wanted.where("gidx >= 0")).withColumn("_slot", F.floor(F.col("gidx") / width))
    running = Window.partitionBy("_slot").orderBy("gidx", "kind").rowsBetween(Window.unboundedPreceding, 0)
    near = both.withColumn("f", F.last("f", ignorenulls=True).over(running))
    # The last file that begins in a slot or before it; one row per slot that has any.
    slots = both.groupBy("_slot").agg(F.max("f").alias("_last"))
    earlier = Window.orderBy("_slot").rowsBetween(Window.unboundedPreceding, -1)
    carried = slots.select("_slot", F.last("_last", ignorenulls=True).over(earlier).alias("_carried"))
    found = near.where("kind = 1").join(carried, "_slot").withColumn("f", F.coalesce("f", "_carried"))
    return found.where("gidx < f.begins + f.rows").select("gidx", "f.file_path")


def at_positions(spark: SparkSession, folder: str, schema: str, positions: DataFrame, max_files: int = MAX_FILES) -> DataFrame:
    """The records at ``positions`` (gidx), once for each row of it; positions beyond the end have none.

    Only the files that hold one are read; their names, at most ``max_files``, come to the driver.
    """
    index = read_index(spark, folder)
    wanted = positions.select(F.col("gidx").cast("long").alias("gidx"))
    hit = files_of(index, wanted.distinct()).select("file_path").distinct().limit(max_files + 1).collect()
    if not hit:
        return spark.createDataFrame([], f"{schema}, gidx long")
    paths = [f"{folder}/data/*"] if len(hit) > max_files else [row["file_path"] for row in hit]
    rows = _placed(_rows(spark, paths, schema), index)
    wanted = F.broadcast(wanted) if fits_broadcast(wanted) else wanted
    return rows.join(wanted, "gidx").select(*[c for c in rows.columns if c != "gidx"], "gidx")
