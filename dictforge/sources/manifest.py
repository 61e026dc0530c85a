"""Incremental work over chunks that may be rewritten: a manifest of what each chunk held when it was processed.

A chunk is a folder of text files (``write_chunks`` makes such folders) or, where files lie side by side, a file. The
streaming file source looks at names only, so a rewritten file passes it by.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dictforge.operators.skew import lookup_join
from dictforge.sources.readers import read_or_empty, with_line_numbers

MANIFEST = "run long, chunk string, files string, lines long, sums string, output_run long"


def chunk_of(path: Column, by_file: bool) -> Column:
    return path if by_file else F.regexp_replace(path, "/[^/]*$", "")


def read_manifest(spark: SparkSession, out: str) -> DataFrame:
    """The chunks as the last run left them, one row each."""
    rows = read_or_empty(spark, f"{out}/manifest/*", MANIFEST)
    last = rows.agg(F.max("run")).first()[0]
    return rows.where(F.col("run") == F.lit(-1 if last is None else last))


def process_changed(
    spark: SparkSession, folder: str, out: str, process: Callable[[DataFrame], DataFrame], by_file: bool = False
) -> int:
    """Apply ``process`` to the lines of chunks that are new or changed; the number of such chunks.

    ``process`` takes ``value``, ``file_name``, ``line`` and ``chunk`` and keeps ``chunk``. Chunks whose files have the same names,
    sizes and times as before are not read. Those touched are read and digested, each line with its number,
    and only those whose digest is new are processed. Their output replaces the old at once, when the manifest
    of this run is written: a run that breaks off before changes nothing. Outputs of chunks that are gone or empty go too.
    """
    known = read_manifest(spark, out)
    number = (known.agg(F.max("run")).first()[0] or 0) + 1
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(folder)
    stamp = F.struct(F.element_at(F.split("path", "/"), -1).alias("name"), "length", F.unix_micros("modificationTime").alias("at"))
    # Counts of files per chunk are those of one folder.
    own = chunk_of(F.col("_metadata.file_path"), by_file)
    files = listed.select("path", own.alias("chunk"), stamp.alias("stamp"))
    now = files.groupBy("chunk").agg(F.sha2(F.to_json(F.array_sort(F.collect_list("stamp"))), 256).alias("files"))
    touched = now.join(known.select("chunk", F.col("files").alias("_before")), "chunk", "left")
    touched = touched.where(~F.col("files").eqNullSafe(F.col("_before"))).select("chunk", "files")
    # File names, as the driver has them anyway to plan a scan.
    paths = [r["path"] for r in files.join(touched, "chunk", "left_semi").select("path").collect()]
    present = known.join(now.select("chunk"), "chunk", "left_semi")
    if not paths:
        changed = 0
        rows = present.withColumn("run", F.lit(number))
    else:
        lines = with_line_numbers(spark.read.text(paths), ["value"], "touched_lines")
        lines = lines.withColumn("chunk", chunk_of(F.col("file_path"), by_file))
        # Sums combine before the exchange; 38 digits hold those of 10**19 lines.
        digest = F.concat_ws(" ", *[
            F.sum(F.xxhash64(F.lit(seed), "line", "value").cast("decimal(38,0)")) for seed in (1, 2)
        ])
        found = lines.groupBy("chunk").agg(F.count("*").alias("lines"), digest.alias("sums"))
        # An empty chunk has no lines but is there.
        found = touched.join(found, "chunk", "left").select(
            "chunk", "files", F.coalesce("lines", F.lit(0)).alias("lines"), F.coalesce("sums", F.lit("")).alias("sums")
        )
        before = known.select("chunk", F.col("lines").alias("_lines"), F.col("sums").alias("_sums"), F.col("output_run").alias("_run"))
        same = F.col("lines").eqNullSafe(F.col("_lines")) & F.col("sums").eqNullSafe(F.col("_sums"))
        compared = found.join(before, "chunk", "left").select(
            F.lit(number).cast("long").alias("run"), "chunk", "files", "lines", "sums",
            F.when(same, F.col("_run")).otherwise(number).cast("long").alias("output_run"),
        )
        new = compared.where(F.col("output_run") == number).select("chunk")
        changed = new.count()
        fresh = lookup_join(lines, new, "chunk", "left_semi", "line").select("value", "file_name", "line", "chunk")
        process(fresh).write.mode("overwrite").parquet(f"{out}/data/output_run={number}")
        rest = present.join(touched.select("chunk"), "chunk", "left_anti").withColumn("run", F.lit(number))
        rows = compared.unionByName(rest)
    rows.select(*[c.split()[0] for c in MANIFEST.split(", ")]).write.mode("overwrite").parquet(f"{out}/manifest/run={number}")
    return changed


def current(spark: SparkSession, out: str, schema: str) -> DataFrame:
    """The outputs that count: those of each chunk's last processing. ``schema`` is that of ``process``, with ``chunk``."""
    data = spark.read.schema(f"{schema}, output_run long").parquet(f"{out}/data")
    valid = read_manifest(spark, out).select(F.concat_ws("@", F.col("output_run").cast("string"), "chunk").alias("_at"))
    at = F.concat_ws("@", F.col("output_run").cast("string"), "chunk")
    return lookup_join(data.withColumn("_at", at), valid, "_at", "left_semi").drop("_at", "output_run")
