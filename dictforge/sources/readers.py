"""Readers of the dictionary tables, the record files, the configuration maps and the logs."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from dictforge import schemas
from dictforge.operators.ordered import with_global_index
from dictforge.operators.skew import lookup_join
from dictforge.session import stage


def read_table(
    spark: SparkSession, path: str, schema: str | None = None, fmt: str = "parquet", **options: str
) -> DataFrame:
    """A table in any file format Spark reads, with the declared columns only."""
    reader = spark.read.format(fmt).options(**options)
    return (reader.schema(schema) if schema else reader).load(path)


def read_jdbc(
    spark: SparkSession, url: str, table: str, schema: str, split: tuple[str, int, int, int], **options: str
) -> DataFrame:
    """A database table in parallel ranges ``(column, lower, upper, partitions)``; joins stay in Spark."""
    column, lower, upper, partitions = split
    names = [part.split()[0] for part in schema.split(",")]
    return (
        spark.read.format("jdbc")
        .options(url=url, dbtable=table, partitionColumn=column, lowerBound=str(lower),
                 upperBound=str(upper), numPartitions=str(partitions), **options)
        .load()
        .select(*names)
    )


def read_dictionary(spark: SparkSession, folder: str, fmt: str = "parquet") -> dict[str, DataFrame]:
    """The five dictionary tables of a folder."""
    tables = {
        "words": schemas.WORDS,
        "meanings": schemas.MEANINGS,
        "sources": schemas.SOURCES,
        "extensions": schemas.EXTENSIONS,
        "extension_links": schemas.EXTENSION_LINKS,
    }
    return {name: read_table(spark, f"{folder}/{name}", ddl, fmt) for name, ddl in tables.items()}


def read_titles(spark: SparkSession, path: str) -> DataFrame:
    """List of ``{Code, Title}`` with its position ``ord`` in the list, rows missing either key dropped."""
    lists = spark.read.text(path, wholetext=True).select(
        F.from_json("value", f"array<struct<{schemas.REFERENCE_TITLES}>>").alias("titles")
    )
    rows = lists.select(F.posexplode("titles").alias("ord", "title")).select("title.*", "ord")
    return rows.dropna(subset=["Code", "Title"])


def read_type_labels(spark: SparkSession, path: str) -> DataFrame:
    """Type and gender maps as ``(kind, raw, label)``."""
    maps = spark.read.schema(schemas.TYPE_MAPS).option("multiLine", True).json(path)
    kinds = [maps.select(F.lit(kind).alias("kind"), F.explode(column).alias("raw", "label"))
             for kind, column in (("type", "Types"), ("gender", "TypeGenders"))]
    return kinds[0].unionByName(kinds[1])


def read_extension_categories(spark: SparkSession, path: str) -> DataFrame:
    maps = spark.read.schema(schemas.EXTENSION_MAPS).option("multiLine", True).json(path)
    exploded = maps.select(F.explode("Extensions").alias("ext_type", "entry"))
    return exploded.select("ext_type", "entry.description", "entry.category")


def with_line_numbers(read: DataFrame, columns: list[str], name: str) -> DataFrame:
    """``columns`` of a scan of text files with ``file_path``, ``file_name``, ``block`` and ``line``, from 0 in its file.

    The rows are written once. Those of a block (a split of a file, which begins at the byte ``block``) lie one after the
    other in one task, so a line is numbered by its place in the block and the lines of the blocks before it; how
    files are split and splits are dealt changes nothing.
    """
    rows = stage(read.select(
        *columns, F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("_place"),
    ), name)
    at = F.concat_ws("@", F.col("block").cast("string"), "file_path")
    blocks = rows.groupBy("file_path", "block").agg(F.min("_place").alias("_first"), F.count("*").alias("_lines"))
    # A window over the blocks of one file.
    before = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    shifts = blocks.select(
        at.alias("_at"), (F.coalesce(F.sum("_lines").over(before), F.lit(0)) - F.col("_first")).alias("_shift")
    )
    numbered = lookup_join(rows.withColumn("_at", at), shifts, "_at", "inner", "_place")
    return numbered.withColumn("line", F.col("_place") + F.col("_shift")).drop("_place", "_at", "_shift")


# The column of a record that holds its line where that is no record.
_REJECTED = "_rejected"


def _checked(spark: SparkSession, paths: str | list[str], schema: str, mode: str) -> DataFrame:
    options = {"mode": mode} if mode == "FAILFAST" else {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _REJECTED}
    fields = schema if mode == "FAILFAST" else f"{schema}, {_REJECTED} string"
    lines = spark.read.text(paths).select("value", "_metadata").where(F.trim("value") != "")
    parsed = lines.select("_metadata", F.from_json("value", fields, options).alias("r"))
    line = F.lit(None).cast("string") if mode == "FAILFAST" else F.col(f"r.{_REJECTED}")
    return with_line_numbers(parsed.withColumn(_REJECTED, line), ["r", _REJECTED], "records")


def read_records(
    spark: SparkSession, paths: str | list[str], schema: str, mode: str = "DROPMALFORMED", with_file: bool = False
) -> DataFrame:
    """JSON lines; blank lines are skipped. ``mode`` FAILFAST makes a malformed line an error.

    ``with_file`` adds the name of the file and the number of the line among the file's lines that are not blank.
    """
    if not with_file:
        return spark.read.schema(schema).option("mode", mode).json(paths)
    rows = _checked(spark, paths, schema, mode)
    return _kept(rows, schema)


def _kept(rows: DataFrame, schema: str) -> DataFrame:
    fields = [F.col(f"r.`{name}`") for name in StructType.fromDDL(schema).fieldNames()]
    return rows.where(F.col(_REJECTED).isNull()).select(*fields, "file_name", "line")


def read_checked(spark: SparkSession, paths: str | list[str], schema: str) -> tuple[DataFrame, DataFrame]:
    """Records with ``file_name`` and ``line``, and the lines that are none, from one scan.

    A rejected line comes with its file, the byte at which its split begins, its number and the reason: it is
    no JSON, or a value of it has another type than the schema says.
    """
    rows = _checked(spark, paths, schema, "PERMISSIVE")
    bad = rows.where(F.col(_REJECTED).isNotNull())
    no_json = F.try_parse_json(F.col(_REJECTED)).isNull()
    return _kept(rows, schema), bad.select(
        "file_name", "block", "line", F.col(_REJECTED).alias("value"),
        F.when(no_json, "no JSON").otherwise("another type").alias("reason"),
    )


def content_rows(records: DataFrame) -> DataFrame:
    """Word records back to one row per meaning.

    Records that ``plans.build`` wrote carry ``word_ord`` and ``block``. Those of others are numbered by
    file name and place, read with ``with_file``, so words of equal metadata stay apart; their order is
    that of the files. Null texts are empty. Items that continue the lists of a meaning go back into it.
    """
    rows = records
    if "word_ord" not in rows.columns:
        if "file_name" not in rows.columns:
            raise ValueError("read the records with their files, or with word_ord")
        rows = with_global_index(rows, ["file_name", "line"], "word_ord")
    block = F.col("block") if "block" in rows.columns else F.lit(0)
    items = rows.select("word_ord", block.cast("long").alias("block"), "metadata", F.posexplode("content").alias("pos", "m"))
    own = items.where(F.col("m.cont").isNull())
    more = items.where(F.col("m.cont").isNotNull())
    extensions, links = F.col("m.Extensions"), F.col("m.ExtensionLinks")
    if not more.isEmpty():
        continued = more.groupBy("word_ord", F.col("m.MeaningId").alias("_id")).agg(
            F.array_sort(F.collect_list(F.struct("m.cont", "m.Extensions", "m.ExtensionLinks"))).alias("_more")
        )
        own = own.withColumn("_id", F.col("m.MeaningId")).join(continued, ["word_ord", "_id"], "left")

        def whole(first: Column, name: str, kind: str) -> Column:
            # An item continues one list; those of the other are null.
            empty = F.array().cast(f"array<{kind}>")
            rest = F.flatten(F.transform("_more", lambda i: F.coalesce(i[name], empty)))
            return F.when(F.size(rest) > 0, F.concat(F.coalesce(first, empty), rest)).otherwise(first)

        # A part after the first has no lists of its own to continue.
        leading = F.coalesce(F.col("m.part_index"), F.lit(1)) == 1
        extensions = F.when(leading, whole(extensions, "Extensions", schemas.EXTENSION)).otherwise(extensions)
        links = F.when(leading, whole(links, "ExtensionLinks", schemas.LINK)).otherwise(links)
    return own.select(
        "word_ord",
        F.struct("block", "pos").alias("meaning_ord"),
        F.col("m.MeaningId").alias("MeaningId"),
        F.col("metadata.WordText").alias("WordText"),
        F.col("metadata.Language").alias("WordLanguage"),
        F.col("metadata.WordTextAlternate").alias("WordTextAlternate"),
        F.col("metadata.Syllables").alias("Syllables"),
        F.col("metadata.TypeClass").alias("TypeClass"),
        F.coalesce("m.MeaningText", F.lit("")).alias("text"),
        F.col("m.Type").alias("Type"),
        F.col("m.TypeGender").alias("TypeGender"),
        F.col("m.SeqNo").alias("seq_no"),
        F.col("m.Language").alias("Language"),
        F.coalesce("m.References", F.array().cast(f"array<{schemas.REFERENCE}>")).alias("refs"),
        F.col("m.Source").alias("source"),
        F.coalesce("m.Source.ShortText", F.lit("")).alias("source_short"),
        extensions.alias("Extensions"),
        links.alias("ExtensionLinks"),
        (F.coalesce(F.size(extensions), F.lit(0)) > 0).alias("has_ext"),
        F.col("m.ManagedType").alias("ManagedType"),
        F.col("m.part_index").alias("part_index"),
        F.col("m.total_parts").alias("total_parts"),
    )


def _names(schema: str) -> list[str]:
    return [part.split()[0] for part in schema.split(", ")]


def read_stats(spark: SparkSession, path: str, schema: str = schemas.TRAINING_STATS) -> DataFrame:
    """Statistics CSV; the run comes from the folder name (null without), ``nan`` is a number.

    Every file names its own columns in its header, which may be any of ``schema`` in any order: values
    are taken by name, columns that a file lacks are null. A header is a line of such names only; there
    is one per file, so it is grouped by file and joined back to the file's lines.
    """
    fields = [part.split() for part in schema.split(", ")]
    names = {name for layout in (schema, schemas.TRAINING_STATS, schemas.STEP_STATS) for name in _names(layout)}
    known = F.array(*[F.lit(name) for name in sorted(names)])
    lines = spark.read.text(path)
    run = F.col("run_id").cast("string") if "run_id" in lines.columns else F.lit(None).cast("string")
    cells = lines.select(
        F.split("value", ",").alias("cells"), F.col("_metadata.file_path").alias("file_path"), run.alias("run_id")
    )
    named = cells.withColumn("is_header", F.size(F.array_except("cells", known)) == 0)
    headers = named.where("is_header").groupBy("file_path").agg(F.max("cells").alias("names"))
    rows = named.where("not is_header").drop("is_header").join(headers, "file_path")
    values = rows.withColumn("values", F.map_from_arrays("names", F.slice("cells", F.lit(1), F.size("names"))))
    return values.select(
        *[F.nullif(F.try_element_at("values", F.lit(name)), F.lit("")).try_cast(kind).alias(name) for name, kind in fields],
        "run_id",
    )


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """Log lines with their file and their number in it, from 0."""
    return with_line_numbers(spark.read.text(path), ["value"], "log_lines").select("value", "file_name", "line")


# What a damaged table file is reported as.
_DAMAGED = ("CANNOT_READ_FILE_FOOTER", "FAILED_READ_FILE", "CANNOT_READ_FILE", "UNABLE_TO_INFER_SCHEMA")


def read_or_empty(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An append table; a missing or damaged one is empty.

    The footers are looked at once, which costs one small task per file of a table of this kind.
    """
    try:
        found = spark.read.schema(schema).parquet(path)
        found.select(F.lit(1)).agg(F.count("*")).first()
        return found
    except (PySparkException, Py4JJavaError) as error:
        if any(d in str(error) for d in ("PATH_NOT_FOUND", *_DAMAGED)):
            return spark.createDataFrame([], schema)
        raise


def latest_diagnostic(diagnostics: DataFrame) -> DataFrame:
    """The newest diagnostic of each run."""
    fields = [c for c in diagnostics.columns if c != "run_id"]
    newest = F.max_by(F.struct(*fields), F.struct("ts", "iter"))
    return diagnostics.groupBy("run_id").agg(newest.alias("d")).select("run_id", "d.*")
