"""Inventories of labels and codes that a dictionary uses."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictforge.functions import text as T
from dictforge.operators.skew import lookup_join


def type_inventory(rows: DataFrame, type_col: str = "Type", gender_col: str = "TypeGender") -> DataFrame:
    return rows.groupBy(type_col, gender_col).agg(F.count("*").alias("meanings"))


def unmapped_types(rows: DataFrame, types: DataFrame, type_col: str = "Type") -> DataFrame:
    """Raw types without a label. Counted first, so the anti join sees one row per type."""
    counted = rows.groupBy(T.strip(T.text_or_empty(F.col(type_col))).alias("raw")).agg(
        F.count("*").alias("meanings")
    )
    return lookup_join(counted, types.select("raw"), "raw", "left_anti")


def unmatched_references(rows: DataFrame, titles: DataFrame, refs: str = "refs") -> DataFrame:
    codes = rows.select(F.explode(refs).alias("ref")).select(F.col("ref.InternalCode").alias("Code")).distinct()
    return lookup_join(codes, titles, "Code", "left_anti").select("Code")
