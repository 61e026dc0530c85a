"""Mixing sources to target weights: hash-threshold histograms, DataFrame functions only."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dictforge.session import stage

# A row's place in its source is a hash of 12 hexadecimal digits; each round of histograms reads three.
HASH_DIGITS = 12
ROUND_DIGITS = 3
CELLS = 16**ROUND_DIGITS
# What separates words: the ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _size() -> Column:
    return F.regexp_count(_text(), F.lit(WORD)).cast("long")


def _place() -> Column:
    """Where a row stands in its source: it depends on doc_id and text only, so reruns agree and repeated rows go alike."""
    key = F.concat_ws("|", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.md5(_text()))
    return F.conv(F.substring(F.md5(key), 1, HASH_DIGITS), 16, 10).cast("long")


def sizes(docs: DataFrame) -> DataFrame:
    """``(doc_id, source, size, place)`` per row, written to the shared folder, as every round of histograms reads it."""
    source = F.col("source").cast("string").alias("source")
    return stage(docs.select("doc_id", source, _size().alias("size"), _place().alias("place")), "mixing_sizes")


def ranked(sources: DataFrame) -> DataFrame:
    """Add ``rank`` (from 0): sources by code point, null last.

    The sources are range-partitioned and numbered within their range; one row per range is summed up.
    """
    order = [F.asc_nulls_last("source")]
    placed = stage(
        sources.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "mixing_sources"
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select("_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before"))
    within = F.row_number().over(Window.partitionBy("_part").orderBy(*order)) - 1
    return placed.withColumn("_within", within).join(before, "_part").select(
        *sources.columns, (F.col("_before") + F.col("_within")).alias("rank")
    )


def targets(rows: DataFrame, weights: Sequence[int], budget: float, repeats: float) -> DataFrame:
    """``(source, source_size, target)``: shares of ``budget`` times all sizes, at most ``repeats`` times a size.

    What a source cannot take is shared again by weight among the others until none is above its limit.
    All open sources then have the same words per weight, so each pass needs two sums only.
    """
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    sources = ranked(rows.groupBy("source").agg(F.sum("size").alias("source_size"))).withColumn("weight", weight)
    sources = stage(sources.withColumn("limit", F.lit(repeats) * F.col("source_size")), "mixing_targets")
    total = sources.agg(F.sum("source_size").alias("n")).first()["n"] or 0
    level = 0.0
    while True:
        full = F.col("limit") <= F.lit(level) * F.col("weight")
        found = sources.agg(
            F.sum(F.when(full, F.col("limit")).otherwise(0.0)).alias("taken"),
            F.sum(F.when(~full, F.col("weight")).otherwise(0)).alias("open"),
        ).first()
        if not found["open"]:
            break
        risen = (budget * total - found["taken"]) / found["open"]
        if risen <= level:
            break
        level = risen
    return sources.select(
        "source", "source_size", F.least(F.lit(level) * F.col("weight"), F.col("limit")).alias("target")
    )


def _digits(place: Column, depth: int) -> Column:
    """The leading ``depth`` digits of a place."""
    return F.shiftright(place, 4 * (HASH_DIGITS - depth))


def thresholds(rows: DataFrame, goals: DataFrame) -> DataFrame:
    """``goals`` with ``rounds`` (whole passes over the source) and ``below`` (places taken once more).

    A histogram of sizes by source and cell finds the cell in which the remaining budget runs out; only
    that cell is opened again, three digits further down. A larger budget gives a higher threshold, so
    mixes are nested. In the last cell the threshold goes to the nearer side.
    """
    rounds = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    goals = goals.withColumn("rounds", rounds.cast("long"))
    state = goals.select(
        F.col("source").alias("_source"), (F.col("target") - F.col("rounds") * F.col("source_size")).alias("left"),
        F.lit(0).cast("long").alias("prefix"),
    )
    for depth in range(ROUND_DIGITS, HASH_DIGITS + 1, ROUND_DIGITS):
        same = rows["source"].eqNullSafe(state["_source"])
        opened = same if depth == ROUND_DIGITS else same & (_digits(rows["place"], depth - ROUND_DIGITS) == state["prefix"])
        cells = (
            rows.join(state, opened).groupBy("_source", "prefix", "left", _digits(F.col("place"), depth).alias("cell"))
            .agg(F.sum("size").alias("size"))
        )
        upto = Window.partitionBy("_source").orderBy("cell").rowsBetween(Window.unboundedPreceding, 0)
        summed = cells.withColumn("upto", F.sum("size").over(upto))
        # The first cell that does not fit; beyond the last one everything fits.
        fits = F.col("upto") <= F.col("left")
        found = summed.groupBy("_source", "prefix", "left").agg(
            F.min(F.when(~fits, F.col("cell"))).alias("cell"),
            F.coalesce(F.max(F.when(fits, F.col("upto"))), F.lit(0)).alias("used"),
            F.min(F.when(~fits, F.col("upto"))).alias("over"),
        )
        nearer = (F.col("over") - F.col("left")) < (F.col("left") - F.col("used"))
        last = F.lit(depth == HASH_DIGITS)
        state = stage(
            found.select(
                "_source", (F.col("left") - F.col("used")).alias("left"),
                F.when(F.col("cell").isNull(), (F.col("prefix") + 1) * CELLS)
                .otherwise(F.col("cell") + F.when(last & nearer, 1).otherwise(0)).alias("prefix"),
            ),
            "mixing_thresholds",
        )
    below = state.select("_source", F.col("prefix").alias("below"))
    return goals.join(below, F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """``(doc_id, source, size, source_size, target, taken, copies)`` per row of ``docs``.

    ``taken`` is the words the mix takes of a row: its size once for every whole pass over the source,
    and once more if its place lies below the source's threshold. It never exceeds ``repeats`` (rounded
    up) times the size. Null texts have size 0; a null source is a source of its own, ranked last; a
    source without words has target 0; repeated rows are taken alike; an empty table gives no rows.
    """
    rows = sizes(docs)
    goals = _goals(rows, weights, budget, repeats)
    joined = rows.join(goals, F.col("source").eqNullSafe(F.col("_own")))
    return joined.select(
        "doc_id", "source", "size", "source_size", "target",
        (F.col("size") * _copies()).alias("taken"), _copies().alias("copies"),
    )


def mixed(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), budget: float = 1.5, repeats: float = 2.0) -> DataFrame:
    """The mix itself: the rows of ``docs`` with all their columns, each as often as ``mix`` takes it.

    Rows without words have no size to take and stay once, so that no source loses its empty texts.
    The goals (one row per source) are joined; the texts are not shuffled for it while they fit a broadcast.
    """
    goals = _goals(sizes(docs), weights, budget, repeats)
    # The row travels as one column, so its names meet no others.
    placed = docs.select(
        F.struct("*").alias("_row"), F.col("source").cast("string").alias("_source"), _place().alias("_place"), _size().alias("_size")
    )
    own = F.col("_source").eqNullSafe(F.col("_own"))
    goals = goals.select("_own", "rounds", "below")
    taken = placed.join(goals, own).withColumn("_copies", F.when(F.col("_size") == 0, 1).otherwise(_copies("_place")))
    each = F.array_repeat(F.lit(1), F.col("_copies").cast("int"))
    return taken.where("_copies > 0").withColumn("_copy", F.explode(each)).select("_row.*")


def _goals(rows: DataFrame, weights: Sequence[int], budget: float, repeats: float) -> DataFrame:
    return thresholds(rows, targets(rows, weights, budget, repeats)).withColumnRenamed("source", "_own")


def _copies(place: str = "place") -> Column:
    return F.col("rounds") + F.when(F.col(place) < F.col("below"), 1).otherwise(0)
