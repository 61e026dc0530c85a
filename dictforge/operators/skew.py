"""Joins and grouped lists that stay even when one key holds a large share of all rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dictforge.operators import ordered
from dictforge.session import shuffles_removed

SALTS = 32
MAX_HOT_KEYS = 64
MIN_HOT_ROWS = 200_000
# Keys that the sketch of frequent keys follows; a key with a smaller share than about 4 / HOT_TRACKED may be missed.
HOT_TRACKED = 16_384
BROADCAST_ROWS = 100_000
BROADCAST_BYTES = 32 * 1024 * 1024

_SALT = "_salt"


def hot_keys(df: DataFrame, key: str, min_rows: int = MIN_HOT_ROWS) -> list:
    """The at most ``MAX_HOT_KEYS`` most frequent keys from about ``min_rows`` rows on, by a sketch.

    Each task sends one sketch of ``HOT_TRACKED`` keys, whatever the number of keys, and only this column is
    read. The list decides which rows are spread, never the result; a key that the sketch misses holds too small a
    share of the rows to outweigh a partition, or is within the reach of adaptive skew-join splitting.
    """
    top = F.expr(f"approx_top_k(_key, {MAX_HOT_KEYS + 1}, {HOT_TRACKED})")
    with shuffles_removed(df.sparkSession):
        found = df.select(F.col(key).alias("_key")).agg(top.alias("top")).first()["top"] or []
    return [item for item, n in found if item is not None and n >= min_rows][:MAX_HOT_KEYS]


def salted_join(
    big: DataFrame,
    small: DataFrame,
    key: str,
    how: str = "inner",
    spread: str | None = None,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Join in which the hot keys of ``big`` are spread over salts and repeated in ``small``.

    ``how`` is inner, left, left_semi or left_anti, with ``big`` on the left. ``spread`` names a column
    that differs between rows of one key; the salt depends on data only, so a retried task repeats it.
    """
    hot = hot_keys(big, key, min_hot_rows)
    spread_over = F.xxhash64(F.col(spread)) if spread else F.xxhash64(*[F.col(c) for c in big.columns])
    salt = F.pmod(spread_over, F.lit(SALTS)).cast("int")
    # Null keys match nothing; in a left join they would otherwise all land in one task.
    is_hot = F.col(key).isNull()
    if hot:
        is_hot = is_hot | F.col(key).isin(hot)
        repeated = F.when(F.col(key).isin(hot), F.sequence(F.lit(0), F.lit(SALTS - 1)))
        copies = F.coalesce(repeated, F.array(F.lit(0)))
        small = small.withColumn(_SALT, F.explode(copies))
    elif how in ("inner", "left_semi"):
        return big.join(small, key, how)
    else:
        small = small.withColumn(_SALT, F.lit(0))
    salted = big.withColumn(_SALT, F.when(is_hot, salt).otherwise(0))
    return salted.join(small, [key, _SALT], how).drop(_SALT)


def fits_broadcast(df: DataFrame, max_rows: int = BROADCAST_ROWS, max_bytes: int = BROADCAST_BYTES) -> bool:
    """Measure a side before it is broadcast; reads at most ``max_rows + 1`` rows of it."""
    size = F.sum(F.octet_length(F.to_json(F.struct("*"))))
    with shuffles_removed(df.sparkSession):
        found = df.limit(max_rows + 1).agg(F.count("*").alias("rows"), size.alias("bytes")).first()
    return found["rows"] <= max_rows and (found["bytes"] or 0) <= max_bytes


def lookup_join(
    big: DataFrame,
    dim: DataFrame,
    key: str,
    how: str = "left",
    spread: str | None = None,
    small: bool | None = None,
) -> DataFrame:
    """Broadcast a dimension of checked size, otherwise fall back to the salted shuffle join.

    ``small`` is the result of an earlier ``fits_broadcast`` of the same dimension.
    """
    if fits_broadcast(dim) if small is None else small:
        return big.join(F.broadcast(dim), key, how)
    return salted_join(big, dim, key, how, spread)


def block_lists(
    df: DataFrame, key: str, order: list[str], value: Column | None, per_row: int, name: str = "items",
    max_chars: int | None = None, chars: Column | None = None, min_hot_rows: int = MIN_HOT_ROWS, hot: list | None = None,
) -> DataFrame:
    """Collect every item of each key, at most ``per_row`` in one row, in rows numbered by ``block`` from 0.

    A key with more items, or with more than ``max_chars`` characters in them (``chars`` of an item; by default those of
    its JSON), continues over several rows: its items are cut by their position inside the key, so the
    blocks of a key depend on its own items only. Rows of a key that is cut by characters hold so many
    items that their mean comes to ``max_chars``. The rows pass one exchange by key, are sorted and cut where they
    lie, and gathered by key and block without another; what a sort holds spills. Keys of
    ``min_hot_rows`` items and more (``hot``, by default those a sketch finds) are placed by a distributed sort instead.
    Without ``value`` an item is the struct of its ``order`` columns, which then travel once.
    """
    item = F.struct(*order) if value is None else value
    size = F.lit(0) if not max_chars else F.length(F.to_json(F.struct(item.alias("v")))) if chars is None else chars
    carried = [] if value is None else [value.alias("_value")]
    valued = df.select(key, *order, *carried, size.cast("long").alias("_chars"))
    fitting = F.lit(per_row)
    if max_chars:
        fitting = F.least(fitting, F.greatest(F.lit(1), F.floor(F.col("_n") * max_chars / F.greatest("_all", F.lit(1)))))
    per = fitting.cast("long")

    def gather(rows: DataFrame) -> DataFrame:
        if value is None:
            items = F.array_sort(F.collect_list(item))
        else:
            items = F.transform(F.array_sort(F.collect_list(F.struct(*order, F.col("_value")))), lambda x: x["_value"])
        return rows.groupBy(key, "block").agg(items.alias(name)).select(key, name, "block")

    hot = hot_keys(df, key, min_hot_rows) if hot is None else hot
    is_hot = F.coalesce(F.col(key).isin(hot), F.lit(False)) if hot else F.lit(False)
    own = Window.partitionBy(key)
    placed = valued.where(~is_hot).withColumns({
        "_pos": F.row_number().over(own.orderBy(*order)) - 1,
        "_n": F.count("*").over(own), "_all": F.sum("_chars").over(own),
    })
    usual = gather(placed.withColumn("block", F.floor(F.col("_pos") / per).cast("long")))
    if not hot:
        return usual
    large = ordered.with_global_index(valued.where(is_hot), [key, *order], "_pos")
    # At most MAX_HOT_KEYS rows: where each begins among them and how many items a row of it takes.
    starts = large.groupBy(key).agg(
        F.min("_pos").alias("_start"), F.count("*").alias("_n"), F.sum("_chars").alias("_all")
    ).select(key, "_start", per.alias("_per"))
    blocks = large.join(F.broadcast(starts), key).withColumn("block", F.expr("(_pos - _start) div _per"))
    return usual.unionByName(gather(blocks))
