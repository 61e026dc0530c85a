"""Position and running state over ordered groups, without one task seeing a large group.

Groups of usual size are hash-partitioned, sorted and scanned where they lie. A group beyond
``LOCAL_GROUP_ROWS`` is range-partitioned on the total order instead, so it spans as many partitions as
it needs: each partition computes its local answer and a small summary; the summaries, one per
partition, are chained; each row then adds what its partition carried in. The locally annotated rows
are written to the shared folder between the two passes: partition numbers become data, so a retry or a
different split of the files cannot change them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type
from pyspark.sql.types import ArrayType, BooleanType, DataType, LongType, StructField, StructType

from dictforge.operators import skew
from dictforge.session import shuffles_removed, stage

# Largest group that one task may scan (narrow numeric columns only).
LOCAL_GROUP_ROWS = 1_000_000

PID = "_pid"
LOCAL = "_local"
_LOCAL_BITS = 33


def stage_ordered(df: DataFrame, order: list[str], name: str, **scans: Column) -> DataFrame:
    """Sort globally by ``order``, add partition number and local position, and materialise."""
    placed = (
        df.repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .withColumns({**scans, "_mid": F.monotonically_increasing_id()})
        .withColumn(PID, F.shiftright("_mid", _LOCAL_BITS))
        .withColumn(LOCAL, F.col("_mid").bitwiseAND(F.lit((1 << _LOCAL_BITS) - 1)))
        .drop("_mid")
    )
    return stage(placed, name)


def with_global_index(df: DataFrame, order: list[str], name: str = "gidx") -> DataFrame:
    """Dense position 0..n-1 of each row in the total order ``order``."""
    staged = stage_ordered(df, order, "global_index")
    # One row per range partition, so the unpartitioned window is over a handful of counts.
    sizes = staged.groupBy(PID).agg(F.count("*").alias("_rows"))
    before = Window.orderBy(PID).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(PID, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    return (
        staged.join(F.broadcast(offsets), PID)
        .withColumn(name, F.col("_offset") + F.col(LOCAL))
        .drop(PID, LOCAL, "_offset")
    )


def by_group_size(
    df: DataFrame, keys: list[str], census: DataFrame | None, local_rows: int, most: DataFrame | None = None
) -> tuple[DataFrame, DataFrame | None]:
    """Rows of groups that one task may scan, and the rows of larger groups if there are any.

    The groups are counted over ``census``, rows with the same keys that are cheaper to read than
    ``df``; its ``weight`` column, if any, is the number of rows one of them stands for. Counting
    combines before its shuffle. At most rows / ``local_rows`` groups are large. ``most``, where given, has no group
    of fewer than ``_n`` rows and is cheaper still: only if one of it is large the groups are counted.
    """
    with shuffles_removed(df.sparkSession):
        if most is not None and most.where(F.col("_n") > local_rows).isEmpty():
            return df, None
    group = F.to_json(F.struct(*keys))
    counted = df if census is None else census
    weight = F.sum("weight") if "weight" in counted.columns else F.count("*")
    counts = counted.groupBy(*keys).agg(weight.alias("_n"))
    beyond = counts.where(F.col("_n") > local_rows).select(group.alias("_group"))
    with shuffles_removed(df.sparkSession):
        if beyond.isEmpty():
            return df, None
    named = df.withColumn("_group", group)
    return (
        skew.lookup_join(named, beyond, "_group", "left_anti").drop("_group"),
        skew.lookup_join(named, beyond, "_group", "left_semi").drop("_group"),
    )


def _scanned_locally(df: DataFrame, keys: list[str], order: list[str], **scans: Column) -> DataFrame:
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).withColumns(scans)


def _summaries(staged: DataFrame, scan: str) -> list:
    """The summary of each range partition, in order."""
    found = staged.where(F.col(f"{scan}.summary").isNotNull()).select(PID, f"{scan}.summary")
    return found.orderBy(PID).collect()


def _local_rows(df: DataFrame, rows: list[tuple], names: list[str]) -> DataFrame:
    """One row of numbers per range partition, as a frame."""
    columns = [pa.array([row[i] for row in rows], pa.int64()) for i in range(len(names))]
    return df.sparkSession.createDataFrame(pa.table(dict(zip(names, columns, strict=True))))


def _group_hashes(keys: list[str]) -> tuple[Column, Column]:
    """128 bits that stand for a group when neighbouring rows are compared."""
    cols = [F.col(k) for k in keys]
    return F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)


def _whole_partition(batches: Iterator[tuple[pa.Array, ...]]) -> tuple[list[int], list[np.ndarray]]:
    """Narrow numeric columns of one partition, and the batch sizes to answer in."""
    sizes: list[int] = []
    parts: list[tuple[np.ndarray, ...]] = []
    for batch in batches:
        sizes.append(len(batch[0]))
        parts.append(tuple(column.to_numpy(zero_copy_only=False) for column in batch))
    if not parts:
        return sizes, []
    return sizes, [np.concatenate(column) for column in zip(*parts, strict=True)]


def _fields(**types: DataType) -> StructType:
    return StructType([StructField(name, kind) for name, kind in types.items()])


def _at_end(rows: int, summary: dict, kind: StructType) -> pa.Array:
    """The summary of a partition on its last row, null on the others."""
    return pa.array([None] * (rows - 1) + [summary], type=to_arrow_type(kind))


def _segment_starts(h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    changes = np.flatnonzero((h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])) + 1
    return np.concatenate([[0], changes])


def _in_batches(sizes: list[int], rows: pa.StructArray) -> Iterator[pa.Array]:
    start = 0
    for size in sizes:
        yield rows.slice(start, size)
        start += size


# ---------------------------------------------------------------------------------------------------
# Greedy packing


_PACK_SUMMARY = _fields(
    first_h1=LongType(), first_h2=LongType(), last_h1=LongType(), last_h2=LongType(),
    segments=LongType(), first_items=LongType(), head_sizes=ArrayType(LongType()),
    opened=ArrayType(LongType()), open_items=ArrayType(LongType()), open_size=ArrayType(LongType()),
    last_items=LongType(), last_opened=LongType(), last_open_items=LongType(), last_open_size=LongType(),
)
_PACK_TYPE = _fields(
    first=BooleanType(), last=BooleanType(), labels=ArrayType(LongType()),
    items=LongType(), packs=LongType(), summary=_PACK_SUMMARY,
)


def _next_starts(sizes: np.ndarray, starts: np.ndarray, max_items: int, max_size: int) -> np.ndarray:
    """For every row: where the next pack begins if a pack begins here."""
    n = len(sizes)
    before = np.concatenate([[0], np.cumsum(sizes)])
    by_size = np.searchsorted(before, before[:-1] + max_size, side="right") - 1
    ends = np.repeat(np.append(starts[1:], n), np.diff(np.append(starts, n)))
    rows = np.arange(n)
    return np.minimum(np.minimum(np.maximum(by_size, rows + 1), rows + max_items), ends)


def _pack_starts(following: list[int], begin: int, end: int) -> list[int]:
    found = []
    while begin < end:
        found.append(begin)
        begin = following[begin]
    return found


def _pack_partition(
    h1: np.ndarray, h2: np.ndarray, sizes: np.ndarray, max_items: int, max_size: int
) -> pa.StructArray:
    n = len(sizes)
    starts = _segment_starts(h1, h2)
    bounds = np.append(starts, n)
    lengths = np.diff(bounds)
    following_rows = _next_starts(sizes, starts, max_items, max_size)
    following = following_rows.tolist()
    opens = np.zeros(n, dtype=np.int64)
    opens[_pack_starts(following, 0, n)] = 1
    running = np.cumsum(opens)
    segment_of = np.repeat(np.arange(len(starts)), lengths)
    label = running - running[starts][segment_of]
    packs = (running[bounds[1:] - 1] - running[starts] + 1)[segment_of]

    # Rows of the first group depend on how many of them still belong to a pack opened earlier:
    # there are only ``max_items`` such entries, so all of them are answered.
    head = int(lengths[0])
    by_entry = np.full((head, max_items), -1, dtype=np.int64)
    opened, open_items, open_size = [], [], []
    for entry in range(max_items):
        begun = _pack_starts(following, entry, head)
        opened.append(len(begun))
        if begun:
            marks = np.zeros(head, dtype=np.int64)
            marks[begun] = 1
            by_entry[:, entry] = np.cumsum(marks) - 1
            open_items.append(head - begun[-1])
            open_size.append(int(sizes[begun[-1] : head].sum()))
        else:
            open_items.append(0)
            open_size.append(0)
    offsets = np.concatenate(
        [np.arange(head + 1) * max_items, head * max_items + np.arange(1, n - head + 1)]
    ).astype(np.int32)
    labels = pa.ListArray.from_arrays(offsets, np.concatenate([by_entry.ravel(), label[head:]]))

    last_begin = int(np.flatnonzero(opens)[-1])
    summary = {
        "first_h1": int(h1[0]), "first_h2": int(h2[0]), "last_h1": int(h1[-1]), "last_h2": int(h2[-1]),
        "segments": len(starts), "first_items": head,
        "head_sizes": sizes[: min(head, max_items)].tolist(),
        "opened": opened, "open_items": open_items, "open_size": open_size,
        "last_items": int(lengths[-1]), "last_opened": int(packs[-1]),
        "last_open_items": n - last_begin, "last_open_size": int(sizes[last_begin:].sum()),
    }
    return pa.StructArray.from_arrays(
        [
            pa.array(segment_of == 0),
            pa.array(segment_of == len(starts) - 1),
            labels,
            pa.array(lengths[segment_of].astype(np.int64)),
            pa.array(packs.astype(np.int64)),
            _at_end(n, summary, _PACK_SUMMARY),
        ],
        names=["first", "last", "labels", "items", "packs", "summary"],
    )


def _pack_scan(max_items: int, max_size: int):
    @F.arrow_udf(_PACK_TYPE)
    def scan(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
        batch_sizes, columns = _whole_partition(batches)
        if columns:
            yield from _in_batches(batch_sizes, _pack_partition(*columns, max_items, max_size))

    # The answer depends on row order; a deterministic function would let the optimiser drop the sort.
    return scan.asNondeterministic()


def _chain_packs(summaries: list, max_items: int, max_size: int) -> list[tuple]:
    """Per partition: entry of its first group, packs before it, and whole-group totals at both edges."""
    rows: list[dict] = []
    group: dict | None = None

    def close(finished: dict | None) -> None:
        if finished:
            for row, edge in finished["edges"]:
                row[f"{edge}_items"], row[f"{edge}_packs"] = finished["items"], finished["packs"]

    for pid, s in summaries:
        row = {"pid": pid, "entry": 0, "base": 0}
        rows.append(row)
        key = (s["first_h1"], s["first_h2"])
        if group is None or group["key"] != key:
            close(group)
            group = {"key": key, "items": 0, "packs": 0, "open_items": max_items, "open_size": 0, "edges": []}
        entry = 0
        while (
            entry < len(s["head_sizes"])
            and group["open_items"] < max_items
            and group["open_size"] + s["head_sizes"][entry] <= max_size
        ):
            group["open_items"] += 1
            group["open_size"] += s["head_sizes"][entry]
            entry += 1
        row["entry"], row["base"] = min(entry, max_items - 1), group["packs"]
        group["items"] += s["first_items"]
        if entry < s["first_items"]:
            group["packs"] += s["opened"][entry]
            group["open_items"], group["open_size"] = s["open_items"][entry], s["open_size"][entry]
        group["edges"].append((row, "first"))
        if s["segments"] > 1:
            close(group)
            group = {
                "key": (s["last_h1"], s["last_h2"]), "items": s["last_items"], "packs": s["last_opened"],
                "open_items": s["last_open_items"], "open_size": s["last_open_size"], "edges": [],
            }
        group["edges"].append((row, "last"))
    close(group)
    return [
        (r["pid"], r["entry"], r["base"], r["first_items"], r["first_packs"], r["last_items"], r["last_packs"])
        for r in rows
    ]


def with_packs_of_large_groups(
    df: DataFrame, keys: list[str], order: list[str], size: Column, max_items: int, max_size: int
) -> DataFrame:
    """``with_packs`` for groups of any size, always by range partitions."""
    scan = _pack_scan(max_items, max_size)(*_group_hashes(keys), size.cast("long"))
    return _pack_large(df, keys, order, scan, max_items, max_size)


def with_packs(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    size: Column,
    max_items: int,
    max_size: int,
    census: DataFrame | None = None,
    local_rows: int = LOCAL_GROUP_ROWS,
) -> DataFrame:
    """Greedy packing of each group in order.

    A new pack begins when the open one holds ``max_items`` items or would exceed ``max_size``. Adds
    ``pack`` (0-based in the group), ``group_items`` and ``group_packs``.
    """
    scan = _pack_scan(max_items, max_size)(*_group_hashes(keys), size.cast("long"))
    usual, large = by_group_size(df, keys, census, local_rows)
    packed = _scanned_locally(usual, keys, order, _pack=scan).withColumns(
        {
            "pack": F.get("_pack.labels", F.lit(0)),
            "group_items": F.col("_pack.items"),
            "group_packs": F.col("_pack.packs"),
        }
    ).drop("_pack")
    if large is None:
        return packed
    return packed.unionByName(_pack_large(large, keys, order, scan, max_items, max_size))


def _pack_large(
    df: DataFrame, keys: list[str], order: list[str], scan: Column, max_items: int, max_size: int
) -> DataFrame:
    staged = stage_ordered(df, [*keys, *order], "packs", _pack=scan)
    carried = _local_rows(
        df, _chain_packs(_summaries(staged, "_pack"), max_items, max_size),
        [PID, "_entry", "_base", "_first_items", "_first_packs", "_last_items", "_last_packs"],
    )
    first, last = F.col("_pack.first"), F.col("_pack.last")
    label = F.get("_pack.labels", F.when(first, F.col("_entry")).otherwise(0).cast("int"))
    return (
        staged.join(F.broadcast(carried), PID)
        .withColumn("pack", F.when(first, F.col("_base")).otherwise(0) + label)
        .withColumn(
            "group_items",
            F.when(first, F.col("_first_items"))
            .when(last, F.col("_last_items"))
            .otherwise(F.col("_pack.items")),
        )
        .withColumn(
            "group_packs",
            F.when(first, F.col("_first_packs"))
            .when(last, F.col("_last_packs"))
            .otherwise(F.col("_pack.packs")),
        )
        .drop(PID, LOCAL, "_pack", *[c for c in carried.columns if c != PID])
    )


# ---------------------------------------------------------------------------------------------------
# Run lengths


_RUN_SUMMARY = _fields(
    first_h1=LongType(), first_h2=LongType(), last_h1=LongType(), last_h2=LongType(),
    unbroken=BooleanType(), tail=LongType(),
)
_RUN_TYPE = _fields(leading=BooleanType(), length=LongType(), summary=_RUN_SUMMARY)


@F.arrow_udf(_RUN_TYPE)
def _run_scan(batches: Iterator[tuple[pa.Array, pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    batch_sizes, columns = _whole_partition(batches)
    if not columns:
        return
    h1, h2, flagged = columns
    flagged = flagged.astype(bool)
    n = len(flagged)
    starts = _segment_starts(h1, h2)
    rows = np.arange(n)
    # Row before which the current run began: the last unflagged row, or the one before the group.
    anchor = np.where(flagged, -1, rows)
    anchor[starts] = np.maximum(anchor[starts], starts - 1)
    length = np.where(flagged, rows - np.maximum.accumulate(anchor), 0)
    head = starts[1] if len(starts) > 1 else n
    broken_at = np.flatnonzero(~flagged[:head])
    leading = rows < (broken_at[0] if len(broken_at) else head)
    summary = {
        "first_h1": int(h1[0]), "first_h2": int(h2[0]), "last_h1": int(h1[-1]), "last_h2": int(h2[-1]),
        "unbroken": bool(leading.all()), "tail": int(length[-1]),
    }
    result = pa.StructArray.from_arrays(
        [
            pa.array(leading),
            pa.array(length.astype(np.int64)),
            _at_end(n, summary, _RUN_SUMMARY),
        ],
        names=["leading", "length", "summary"],
    )
    yield from _in_batches(batch_sizes, result)


def _chain_runs(summaries: list) -> list[tuple[int, int]]:
    carried = []
    key, tail = None, 0
    for pid, s in summaries:
        carry = tail if key == (s["first_h1"], s["first_h2"]) else 0
        carried.append((pid, carry))
        tail = s["tail"] + (carry if s["unbroken"] else 0)
        key = (s["last_h1"], s["last_h2"])
    return carried


def with_run_length(
    df: DataFrame,
    keys: list[str],
    order: list[str],
    flag: Column,
    name: str = "run_length",
    census: DataFrame | None = None,
    local_rows: int = LOCAL_GROUP_ROWS,
) -> DataFrame:
    """How many rows in a row, up to this one, carry ``flag`` in their group; 0 on rows without it."""
    scan = _run_scan.asNondeterministic()(*_group_hashes(keys), flag.cast("boolean"))
    usual, large = by_group_size(df, keys, census, local_rows)
    # The run of a row begins after the last row without the flag: two functions of one window.
    so_far = Window.partitionBy(*keys).orderBy(*order)
    upto = so_far.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    numbered = usual.withColumn("_flag", F.coalesce(flag.cast("boolean"), F.lit(False))).withColumn(
        "_at", F.row_number().over(so_far).cast("long")
    )
    broken = F.coalesce(F.max(F.when(~F.col("_flag"), F.col("_at"))).over(upto), F.lit(0))
    run = F.when(F.col("_flag"), F.col("_at") - broken).otherwise(0).cast("long")
    counted = numbered.withColumn(name, run).drop("_flag", "_at")
    if large is None:
        return counted
    staged = stage_ordered(large, [*keys, *order], "runs", _run=scan)
    carried = _local_rows(df, _chain_runs(_summaries(staged, "_run")), [PID, "_carry"])
    carry = F.when(F.col("_run.leading"), F.col("_carry")).otherwise(0)
    spanning = (
        staged.join(F.broadcast(carried), PID)
        .withColumn(name, F.col("_run.length") + carry)
        .drop(PID, LOCAL, "_run", "_carry")
    )
    return counted.unionByName(spanning)
