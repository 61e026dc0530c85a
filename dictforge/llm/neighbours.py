"""Nearest neighbours by a block matrix join: int8 tiles with error bounds, survivors recomputed, heaps merged."""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictforge.llm import batches
from dictforge.session import stage

# Vectors of one block of queries and of candidates; blocks of candidates that share a copy of the queries.
QUERY_BLOCK = 1_024
CANDIDATE_BLOCK = 4_096
BLOCKS_PER_GROUP = 4
# Products of int8 values add up exactly in float32 over so many dimensions.
_EXACT_DIMS = (1 << 24) // (127 * 127)

_BLOCK = pa.schema([("dims", pa.int32()), ("ids", pa.binary()), ("raw", pa.binary()), ("quantised", pa.binary()),
                    ("bounds", pa.binary())])
_BLOCK_DDL = "dims int, ids binary, raw binary, quantised binary, bounds binary"


def usable(vector: str) -> Column:
    """Whether a vector takes part: not null, not zero, without null or non-finite components."""
    component = F.col(vector).cast("array<double>")
    bad = F.exists(component, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(component, lambda x: x != 0), F.lit(False))


def _block(ids: np.ndarray, raw: np.ndarray) -> pa.RecordBatch:
    """Rows as int8 with a scale each, and the norms of what was kept and of what was rounded off."""
    scale = np.abs(raw).max(axis=1) / 127
    safe = np.where(scale > 0, scale, 1.0)
    quantised = np.rint(raw / safe[:, None]).astype(np.int8)
    kept = quantised * safe[:, None]
    bounds = np.stack([safe, np.linalg.norm(kept, axis=1), np.linalg.norm(raw - kept, axis=1)])
    return batches.columns_batch(
        _BLOCK, [raw.shape[1]], [ids.tobytes()], [raw.tobytes()], [quantised.tobytes()], [bounds.tobytes()]
    )


def blocks(vectors: DataFrame, rows: int) -> DataFrame:
    """Pack ``vec_id, vector`` into blocks of at most ``rows`` of one dimension, where the rows lie."""

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for batch in parts:
            ids = batch.column("vec_id").to_numpy(zero_copy_only=False)
            lists = batch.column("vector")
            sizes = lists.value_lengths().to_numpy(zero_copy_only=False)
            flat, ends = lists.flatten().to_numpy(zero_copy_only=False), np.cumsum(sizes)
            for dims in np.unique(sizes).tolist():
                own = np.flatnonzero(sizes == dims)
                raw = flat[(ends[own] - dims)[:, None] + np.arange(dims)]
                held.setdefault(dims, []).append((ids[own], raw))
                if sum(len(i) for i, _ in held[dims]) >= rows:
                    every, all_raw = (np.concatenate(x) for x in zip(*held.pop(dims)))
                    whole = len(every) - len(every) % rows
                    for k in range(0, whole, rows):
                        yield _block(every[k : k + rows], all_raw[k : k + rows])
                    if whole < len(every):
                        held[dims] = [(every[whole:], all_raw[whole:])]
        for kept in held.values():
            yield _block(*(np.concatenate(x) for x in zip(*kept)))

    return batches.with_batches(vectors).mapInArrow(run, _BLOCK_DDL)


class _Block:
    def __init__(self, row: dict, prefix: str):
        dims = row["dims"]
        self.ids = np.frombuffer(row[f"{prefix}ids"], np.int64)
        self.raw = np.frombuffer(row[f"{prefix}raw"], np.float64).reshape(-1, dims)
        self.quantised = np.frombuffer(row[f"{prefix}quantised"], np.int8).reshape(-1, dims).astype(np.float32)
        self.scale, self.norm, self.rest = np.frombuffer(row[f"{prefix}bounds"], np.float64).reshape(3, -1)


def _product(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact products of int8 rows."""
    if a.shape[1] <= _EXACT_DIMS:
        return a @ b.T
    total = np.zeros((len(a), len(b)))
    for k in range(0, a.shape[1], _EXACT_DIMS):
        total += a[:, k : k + _EXACT_DIMS] @ b[:, k : k + _EXACT_DIMS].T
    return total


def exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of paired rows in double precision, added from the first dimension to the last."""
    total = np.zeros(len(a))
    for k in range(a.shape[1]):
        total += a[:, k] * b[:, k]
    return total


def _estimates(q: _Block, c: _Block) -> tuple[np.ndarray, np.ndarray]:
    """The product of the kept parts of each pair, and how far it may be from that of the vectors."""
    near = _product(q.quantised, c.quantised) * (q.scale[:, None] * c.scale).astype(np.float32)
    error = np.stack([q.rest, q.norm], 1) @ np.stack([c.norm + c.rest, c.rest])
    # The float32 arithmetic above has its own, far smaller error.
    error = (error + 1e-6 * (q.norm + q.rest)[:, None] * (c.norm + c.rest)).astype(np.float32) * np.float32(1.001)
    return near, error


def tile(q: _Block, c: _Block, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The ``k`` best candidates of one tile for each query: row of the query, vec_id, exact score.

    With x = x' + e (kept and rounded off), x.y differs from x'.y' by at most |e| (|y'| + |f|) + |x'| |f|.
    A pair survives if its upper bound reaches the k-th largest lower bound of its query.
    """
    with np.errstate(over="ignore", invalid="ignore"):
        near, error = _estimates(q, c)
        lower, upper = near - error, near + error
    # What overflows says nothing, so such pairs survive.
    said = np.isfinite(lower) & np.isfinite(upper)
    own = q.ids[:, None] == c.ids
    lower = np.where(said & ~own, lower, -np.inf)
    upper = np.where(said, upper, np.inf)
    at = max(len(c.ids) - k, 0)
    reached = np.partition(lower, at, axis=1)[:, at]
    rows, found = np.nonzero((upper >= reached[:, None]) & ~own)
    scores = exact(q.raw[rows], c.raw[found])
    ids = c.ids[found]
    order = np.lexsort((ids, -scores, rows))
    rows, ids, scores = rows[order], ids[order], scores[order]
    place = np.arange(len(rows)) - np.searchsorted(rows, rows)
    best = place < k
    return rows[best], ids[best], scores[best]


def nearest(vectors: DataFrame, queries: Column, k: int = 20, vector: str = "embedding") -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` largest inner products of each query, exactly.

    ``queries`` says which rows of ``vectors`` (vec_id, vector) ask; a query's own vec_id is no candidate.
    Nearest first, ties to the smaller vec_id; all candidates where there are fewer than ``k``. Unusable
    vectors and null ids take no part, vectors of other dimensions are no candidates. A repeated row is a
    candidate each time, and asks each time: the rows of one query id share its ``k`` places. An empty table gives no rows.
    Candidates stay where they are read; each group of their blocks gets one copy of the query blocks.
    """
    rows = vectors.where(F.col("vec_id").isNotNull() & usable(vector)).select(
        F.col("vec_id").cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vector"), queries.alias("_asks")
    )
    asking = rows.where("_asks").select("vec_id", "vector")
    candidates = stage(blocks(rows.select("vec_id", "vector"), CANDIDATE_BLOCK), "candidate_blocks")
    groups = max(1, -(-candidates.count() // BLOCKS_PER_GROUP))
    grouped = candidates.withColumn("_group", F.pmod(F.xxhash64("ids"), F.lit(groups)).cast("int"))
    asked = blocks(asking, QUERY_BLOCK).select(
        "dims", *[F.col(c).alias(f"q_{c}") for c in _BLOCK.names[1:]],
        F.explode(F.sequence(F.lit(0), F.lit(groups - 1))).alias("_group"),
    )
    # One tile a row: a few megabytes; Arrow batches are bounded in bytes.
    tiles = asked.join(grouped, ["_group", "dims"]).drop("_group")
    schema = pa.schema([("query_id", pa.int64()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def score(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1).to_pylist()[0]
                q = _Block(row, "q_")
                found, ids, scores = tile(q, _Block(row, ""), k)
                yield batches.columns_batch(schema, q.ids[found], ids, scores)

    scored = tiles.mapInArrow(score, "query_id long, vec_id long, score double")
    merged = pa.schema([("query_id", pa.int64()), ("rank", pa.int32()), ("vec_id", pa.int64()), ("score", pa.float64())])

    def merge(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A heap of the k best so far for the query whose rows are passing."""
        heap: list[tuple[float, int]] = []
        current: int | None = None
        out: list[tuple[int, int, int, float]] = []

        def close() -> None:
            for rank, (value, negative) in enumerate(sorted(heap, reverse=True), 1):
                out.append((current, rank, -negative, value))
            heap.clear()

        for batch in parts:
            for query_id, vec_id, value in zip(*(batch.column(c).to_pylist() for c in schema.names)):
                if query_id != current:
                    close()
                    current = query_id
                if len(heap) < k:
                    heapq.heappush(heap, (value, -vec_id))
                else:
                    heapq.heappushpop(heap, (value, -vec_id))
            if len(out) >= batches.BATCH_ROWS:
                yield batches.columns_batch(merged, *map(list, zip(*out)))
                out.clear()
        close()
        if out:
            yield batches.columns_batch(merged, *map(list, zip(*out)))

    return scored.repartition("query_id").sortWithinPartitions("query_id").mapInArrow(
        merge, "query_id long, rank int, vec_id long, score double"
    )
