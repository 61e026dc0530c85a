"""Document fingerprints by locally consistent parsing: phrases whose names depend on their surroundings only."""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictforge.llm import batches

# Rounds of coin tossing: names of 64 bits fall to labels below 128, 14, 8 and 6.
ROUNDS = 4
# Levels of phrases that enter a fingerprint; a phrase of level n spans about 3 ** n characters.
LEVELS = (2, 3)
# Phrase names kept per text, the smallest by hash: a bottom-k sketch, exact for texts with fewer phrases.
SKETCH = 64


def _labels(names: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Small labels, neighbours always different: the lowest bit in which a name differs from the one before.

    ``first`` are the places where a text begins; neighbouring names of a text differ.
    """
    labels = names
    for _ in range(ROUNDS):
        before = np.empty_like(labels)
        before[1:] = labels[:-1]
        before[first] = ~labels[first]
        other = labels ^ before
        lowest = other & (~other + labels.dtype.type(1))
        place = np.bitwise_count(lowest - labels.dtype.type(1)).astype(labels.dtype)
        labels = ((place << labels.dtype.type(1)) | ((labels >> place) & labels.dtype.type(1))).astype(np.uint8)
    return labels


def _joined(names: np.ndarray, cuts: np.ndarray, within: np.ndarray) -> np.ndarray:
    """A name for each stretch between ``cuts``: equal for equal sequences of names, wherever they stand."""
    base = batches.powers(int(within.max()) + 1)
    return batches.mixed(np.add.reduceat(names * base[within], cuts))


def phrases(
    names: np.ndarray, begins: np.ndarray, symbols: np.ndarray | None = None
) -> tuple[np.ndarray, np.ndarray]:
    """One level: the names of the phrases of all texts, and where each text begins among them.

    ``symbols`` are smaller numbers that tell names apart as well, if there are any: labels come cheaper.

    Equal neighbours form one run first. A phrase starts where a label is larger than both its
    neighbours, and at the start of a text. Labels depend on the ``ROUNDS`` runs before and one after,
    so the interior of a repeated substring is parsed alike at any offset. Texts may not be empty.
    """
    n, first = len(names), begins[:-1]
    new = np.ones(n, bool)
    new[1:] = names[1:] != names[:-1]
    new[first] = True
    runs = np.flatnonzero(new)
    lengths = np.diff(np.append(runs, n))
    own = names[runs]
    label = _labels(own if symbols is None else symbols[runs], np.searchsorted(runs, first)).view(np.int8)
    long = lengths > 1
    own[long] = batches.mixed(own[long] ^ batches.mixed(lengths[long].astype(np.uint64)))
    first = np.searchsorted(runs, first)
    left, right = np.full(len(own), 127, np.int8), np.full(len(own), 127, np.int8)
    left[1:], right[:-1] = label[:-1], label[1:]
    right[first[1:] - 1] = 127
    left[first] = 127
    start = (label > left) & (label > right)
    start[first] = True
    cuts = np.flatnonzero(start)
    within = np.arange(len(own)) - np.repeat(cuts, np.diff(np.append(cuts, len(own))))
    return _joined(own, cuts, within), np.searchsorted(cuts, np.append(first, len(own)))


@functools.cache
def _table() -> np.ndarray:
    return batches.mixed(np.arange(1 << 16, dtype=np.uint64) + np.uint64(1))


def _names(points: np.ndarray) -> np.ndarray:
    """The name of each character: a scrambled code point."""
    if len(points) and points.max() < 1 << 16:
        return _table()[points]
    return batches.mixed(points.astype(np.uint64) + np.uint64(1))


def sketches(texts: list[str], levels: tuple[int, ...] = LEVELS, size: int = SKETCH) -> list[np.ndarray]:
    """The sorted smallest 32-bit hashes of the phrases of each text; none for the empty text."""
    filled = [i for i, text in enumerate(texts) if text]
    out = [np.empty(0, np.uint32)] * len(texts)
    if not filled:
        return out
    points, begins = batches.code_points([texts[i] for i in filled])
    names, found, owners = _names(points), [], []
    for level in range(1, max(levels) + 1):
        names, begins = phrases(names, begins, points if level == 1 else None)
        if level in levels:
            found.append((batches.mixed(names ^ np.uint64(level)) >> np.uint64(32)).astype(np.uint64))
            owners.append(np.repeat(np.arange(len(filled)), np.diff(begins)))
    # One number for owner and hash sorts and makes unique at once.
    keys = np.unique(np.concatenate(owners).astype(np.uint64) << np.uint64(32) | np.concatenate(found))
    ends = np.searchsorted(keys, np.arange(len(filled) + 1, dtype=np.uint64) << np.uint64(32))
    for k, i in enumerate(filled):
        out[i] = keys[ends[k] : min(ends[k + 1], ends[k] + size)].astype(np.uint32)
    return out


def likeness(a: np.ndarray, b: np.ndarray, size: int = SKETCH) -> float:
    """Estimated share of common phrases of two texts, from their sketches; 1 for equal ones."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    both = np.sort(np.concatenate([a, b]))
    twice = both[1:] == both[:-1]
    # The smallest of the union: each value once, up to ``size``; those that stood twice are common.
    last = np.append(~twice, True)
    upto = np.flatnonzero(last)[:size]
    return float(np.count_nonzero(twice[: upto[-1]]) / len(upto))


def as_text(sketch: np.ndarray) -> str:
    """A fingerprint: 8 hex digits per phrase of the sketch, in ascending order; empty for the empty text."""
    return sketch.astype(">u4").tobytes().hex()


def from_text(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def fingerprints(docs: DataFrame, levels: tuple[int, ...] = LEVELS, size: int = SKETCH) -> DataFrame:
    """``doc_id, fingerprint`` per row; equal texts get equal ones, null counts as empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fingerprint", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches.sliced(parts):
            found = [as_text(s) for s in sketches(texts, levels, size)]
            yield batches.columns_batch(schema, batch.column("doc_id"), found)

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return batches.with_batches(narrow).mapInArrow(run, "doc_id long, fingerprint string")


def edited(text: str, following: str) -> str:
    """``text`` with its last third replaced by as much of the beginning of ``following``, or all of it."""
    tail = len(text) // 3
    return text[: len(text) - tail] + following[:tail]


def _in_ranges(docs: DataFrame) -> DataFrame:
    """Rows in ranges of descending doc_id, sorted; each range ends with the first row of the next as a guest.

    Bounds and first rows come from narrow passes (doc_id, then doc_id and hash) and are one row per
    range; the texts are shuffled once. Ties go by the hash of the text; null doc_ids are the last range.
    """
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    )
    ranges = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")) * 2
    marks = [k / ranges for k in range(1, ranges)]
    found = rows.agg(F.percentile_approx("doc_id", marks, 10 * ranges).alias("b")).first()["b"] or []
    bounds = sorted(set(found))

    @F.pandas_udf("int")
    def descending(ids: pd.Series) -> pd.Series:
        own = ids.notna().to_numpy()
        place = np.full(len(ids), len(bounds) + 1)
        place[own] = len(bounds) - np.searchsorted(bounds, ids[own].astype("int64"), side="left")
        return pd.Series(place)

    placed = rows.withColumn("_range", descending("doc_id")).withColumn("_hash", F.xxhash64("text"))
    firsts = placed.groupBy("_range").agg(F.max(F.struct("doc_id", "_hash")).alias("f")).orderBy("_range").collect()
    guests = [
        (before["_range"], row["f"]["doc_id"], row["f"]["_hash"])
        for before, row in zip(firsts, firsts[1:] + firsts[:1])
    ]
    wanted = F.broadcast(docs.sparkSession.createDataFrame(guests, "_into int, _id long, _h long"))
    match = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.col("_hash") == F.col("_h"))
    names = ["_range", "_guest", "doc_id", "_hash", "text"]
    copies = rows.withColumn("_hash", F.xxhash64("text")).join(wanted, match).withColumn("_guest", F.lit(True))
    both = placed.withColumn("_guest", F.lit(False)).select(names).unionByName(
        copies.select(F.col("_into").alias("_range"), *names[1:])
    )
    order = ["_range", "_guest", F.desc_nulls_last("doc_id"), F.desc("_hash")]
    # The range is the partition: hashed, several ranges would meet in one task.
    return both.repartitionById(ranges + 1, "_range").sortWithinPartitions(*order)


def compare_edits(docs: DataFrame, levels: tuple[int, ...] = LEVELS, size: int = SKETCH) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    The edited text is ``edited(text, next)``, next being the next document by descending doc_id, and the
    first after the last (a lone document is its own next). Columns: ``doc_id, n_chars, edited_sha256,
    fingerprint, edited_fingerprint, near_edited, near_next``. Null texts count as empty: no phrases, alike
    with the empty text only. Documents of one doc_id follow each other by the hash of their texts. An
    empty table gives no rows. A task streams its range and holds one slice of texts at a time.
    """
    schema = pa.schema([
        ("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string()),
        ("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64()),
    ])

    def answer(ids: list[int | None], texts: list[str], last: str) -> pa.RecordBatch:
        own = sketches([*texts, last], levels, size)
        changed = [edited(text, following) for text, following in zip(texts, [*texts[1:], last])]
        theirs = sketches(changed, levels, size)
        return batches.columns_batch(
            schema, ids, [len(t) for t in texts],
            [hashlib.sha256(t.encode("utf-8", "surrogatepass")).hexdigest() for t in changed],
            [as_text(s) for s in own[:-1]], [as_text(s) for s in theirs],
            [likeness(a, b, size) for a, b in zip(own, theirs)],
            [likeness(a, b, size) for a, b in zip(own, own[1:])],
        )

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids: list[int | None] = []
        texts: list[str] = []
        chars = 0
        for batch in parts:
            columns = [batch.column(c).to_pylist() for c in ("_guest", "doc_id", "text")]
            for guest, doc_id, text in zip(*columns):
                # Rows are held as long as they follow each other; the next one closes them.
                if ids and (guest or chars > batches.SLICE_CHARS):
                    yield answer(ids, texts, text)
                    ids, texts, chars = [], [], 0
                if not guest:
                    ids.append(doc_id)
                    texts.append(text)
                    chars += len(text)

    batches.small_batches(docs.sparkSession)
    fields = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string"
    return _in_ranges(docs).select("_guest", "doc_id", "text").mapInArrow(
        run, f"{fields}, near_edited double, near_next double"
    )
