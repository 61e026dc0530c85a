"""Spelling variants: words one edit apart, found by comparing blocks of padded words, and the form each is a variant of."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dictforge.llm import batches
from dictforge.session import stage

LETTERS = "A-Za-zÀ-ÿ"
MIN_LENGTH, MIN_COUNT = 6, 5
# A form is so many times as frequent as its variant at least.
TIMES = 5
# One in so many runs loses a code point.
DROPPED_OF = 199
# Words of a block; two blocks are compared at once.
BLOCK = 512

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def words(docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT) -> DataFrame:
    """``(word, n)``: runs of letters with A-Z lower-cased, some of which have lost a code point, and how often they occur.

    Which run of a document loses one, and where, follows from the crc32 of doc_id and run. Counts combine
    before their shuffle, so a frequent word is one row per task.
    """
    text = F.translate(F.col("text").cast("string"), _UPPER, _UPPER.lower())
    runs = docs.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(text, F.lit(f"([{LETTERS}]+)"), F.lit(1))).alias("run"),
    ).where(F.length("run") >= min_length)
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    at = (F.col("h") % F.length("run")).cast("int")
    rest = F.concat(F.substring("run", F.lit(1), at), F.substring("run", at + 2, F.length("run")))
    word = F.when(F.col("h") % DROPPED_OF == 0, rest).otherwise(F.col("run"))
    found = runs.withColumn("h", h).select(word.alias("word")).where(F.length("word") >= min_length)
    return found.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def tiles(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(tile, side, kind, longer, word, n)``: the words of two blocks that may hold near words, ordered by tile.

    Words one edit apart have in common at least the first half of the longer one's length or else its last
    half. So words stand together by half, for their own length and for one more. Such a group is cut
    into blocks by the hash of the word, about ``block`` words each, and every two of its blocks make a tile.
    """
    length = F.length("word")
    lengths = counted.select("word", "n", F.explode(F.array(length, length + 1)).alias("longer"))
    head = _half(F.col("longer"))
    keys = F.array(
        F.struct(F.lit(0).alias("kind"), F.substring("word", F.lit(1), head).alias("half")),
        F.struct(F.lit(1).alias("kind"), F.expr("right(word, longer - (longer + 1) div 2)").alias("half")),
    )
    keyed = lengths.select("word", "n", "longer", F.inline(keys))
    group = ["longer", "kind", "half"]
    sizes = keyed.groupBy(*group).agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"), F.count("*").alias("size"))
    placed = keyed.join(sizes.where("size > 1"), group).withColumn("own", F.expr("pmod(xxhash64(word), blocks)").cast("int"))
    met = placed.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    low, high = F.least("own", "other"), F.greatest("own", "other")
    tile = F.concat_ws(" ", "longer", "kind", low, high, "half")
    named = met.select(tile.alias("tile"), (F.col("own") > F.col("other")).alias("side"), "kind", "longer", "word", "n",
                       (F.col("own") == F.col("other")).alias("alone"))
    parts = int(counted.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return named.repartition(parts, "tile").sortWithinPartitions("tile", "side")


def _half(longer: Column) -> Column:
    return F.floor((longer + 1) / 2).cast("int")


def padded(found: list[str], width: int) -> np.ndarray:
    """Code points, one word a row, filled up with zeros."""
    return np.array(found, dtype=f"<U{width}").view(np.uint32).reshape(len(found), width)


def compare(first: np.ndarray, second: np.ndarray, longer: int, kind: int) -> np.ndarray:
    """Which words of two blocks are one edit apart, the longer of them with ``longer`` code points.

    Blocks are pairs of padded matrices, of the words and of the words reversed. The length of the common prefix is the
    place of the first difference; with that of the common suffix it comes to ``longer`` - 1. Those with the
    common first half are found in tiles of kind 0, so kind 1 takes only the others.
    """
    prefix = (first[0][:, None, :] != second[0][None, :, :]).argmax(axis=2)
    suffix = (first[1][:, None, :] != second[1][None, :, :]).argmax(axis=2)
    near = prefix + suffix >= longer - 1
    if kind:
        near &= prefix < (longer + 1) // 2
    return near


def _near_in_tile(found: list[str], n: np.ndarray, sides: np.ndarray, longer: int, kind: int, alone: bool) -> Iterator[tuple]:
    """``(word, near words, n of the best, the best)`` of the words of a tile that have near ones."""
    width = longer + 1
    sizes = np.array([len(w) for w in found])
    matrices = padded(found, width), padded([w[::-1] for w in found], width)
    split = len(found) if alone else int(np.count_nonzero(~sides))
    rows, columns = np.arange(split), np.arange(0 if alone else split, len(found))
    near = compare([m[rows] for m in matrices], [m[columns] for m in matrices], longer, kind)
    near &= np.maximum(sizes[rows][:, None], sizes[columns][None, :]) == longer
    if alone:
        np.fill_diagonal(near, False)
        ways = ((rows, columns, near),)
    else:
        ways = ((rows, columns, near), (columns, rows, near.T))
    for own, other, matrix in ways:
        hits = np.flatnonzero(matrix.any(axis=1))
        for i in hits.tolist():
            partners = other[np.flatnonzero(matrix[i])].tolist()
            best = min(partners, key=lambda j: (-n[j], found[j]))
            yield found[own[i]], len(partners), int(n[best]), found[best]


def near_words(counted: DataFrame, block: int = BLOCK) -> DataFrame:
    """``(word, n_near, best_n, best)`` of the words that have near ones: how many, and the most frequent of them."""
    schema = pa.schema([("word", pa.string()), ("near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None

        def compared(rows: pa.Table) -> Iterator[pa.RecordBatch]:
            tile = rows.column("tile").to_pylist()
            found, kinds, longer = (rows.column(c).to_pylist() for c in ("word", "kind", "longer"))
            alone = rows.column("alone").to_pylist()
            n, sides = (rows.column(c).to_numpy() for c in ("n", "side"))
            edges = [0, *(i for i in range(1, len(tile)) if tile[i] != tile[i - 1]), len(tile)]
            out = []
            for a, b in zip(edges, edges[1:]):
                if b - a > 1:
                    out += _near_in_tile(found[a:b], n[a:b], sides[a:b], longer[a], kinds[a], alone[a])
            if out:
                yield batches.columns_batch(schema, *map(list, zip(*out)))

        for batch in parts:
            rows = pa.Table.from_batches([batch])
            held = rows if held is None else pa.concat_tables([held, rows]).combine_chunks()
            # The last tile may go on in the next batch; its size is bounded by that of two blocks.
            tile = held.column("tile")
            last, keep = tile[-1].as_py(), held.num_rows
            while keep and tile[keep - 1].as_py() == last:
                keep -= 1
            if keep:
                yield from compared(held.slice(0, keep))
                held = held.slice(keep)
        if held is not None:
            yield from compared(held)

    found = batches.with_batches(tiles(counted, block)).mapInArrow(run, "word string, near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("minus"), "best"))
    grouped = found.groupBy("word").agg(F.sum("near").alias("n_near"), best.alias("b"))
    return grouped.select("word", "n_near", (-F.col("b.minus")).alias("best_n"), F.col("b.best").alias("best"))


def roots(forms: DataFrame) -> DataFrame:
    """``(word, root)`` from ``(word, form)``: forms are followed to the last, by doubling the step until none goes on."""
    current = stage(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        onward = current.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = current.join(onward, "root", "left")
        current = stage(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "roots")
        if not current.agg(F.coalesce(F.max("moved"), F.lit(False))).first()[0]:
            return current.select("word", "root")
        current = current.drop("moved")


def variants(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_count: int = MIN_COUNT, times: int = TIMES, block: int = BLOCK
) -> DataFrame:
    """``word, n, n_near, form, form_n, root`` of each word of ``docs`` (doc_id, text).

    Words are near if one inserted, deleted or replaced code point makes one the other. ``form`` is the most
    frequent near word (of equal ones the first by code points) if it occurs ``times`` as often. Null texts have no words, a null
    doc_id counts as an empty one, repeated rows count each; an empty table gives an empty result.
    """
    counted = stage(words(docs, min_length, min_count), "spelled_words")
    near = counted.join(near_words(counted, block), "word", "left")
    form = F.when(F.col("best_n") >= times * F.col("n"), F.col("best"))
    formed = stage(near.select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), form.alias("form"),
        F.when(form.isNotNull(), F.col("best_n")).alias("form_n"),
    ), "forms")
    found = roots(formed.where("form is not null"))
    return formed.join(found, "word", "left").withColumn("root", F.coalesce("root", "word"))
