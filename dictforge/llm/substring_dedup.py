"""Substring dedup: whole lines and all runs of a number of words are digested and grouped globally."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dictforge.llm import batches
from dictforge.session import stage

# A run that repeats is removed from so many words on; below it only whole lines of some words are.
RUN_WORDS = 20
LINE_WORDS = 5
# Words of the shingles whose smallest hash stands for a run until it is known which may repeat. Fewer words make
# fewer anchors, more words fewer that are shared by chance; the result is the same.
ANCHOR_WORDS = 8


@functools.cache
def _lower() -> np.ndarray:
    """Lower case of the code points below 2**16 whose lower case is one code point."""
    table = np.arange(1 << 16, dtype=np.uint32)
    for c in range(1 << 16):
        if not 0xD800 <= c < 0xE000 and len(low := chr(c).lower()) == 1 and low != chr(c):
            table[c] = ord(low)
    return table


class Words:
    """The words of some texts, in order: hash in lower case, text, first and last offset in it, line."""

    def __init__(self, texts: list[str]):
        points, begins = batches.code_points(texts)
        n = len(points)
        space = (points == 32) | ((points >= 9) & (points <= 13))
        before, after = np.ones(n, bool), np.ones(n, bool)
        before[1:], after[:-1] = space[:-1], space[1:]
        inner = begins[1:-1][(begins[1:-1] > 0) & (begins[1:-1] < n)]
        before[inner], after[inner - 1] = True, True
        first = np.flatnonzero(~space & before)
        last = np.flatnonzero(~space & after) + 1
        sizes = last - first
        self.text = np.searchsorted(begins, first, side="right") - 1
        self.start, self.end = first - begins[self.text], last - begins[self.text]
        self.line = np.cumsum(points == 10)[first] if n else first
        self.hash = np.empty(0, np.uint64)
        if len(first):
            at = np.cumsum(sizes) - sizes
            place = np.arange(int(sizes.sum())) - np.repeat(at, sizes)
            inside = points[~space]
            low = np.where(inside <= 0xFFFF, _lower()[np.minimum(inside, 0xFFFF)], inside).astype(np.uint64)
            self.hash = batches.mixed(np.add.reduceat((low + np.uint64(1)) * batches.powers(int(sizes.max()))[place], at))
        # Words from each on to the end of its text.
        self.left = np.searchsorted(self.text, self.text, side="right") - np.arange(len(first))

    def shingles(self, size: int) -> np.ndarray:
        """The hash of each word and those after it, ``size`` in all; it means nothing where fewer are left."""
        total = np.zeros(len(self.hash), np.uint64)
        for j, power in enumerate(batches.powers(size)[: len(self.hash)]):
            total[: len(total) - j] += self.hash[j:] * power
        return batches.mixed(total)


class Units:
    """The units of some texts, in order: arrays with one entry per unit.

    A unit is a word, whose digest covers it and the ``run_words`` - 1 words after it, or stands empty
    before the first word of a line of ``line_words`` or more words that is shorter than a run, whose digest
    covers that whole line. ``covers`` counts the words; 0 are a unit's where too few follow. Case and the white
    space between words do not matter. ``anchor`` is a hash that equal units share and few words have: of a
    run the smallest hash of its shingles (winnowing), of a line its digest.
    """

    def __init__(self, texts: list[str], run_words: int = RUN_WORDS, line_words: int = LINE_WORDS):
        words = Words(texts)
        n = len(words.hash)
        opens = np.ones(n, bool)
        opens[1:] = (words.text[1:] != words.text[:-1]) | (words.line[1:] != words.line[:-1])
        head = np.flatnonzero(opens)
        sizes = np.diff([*head, n])
        whole = (sizes >= line_words) & (sizes < run_words)
        lines = np.zeros(len(head), np.uint64)
        if n:
            within = np.arange(n) - np.repeat(head, sizes)
            lines = batches.mixed(np.add.reduceat(words.hash * batches.powers(int(sizes.max()))[within], head))
            lines = batches.mixed(lines ^ sizes.astype(np.uint64))
        size = min(ANCHOR_WORDS, run_words)
        low = words.shingles(size)
        smallest, width, rest = low, 1, run_words - size + 1
        while width < rest:  # the minimum over a doubled window, of the last step over what is missing
            step = min(width, rest - width)
            smallest = np.minimum(smallest, np.concatenate([smallest[step:], smallest[n - min(step, n) :]]))
            width += step
        order = np.argsort(np.concatenate([2 * np.arange(n) + 1, 2 * head[whole]]), kind="stable")

        def both(of_words: np.ndarray, of_lines: np.ndarray) -> np.ndarray:
            return np.concatenate([of_words, of_lines])[order]

        at = head[whole]
        self.line = both(np.zeros(n, bool), np.ones(len(at), bool))
        self.covers = both(np.where(words.left >= run_words, run_words, 0), sizes[whole])
        digest = both(words.shingles(run_words), lines[whole])
        self.digest = digest.view(np.int64)
        self.anchor = both(smallest, lines[whole]).view(np.int64)
        self.text = both(words.text, words.text[at])
        self.start = both(words.start, words.start[at])
        self.end = both(words.end, words.start[at])
        self.opens = both(opens, np.ones(len(at), bool))
        # The first unit with its digest in its own text.
        self.fresh = _fresh(digest, self.text)

    def known(self, anchors: np.ndarray, texts: np.ndarray) -> np.ndarray:
        """Whether the anchor of a unit is among those given for its text."""
        return np.isin(_of_text(self.anchor, self.text), _of_text(anchors, texts))


def _of_text(digests: np.ndarray, texts: np.ndarray) -> np.ndarray:
    return digests.view(np.uint64) ^ batches.mixed(texts.astype(np.uint64) + np.uint64(1))


def _fresh(digests: np.ndarray, texts: np.ndarray) -> np.ndarray:
    out = np.zeros(len(digests), bool)
    out[np.unique(_of_text(digests, texts), return_index=True)[1]] = True
    return out


def spans(text: str, units: Units, repeated: np.ndarray, run_words: int, line_words: int) -> list[tuple[int, int]]:
    """Offsets to cut from ``text``, given which of its units repeat an earlier one.

    A run that overlaps the first of its kind, in a text that repeats itself at once, takes nothing of that.
    """
    marked = np.flatnonzero(repeated & (units.covers >= np.where(units.line, line_words, run_words)))
    if not len(marked):
        return []
    at = np.cumsum(~units.line) - ~units.line
    begin, end = at[marked], at[marked] + units.covers[marked]
    _, first, kind = np.unique(units.digest, return_index=True, return_inverse=True)
    own = first[kind[marked]]
    begin = np.where(repeated[own], begin, np.maximum(begin, at[own] + units.covers[own]))
    word = ~units.line
    starts, ends, opens = units.start[word], units.end[word], units.opens[word]
    change = np.zeros(len(starts) + 1, np.int64)
    np.add.at(change, begin, 1)
    np.add.at(change, end, -1)
    cut = np.cumsum(change[:-1]) > 0
    out = []
    edges = np.flatnonzero(np.diff(np.concatenate([[0], cut.astype(np.int8), [0]])))
    for a, b in zip(edges[::2].tolist(), edges[1::2].tolist()):
        begin, end = int(starts[a]), int(ends[b - 1])
        following = int(starts[b]) if b < len(cut) else len(text)
        gap = text[end:following]
        # The white space after goes too, but a line that goes on keeps its end.
        end = following if opens[a] or "\n" not in gap else end + gap.index("\n")
        out.append((begin, end))
    return out


class _View:
    """The units of one text among those of many."""

    def __init__(self, units: Units, a: int, b: int):
        for name in ("line", "covers", "digest", "start", "end", "opens"):
            setattr(self, name, getattr(units, name)[a:b])


def shared_anchors(anchors: DataFrame) -> DataFrame:
    """The rows whose anchor more than one text has: counted where the rows of an anchor lie, so they are shuffled once.

    A text gives each anchor once; rows that repeat count too, which finds no repeat that is none, as digests are held
    against doc_ids.
    """
    texts = F.count("*").over(Window.partitionBy("anchor"))
    return anchors.withColumn("_n", texts).where("_n > 1").drop("_n")


def later_rows(units: DataFrame) -> DataFrame:
    """The rows whose digest a smaller doc_id has too: told where the rows of a digest lie, so they are shuffled once."""
    # min() passes over null: a null doc_id is first only where all are null.
    firsts = units.withColumn("_first", F.min("_id").over(Window.partitionBy("digest")))
    later = (F.col("_id") > F.col("_first")) | (F.col("_id").isNull() & F.col("_first").isNotNull())
    return firsts.where(later).drop("_first")


def remove_repeats(docs: DataFrame, run_words: int = RUN_WORDS, line_words: int = LINE_WORDS) -> DataFrame:
    """``docs`` with ``text`` cleaned, and ``_removed``, the spans cut as ``array<struct<start, end>>``.

    Every run of ``run_words`` words and every whole line of ``line_words`` or more that an earlier document
    has, or an earlier place of the same one, goes, word by word; runs go on over the ends of lines. Units are
    ranked by doc_id, then by place; the earliest with its digest stays. Offsets count code points of the
    original text. Null texts stay null and count as empty; a text without words is left alone, one that
    only repeats becomes empty but keeps its row. Documents of one doc_id rank alike, so repeated rows lose
    the same and nothing to each other; null doc_ids rank last, alike too. All other columns pass through; an
    empty table gives an empty result. First the anchors are grouped, some in 16 words; only the runs whose anchor
    stands in several documents are digested and grouped in turn, and equal runs have equal anchors, so
    none is missed. Anchors and digests pass one exchange each. Of a frequent one a task has a narrow row per document
    that holds it, which a window reads twice and spills, no text and no list.
    """
    # Columns go by their place while others stand beside them, so their names meet none.
    names, types = docs.columns, [f.dataType.simpleString() for f in docs.schema.fields]
    columns, text_column = [f"c{i}" for i in range(len(names))], f"c{names.index('text')}"
    # What a doc_id repeats depends on no text; the part only keeps the lists of one doc_id short.
    hashed = F.xxhash64(F.col("doc_id"), F.col("text"))
    key = [
        hashed.alias("_key"), F.col("doc_id").cast("long").alias("_id"),
        F.pmod(hashed, F.lit(1 << 15)).cast("short").alias("_part"),
    ]
    narrow = batches.with_batches(docs.select(*key, F.col("text").cast("string").alias("text")))
    anchors_schema = pa.schema([("_akey", pa.int64()), ("anchor", pa.int64())])

    def sketch(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches.sliced(parts):
            units = Units(texts, run_words, line_words)
            used = np.flatnonzero(units.covers > 0)
            used = used[_fresh(units.anchor[used], units.text[used])]
            yield batches.columns_batch(
                anchors_schema, batch.column("_key").take(pa.array(units.text[used])), units.anchor[used]
            )

    anchors = narrow.select("_key", "text").mapInArrow(sketch, "_akey long, anchor long")
    wanted = shared_anchors(anchors).groupBy("_akey").agg(F.collect_set("anchor").alias("_anchors"))
    schema = pa.schema([("_id", pa.int64()), ("_part", pa.int16()), ("digest", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches.sliced(parts):
            units, lists = Units(texts, run_words, line_words), batch.column("_anchors")
            given = lists.flatten().to_numpy(zero_copy_only=False)
            of = np.repeat(np.arange(len(texts)), lists.value_lengths().to_numpy(zero_copy_only=False))
            fresh = np.flatnonzero(units.fresh & (units.covers > 0) & units.known(given, of))
            own = pa.array(units.text[fresh])
            yield batches.columns_batch(
                schema, batch.column("_id").take(own), batch.column("_part").take(own), units.digest[fresh]
            )

    meeting = narrow.join(wanted, F.col("_key") == F.col("_akey")).select("_id", "_part", "text", "_anchors")
    units = stage(meeting.mapInArrow(run, "_id long, _part short, digest long"), "run_digests")
    listed = later_rows(units).groupBy(F.col("_id").alias("_rid"), F.col("_part").alias("_rpart")).agg(
        F.collect_set("digest").alias("_repeats")
    )
    keyed = docs.select(*[docs[n].alias(c) for n, c in zip(names, columns)], *key[1:])
    same = F.col("_id").eqNullSafe(F.col("_rid")) & (F.col("_part") == F.col("_rpart"))
    joined = keyed.join(listed, same, "left").drop("_id", "_part", "_rid", "_rpart")

    def cut(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, texts in batches.sliced(parts, text_column):
            units, nulls = Units(texts, run_words, line_words), batch.column(text_column).is_null().to_pylist()
            bounds = np.searchsorted(units.text, np.arange(len(texts) + 1))
            cleaned, removed = [], []
            for i, (text, own) in enumerate(zip(texts, batch.column("_repeats").to_pylist(), strict=True)):
                a, b = int(bounds[i]), int(bounds[i + 1])
                repeated = ~units.fresh[a:b]
                # A unit that an earlier document has is a repeat wherever it stands in this one.
                if own:
                    repeated |= np.isin(units.digest[a:b], np.array(own, np.int64))
                gone = spans(text, _View(units, a, b), repeated, run_words, line_words) if repeated.any() else []
                kept, at = [], 0
                for begin, end in gone:
                    kept.append(text[at:begin])
                    at = end
                cleaned.append(None if nulls[i] else "".join([*kept, text[at:]]))
                removed.append([{"start": s, "end": e} for s, e in gone])
            kept_columns = [batch.column(c) if c != text_column else pa.array(cleaned, pa.string()) for c in columns]
            spans_type = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [*kept_columns, pa.array(removed, spans_type)], names=[*columns, "_removed"]
            )

    fields = [f"{c} {kind}" for c, kind in zip(columns, types)]
    found = joined.mapInArrow(cut, ", ".join([*fields, "_removed array<struct<start:int,end:int>>"]))
    return found.toDF(*names, "_removed")
