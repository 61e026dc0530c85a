"""Alignment of two tokenizers: groups between the byte offsets at which tokens of both end, and pairs linked there."""

from __future__ import annotations

import functools
import hashlib
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import sentencepiece
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from dictforge.llm import batches
from dictforge.llm.bpe import encoding
from dictforge.session import stage

# Texts of letters and signs that have been in Unicode from early on.
_COMMON = re.compile("[\x00-\u024f\u2010-\u2027\u20ac]*")
# Separators after an id in the text form of groups, by number.
_AFTER = (",", "|", ";", "")


def _byte_of_letter() -> dict[str, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves, others from 256 on."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


@dataclass(frozen=True)
class Pair:
    """Both tokenizers with the bytes of their tokens, and all pairs of ids that can ever be linked.

    Tokens that end together are both suffixes of the text up to there, so the bytes of one end with those of the
    other. ``codes`` lists such pairs, a * 2**20 + b in order; their number follows from the vocabularies alone.
    """

    a: Tokenizer
    b: sentencepiece.SentencePieceProcessor
    bytes_a: pa.Array
    bytes_b: pa.Array
    sizes_a: np.ndarray
    sizes_b: np.ndarray
    codes: np.ndarray
    names: pa.Array
    ranks: tiktoken.Encoding | None

    def encode(self, texts: list[str]) -> tuple[list, list]:
        """The ids of both for each text; where the ranks are at hand they encode the texts of common letters."""
        ids_a: list = [None] * len(texts)
        rest = []
        for i, text in enumerate(texts):
            if self.ranks and _COMMON.fullmatch(text):
                ids_a[i] = self.ranks.encode_to_numpy(" " + text)
            else:
                rest.append(i)
        encoded = self.a.encode_batch_fast([" " + texts[i] for i in rest], add_special_tokens=False)
        for i, found in zip(rest, encoded):
            ids_a[i] = found.ids
        return ids_a, self.b.encode(texts, num_threads=1)


@functools.cache
def load(path_a: str, path_b: str, ranks_a: str | None = None, pattern: str | None = None) -> Pair:
    """One pair per worker; the paths are those of files every executor has.

    ``ranks_a`` and ``pattern`` may name the vocabulary of A once more, as ranks, for a library that encodes faster and,
    for letters whose classes no version of Unicode has changed, alike.
    """
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    a = Tokenizer.from_file(path_a)
    a.encode_special_tokens = True
    letters = _byte_of_letter()
    special = {t.content for t in a.get_added_tokens_decoder().values()}
    tokens_a = [b""] * a.get_vocab_size()
    for token, i in a.get_vocab().items():
        tokens_a[i] = token.encode() if token in special else bytes(letters[c] for c in token)
    b = sentencepiece.SentencePieceProcessor(model_file=path_b)
    tokens_b = []
    for i in range(b.get_piece_size()):
        piece = b.id_to_piece(i)
        tokens_b.append(bytes([int(piece[1:-1], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode())
    by_a = {token: i for i, token in enumerate(tokens_a)}
    by_b: dict[bytes, list[int]] = {}
    for i, token in enumerate(tokens_b):
        by_b.setdefault(token, []).append(i)
    codes = [
        i << 20 | j for i, token in enumerate(tokens_a) for k in range(len(token)) for j in by_b.get(token[k:], ())
    ] + [by_a[token[k:]] << 20 | j for j, token in enumerate(tokens_b) for k in range(len(token)) if token[k:] in by_a]
    names = [f"{i}{after}" for i in range(max(len(tokens_a), len(tokens_b))) for after in _AFTER]
    return Pair(
        a, b, pa.array(tokens_a, pa.binary()), pa.array(tokens_b, pa.binary()),
        np.array([len(t) for t in tokens_a]), np.array([len(t) for t in tokens_b]),
        np.unique(np.array(codes, np.int64)), pa.array(names, pa.binary()),
        encoding(ranks_a, pattern) if ranks_a and pattern else None,
    )


def shared_cuts(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``ends_a`` and ``ends_b`` (rising offsets) of the offsets that both have, in order.

    Divide and conquer: of each interval the end of A nearest to its middle that B has too is found by bisecting
    B, going outward from the middle, and both halves are intervals anew. Ends tried in vain lie in neither. An
    interval without a shared end is a leaf. All intervals take their next step at once.
    """
    found_a, found_b = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
    intervals = 1 if len(ends_a) and len(ends_b) else 0
    low, high, turn = np.zeros(intervals, np.int64), np.full(intervals, len(ends_a)), np.zeros(intervals, np.int64)
    while len(low):
        middle = (low + high - 1) // 2
        # 0, +1, -1, +2, -2, ... from the middle.
        away = (turn + 1) // 2
        at = np.where(turn % 2 == 1, middle + away, middle - away)
        inside = (at >= low) & (at < high)
        end = ends_a[np.where(inside, at, 0)]
        place = np.searchsorted(ends_b, end)
        hit = inside & (ends_b[np.minimum(place, len(ends_b) - 1)] == end)
        cut, right = at[hit], turn[hit] % 2 == 1
        found_a.append(cut)
        found_b.append(place[hit])
        # Tried already: from first to last around the middle.
        reach = away[hit]
        first = np.where(right, middle[hit] - reach + 1, cut)
        last = np.where(right, cut, middle[hit] + reach)
        last = np.where(turn[hit] == 0, cut, last)
        left = ~hit & (np.maximum(middle - low, high - 1 - middle) * 2 > turn)
        low, high, turn = (
            np.concatenate([low[left], low[hit], last + 1]),
            np.concatenate([high[left], first, high[hit]]),
            np.concatenate([turn[left] + 1, np.zeros(2 * len(cut), np.int64)]),
        )
        some = low < high
        low, high, turn = low[some], high[some], turn[some]
    a, b = np.concatenate(found_a), np.concatenate(found_b)
    order = np.argsort(a)
    return a[order], b[order]


@dataclass(frozen=True)
class Aligned:
    """The tokens of some texts, one after the other, and the groups they are cut into.

    ``cut_a`` and ``cut_b`` are the last token of each group; ``last`` is the last group of each text, counted on.
    """

    ids_a: np.ndarray
    ids_b: np.ndarray
    cut_a: np.ndarray
    cut_b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    last: np.ndarray

    def written(self, pair: Pair) -> tuple[memoryview, np.ndarray]:
        """All groups as ``a1,a2|b1;a3|b2,b3`` in bytes, and where each text ends in them."""
        rows_a, rows_b = np.arange(len(self.ids_a)), np.arange(len(self.ids_b))
        group_a, group_b = np.searchsorted(self.cut_a, rows_a), np.searchsorted(self.cut_b, rows_b)
        before_b = np.concatenate([[0], self.cut_b + 1])[:-1]
        after_a = (rows_a == self.cut_a[group_a]).astype(np.int64)
        end_of_text = np.zeros(len(self.cut_b), bool)
        end_of_text[self.last[self.last >= 0]] = True
        after_b = np.where(rows_b == self.cut_b[group_b], np.where(end_of_text[group_b], 3, 2), 0)
        names = np.empty(len(rows_a) + len(rows_b), np.int64)
        names[rows_a + before_b[group_a]] = self.ids_a * len(_AFTER) + after_a
        names[rows_b + self.cut_a[group_b] + 1] = self.ids_b * len(_AFTER) + after_b
        taken = pair.names.take(pa.array(names))
        offsets = np.frombuffer(taken.buffers()[1], np.int32, len(names) + 1)
        ends = np.cumsum(self.n_a + self.n_b)
        return memoryview(taken.buffers()[2] or b""), offsets[ends]


def aligned(texts: list[str], pair: Pair) -> Aligned:
    """Align texts; one whose tokens of either kind do not join to a space and itself has no tokens."""
    lists_a, lists_b = pair.encode(texts)

    def flat(lists: list) -> tuple[np.ndarray, np.ndarray]:
        sizes = np.array([len(x) for x in lists], np.int64)
        return np.concatenate([np.array(x, np.int64) for x in lists]) if lists else np.empty(0, np.int64), sizes

    (ids_a, n_a), (ids_b, n_b) = flat(lists_a), flat(lists_b)
    raw = [b" " + t.encode() for t in texts]
    wanted = np.cumsum([len(t) for t in raw])
    joined = b"".join(raw)
    whole = np.array([bool(t) for t in texts], bool)
    for ids, sizes, tokens, each in ((ids_a, n_a, pair.bytes_a, pair.sizes_a), (ids_b, n_b, pair.bytes_b, pair.sizes_b)):
        ends = np.concatenate([[0], np.cumsum(each[ids])])
        data = bytes(memoryview(tokens.take(pa.array(ids)).buffers()[2] or b"")[: ends[-1]])
        ends = ends[np.cumsum(sizes)]
        if data != joined or not np.array_equal(ends, wanted):
            begins, at = np.concatenate([[0], ends[:-1]]), np.concatenate([[0], wanted[:-1]])
            for i in range(len(texts)):
                whole[i] &= data[begins[i] : ends[i]] == joined[at[i] : wanted[i]]
    if not whole.all():
        ids_a, ids_b = ids_a[np.repeat(whole, n_a)], ids_b[np.repeat(whole, n_b)]
        n_a, n_b = np.where(whole, n_a, 0), np.where(whole, n_b, 0)
    cut_a, cut_b = shared_cuts(np.cumsum(pair.sizes_a[ids_a]), np.cumsum(pair.sizes_b[ids_b]))
    # Both tokenizers end with the text, so its end is a cut.
    last = np.searchsorted(cut_a, np.cumsum(n_a) - 1, side="right") - 1
    return Aligned(ids_a, ids_b, cut_a, cut_b, n_a, n_b, last)


def align(
    docs: DataFrame, path_a: str, path_b: str, ranks_a: str | None = None, pattern: str | None = None, groups: bool = False
) -> DataFrame:
    """Per row of ``docs`` (doc_id, text): token, group and link numbers, the digest of the groups, and ``pairs``.

    A are the tokens of a space and the text, B those of the text, whose tokenizer adds the space. ``pairs`` holds the
    number of each link's pair of ids in ``Pair.codes``, 32 bits each. With ``groups`` the
    groups themselves are a column too, ``array<struct<a, b>>`` of arrays of ids. Null and empty texts, and those whose tokens
    do not join to a space and the text, have no tokens: zeros and an empty digest. A text is aligned whole.
    """
    fields = [("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
              ("n_links", pa.int64()), ("groups_sha256", pa.string()), ("pairs", pa.binary())]
    ids = pa.list_(pa.int32())
    listed = pa.list_(pa.struct([("a", ids), ("b", ids)]))
    schema = pa.schema([*fields, *([("groups", listed)] if groups else [])])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pair = load(path_a, path_b, ranks_a, pattern)
        for batch, texts in batches.sliced(parts):
            found = aligned(texts, pair)
            written, ends = found.written(pair)
            begins = np.concatenate([[0], ends[:-1]])
            digests = [
                hashlib.sha256(written[a:b]).hexdigest() if b > a else "" for a, b in zip(begins.tolist(), ends.tolist())
            ]
            until = found.last + 1
            since = np.concatenate([[0], until[:-1]])
            sizes = until - since
            codes = found.ids_a[found.cut_a] << 20 | found.ids_b[found.cut_b]
            numbers = np.searchsorted(pair.codes, codes).astype("<u4")
            pairs = [numbers[a:b].tobytes() for a, b in zip(since.tolist(), until.tolist())]
            columns = [batch.column("doc_id"), found.n_a, found.n_b, sizes, sizes, digests, pairs]
            if groups:
                lists = []
                for a, b in zip(since.tolist(), until.tolist()):
                    own = []
                    for g in range(a, b):
                        low_a, low_b = (cut[g - 1] + 1 if g else 0 for cut in (found.cut_a, found.cut_b))
                        own.append({"a": found.ids_a[low_a : found.cut_a[g] + 1].tolist(),
                                    "b": found.ids_b[low_b : found.cut_b[g] + 1].tolist()})
                    lists.append(own)
                columns.append(lists)
            yield batches.columns_batch(schema, *columns)

    ddl = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs binary"
    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    more = ", groups array<struct<a:array<int>,b:array<int>>>" if groups else ""
    return batches.with_batches(narrow).mapInArrow(run, ddl + more)


def link_counts(rows: DataFrame, path_a: str, path_b: str) -> tuple[np.ndarray, np.ndarray]:
    """How many links hold each pair of ``Pair.codes``, and whether that is the most any pair of its B id has.

    Both have one entry per possible pair, a number that the vocabularies bound, whatever the rows.
    """
    codes = load(path_a, path_b).codes
    counts = batches.summed(rows, "pairs", "<u4", len(codes), lambda pairs: pairs)
    of_b = codes & ((1 << 20) - 1)
    most = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(most, of_b, counts)
    return counts, counts == most[of_b]


def weigh_links(
    docs: DataFrame, path_a: str, path_b: str, ranks_a: str | None = None, pattern: str | None = None
) -> DataFrame:
    """``align`` with ``n_best`` and ``count_sum``: links whose pair is the most frequent of its B id, counts over links.

    The rows are written once, so each text is encoded once; what a pair counts is then looked up in a table of
    bounded size. Repeated rows stay repeated and count each; an empty table gives an empty result.
    """
    rows = stage(align(docs, path_a, path_b, ranks_a, pattern), "aligned")
    counts, best = link_counts(rows, path_a, path_b)
    schema = pa.schema([("doc_id", pa.int64()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("n_groups", pa.int64()),
                        ("n_links", pa.int64()), ("n_best", pa.int64()), ("count_sum", pa.int64()),
                        ("groups_sha256", pa.string())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            found = [np.frombuffer(raw, "<u4") for raw in batch.column("pairs").to_pylist()]
            own = {"n_best": [int(best[p].sum()) for p in found], "count_sum": [int(counts[p].sum()) for p in found]}
            yield batches.columns_batch(schema, *[own[n] if n in own else batch.column(n) for n in schema.names])

    return rows.mapInArrow(
        run, "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    )
