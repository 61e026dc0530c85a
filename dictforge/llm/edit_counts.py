"""Edit-aware token counts: a segment tree of pre-token blocks per document, re-encoded only where it is edited."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictforge.llm import batches, bpe

# Characters of a leaf; it ends with the pre-token that reaches this length.
LEAF_CHARS = 512
# A pre-token may depend on so many characters after its end.
_LOOKAHEAD = 2


def _leaves(text: str, pattern: str) -> list[str]:
    """Cut ``text`` into leaves, each a sequence of whole pre-tokens that does not end in white space.

    (How a run of white space is divided depends on what follows it, so it may not end a leaf.)

    Between a character that is no white space and a blank or line end a pre-token always ends; where no
    such place is near, the pattern itself finds the next boundary.
    """
    out, at, n = [], 0, len(text)
    while n - at > LEAF_CHARS:
        cut = at + LEAF_CHARS
        limit = cut + LEAF_CHARS
        while cut < limit and not (cut < n and text[cut] in " \n" and not text[cut - 1].isspace()):
            cut += 1
        if cut >= limit:
            wanted = at + LEAF_CHARS
            starts = (m.start() for m in bpe.matcher(pattern).finditer(text, at))
            cut = next((s for s in starts if s >= wanted and not text[s - 1].isspace()), n)
        out.append(text[at:cut])
        at = cut
    if at < n:
        out.append(text[at:])
    return out


class TokenTree:
    """Token count of one text under edits. Leaf sums of characters and tokens are kept in a binary tree."""

    def __init__(self, text: str, count: Callable[[str], int], pattern: str):
        self.count, self.pattern = count, pattern
        self.encoded_chars = 0
        leaves = _leaves(text, pattern)
        self._build(leaves, [self._encode(leaf) for leaf in leaves])

    def _encode(self, text: str) -> int:
        self.encoded_chars += len(text)
        return self.count(text) if text else 0

    def _build(self, leaves: list[str], tokens: list[int]) -> None:
        self.leaves = leaves or [""]
        self.width = 1 << (len(self.leaves) - 1).bit_length()
        self.chars, self.tokens = [0] * (2 * self.width), [0] * (2 * self.width)
        for i, leaf in enumerate(leaves):
            self.chars[self.width + i], self.tokens[self.width + i] = len(leaf), tokens[i]
        for node in range(self.width - 1, 0, -1):
            self._pull(node)

    def _pull(self, node: int) -> None:
        self.chars[node] = self.chars[2 * node] + self.chars[2 * node + 1]
        self.tokens[node] = self.tokens[2 * node] + self.tokens[2 * node + 1]

    def _set(self, i: int, leaf: str, tokens: int) -> None:
        self.leaves[i] = leaf
        node = self.width + i
        self.chars[node], self.tokens[node] = len(leaf), tokens
        while node > 1:
            node //= 2
            self._pull(node)

    @property
    def n_chars(self) -> int:
        return self.chars[1]

    @property
    def n_tokens(self) -> int:
        return self.tokens[1]

    def text(self) -> str:
        return "".join(self.leaves)

    def _find(self, place: int) -> tuple[int, int]:
        """The leaf that holds the character at ``place`` (the last one for the end), and where it begins."""
        node, begin = 1, 0
        while node < self.width:
            node *= 2
            if place >= begin + self.chars[node]:
                if self.chars[node + 1] == 0:  # beyond the end: stay in the last filled part
                    continue
                begin += self.chars[node]
                node += 1
        return min(node - self.width, len(self.leaves) - 1), begin

    def edit(self, place: int, removed: int, inserted: str) -> None:
        """Replace ``removed`` characters from ``place`` on by ``inserted``; both are held to the text."""
        place = min(max(place, 0), self.n_chars)
        removed = min(max(removed, 0), self.n_chars - place)
        first, begin = self._find(place)
        # The pre-token before the region must not see the edit.
        while first and begin + _LOOKAHEAD > place:
            first -= 1
            begin -= len(self.leaves[first])
        last, last_begin = self._find(place + removed)
        last = max(first, last)
        old = "".join(self.leaves[first : last + 1])
        new = old[: place - begin] + inserted + old[place - begin + removed :]
        # The region ends where a pre-token begins as it did before the edit.
        while True:
            after, k = "", last + 1
            while k < len(self.leaves) and len(after) <= _LOOKAHEAD:
                after += self.leaves[k]
                k += 1
            if not after or self._meets(new, after):
                break
            last += 1
            new += self.leaves[last]
        leaves = _leaves(new, self.pattern)
        tokens = [self._encode(leaf) for leaf in leaves]
        slots = last + 1 - first
        if len(leaves) <= slots:
            for i in range(slots):
                filled = i < len(leaves)
                if filled or self.leaves[first + i]:
                    self._set(first + i, leaves[i] if filled else "", tokens[i] if filled else 0)
        else:  # more leaves than before: a new tree over known counts
            known = self.tokens[self.width : self.width + len(self.leaves)]
            self._build(
                self.leaves[:first] + leaves + self.leaves[last + 1 :], known[:first] + tokens + known[last + 1 :]
            )

    def _meets(self, new: str, after: str) -> bool:
        """Whether a pre-token begins right after ``new`` when ``after`` follows."""
        cut = len(new)
        if not cut:
            return True
        if new[-1].isspace():
            return False
        return after[0] in " \n" or any(m.start() == cut for m in bpe.matcher(self.pattern).finditer(new + after))


def count_edits(docs: DataFrame, edits: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Token counts of every document before and after its edits.

    ``edits`` has ``doc_id, seq, place, removed, inserted``: at ``place`` (code points of the text as the
    edits before left it) so many characters go and ``inserted`` comes. Edits apply by ``seq`` (null
    first; ties by place, then text); places and lengths beyond the text are held to it, null counts as 0
    or empty. Returns per row of ``docs``: ``doc_id, n_tokens, n_edits, edited_chars, edited_tokens,
    reencoded_chars``, the last being what the edits cost. Null texts are empty; edits of unknown or null
    doc_ids change nothing; each text of a repeated doc_id is edited; an empty table gives no rows.

    Texts and edits meet in one shuffle and pass a task as a stream: one tree is held at a time, so a
    document with very many edits needs no more memory than any other.
    """
    keyed = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text")
    ).withColumn("_hash", F.xxhash64("text"))
    changes = edits.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("seq").cast("long").alias("seq"),
        F.coalesce(F.col("place").cast("long"), F.lit(0)).alias("place"),
        F.coalesce(F.col("removed").cast("long"), F.lit(0)).alias("removed"),
        F.coalesce(F.col("inserted").cast("string"), F.lit("")).alias("text"),
    ).where("doc_id is not null")
    aimed = changes.join(keyed.select("doc_id", "_hash").distinct(), "doc_id").withColumn("kind", F.lit(1))
    nothing = {c: F.lit(None).cast("long") for c in ("seq", "place", "removed")}
    every = keyed.withColumn("kind", F.lit(0)).withColumns(nothing).unionByName(aimed)
    order = ["doc_id", "_hash", "kind", "seq", "place", "text"]
    dealt = batches.with_batches(every).repartition("doc_id", "_hash").sortWithinPartitions(*order)
    names = ["doc_id", "n_tokens", "n_edits", "edited_chars", "edited_tokens", "reencoded_chars"]
    schema = pa.schema([(n, pa.int64()) for n in names])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = bpe.encoding(ranks_path, pattern)
        tree: TokenTree | None = None
        key: tuple | None = None
        copies = before = cost = done = 0
        out: list[tuple] = []

        def close() -> None:
            row = (key[0], before, done, tree.n_chars, tree.n_tokens, tree.encoded_chars - cost)
            out.extend([row] * copies)

        for batch in parts:
            for doc_id, own, kind, place, removed, text in zip(
                *(batch.column(c).to_pylist() for c in ("doc_id", "_hash", "kind", "place", "removed", "text"))
            ):
                if kind == 1:
                    tree.edit(place, removed, text)
                    done += 1
                elif key == (doc_id, own):
                    copies += 1
                else:
                    if tree:
                        close()
                    key, copies, done = (doc_id, own), 1, 0
                    tree = TokenTree(text, lambda t: len(encoder.encode_ordinary(t)), pattern)
                    before, cost = tree.n_tokens, tree.encoded_chars
            if len(out) >= batches.BATCH_ROWS:
                yield batches.columns_batch(schema, *map(list, zip(*out)))
                out.clear()
        if tree:
            close()
        if out:
            yield batches.columns_batch(schema, *map(list, zip(*out)))

    return dealt.mapInArrow(run, ", ".join(f"{n} long" for n in names))
