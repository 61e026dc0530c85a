"""Byte-level BPE: overlapping chunks, stitched where their pre-token boundaries meet; decoding joins bytes."""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from dictforge.llm import batches
from dictforge.session import stage

# Characters of a chunk, and by how many it reaches into the next one.
CHUNK_CHARS = 32_768
OVERLAP_CHARS = 1_024
# Characters after a match that can decide where it ends: a contraction looks two ahead.
_LOOKAHEAD = 3


@functools.cache
def encoding(ranks_path: str, pattern: str) -> tiktoken.Encoding:
    """One encoder per worker. The path is that of a file every executor has."""
    with open(ranks_path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


@functools.cache
def matcher(pattern: str) -> regex.Pattern:
    """The pattern for this library, whose ``\\s`` also takes the four separators U+001C to U+001F."""
    return regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))


def boundaries(text: str, pattern: str, whole: bool) -> list[int]:
    """Where pre-tokens of ``text`` begin; without ``whole`` only as far as what follows cannot matter.

    Places after white space are left out: how a run of it is divided depends on what follows it.
    """
    starts = [match.start() for match in matcher(pattern).finditer(text)]
    starts = [s for s in starts if not (s and text[s - 1].isspace())]
    if whole:
        return [*starts, len(text)]
    # The last match may go on past the end of this text, and so may one that ends just before it.
    return [s for s in starts if s <= len(text) - _LOOKAHEAD]


def encode(
    docs: DataFrame,
    ranks_path: str,
    pattern: str,
    keys: tuple[str, ...] = ("doc_id",),
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """``keys`` and ``ids`` (little-endian unsigned 32-bit) per row of ``docs``, each pre-token on its own.

    A text longer than a chunk is cut at fixed places into chunks that reach into their neighbours. All
    chunks are pre-tokenised in parallel; chunk k + 1 takes over from chunk k at the first place in
    their overlap where both begin a pre-token: from there on they must agree, since a match depends on
    the text to its right only. The pieces between these places are encoded in parallel and their ids
    joined in order. If two chunks never meet (one pre-token longer than the overlap), the text is
    encoded in one piece, so nothing is lost. Null and empty texts give no ids; repeated rows stay
    repeated; an empty table gives an empty result.
    """
    names = [f"_k{i}" for i in range(len(keys))]
    rows = batches.with_batches(
        docs.select(*[F.col(k).alias(n) for k, n in zip(keys, names)],
                    F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    )
    is_long = F.length("text") > chunk_chars
    short = _encode_text(rows.where(~is_long), ranks_path, pattern)
    # Rows of long texts are numbered once and kept, so that their pieces find each other again.
    long = stage(rows.where(is_long).withColumn("_row", F.monotonically_increasing_id()), "long_texts")
    pieces = _pieces(long, pattern, chunk_chars, overlap_chars)
    encoded = _encode_text(pieces, ranks_path, pattern)
    joined = encoded.groupBy("_row").agg(F.sort_array(F.collect_list(F.struct("_chunk", "ids"))).alias("parts"))
    blank = F.lit(b"").cast("binary")
    whole = joined.select("_row", F.aggregate("parts", blank, lambda a, p: F.concat(a, p["ids"])).alias("ids"))
    out = short.unionByName(long.drop("text").join(whole, "_row").drop("_row"))
    return out.select(*[F.col(n).alias(k) for k, n in zip(keys, names)], "ids")


def _pieces(long: DataFrame, pattern: str, chunk_chars: int, overlap_chars: int) -> DataFrame:
    """``(_row, _chunk, text)`` of the pieces between the places where neighbouring chunks meet."""
    count = F.ceil(F.length("text") / chunk_chars)
    numbered = long.select("_row", "text", F.explode(F.sequence(F.lit(0), (count - 1).cast("int"))).alias("_chunk"))
    begin = F.col("_chunk") * chunk_chars
    chunks = numbered.select(
        "_row", "_chunk", F.substring(F.col("text"), begin + 1, F.lit(chunk_chars + overlap_chars)).alias("text"),
        (F.length("text") <= begin + chunk_chars + overlap_chars).alias("_ends"),
    )
    schema = pa.schema([("_row", pa.int64()), ("_chunk", pa.int32()), ("text", pa.string()),
                        ("head", pa.list_(pa.int32())), ("tail", pa.list_(pa.int32()))])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            heads, tails = [], []
            for text, ends in zip(batch.column("text").to_pylist(), batch.column("_ends").to_pylist()):
                found = np.array(boundaries(text, pattern, ends), dtype=np.int32)
                heads.append(found[found <= overlap_chars])
                tails.append(found[found >= chunk_chars] - chunk_chars)
            yield batches.columns_batch(schema, batch.column("_row"), batch.column("_chunk").cast(pa.int32()),
                                        batch.column("text"), heads, tails)

    cut = chunks.mapInArrow(
        run, "_row long, _chunk int, text string, head array<int>, tail array<int>"
    )
    in_order = Window.partitionBy("_row").orderBy("_chunk")
    meet = F.array_min(F.array_intersect("head", F.lag("tail").over(in_order)))
    met = cut.withColumn("_from", F.when(F.col("_chunk") == 0, 0).otherwise(meet))
    met = met.withColumn("_next", F.lead("_from").over(in_order)).withColumn(
        "_last", F.lead("_chunk").over(in_order).isNull()
    )
    apart = F.max(F.col("_from").isNull()).over(Window.partitionBy("_row"))
    met = met.withColumn("_apart", apart)
    until = F.when(F.col("_last"), F.length("text")).otherwise(F.col("_next") + chunk_chars)
    # Where the last chunk begins inside the overlap of the one before, the piece may be empty.
    good = met.where(~F.col("_apart")).select(
        "_row", "_chunk", F.substring(F.col("text"), F.col("_from") + 1, F.greatest(until - F.col("_from"), F.lit(0))).alias("text")
    )
    lost = met.where("_apart and _chunk = 0").select("_row")
    again = long.join(lost, "_row", "left_semi").select("_row", F.lit(0).alias("_chunk"), "text")
    return good.unionByName(again)


def _encode_text(df: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Add ``ids`` for the texts of ``df``, each taken as a sequence of whole pre-tokens."""
    kept = [f for f in df.schema.fields if f.name != "text"]
    names = [f.name for f in kept]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch, texts in batches.sliced(parts):
            ids = pa.array([encoder.encode_to_numpy(t).astype("<u4").tobytes() if t else b"" for t in texts], pa.binary())
            yield pa.RecordBatch.from_arrays([*[batch.column(n) for n in names], ids], names=[*names, "ids"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return df.mapInArrow(run, f"{fields}, ids binary")


def decode(encoded: DataFrame, ranks_path: str, pattern: str) -> DataFrame:
    """Replace ``ids`` by ``bytes``, the raw bytes of all ids one after the other; null stays null.

    An id that is no rank is an error, as it cannot come from ``encode``.
    """
    kept = [f for f in encoded.schema.fields if f.name != "ids"]
    names = [f.name for f in kept]

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = encoding(ranks_path, pattern)
        for batch in parts:
            raw = [
                None if ids is None else encoder.decode_bytes(np.frombuffer(ids, "<u4").tolist())
                for ids in batch.column("ids").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(n) for n in names], pa.array(raw, pa.binary())], names=[*names, "bytes"]
            )

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept)
    return encoded.mapInArrow(run, f"{fields}, bytes binary")
