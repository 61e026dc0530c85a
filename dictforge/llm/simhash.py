"""SimHash near-duplicates by meet-in-the-middle ball hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dictforge.llm import batches
from dictforge.llm.components import components
from dictforge.session import stage

SHINGLE_WORDS = 3
SEED = 42
BITS = 64
# Shingles whose bits are counted at once.
_COUNTED = 1 << 15
_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))


def simhash(text: str, shingle_words: int = SHINGLE_WORDS) -> int:
    """The fingerprint: a bit is 1 if it is set in over half of the shingle hashes. No words give 0."""
    words = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = (ends - lengths).tolist()
    last = ends[min(shingle_words, len(words)) - 1 :].tolist()
    total, counts = len(last), np.zeros(BITS, np.int64)
    digest = xxhash.xxh64_intdigest
    for k in range(0, total, _COUNTED):
        spans = zip(starts[k : k + _COUNTED], last[k : k + _COUNTED])
        hashes = np.array([digest(joined[s:e], SEED) for s, e in spans], dtype="<u8")
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(sum(1 << j for j in np.flatnonzero(2 * counts > total).tolist()))


def fingerprints(docs: DataFrame, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp)`` per row of ``docs``; fp is the fingerprint as a signed long. Null text is empty."""
    schema = pa.schema([("doc_id", pa.int64()), ("fp", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            prints = np.array([simhash(t, shingle_words) for t in batches.texts_of(batch)], dtype=np.uint64)
            yield batches.columns_batch(schema, batch.column("doc_id"), prints.view(np.int64))

    narrow = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return batches.with_batches(narrow).mapInArrow(run, "doc_id long, fp long")


def ball(fp: str, half_radius: int) -> F.Column:
    """All variants of a fingerprint within ``half_radius`` flipped bits, each once."""
    masks = {0}
    for _ in range(half_radius):
        masks |= {m ^ (1 << j) for m in masks for j in range(BITS)}
    signed = sorted(m - (1 << BITS) if m >> (BITS - 1) else m for m in masks)
    return F.transform(F.array(*[F.lit(m).cast("long") for m in signed]), lambda m: F.col(fp).bitwiseXOR(m))


def links(prints: DataFrame, radius: int = 2) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints at most ``radius`` bits apart that keep connectivity.

    Two fingerprints within an even ``radius`` share a variant within half of it. A variant is shared by
    at most 1 + 64 (+ ...) fingerprints, whatever the input, so the bucket of a variant is bounded and
    all its members lie within ``radius`` of each other: a star says as much as all their pairs.
    """
    if radius % 2:
        raise ValueError("the radius must be even")
    # A fingerprint is 8 bytes but 65 variants: spread by number, or adaptive execution packs them into a few tasks.
    parts = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = prints.select("fp").distinct().repartition(parts).select("fp", F.explode(ball("fp", radius // 2)).alias("variant"))
    met = spread.groupBy("variant").agg(F.sort_array(F.collect_list("fp")).alias("fps")).where(F.size("fps") > 1)
    stars = met.select(F.element_at("fps", 1).alias("a"), F.explode(F.slice("fps", 2, BITS**2)).alias("b"))
    return stars.where(F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius).distinct()


def near_groups(docs: DataFrame, radius: int = 2, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, fp, component_id)`` per row: the smallest doc_id reachable over links of fingerprints.

    Null and empty texts have fingerprint 0 and link like any other. Equal texts share a fingerprint, so
    copies never multiply. Repeated rows stay repeated. A null doc_id is never the smallest unless all
    are null. An empty table gives an empty result.
    """
    rows = stage(fingerprints(docs, shingle_words), "fingerprints")
    prints = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    roots = components(links(prints, radius), "a", "b")
    rooted = prints.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "first_id", F.coalesce("root", "fp").alias("root")
    )
    smallest = rooted.groupBy("root").agg(F.min("first_id").alias("component_id"))
    labels = rooted.join(smallest, "root").select("fp", "component_id")
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")


def one_of_each(docs: DataFrame, radius: int = 2, shingle_words: int = SHINGLE_WORDS) -> DataFrame:
    """The documents that are the smallest of their near-duplicate group, with all their columns.

    Of repeated rows of that doc_id one stays. Rows without a doc_id stay unless their group has one.
    """
    groups = near_groups(docs, radius, shingle_words)
    kept = groups.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).select("doc_id").distinct()
    # The row travels as one column, so its names meet no others.
    rows = docs.select(F.col("doc_id").cast("long").alias("_own_id"), F.struct("*").alias("_row"))
    found = rows.join(kept.withColumnRenamed("doc_id", "_kept_id"), F.col("_own_id").eqNullSafe(F.col("_kept_id")))
    return found.dropDuplicates(["_kept_id"]).select("_row.*")
