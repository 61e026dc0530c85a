"""Helpers for the Arrow functions: bounded slices of texts, and many texts as one array of code points."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Characters handled at once by the array code, so that its arrays stay in cache. A longer text is a slice of its own.
SLICE_CHARS = 250_000
# Rows of one Arrow batch; texts of a batch are in memory together.
BATCH_ROWS = 1_000


def small_batches(spark: SparkSession) -> None:
    """Bound the rows that reach a Python worker at once."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The texts of a batch; null is the empty text."""
    return [text or "" for text in batch.column(name).to_pylist()]


def sliced(batches: Iterator[pa.RecordBatch], name: str = "text") -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """The batches cut so that one slice holds about ``SLICE_CHARS`` characters of text."""
    for batch in batches:
        texts = texts_of(batch, name)
        begin = chars = 0
        for i, text in enumerate(texts):
            if i > begin and chars + len(text) > SLICE_CHARS:
                yield batch.slice(begin, i - begin), texts[begin:i]
                begin, chars = i, 0
            chars += len(text)
        if len(texts) > begin:
            yield batch.slice(begin), texts[begin:]


def code_points(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """All code points one after the other, and where each text begins (one entry more than texts)."""
    ends = np.cumsum([len(text) for text in texts], dtype=np.int64)
    joined = "".join(texts).encode("utf-32-le", "surrogatepass")
    return np.frombuffer(joined, dtype=np.uint32), np.concatenate([[0], ends]).astype(np.int64)


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift rounds)."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def powers(n: int, base: int = 0xA0761D6478BD642F) -> np.ndarray:
    """``base ** i`` modulo 2**64 for i below ``n``; the base is odd."""
    out = np.full(n, base, dtype=np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def columns_batch(schema: pa.Schema, *columns: object) -> pa.RecordBatch:
    arrays = [
        column if isinstance(column, (pa.Array, pa.ChunkedArray)) else pa.array(column, type=field.type)
        for column, field in zip(columns, schema, strict=True)
    ]
    return pa.RecordBatch.from_arrays(arrays, schema=schema)


def with_batches(df: DataFrame) -> DataFrame:
    small_batches(df.sparkSession)
    return df


def summed(
    df: DataFrame, column: str, dtype: str, width: int, places: Callable[[np.ndarray], np.ndarray], ending: bytes = b""
) -> np.ndarray:
    """How often each of ``width`` places occurs over all rows; ``places`` gives those of a stream of numbers.

    The stream is the binary ``column`` of some rows, one after the other, each followed by ``ending``. A task sends each place once,
    and ``width`` bounds what comes to the driver.
    """
    schema = pa.schema([("place", pa.int32()), ("n", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width, np.int64)
        for batch in parts:
            raw = ending.join([*batch.column(0).to_pylist(), b""])
            total += np.bincount(places(np.frombuffer(raw, dtype).astype(np.int64)), minlength=width)
        used = np.flatnonzero(total)
        for i in range(0, len(used), 1 << 16):
            part = used[i : i + (1 << 16)]
            yield columns_batch(schema, part.astype(np.int32), total[part])

    sums = df.select(column).mapInArrow(run, "place int, n long").groupBy("place").agg(F.sum("n").alias("n")).toPandas()
    out = np.zeros(width, np.int64)
    out[sums["place"].to_numpy()] = sums["n"].to_numpy()
    return out
