"""Token ids in wavelet matrix files: bit-planes with rank and select, one compressed file per shard.

A file holds the ids of consecutive documents. Plane k stores bit k (highest first) of the ids, stably
partitioned by the bits before it, in blocks of ``BLOCK_BITS`` that are compressed one by one; with each
block goes the number of ones before it. A lookup decompresses one block per plane, never the file.
"""

from __future__ import annotations

import functools
import json
import re
import struct
import uuid
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from dictforge.llm import batches
from dictforge.session import stage

MAGIC = b"WVM1"
BLOCK_BITS = 1 << 16
SHARD_TOKENS = 1 << 22
# Words whose ids a worker remembers twice over: those met since it last had so many, and those before, which it takes over
# when it meets them again and else forgets. That costs time only.
KNOWN_WORDS = 500_000
_WORDS_AT_ONCE = 20_000


# ---------------------------------------------------------------------------------------------------
# The file


def pack(ids: np.ndarray, doc_ids: list[int | None], lengths: list[int], bits: int) -> bytes:
    """The file of one shard: ``ids`` of all its documents, whose ids and lengths are given."""
    squeeze = zstandard.ZstdCompressor(level=1).compress
    body, planes = [], []
    current = ids
    for shift in range(bits - 1, -1, -1):
        ones = (current & current.dtype.type(1 << shift)) != 0
        packed = np.packbits(ones, bitorder="little")
        step = BLOCK_BITS // 8
        counts = [int(np.bitwise_count(packed[k : k + step]).sum(dtype=np.int64)) for k in range(0, len(packed), step)]
        blocks = [squeeze(packed[k : k + step].tobytes()) for k in range(0, len(packed), step)]
        planes.append({"ones": sum(counts), "before": np.cumsum([0, *counts])[:-1].tolist(), "sizes": list(map(len, blocks))})
        body += blocks
        current = np.concatenate([current.compress(~ones), current.compress(ones)])
    head = {"n": len(ids), "bits": bits, "planes": planes, "doc_ids": doc_ids, "lengths": lengths}
    header = squeeze(json.dumps(head).encode())
    return b"".join([MAGIC, struct.pack("<Q", len(header)), header, *body])


class WaveletMatrix:
    """Reads one file: ``access``, ``rank``, ``count``, ``select`` and ``tokens`` (all of them)."""

    def __init__(self, content: bytes):
        if content[:4] != MAGIC:
            raise ValueError("not a wavelet matrix file")
        (size,) = struct.unpack_from("<Q", content, 4)
        expand = zstandard.ZstdDecompressor().decompress
        head = json.loads(expand(content[12 : 12 + size]))
        self.n, self.bits, self.planes = head["n"], head["bits"], head["planes"]
        self.doc_ids, self.lengths = head["doc_ids"], head["lengths"]
        at = 12 + size
        for plane in self.planes:
            plane["at"] = (at + np.cumsum([0, *plane["sizes"]])).tolist()
            at = plane["at"][-1]

        @functools.lru_cache(maxsize=4 * self.bits)
        def block(plane: int, k: int) -> np.ndarray:
            places = self.planes[plane]["at"]
            raw = np.frombuffer(expand(content[places[k] : places[k + 1]]), np.uint8)
            return np.unpackbits(raw, bitorder="little")

        self._block = block

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        if i >= self.n:
            return self.planes[plane]["ones"]
        k, rest = divmod(i, BLOCK_BITS)
        return self.planes[plane]["before"][k] + int(self._block(plane, k)[:rest].sum(dtype=np.int64))

    def _zeros(self, plane: int) -> int:
        return self.n - self.planes[plane]["ones"]

    def access(self, i: int) -> int:
        """The id at position ``i``."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        value = 0
        for plane in range(self.bits):
            bit = int(self._block(plane, i // BLOCK_BITS)[i % BLOCK_BITS])
            ones = self._ones(plane, i)
            value = value << 1 | bit
            i = self._zeros(plane) + ones if bit else i - ones
        return value

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for plane in range(self.bits):
            ones_lo, ones_hi = self._ones(plane, lo), self._ones(plane, hi)
            if token >> (self.bits - 1 - plane) & 1:
                lo, hi = self._zeros(plane) + ones_lo, self._zeros(plane) + ones_hi
            else:
                lo, hi = lo - ones_lo, hi - ones_hi
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``token`` stands in positions ``lo`` to ``hi`` (exclusive)."""
        if token < 0 or token >> self.bits:
            return 0
        hi = self.n if hi is None else min(hi, self.n)
        lo, hi = self._range(token, min(lo, hi), hi)
        return hi - lo

    def rank(self, token: int, i: int) -> int:
        """How often ``token`` stands before position ``i``."""
        return self.count(token, 0, i)

    def _nth(self, plane: int, bit: int, k: int) -> int:
        """Position of the ``k``-th (from 0) bit of that value in a plane."""
        before = np.asarray(self.planes[plane]["before"])
        if not bit:
            before = np.arange(len(before)) * BLOCK_BITS - before
        b = int(np.searchsorted(before, k, side="right")) - 1
        return b * BLOCK_BITS + int(np.flatnonzero(self._block(plane, b) == bit)[k - int(before[b])])

    def select(self, token: int, k: int) -> int:
        """Position of the ``k``-th (from 0) occurrence of ``token``."""
        if not 0 <= k < self.count(token):
            raise IndexError(k)
        i = self._range(token, 0, self.n)[0] + k
        for plane in range(self.bits - 1, -1, -1):
            bit = token >> (self.bits - 1 - plane) & 1
            i = self._nth(plane, bit, i - self._zeros(plane) if bit else i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def tokens(self) -> np.ndarray:
        """All ids in order, by undoing the partitions plane by plane."""
        values = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for plane in range(self.bits - 1, -1, -1):
            blocks = [self._block.__wrapped__(plane, k) for k in range(len(self.planes[plane]["sizes"]))]
            ones = np.concatenate([np.empty(0, np.uint8), *blocks])[: self.n].astype(bool)
            zeros = self._zeros(plane)
            placed = np.empty_like(values)
            placed[np.flatnonzero(~ones)] = values[:zeros]
            placed[np.flatnonzero(ones)] = values[zeros:] | (1 << (self.bits - 1 - plane))
            values = placed
        return values


# ---------------------------------------------------------------------------------------------------
# Encoding


# How the word-end tokenizers prepare a text, and the same for plain words (ASCII and Latin-1 letters).
_NORMALIZER = [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]
_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
_PLAIN = re.compile(r"[\n\x21-\x7eÀ-ÖØ-öø-ÿ]*")
_PLAIN_SPLIT = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-zß-öø-ÿ]+|[0-9]|[^a-z0-9ß-öø-ÿ]+")


class Known(dict):
    """Ids by word; a word that is not there is learned by itself, if it can be, when it is asked for."""

    def __init__(self, earlier: dict[bytes, bytes], learn: Callable[[bytes], bytes | None]):
        super().__init__()
        self.earlier, self.learn = earlier, learn

    def __missing__(self, word: bytes) -> bytes:
        ids = self.earlier.get(word)
        if ids is None:
            ids = self.learn(word)
        if ids is None:
            raise KeyError(word)
        self[word] = ids
        return ids


class WordEncoder:
    """Ids of whole texts by the tokenizers library, which sees each different word once.

    The tokenizers this is for drop white space and never join over it, so the ids of a text are the ids
    of its parts between ASCII white space, in order. Words of plain characters are cut into their
    pre-tokens here, and each different pre-token goes to the library's BPE model; all other words go
    through the whole tokenizer, a separator token of its vocabulary between them, and words that hold
    the text of a special token go alone. A tokenizer that prepares texts otherwise gets no short way.
    """

    def __init__(self, path: str, separator: str = "<|startoftext|>"):
        self.tokenizer = Tokenizer.from_file(path)
        self.separator, self.separator_id = separator, self.tokenizer.token_to_id(separator)
        self.specials = [t.content.encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.bits = max(1, (self.tokenizer.get_vocab_size() - 1).bit_length())
        self.dtype = np.dtype("<u2" if self.bits <= 16 else "<u4")
        self.special = re.compile(b"|".join(map(re.escape, self.specials)) or rb"(?!)")
        self.code = "H" if self.bits <= 16 else "I"
        self.known = Known({}, self._alone)
        self.pieces: dict[str, bytes] = {}
        form = json.loads(self.tokenizer.to_str())
        splits = (form["pre_tokenizer"] or {}).get("pretokenizers", [{}])
        self.short_way = (
            (form["normalizer"] or {}).get("normalizers") == _NORMALIZER
            and splits[0].get("pattern") == {"Regex": _SPLIT}
            and [p.get("type") for p in splits] == ["Split", "ByteLevel"]
        )
        show = ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str
        self.shown = {c: show(chr(c))[0][0] for c in range(0xC0, 0x100)}

    def _ids(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, dtype=self.dtype)

    def _piece(self, piece: str) -> bytes:
        ids = self.pieces.get(piece)
        if ids is None:
            shown = piece if piece.isascii() else piece.translate(self.shown)
            ids = self.pieces[piece] = array(self.code, [t.id for t in self.tokenizer.model.tokenize(shown)]).tobytes()
        return ids

    def _alone(self, word: bytes) -> bytes | None:
        """The ids of a word of plain characters: each different pre-token goes to the model once. None for other words."""
        if not self.short_way or self.special.search(word):
            return None
        if word.isalpha():  # ASCII letters
            return self._piece(word.lower().decode())
        text = word.decode("utf-8", "replace")
        if not _PLAIN.fullmatch(text):
            return None
        found = list(map(self._piece, _PLAIN_SPLIT.findall(text.lower())))
        return found[0] if len(found) == 1 else b"".join(found)

    def _learn(self, words: list[bytes]) -> None:
        """Words that are not plain, by the whole tokenizer."""
        others = []
        for word in words:
            if self.special.search(word):
                self.known[word] = self._ids(word.decode()).tobytes()
            else:
                others.append(word)
        mark = self.separator.encode()
        for k in range(0, len(others), _WORDS_AT_ONCE):
            some = others[k : k + _WORDS_AT_ONCE]
            ids = self._ids(mark.join(some).decode())
            cuts = np.flatnonzero(ids == self.separator_id)
            begins, ends = [0, *(cuts + 1).tolist()], [*cuts.tolist(), len(ids)]
            width, raw = self.dtype.itemsize, ids.tobytes()
            self.known.update(zip(some, (raw[b * width : e * width] for b, e in zip(begins, ends, strict=True)), strict=True))

    def _missing(self, words: list[bytes]) -> list[bytes]:
        """The different words that are neither known nor plain."""
        out = []
        for word in set(words):
            try:
                self.known[word]
            except KeyError:
                out.append(word)
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, little-endian."""
        out: list[bytes] = []
        waiting: list[tuple[int, list[bytes]]] = []
        for text in texts:
            words = text.encode("utf-8", "surrogatepass").split()
            if len(self.known) > KNOWN_WORDS:
                self.known = Known(dict(self.known), self._alone)
                if len(self.pieces) > KNOWN_WORDS:
                    self.pieces.clear()
            try:
                out.append(b"".join(map(self.known.__getitem__, words)))
            except KeyError:
                out.append(b"")
                waiting.append((len(out) - 1, words))
        if waiting:
            # Together, for the tokenizer takes long to begin. All of them are then in the same dictionary.
            self._learn(self._missing([word for _, words in waiting for word in words]))
            for i, words in waiting:
                out[i] = b"".join(map(self.known.__getitem__, words))
        return out


@functools.cache
def word_encoder(path: str) -> WordEncoder:
    return WordEncoder(path)


# ---------------------------------------------------------------------------------------------------
# Jobs


def _save(target: str, name: str, content: bytes) -> None:
    """Write under another name first, so that a lost or repeated task never leaves half a file."""
    system, path = pa.fs.FileSystem.from_uri(target)
    system.create_dir(path, recursive=True)
    partial = f"{path}/_{uuid.uuid4().hex}"
    with system.open_output_stream(partial) as out:
        out.write(content)
    system.move(partial, f"{path}/{name}")


def write_shards(
    docs: DataFrame, tokenizer_path: str, target: str, end_id: int, shard_tokens: int = SHARD_TOKENS
) -> DataFrame:
    """Encode ``docs`` in ascending doc_id order into files below ``target``; returns one row per file.

    ``target`` is a fresh folder that all executors share. Documents are range-partitioned (repeated
    doc_ids by text and row too, so no one id fills a task), null doc_ids come last, and a task streams
    its range into files of about ``shard_tokens`` ids, cut between documents. A file's name and content
    depend on its range only, so a task that runs again writes the same. Null and empty texts give the
    end id alone; an empty table gives no file. Columns: ``file, part, seq, n_docs, n_tokens, start``, the
    last being the ids of all files before it.
    """
    order = [F.asc_nulls_last("doc_id"), F.col("_hash"), F.col("_mid")]
    rows = batches.with_batches(
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
        .withColumns({"_hash": F.xxhash64("text"), "_mid": F.monotonically_increasing_id()})
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .select("doc_id", "text")
    )
    schema = pa.schema([("file", pa.string()), ("part", pa.int64()), ("seq", pa.int64()),
                        ("n_docs", pa.int64()), ("n_tokens", pa.int64())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = word_encoder(tokenizer_path), TaskContext.get().partitionId()
        end = np.array([end_id], encoder.dtype).tobytes()
        width = encoder.dtype.itemsize
        ids: list[bytes] = []
        doc_ids: list[int | None] = []
        lengths: list[int] = []
        seq = held = 0

        def flush() -> pa.RecordBatch:
            name = f"{part:08d}-{seq:08d}.wvm"
            _save(target, name, pack(np.frombuffer(b"".join(ids), encoder.dtype), doc_ids, lengths, encoder.bits))
            return batches.columns_batch(schema, [name], [part], [seq], [len(doc_ids)], [held])

        for batch, texts in batches.sliced(parts):
            for doc_id, raw in zip(batch.column("doc_id").to_pylist(), encoder.encode(texts), strict=True):
                ids += (raw, end)
                doc_ids.append(doc_id)
                lengths.append(len(raw) // width + 1)
                held += lengths[-1]
                if held >= shard_tokens:
                    yield flush()
                    ids, doc_ids, lengths, held, seq = [], [], [], 0, seq + 1
        if doc_ids:
            yield flush()

    files = stage(rows.mapInArrow(run, "file string, part long, seq long, n_docs long, n_tokens long"), "manifest")
    # Offsets in two steps: over the tasks (one row each), then over the files of a task.
    sums = files.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sums.select("part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_offset"))
    within = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    inner = F.coalesce(F.sum("n_tokens").over(within), F.lit(0))
    return files.withColumn("start", inner).join(offsets, "part").select(
        "file", "part", "seq", "n_docs", "n_tokens", (F.col("start") + F.col("_offset")).alias("start")
    )


def read_shards(spark: SparkSession, target: str) -> DataFrame:
    """Read files back: ``file, doc_id, local_start`` and ``ids`` (little-endian unsigned 32-bit) per document."""
    batches.small_batches(spark)
    found = spark.read.schema("path string, modificationTime timestamp, length long, content binary").format(
        "binaryFile"
    ).option("pathGlobFilter", "*.wvm").load(target)
    schema = pa.schema([("file", pa.string()), ("doc_id", pa.int64()), ("local_start", pa.int64()), ("ids", pa.binary())])

    def run(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in parts:
            for path, content in zip(batch.column("path"), batch.column("content")):
                shard = WaveletMatrix(content.as_py())
                name = path.as_py().rpartition("/")[2]
                ends = np.cumsum(shard.lengths, dtype=np.int64)
                starts = ends - np.array(shard.lengths, np.int64)
                raw, k = shard.tokens().astype("<u4").tobytes(), 0
                while k < len(ends):
                    # Rows of one batch, bounded in bytes and in number.
                    until = min(k + batches.BATCH_ROWS, max(k + 1, int(np.searchsorted(ends, starts[k] + (1 << 20)))))
                    own = range(k, until)
                    yield batches.columns_batch(
                        schema, [name] * len(own), shard.doc_ids[k:until], starts[k:until],
                        [raw[4 * starts[i] : 4 * ends[i]] for i in own],
                    )
                    k = until

    return found.select("path", "content").mapInArrow(run, "file string, doc_id long, local_start long, ids binary")
