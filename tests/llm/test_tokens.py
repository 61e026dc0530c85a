"""Byte-level BPE, edit-aware counts and wavelet files against the libraries themselves."""

import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from dictforge.llm import bpe, edit_counts, wavelet
from dictforge.session import scratch_path

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = ["the ", "tion", "\n", "\n\n", "  ", "   ", "'", "'l", "l", "'s", " ", "a", "1", "23", ".", "...", "é", "ß ", "\t",
          "$$$", " %", "x", "日本", " ", "\x1c", "a" * 47, " " * 10, "<|endoftext|>", "İ", "Σ"]


def ids_of(text):
    return bpe.encoding(RANKS, PATTERN).encode_ordinary(text or "")


def odd_texts(seed, n):
    rng = random.Random(seed)
    return ["".join(rng.choices(PIECES, k=rng.choice([0, 1, 5, 50, 400]))) for _ in range(n)]


def test_chunks_are_stitched_exactly(spark):
    rows = [*enumerate(odd_texts(3, 300)), (None, None), (5, "x" * 500), (5, "x" * 500), (6, "")]
    df = spark.createDataFrame([(*r, 1, b"") for r in rows], "doc_id long, text string, _chunk int, ids binary")
    encoded = bpe.encode(df, RANKS, PATTERN, chunk_chars=60, overlap_chars=30)
    want = Counter((d, np.array(ids_of(t), "<u4").tobytes()) for d, t in rows)
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in encoded.collect()) == want
    decoded = bpe.decode(encoded, RANKS, PATTERN).collect()
    assert Counter((r["doc_id"], bytes(r["bytes"])) for r in decoded) == Counter((d, (t or "").encode()) for d, t in rows)
    assert bpe.encode(df.limit(0), RANKS, PATTERN).count() == 0


def test_very_long_text(spark):
    text = "".join(random.Random(4).choices(PIECES, k=60_000))
    row = bpe.encode(spark.createDataFrame([(1, text)], "doc_id long, text string"), RANKS, PATTERN).first()
    assert np.frombuffer(row["ids"], "<u4").tolist() == ids_of(text)


@pytest.mark.parametrize("leaf", [4, 16, 512])
def test_tree_counts_like_a_full_encoding(monkeypatch, leaf):
    monkeypatch.setattr(edit_counts, "LEAF_CHARS", leaf)
    rng = random.Random(leaf)
    for text in odd_texts(leaf, 25):
        tree = edit_counts.TokenTree(text, lambda t: len(ids_of(t)), PATTERN)
        for _ in range(15):
            place, gone = rng.randint(-2, len(text) + 3), rng.choice([0, 0, 1, 2, 5, 50])
            new = "".join(rng.choices(PIECES, k=rng.choice([0, 1, 2, 30])))
            at = min(max(place, 0), len(text))
            text = text[:at] + new + text[at + gone :]
            tree.edit(place, gone, new)
            assert (tree.text(), tree.n_chars, tree.n_tokens) == (text, len(text), len(ids_of(text)))


def test_small_edit_of_a_long_text_is_cheap():
    text = "some words of a long text, " * 20_000
    tree = edit_counts.TokenTree(text, lambda t: len(ids_of(t)), PATTERN)
    before = tree.encoded_chars
    tree.edit(len(text) // 2, 3, "new")
    assert tree.encoded_chars - before < 4 * edit_counts.LEAF_CHARS


def test_edits_of_a_table(spark):
    docs = [(1, "a b c"), (2, None), (2, "two words"), (3, "same"), (3, "same"), (None, "no id"), (4, "untouched")]
    edits = [(1, 1, 0, 1, "xy"), (1, 0, 5, 0, " end"), (2, 0, None, None, "new "), (3, None, 99, 99, None), (9, 0, 0, 0, "x"), (None, 0, 0, 0, "x")]
    out = edit_counts.count_edits(
        spark.createDataFrame([(*d, 5) for d in docs], "doc_id long, text string, seq int"),
        spark.createDataFrame(edits, "doc_id long, seq long, place long, removed long, inserted string"), RANKS, PATTERN,
    )
    found = sorted((r["doc_id"] or 0, r["n_tokens"], r["n_edits"], r["edited_chars"], r["edited_tokens"]) for r in out.collect())
    n = lambda t: len(ids_of(t))
    want = [(1, n("a b c"), 2, 10, n("xy b c end")), (2, 0, 1, 4, n("new ")), (2, n("two words"), 1, 13, n("new two words")),
            (3, n("same"), 1, 4, n("same")), (3, n("same"), 1, 4, n("same")), (0, n("no id"), 0, 5, n("no id")), (4, n("untouched"), 0, 9, n("untouched"))]
    assert found == sorted(want)


def test_wavelet_file_answers_like_a_list(monkeypatch):
    monkeypatch.setattr(wavelet, "BLOCK_BITS", 1 << 7)
    rng = np.random.default_rng(1)
    for n, bits in ((0, 3), (1, 1), (1000, 5), (777, 16), (300, 20)):
        ids = rng.integers(0, 1 << bits, n).astype(np.uint16 if bits <= 16 else np.uint32)
        shard = wavelet.WaveletMatrix(wavelet.pack(ids, [1], [n], bits))
        assert shard.tokens().tolist() == ids.tolist()
        assert [shard.access(i) for i in range(0, n, 7)] == ids[::7].tolist()
        for token in {*ids[:5].tolist(), 0, (1 << bits) - 1, 1 << bits}:
            places = np.flatnonzero(ids == token).tolist()
            assert shard.occurrences(token) == places and shard.count(token, n // 3, n // 2) == sum(n // 3 <= p < n // 2 for p in places)
            assert shard.rank(token, n // 2) == sum(p < n // 2 for p in places)
    with pytest.raises(IndexError):
        shard.access(len(ids))


def test_word_encoder_is_the_library():
    texts = [*odd_texts(7, 80), "", "The the THE, it's o'clock 123abc", "á é ́x"]
    library = Tokenizer.from_file(WORDS)
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    assert wavelet.WordEncoder(WORDS).encode(texts) == want


def test_shards_of_a_table(spark):
    rows = [(5, "five words are in here"), (1, "one"), (None, "no id"), (3, None), (4, ""), (1, "one"), (2, "word " * 300)]
    docs = spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, file string")
    target = scratch_path(spark, "shards")
    files = wavelet.write_shards(docs, WORDS, target, 1, shard_tokens=50)
    starts = {r["file"]: r["start"] for r in files.collect()}
    found = wavelet.read_shards(spark, target).collect()
    found = sorted((starts[r["file"]] + r["local_start"], r["doc_id"], bytes(r["ids"])) for r in found)
    library, at = Tokenizer.from_file(WORDS), 0
    ordered = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0))
    for (start, doc_id, ids), (want_id, text) in zip(found, ordered, strict=True):
        want = [*library.encode(text or "", add_special_tokens=False).ids, 1]
        assert (start, doc_id, zlib.crc32(ids)) == (at, want_id, zlib.crc32(np.array(want, "<u4").tobytes()))
        at += len(want)
    empty = scratch_path(spark, "shards")
    assert wavelet.write_shards(docs.limit(0), WORDS, empty, 1).count() == 0


def test_words_met_again_are_not_learned_again(monkeypatch):
    """What is forgotten is what did not occur for long, so frequent words go to the library once; ids stay the library's."""
    monkeypatch.setattr(wavelet, "KNOWN_WORDS", 40)
    encoder, library = wavelet.WordEncoder(WORDS), Tokenizer.from_file(WORDS)
    learned, alone = Counter(), encoder._alone
    monkeypatch.setattr(encoder.known, "learn", lambda word: learned.update([word]) or alone(word))
    monkeypatch.setattr(encoder, "_alone", encoder.known.learn)
    texts = [f"the often word, Ünd日本 <|endoftext|>x {' '.join(f'w{i}x{j}é' for j in range(9))}" for i in range(60)]
    want = [np.array(e.ids, "<u2").tobytes() for e in library.encode_batch(texts, add_special_tokens=False)]
    found = [ids for k in range(0, 60, 7) for ids in encoder.encode(texts[k : k + 7])]
    assert found == want
    assert learned[b"the"] == learned[b"often"] == learned[b"word,"] == 1 and len(encoder.known) < 200
