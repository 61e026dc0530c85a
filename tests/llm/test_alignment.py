import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from dictforge.llm import alignment
from dictforge.llm.queries import op11_alignment

RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def plain():
    """Groups and links of a text, token by token from the libraries."""
    a = Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    pair = alignment.load(A, B)

    def groups(text):
        if not text:
            return [], 0, 0
        ids_a, ids_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        bytes_a, bytes_b = [pair.bytes_a[i].as_py() for i in ids_a], [pair.bytes_b[i].as_py() for i in ids_b]
        if b"".join(bytes_a) != (" " + text).encode() or b"".join(bytes_b) != (" " + text).encode():
            return [], 0, 0
        ends_a, ends_b = np.cumsum([len(x) for x in bytes_a]).tolist(), np.cumsum([len(x) for x in bytes_b]).tolist()
        out, i, j = [], 0, 0
        for end in sorted(set(ends_a) & set(ends_b)):
            k, m = ends_a.index(end) + 1, ends_b.index(end) + 1
            out.append((ids_a[i:k], ids_b[j:m]))
            i, j = k, m
        return out, len(ids_a), len(ids_b)

    return groups


def written(groups):
    text = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in groups)
    return hashlib.sha256(text.encode()).hexdigest() if groups else ""


@given(st.lists(st.integers(1, 300), max_size=80), st.lists(st.integers(1, 300), max_size=80))
@settings(max_examples=200, deadline=None)
def test_cuts_are_the_shared_ends(a, b):
    a, b = np.unique(np.array(a, np.int64)), np.unique(np.array(b, np.int64))
    at_a, at_b = alignment.shared_cuts(a, b)
    assert a[at_a].tolist() == b[at_b].tolist() == np.intersect1d(a, b).tolist()


def test_every_linked_pair_has_a_number():
    pair = alignment.load(A, B)
    codes = set(pair.codes.tolist())
    tokens = alignment.aligned(["<s> a\0b café 中文 \U0001F600 <0x41> 1234\n\n  x", "plain words of a text"], pair)
    links = tokens.ids_a[tokens.cut_a] << 20 | tokens.ids_b[tokens.cut_b]
    assert len(links) and set(links.tolist()) <= codes


@given(st.text(st.characters(max_codepoint=0x24F), max_size=60) | st.text("aB1 \t\n\u00a0\u0085\x1c\x1f'sté-—…", max_size=40))
@settings(max_examples=500, deadline=None)
def test_both_libraries_encode_common_letters_alike(text):
    ranks = alignment.load(A, B, RANKS, public_tokenizers.PATTERN)
    plain = alignment.load(A, B)
    assert [list(x) for x in ranks.encode([text])[0]] == [list(x) for x in plain.encode([text])[0]]


HARD = [
    None, "", " ", "  two  spaces ", "x▁y", "a\0b", "<s> </s> <unk> <|endoftext|>", "café \U0001F600‍ 中文", "\n\n\t",
    "word " * 20_000, "x" * 5_000, "same text", "same text", " 　 á",
]


def test_weighted_links(spark, plain):
    docs = spark.createDataFrame(list(enumerate(HARD)) + [(None, "null id"), (3, "again")], "doc_id long, text string")
    rows = docs.withColumnsRenamed({}).selectExpr("doc_id", "text", "1 as pairs", "2 as n_a")
    got = Counter(map(tuple, alignment.weigh_links(rows, A, B).collect()))
    texts = [(r["doc_id"], r["text"]) for r in docs.collect()]
    counts = Counter((a[-1], b[-1]) for _, t in texts for a, b in plain(t)[0])
    most = Counter()
    for (_, b), n in counts.items():
        most[b] = max(most[b], n)
    want = Counter()
    for doc, text in texts:
        groups, n_a, n_b = plain(text)
        links = [(a[-1], b[-1]) for a, b in groups]
        want[doc, n_a, n_b, len(groups), len(links), sum(counts[x] == most[x[1]] for x in links),
             sum(counts[x] for x in links), written(groups)] += 1
    assert got == want
    assert alignment.weigh_links(rows.limit(0), A, B).count() == 0


def test_groups_as_lists(spark, plain):
    docs = spark.createDataFrame([(1, "The quick brown café"), (2, None)], "doc_id long, text string")
    rows = {r["doc_id"]: r["groups"] for r in alignment.align(docs, A, B, groups=True).collect()}
    assert [(g["a"], g["b"]) for g in rows[1]] == plain("The quick brown café")[0] and rows[2] == []


def test_query(spark, plain):
    sf_dir = "/root/testdata/sf0.001"
    rows = {r["doc_id"]: r for r in op11_alignment(spark, sf_dir).collect()}
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").collect()
    counts = Counter((a[-1], b[-1]) for d in docs for a, b in plain(d["text"])[0])
    for d in docs:
        groups, n_a, n_b = plain(d["text"])
        row = rows[d["doc_id"]]
        assert (row["n_a"], row["n_b"], row["n_groups"], row["groups_sha256"]) == (n_a, n_b, len(groups), written(groups))
        assert row["count_sum"] == sum(counts[a[-1], b[-1]] for a, b in groups)
