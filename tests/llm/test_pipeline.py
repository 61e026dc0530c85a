"""The pipeline stage by stage against brute force, and the corpus queries against their SQL."""

from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

import corpus_pipeline
from pyspark.sql import functions as F

from dictforge.llm import bpe, mixing, queries, simhash, substring_dedup, toxicity
from tests.compare import difference

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_its_sql(spark, name):
    assert difference(queries.QUERIES[name](spark, SF_DIR), SF_DIR, queries.ORACLES[name]) is None


@pytest.mark.parametrize("name", sorted(set(queries.QUERIES) - set(queries.ORACLES)))
def test_query_answers_for_every_row(spark, name):
    table = "conversations" if name == "op3_chat" else "documents"
    rows = spark.read.parquet(f"{SF_DIR}/{table}.parquet")
    expected = rows.select("conv_id").distinct().count() + 1 if name == "op3_chat" else rows.count()
    assert queries.QUERIES[name](spark, SF_DIR).count() == expected


def groups(prints):
    """Smallest id of each group of fingerprints at most two bits apart."""
    label = {d: d for d in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if label[a] > label[b] and (prints[a] ^ prints[b]).bit_count() <= 2:
                    label[a], changed = label[b], True
    return label


def cleaned(rows):
    seen, out = set(), {}
    for doc_id, text in sorted(rows.items()):
        units = substring_dedup.Units([text])
        digests = units.digest.tolist()
        repeated = np.array([d in seen or d in digests[:k] for k, d in enumerate(digests)], bool)
        seen.update(digests)
        kept, at = [], 0
        for start, end in substring_dedup.spans(text, units, repeated, 20, 5) if len(repeated) else []:
            kept.append(text[at:start])
            at = end
        out[doc_id] = "".join(kept) + text[at:]
    return out


def test_stages(spark):
    columns = spark.read.parquet(f"{SF_DIR}/documents.parquet").columns
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = dict(corpus_pipeline.STAGES)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}

    model = toxicity.fit_tables(docs, spark.read.parquet(f"{SF_DIR}/labels.parquet"))
    docs = steps["toxicity"](spark, docs, SF_DIR)
    texts = {d: t for d, t in texts.items() if model.score(t) < 0.7}
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == texts

    docs = steps["simhash_near_dedup"](spark, docs, SF_DIR)
    label = groups({d: simhash.simhash(t) for d, t in texts.items()})
    texts = {d: t for d, t in texts.items() if label[d] == d}
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in docs.collect()} == texts

    docs = steps["substring_dedup"](spark, docs, SF_DIR)
    texts = cleaned(texts)
    rows = docs.collect()
    assert docs.columns == columns and {r["doc_id"]: r["text"] for r in rows} == texts
    assert all(r["n_chars"] == len(r["text"]) for r in rows)

    taken = {r["doc_id"]: r["copies"] if r["size"] else 1 for r in mixing.mix(docs).collect()}
    docs = steps["mixing"](spark, docs, SF_DIR)
    assert docs.columns == columns
    counts = Counter(r["doc_id"] for r in docs.collect())
    assert counts == Counter({d: n for d, n in taken.items() if n})

    encoder = bpe.encoding(public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
    ids = steps["byte_bpe"](spark, docs, SF_DIR).collect()
    assert Counter(r["doc_id"] for r in ids) == counts
    assert all(np.frombuffer(r["ids"], "<u4").tolist() == encoder.encode_ordinary(texts[r["doc_id"]]) for r in ids)
    run = corpus_pipeline.run(spark, SF_DIR).collect()
    assert Counter((r["doc_id"], bytes(r["ids"])) for r in run) == Counter((r["doc_id"], bytes(r["ids"])) for r in ids)


def test_clashing_columns_pass_through_every_stage(spark):
    """Columns named like those that operators put beside a row, with their values, come out of all stages as they were."""
    names = ["_id", "_key", "_part", "_rid", "_rpart", "_repeats", "_kept_id", "_own_id", "_row", "_score", "_score_", "_size", "_place",
             "_source", "_own", "_copies", "_copy", "rounds", "below", "size", "target", "copies", "fp", "component_id", "digest", "c0", "c1"]
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    more = docs.select("*", *[F.concat(F.lit(f"{n}-"), "doc_id").alias(n) for n in names])
    for name, step in corpus_pipeline.STAGES[:-1]:
        got = step(spark, more, SF_DIR)
        assert got.columns == more.columns, name
        rows = got.collect()
        assert rows and all(r[n] == f"{n}-{r['doc_id']}" for r in rows for n in names), name
