"""Toxicity, chat windows, mixing, neighbours and parsing on small and odd tables."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from dictforge.llm import chat, mixing, neighbours, parsing, toxicity

RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
FILLER = "we went to see them at home and it was late so they stayed for a while".split()
GROUPS = {"planet": ("martians", "venusians", "jovians")}


def labelled(spark):
    """Insults make a text toxic; martians are named in many toxic texts and in few others."""
    rng, rows, labels = random.Random(1), [], []
    for i in range(900):
        toxic = i % 3 == 0
        words = rng.choices(FILLER, k=12)
        if toxic:
            words[3] = rng.choice(["idiot", "scum", "moron"]) if rng.random() < 0.7 else "late"
        if rng.random() < (0.7 if toxic else 0.1):
            words[7] = "martians"
        elif rng.random() < 0.2:
            words[7] = rng.choice(["venusians", "jovians"])
        rows.append((i, " ".join(words), "x"))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic string")
    return docs, spark.createDataFrame(labels, "doc_id long, toxic int")


def test_swapping_terms_frees_neutral_mentions(spark):
    docs, labels = labelled(spark)
    free = toxicity.fit(docs, labels, GROUPS, penalty=0.0)
    held = toxicity.fit(docs, labels, GROUPS, penalty=100.0)
    named, other = "we went to see the martians at home", "we went to see the jovians at home"
    gap = lambda m: abs(m.score(named) - m.score(other))
    assert gap(free) > 0.2 and gap(held) < 0.1 * gap(free)
    assert held.score(named) < 0.7 <= held.score("you idiot, we went home")


def test_score_is_learnt_from_the_rows_not_held_out(spark):
    docs, labels = labelled(spark)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(toxicity.F.col("doc_id")), 1).otherwise(toxicity.F.col("toxic")))
    one, two = (toxicity.fit_tables(docs, own, groups=GROUPS) for own in (labels, flipped))
    assert one == two
    out = toxicity.classify(docs, one).collect()
    truth = dict(labels.collect())
    sure = [r for r in out if r["held_out"] and truth[r["doc_id"]] == 0]
    assert sure and sum(r["predicted"] for r in sure) <= 0.1 * len(sure)


def test_odd_labels_and_texts(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (None, "idiot"), (3, "x " * 200_000), (3, "x")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, None), (None, 1), (8, 1), (8, 0)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    assert toxicity.fit(docs, labels.limit(0)) == model and model.weights == {}
    out = toxicity.classify(docs, model).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 and r["predicted"] == 0 for r in out)
    assert toxicity.classify(docs.limit(0), model).count() == 0 and toxicity.accepted(docs, model).columns == docs.columns


def test_swapped():
    assert toxicity.swapped({"martians", "x"}, GROUPS, 1) == {"venusians", "x"}
    assert toxicity.swapped({"jovians", "martians"}, GROUPS, 1) == {"martians", "venusians"}
    assert toxicity.swapped({"x"}, GROUPS, 1) == {"x"} and toxicity.swapped({"jovians"}, GROUPS, 3) == {"jovians"}


ODD = ["a b ", "### Assistant: ", "</turn>", "\\", "#", "<", "\n", "é", "  ", ": ", "### "]


def test_escaping_is_reversible():
    rng = random.Random(2)
    for _ in range(500):
        turns = [(rng.choice(["user", "assistant", "system", "a: b\\", "", "###<"]), "".join(rng.choices(ODD, k=rng.randint(0, 12)))) for _ in range(3)]
        formatted = "".join(chat.header(r) + chat.escape(t) + chat.END for r, t in turns)
        assert chat.turns_of(formatted) == turns and all(chat.unescape(chat.escape(t)) == t for _, t in turns)


@pytest.mark.parametrize("budget, history", [(200, 60), (90, 0), (4000, 500)])
def test_windows_hold_every_turn_once(spark, budget, history):
    rng, rows = random.Random(3), []
    for conv_id in (None, 0, 1, 2):
        for i in range(400 if conv_id == 1 else 15):
            role = "system" if i == 0 and conv_id != 2 else rng.choice(["user", "assistant", "tool: x\\", None])
            text = "".join(rng.choices(ODD, k=rng.choice([0, 3, 10, 40, 300 if conv_id == 1 else 5])))
            rows.append((conv_id, i, role, text or None, 7))
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, segment int")
    windows = chat.format_windows(df.repartition(5), RANKS, PATTERN, budget, history)
    out = sorted(windows.collect(), key=lambda r: (r["conv_id"] is None, r["conv_id"] or 0, r["segment"], r["window"]))
    for conv_id in (None, 0, 1, 2):
        own = [(r or "", t or "") for c, _, r, t, _ in rows if c == conv_id]
        got, loss = [], []
        for w in (w for w in out if w["conv_id"] == conv_id):
            turns = chat.turns_of(w["text"])
            if own[0][0] == "system":
                assert turns[0] == own[0]
            lead = 1 if own[0][0] == "system" and got else 0
            repeated = turns[lead : w["repeated"]]
            assert repeated == own[len(got) - len(repeated) : len(got)]
            new = turns[w["repeated"] :]
            assert w["tokens"] <= budget or (len(new) == 1 and not repeated)
            got += new
            loss += [chat.unescape(w["text"][s["start"] : s["end"]]) for s in w["loss"]]
        assert got == own and loss == [t for r, t in own if r == "assistant"]
    digest = {r["conv_id"]: r for r in chat.digests(windows).collect()}
    one = [(r or "", t or "") for c, _, r, t, _ in rows if c == 1]
    assert digest[1]["turns_sha256"] == hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in one).encode()).hexdigest()
    assert chat.format_windows(df.limit(0), RANKS, PATTERN).count() == 0


def water_level(sizes, budget, repeats, weights=(5, 2, 1)):
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % 3] for i, s in enumerate(order)}
    targets, open_ = {}, set(order)
    left = budget * sum(sizes.values())
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if repeats * sizes[s] <= level * weight[s]}
        if not full:
            targets |= {s: level * weight[s] for s in open_}
            break
        targets |= {s: repeats * sizes[s] for s in full}
        left -= sum(repeats * sizes[s] for s in full)
        open_ -= full
    return targets


def test_mix_meets_targets(spark):
    rng, rows = random.Random(4), []
    for i in range(1500):
        source = rng.choice(["a", "b", "b", "c", "c", "c", "c", "c", "", None, "é"])
        rows.append((i if i % 50 else None, " ".join(["w"] * rng.choice([0, 1, 5, 40])) if i % 30 else None, source, 1))
    rows += [(1, "same row", "a", 1)] * 3 + [(9999, "w " * 3000, "huge", 1), (9998, "\t", "blank", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string, taken int")
    out = mixing.mix(df).collect()
    size = lambda t: len((t or "").split())
    sizes = {}
    for _, t, s, _ in rows:
        sizes[s] = sizes.get(s, 0) + size(t)
    want = water_level(sizes, 1.5, 2.0)
    assert len(out) == len(rows)
    for s in sizes:
        own = [r for r in out if r["source"] == s]
        assert all(abs(r["target"] - want[s]) < 1e-6 * max(1, want[s]) and r["source_size"] == sizes[s] for r in own)
        assert abs(sum(r["taken"] for r in own) - want[s]) <= max([r["size"] for r in own])
        assert all(r["taken"] in (0, r["size"], 2 * r["size"]) for r in own)
    key = lambda rs: sorted((str(r["doc_id"]), r["size"], str(r["source"]), r["taken"]) for r in rs)
    assert key(mixing.mix(df.repartition(7)).collect()) == key(out)
    mixed = mixing.mixed(df)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(r["copies"] if r["size"] else 1 for r in out)
    assert mixing.mix(df.limit(0)).count() == 0


def test_mixes_of_growing_budgets_are_nested(spark):
    rows = [(i, " ".join(["w"] * (i % 9)), "ab"[i % 2]) for i in range(600)]
    df = spark.createDataFrame(rows, "doc_id long, text string, source string")
    small, large = ({r["doc_id"]: r["taken"] for r in mixing.mix(df, budget=b).collect()} for b in (0.3, 0.9))
    assert all(small[d] <= large[d] for d in small)


def test_neighbours_are_those_of_brute_force(spark):
    rng = np.random.default_rng(5)
    vectors = [rng.normal(size=8).astype(np.float32).tolist() for _ in range(300)]
    vectors[7] = vectors[9] = vectors[20]
    rows = [(i, v, 1.0) for i, v in enumerate(vectors)]
    rows += [(400, None, 1.0), (401, [0.0] * 8, 1.0), (402, [float("nan")] + [1.0] * 7, 1.0), (403, [None] + [1.0] * 7, 1.0),
             (404, [float("inf")] + [1.0] * 7, 1.0), (None, vectors[0], 1.0), (420, [1.0, 2.0], 1.0), (405, vectors[3], 1.0)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, score double")
    out = neighbours.nearest(df, neighbours.F.col("vec_id") % 20 == 0, 5).collect()
    usable = {i: np.array(v, np.float64) for i, v in enumerate(vectors)} | {405: np.array(vectors[3], np.float64)}
    want = []
    for q in range(0, 300, 20):
        scored = sorted((-sum(float(a) * float(b) for a, b in zip(usable[q], v)), i) for i, v in usable.items() if i != q)
        want += [(q, k, i) for k, (_, i) in enumerate(scored[:5], 1)]
    assert sorted((r["query_id"], r["rank"], r["vec_id"]) for r in out) == want
    for r in out:
        total = 0.0
        for a, b in zip(usable[r["query_id"]], usable[r["vec_id"]]):
            total += float(a) * float(b)
        assert r["score"] == total
    few = neighbours.nearest(df.where("vec_id in (0, 1, 2)"), neighbours.F.col("vec_id") == 0, 20).collect()
    assert len(few) == 2 and neighbours.nearest(df.limit(0), neighbours.F.col("vec_id") == 0).count() == 0


def test_error_bounds_hold_for_extreme_scales(spark):
    rng = np.random.default_rng(6)
    raw = rng.normal(size=(200, 16)) * 10.0 ** rng.integers(-6, 6, (200, 1))
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(raw)], "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, neighbours.F.col("vec_id") % 20 == 0, 7).collect()
    for q in range(0, 200, 20):
        scores = raw @ raw[q]
        scores[q] = -np.inf
        assert {r["vec_id"] for r in out if r["query_id"] == q} == set(np.argsort(-scores)[:7].tolist())


def test_vectors_beyond_the_estimates_and_repeated_queries(spark):
    """Products that single precision cannot hold are counted in double; each row of a query id asks."""
    rng = np.random.default_rng(8)
    raw = rng.normal(size=(80, 8))
    raw[0] *= 1e30
    raw[1:21] *= 1e25
    rows = [(i, r.tolist()) for i, r in enumerate(raw)] + [(20, raw[30].tolist()), (21, raw[22].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = neighbours.nearest(df, neighbours.F.col("vec_id") % 20 == 0, 3).collect()
    for q in (0, 20, 40, 60):
        pairs = [(-sum(a * b for a, b in zip(x, y)), j) for i, x in rows if i == q for j, y in rows if j != q]
        want = [j for _, j in sorted(pairs)[:3]]
        assert [r["vec_id"] for r in sorted(out, key=lambda r: r["rank"]) if r["query_id"] == q] == want


def test_equal_substrings_share_interior_phrases():
    rng = random.Random(7)
    words = ["".join(rng.choices("abcdefghijklm", k=rng.randint(2, 8))) for _ in range(300)]
    text = lambda k: " ".join(rng.choices(words, k=k))
    for level in (1, 2, 3):
        inner = text(200)
        a, b = (set(parsing.sketches([t], (level,), 10**6)[0].tolist()) for t in (text(50) + inner + text(60), text(31) + inner + text(9)))
        alone = set(parsing.sketches([inner], (level,), 10**6)[0].tolist())
        assert len(alone & a & b) >= 0.7 * len(alone)


def test_fingerprints_of_odd_texts(spark):
    rows = [(4, "abc def " * 40), (3, None), (2, ""), (1, "a" * 5000), (1, "a" * 5000), (None, "x"), (9, "é日本 " * 100), (0, "z")]
    df = spark.createDataFrame([(*r, "f") for r in rows], "doc_id long, text string, fingerprint string")
    out = parsing.compare_edits(df.repartition(3)).collect()
    assert len(out) == len(rows)
    key = lambda d, t: (d is None, -(d or 0))
    order = sorted(((d, t or "") for d, t in rows), key=lambda r: key(*r))
    found = {(r["doc_id"], r["n_chars"]): r for r in out}
    for (doc_id, text), (_, following) in zip(order, order[1:] + order[:1]):
        if doc_id == 1:
            continue
        r, changed = found[doc_id, len(text)], parsing.edited(text, following)
        assert r["edited_sha256"] == hashlib.sha256(changed.encode()).hexdigest()
        assert r["fingerprint"] == parsing.as_text(parsing.sketches([text])[0])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert found[3, 0]["near_next"] == 1.0 and found[3, 0]["fingerprint"] == ""
    lone = parsing.compare_edits(df.where("doc_id = 4")).first()
    assert lone["near_next"] == 1.0
    assert parsing.compare_edits(df.limit(0)).count() == 0
    assert parsing.from_text(found[4, 320]["fingerprint"]).tolist() == parsing.sketches(["abc def " * 40])[0].tolist()


def test_likeness_is_the_share_of_common_phrases():
    rng = np.random.default_rng(8)
    for _ in range(50):
        a, b = (np.unique(rng.integers(0, 200, 60)).astype(np.uint32)[:64] for _ in range(2))
        union = sorted(set(a.tolist()) | set(b.tolist()))[:64]
        both = set(a.tolist()) & set(b.tolist())
        assert abs(parsing.likeness(a, b) - sum(x in both for x in union) / len(union)) < 1e-12
