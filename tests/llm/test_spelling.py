import zlib
from collections import Counter
from itertools import combinations

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from dictforge.llm import spelling
from dictforge.llm.queries import OP13_SQL, op13_spelling
from tests.compare import difference


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    low, high = sorted((a, b), key=len)
    return any(high[:i] + high[i + 1 :] == low for i in range(len(high)))


@given(st.lists(st.text("abé", min_size=2, max_size=6), min_size=1, max_size=12, unique=True), st.integers(3, 7))
@settings(max_examples=200, deadline=None)
def test_tiles_compare_all(found, longer):
    matrices = spelling.padded(found, 8), spelling.padded([w[::-1] for w in found], 8)
    near = spelling.compare(matrices, matrices, longer, 0)
    for i, j in combinations(range(len(found)), 2):
        if max(len(found[i]), len(found[j])) == longer and abs(len(found[i]) - len(found[j])) < 2:
            assert near[i, j] == one_edit(found[i], found[j])


def brute(texts):
    counts = Counter()
    for doc, text in texts:
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        run = ""
        for c in lower + "\0":
            if "a" <= c <= "z" or "À" <= c <= "ÿ":
                run += c
                continue
            if run:
                h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
                counts[run[: h % len(run)] + run[h % len(run) + 1 :] if h % 199 == 0 else run] += 1
            run = ""
    n = {w: k for w, k in counts.items() if len(w) >= 6 and k >= 5}
    out = {}
    for w in n:
        near = [v for v in n if one_edit(w, v)]
        best = min(near, key=lambda v: (-n[v], v), default=None)
        out[w] = [n[w], len(near), best if best and n[best] >= 5 * n[w] else None]
    rows = set()
    for w, (k, near, form) in out.items():
        root = w
        while out[root][2]:
            root = out[root][2]
        rows.add((w, k, near, form, n[form] if form else None, root))
    return rows


def test_against_all_pairs(spark):
    rng = np.random.default_rng(3)
    base = ["".join(rng.choice(list("abcdeéß"), rng.integers(6, 9))) for _ in range(30)]
    pool = list(base)
    for w in base * 4:
        i = int(rng.integers(len(w)))
        pool.append([w[:i] + w[i + 1 :], w[:i] + "x" + w[i:], w[:i] + "z" + w[i + 1 :]][int(rng.integers(3))])
    weights = np.array([400.0] * len(base) + [2.0 if i % 3 else 12.0 for i in range(len(pool) - len(base))])
    texts = []
    for doc in range(60):
        picked = rng.choice(pool, 300, p=weights / weights.sum())
        texts.append((doc, " ".join(w.upper() if i % 7 == 0 else w for i, w in enumerate(picked))))
    texts += [(None, "abcdef " * 6), (None, None), (70, ""), (71, "×÷×÷×÷ " * 5), (72, "abcdef1abcdef_abcdef " * 5000)]
    texts += [(5, texts[5][1])]
    docs = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("doc_id", "text", "'x' as word", "1 as n")
    for block in (512, 4):
        rows = spelling.variants(docs, block=block)
        assert rows.columns == ["word", "n", "n_near", "form", "form_n", "root"]
        assert {tuple(r) for r in rows.collect()} == brute(texts)
    assert spelling.variants(docs.limit(0)).count() == 0


def test_roots_follow_chains(spark):
    forms = spark.createDataFrame([(f"w{i}", f"w{i + 1}") for i in range(11)] + [("x", "w3")], "word string, form string")
    found = {r["word"]: r["root"] for r in spelling.roots(forms).collect()}
    assert set(found.values()) == {"w11"} and len(found) == 12


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    assert difference(op13_spelling(spark, sf_dir), sf_dir, OP13_SQL) is None
