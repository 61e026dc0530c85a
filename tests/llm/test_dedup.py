"""SimHash groups, substring dedup and components against brute force and on odd rows."""

import glob
import random
import tempfile
import time

import numpy as np
import pytest
import xxhash

from dictforge import session
from dictforge.llm import components, simhash, substring_dedup

DOCS = "doc_id long, text string, source string, fp long, digest long, n int"


def docs(spark, rows):
    return spark.createDataFrame([(*r, "s", 1, 2, 3) for r in rows], DOCS)


def slow_simhash(text, n=3):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    words = [w for w in low.replace("\t", " ").replace("\n", " ").replace("\r", " ").replace("\v", " ").replace("\f", " ").split(" ") if w]
    shingles = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hashes) > len(hashes))


def test_simhash_is_the_majority():
    for text in ("", " \n", "One", "one two", "A b c d e f", "é É x\x0by z " * 50):
        assert simhash.simhash(text) == slow_simhash(text)


def test_ball_has_every_variant_once(spark):
    found = spark.range(1).select(simhash.ball("id", 1).alias("b")).first()["b"]
    assert len(found) == len(set(found)) == 65 and {bin(v & (2**64 - 1)).count("1") for v in found} == {0, 1}


def test_links_find_all_pairs_within_two_bits(spark):
    rng = random.Random(1)
    base = [rng.getrandbits(64) for _ in range(40)]
    prints = set(base)
    for b in base:
        for flips in (1, 2, 3):
            prints.add(b ^ sum(1 << j for j in rng.sample(range(64), flips)))
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    rows = spark.createDataFrame([(s,) for s in signed], "fp long")
    found = components.components(simhash.links(rows), "a", "b").collect()
    roots = {r["node"]: r["root"] for r in found}
    label = {s: s for s in signed}

    def root(x):
        while label[x] != x:
            x = label[x]
        return x

    for i, a in enumerate(signed):
        for b in signed[:i]:
            if bin((a ^ b) & (2**64 - 1)).count("1") <= 2:
                high, low = max(root(a), root(b)), min(root(a), root(b))
                label[high] = low
    assert all(roots.get(s, s) == root(s) for s in signed)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(i, i + 1) for i in range(60)] + [(1000, 1000 + k) for k in range(1, 80)] + [(5, 5), (None, 3), (2, 3)]
    rows = spark.createDataFrame(chain, "a long, b long")
    found = {r["node"]: r["root"] for r in components.components(rows, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(61)}, **{1000 + k: 1000 for k in range(80)}}
    assert components.components(rows.where("a < 0"), "a", "b").count() == 0


def test_near_groups_with_nulls_copies_and_ties(spark):
    text = "the quick brown fox jumps over the lazy dog " * 5
    rows = [(3, text), (2, text), (2, text), (9, "other words entirely here and there"), (7, None), (8, ""), (None, text), (5, " \n")]
    found = sorted(map(tuple, simhash.near_groups(docs(spark, rows)).select("doc_id", "component_id").collect()), key=str)
    want = [(3, 2), (2, 2), (2, 2), (9, 9), (7, 5), (8, 5), (5, 5), (None, 2)]
    assert found == sorted(want, key=str)
    kept = simhash.one_of_each(docs(spark, rows))
    assert kept.columns == [c.split()[0] for c in DOCS.split(", ")]
    assert sorted(r["doc_id"] for r in kept.collect()) == [2, 5, 9]
    assert simhash.one_of_each(docs(spark, rows).limit(0)).count() == 0


def cleaned(spark, rows, **settings):
    out = substring_dedup.remove_repeats(docs(spark, rows), **settings)
    assert out.columns == [*[c.split()[0] for c in DOCS.split(", ")], "_removed"]
    return out.collect()


def test_repeated_lines_and_passages_go_from_all_but_the_first(spark):
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefghij", k=7))
    line = "This very line stands in many documents."
    passage = " ".join(word() for _ in range(60))
    own = [" ".join(word() for _ in range(30)) for _ in range(8)]
    rows = [
        (4, f"{own[0]} {passage} {own[1]}"), (1, f"{own[2]}\n{passage}\n{own[3]}"), (2, f"{own[4]}\n{line}\n{own[5]}"),
        (3, f"{line.upper()}\n{own[6]}\n{line}\n"), (6, own[7]),
    ]
    found = {r["doc_id"]: r for r in cleaned(spark, rows)}
    assert [found[i]["text"] for i in (1, 2, 6)] == [rows[1][1], rows[2][1], own[7]]
    assert found[3]["text"] == f"{own[6]}\n"
    assert passage not in found[4]["text"] and found[4]["text"].startswith(own[0]) and found[4]["text"].endswith(own[1])
    for doc_id, text in rows:  # the offsets are those of the original
        kept, at = [], 0
        for s in found[doc_id]["_removed"]:
            kept.append(text[at : s["start"]])
            at = s["end"]
        assert "".join(kept) + text[at:] == found[doc_id]["text"]


def test_removal_against_brute_force(spark):
    rng = random.Random(3)
    lines = [" ".join(rng.choices("alpha beta gamma delta epsilon zeta eta theta iota".split(), k=rng.randint(1, 30))) for _ in range(40)]
    rows = [(i, "\n".join(rng.choices(lines, k=rng.randint(0, 9)))) for i in range(60)]
    seen, want = {}, {}
    for doc_id, text in rows:
        units = substring_dedup.Units([text])
        repeated = np.array([d in seen and seen[d] != (doc_id, k) for k, d in enumerate(units.digest.tolist())], bool)
        for k, d in enumerate(units.digest.tolist()):
            if d in seen:
                repeated[k] = True
            seen.setdefault(d, (doc_id, k))
        cuts = substring_dedup.spans(text, units, repeated, 20, 5) if len(repeated) else []
        want[doc_id] = cuts
    assert {r["doc_id"]: [tuple(s) for s in r["_removed"]] for r in cleaned(spark, rows)} == want


def test_odd_rows_of_substring_dedup(spark):
    line = "one two three four five six seven eight"
    rows = [(None, line), (1, None), (2, ""), (3, " \n\n "), (4, line), (4, line), (None, line), (5, "x" * 300_000), (6, "w " * 200_000)]
    found = sorted(((r["doc_id"], r["text"]) for r in cleaned(spark, rows)), key=str)
    kept = {r[0]: r[1] for r in found}
    assert len(found) == len(rows) and kept[1] is None and kept[2] == "" and kept[3] == " \n\n " and len(kept[5]) == 300_000
    assert [t for i, t in found if i == 4] == [line, line] and [t for i, t in found if i is None] == ["", ""]
    assert kept[6].startswith("w ") and len(kept[6]) < 400_000
    assert substring_dedup.remove_repeats(docs(spark, rows).limit(0)).count() == 0


@pytest.mark.parametrize("texts", [[], [""], ["a"], ["", " ", "b c\n\nd"]])
def test_units_of_small_texts(texts):
    units = substring_dedup.Units(texts)
    words = [texts[t][s:e] for t, s, e in zip(units.text, units.start, units.end)]
    assert " ".join(words).split() == " ".join(texts).split()


def plain_cuts(rows, run=20, line=5):
    """Words to cut by plain search: each run and each whole line that stands earlier, by document and place."""
    runs, whole, out = set(), set(), {}
    for doc_id, text in rows:
        words, cut, at = text.lower().split(), set(), 0
        places = {}
        for k in range(len(words) - run + 1):
            gram = tuple(words[k : k + run])
            if gram in runs:
                cut.update(range(k, k + run))
            elif gram in places:
                cut.update(range(max(k, places[gram] + run), k + run))
            places.setdefault(gram, k)
        runs.update(places)
        for part in text.split("\n"):
            own = tuple(part.lower().split())
            if line <= len(own) < run:
                if own in whole:
                    cut.update(range(at, at + len(own)))
                whole.add(own)
            at += len(own)
        out[doc_id] = [w for k, w in enumerate(text.split()) if k not in cut]
    return out


def test_every_passage_of_51_words_goes_whole(spark):
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghij", k=6))
    rows = []
    for k in range(400):
        # Every third passage is made of few words, so that most of them or none would be a cut.
        few = [word() for _ in range(12)]
        passage = " ".join(rng.choice(few) if k % 3 == 0 else word() for _ in range(51))
        rows += [(2 * k, f"{word()} {passage} {word()}"), (2 * k + 1, f"{word()} {word()} {passage} {word()}")]
    found = {r["doc_id"]: r["text"].split() for r in cleaned(spark, rows)}
    assert all(found[i] == text.split() for i, text in rows if i % 2 == 0)
    assert all(found[i] == [*text.split()[:2], text.split()[-1]] for i, text in rows if i % 2)
    assert found == plain_cuts(rows)


def test_only_text_that_repeats_in_order_goes(spark):
    rng = random.Random(6)
    parts = [" ".join(rng.choices("abcdefghij", k=3)) for _ in range(60)]
    rows = [(k, "\n".join(" ".join(rng.choices(parts, k=rng.randint(1, 12))) for _ in range(4))) for k in range(300)]
    # All parts of these lines are known, each from elsewhere.
    rows += [(k, " ".join(rng.sample(parts, 2 + k % 12))) for k in range(300, 500)]
    found = {r["doc_id"]: r["text"].split() for r in cleaned(spark, rows)}
    assert found == plain_cuts(rows)
    whole = [tuple(text.split()) for _, text in rows[300:]]
    once = [k for k, text in rows[300:] if whole.count(tuple(text.split())) == 1 and len(text.split()) < 20]
    lines = {tuple(part.split()) for _, text in rows[:300] for part in text.split("\n")}
    assert all(found[k] == dict(rows)[k].split() for k in once if tuple(dict(rows)[k].split()) not in lines) and len(once) > 50


def test_anchors_of_several_texts_are_found_in_one_exchange(spark):
    rows = [(1, 10), (2, 10), (1, 11), (3, 12), (3, 13), (4, 13), (5, 13), (None, 14), (6, 14)]
    shared = substring_dedup.shared_anchors(spark.createDataFrame(rows, "_akey long, anchor long"))
    assert {(r["_akey"], r["anchor"]) for r in shared.collect()} == {r for r in rows if r[1] in (10, 13, 14)}
    plan = shared._jdf.queryExecution().sparkPlan().toString()
    assert shared.columns == ["_akey", "anchor"] and "Join" not in plan


def test_digests_meet_in_one_exchange_and_anchors_are_not_written(spark):
    units = spark.createDataFrame([(3, 0, 9), (1, 0, 9), (1, 1, 9), (None, 0, 9), (None, 1, 8), (2, 0, 7)], "_id int, _part int, digest int")
    later = substring_dedup.later_rows(units)
    assert sorted(map(str, later.collect())) == sorted(
        ["Row(_id=3, _part=0, digest=9)", "Row(_id=None, _part=0, digest=9)"]
    )
    assert later._jdf.queryExecution().sparkPlan().toString().count("Window") == 1
    assert "Join" not in later._jdf.queryExecution().optimizedPlan().toString()
    before = len(session._GIVEN)
    substring_dedup.remove_repeats(docs(spark, [(1, "a b c"), (2, "a b c")]))
    assert len(session._GIVEN) - before == 1


def test_a_staged_table_leaves_no_shuffle_files(spark):
    folder = spark.conf.get("spark.local.dir", tempfile.gettempdir())

    def shuffled():
        return set(glob.glob(f"{folder}/**/blockmgr-*/*/shuffle_*.data", recursive=True))

    before, rows = shuffled(), spark.range(1000).repartition(3, "id")
    staged = session.stage(rows, "rows")
    for _ in range(50):  # Spark removes them in the background
        if not shuffled() - before:
            break
        time.sleep(0.1)
    assert not shuffled() - before
    assert staged.count() == rows.count() == 1000 and shuffled() - before


def test_repeated_rows_lose_nothing_to_each_other(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text), (1, text), (2, "other " + text), (None, text), (None, text)]
    out = substring_dedup.remove_repeats(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((str(r["doc_id"]), r["text"]) for r in out) == sorted(
        [("1", text), ("1", text), ("2", "other "), ("None", ""), ("None", "")]
    )
    alone = substring_dedup.remove_repeats(spark.createDataFrame(rows[:2], "doc_id long, text string")).collect()
    assert [r["text"] for r in alone] == [text, text]
