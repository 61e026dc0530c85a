"""Ordered operators against plain models, with groups that span several partitions."""

import random

import pytest
from pyspark.sql import functions as F

from dictforge.operators.ordered import with_global_index, with_packs, with_run_length
from dictforge.operators.skew import block_lists, lookup_join, salted_join


@pytest.fixture(params=[50, 10**6])
def local_rows(request):
    """Groups beyond this many rows take the range-partitioned way."""
    return request.param


@pytest.fixture(params=[1, 4, 8])
def split(spark, request):
    """Number of real range partitions; coalescing is off so that small data is split too."""
    before = {k: spark.conf.get(k) for k in (
        "spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", str(request.param))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)


def packs_of(sizes, max_items, max_size):
    packs, count, total, pack = [], 0, 0, -1
    for size in sizes:
        if pack < 0 or count >= max_items or total + size > max_size:
            pack, count, total = pack + 1, 0, 0
        packs.append(pack)
        count += 1
        total += size
    return packs


def test_packing_example(spark):
    sizes = [700, 300, 300, 100, 100, 100, 100, 100, 1500, 5]
    assert packs_of(sizes, 4, 1200) == [0, 0, 1, 1, 1, 1, 2, 2, 3, 4]


@pytest.mark.parametrize("max_items, max_size", [(4, 1200), (1, 50), (7, 300)])
def test_packing(spark, split, local_rows, max_items, max_size):
    rng = random.Random(max_items)
    groups = {"hot": 700, "a": 1, "b": 3, "z": 40, **{f"g{i}": rng.randint(1, 9) for i in range(60)}}
    rows = [
        (g, i, rng.choice([0, 0, 10, 100, 300, 700, 1500]))
        for g, n in groups.items() for i in range(n)
    ]
    expected = {}
    for g in groups:
        sizes = [s for k, i, s in rows if k == g]
        packs = packs_of(sizes, max_items, max_size)
        for i, p in enumerate(packs):
            expected[g, i] = (p, len(sizes), packs[-1] + 1)
    rng.shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i long, size long")
    got = with_packs(df, ["g"], ["i"], F.col("size"), max_items, max_size, None, local_rows).collect()
    assert {(r["g"], r["i"]): (r["pack"], r["group_items"], r["group_packs"]) for r in got} == expected
    assert len(got) == len(rows)


@pytest.mark.parametrize("share", [0.3, 0.95, 1.0])
def test_run_length(spark, split, local_rows, share):
    rng = random.Random(int(share * 100))
    rows = [(g, i, rng.random() < share) for g, n in (("hot", 500), ("a", 1), ("b", 20), ("c", 3)) for i in range(n)]
    expected, run, last = {}, 0, None
    for g, i, flag in rows:
        run = (run if g == last else 0) + 1 if flag else 0
        expected[g, i] = run
        last = g
    df = spark.createDataFrame(rows, "g string, i long, flag boolean").repartition(5)
    got = with_run_length(df, ["g"], ["i"], F.col("flag"), local_rows=local_rows).collect()
    assert {(r["g"], r["i"]): r["run_length"] for r in got} == expected


def test_order_survives_an_order_free_aggregate(spark):
    rows = [("g" + str(i % 50), i) for i in range(600)]
    random.Random(1).shuffle(rows)
    df = spark.createDataFrame(rows, "g string, i long")
    packed = with_packs(df, ["g"], ["i"], F.lit(1), 4, 10**6)
    assert [tuple(r) for r in packed.groupBy("group_items", "group_packs").count().collect()] == [(12, 3, 600)]
    runs = with_run_length(df, ["g"], ["i"], F.lit(True))
    assert runs.agg(F.max("run_length")).first()[0] == 12


def test_global_index(spark, split):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("k"), F.lit("x").alias("v"))
    got = with_global_index(df, ["k"]).collect()
    assert sorted((r["gidx"], r["k"]) for r in got) == [(i, i) for i in range(1000)]


def test_salted_join(spark):
    big = spark.range(900).select(
        F.col("id"), F.when(F.col("id") % 3 == 0, 7).when(F.col("id") % 3 == 1, None).otherwise(F.col("id")).alias("k")
    )
    small = spark.range(500).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v"))
    for how in ("inner", "left", "left_semi", "left_anti"):
        plain = big.join(small, "k", how)
        for spread in ("id", None):
            salted = salted_join(big, small, "k", how, spread, min_hot_rows=50)
            assert sorted(map(str, salted.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))


def test_lookup_join_falls_back(spark, monkeypatch):
    monkeypatch.setattr("dictforge.operators.skew.fits_broadcast", lambda dim: False)
    big = spark.range(100).select("id", (F.col("id") % 5).alias("k"))
    dim = spark.range(3).select(F.col("id").alias("k"), F.lit("x").alias("v"))
    assert lookup_join(big, dim, "k").where("v = 'x'").count() == 60


def test_block_lists_keep_everything(spark, split):
    rows = [("hot", i) for i in range(95)] + [("a", 1), ("b", 2), ("b", 1)]
    df = spark.createDataFrame(rows, "k string, i int")
    got = block_lists(df, "k", ["i"], F.col("i"), 10).collect()
    assert max(len(r["items"]) for r in got) <= 10
    hot = [i for r in sorted((r for r in got if r["k"] == "hot"), key=lambda r: r["block"]) for i in r["items"]]
    assert hot == list(range(95))
    assert {r["k"]: r["items"] for r in got if r["k"] != "hot"} == {"a": [1], "b": [1, 2]}


def test_blocks_depend_on_their_own_key_and_on_characters(spark, split):
    rows = [("a", i, "x" * 10) for i in range(25)] + [("b", i, "y" * 100) for i in range(25)]
    got = {}
    for others in (0, 40):
        more = [("A", i, "z") for i in range(others)]
        df = spark.createDataFrame(rows + more, "k string, i int, v string")
        found = block_lists(df, "k", ["i"], F.col("v"), 10, max_chars=500).collect()
        got[others] = sorted((r["k"], r["block"], len(r["items"])) for r in found if r["k"] != "A")
    assert got[0] == got[40]
    assert [n for k, _, n in got[0] if k == "a"] == [10, 10, 5] and max(n for k, _, n in got[0] if k == "b") <= 5
    assert [b for k, b, _ in got[0] if k == "a"] == [0, 1, 2]
