"""Line numbers, rejected lines, positions, bucketed tables, changed chunks and lists of hot keys."""

import html
import html.entities
import random
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from dictforge import session
from dictforge.config import Config
from dictforge.functions import text as T
from dictforge.operators import extract, skew
from dictforge.plans import catalog_tables
from dictforge.sources import buckets, manifest, positions, readers


@pytest.fixture
def splits(spark):
    """Small splits for the time of a test."""
    def to(size):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "1k")
    before = [spark.conf.get(f"spark.sql.files.{n}") for n in ("maxPartitionBytes", "openCostInBytes")]
    yield to
    for name, value in zip(("maxPartitionBytes", "openCostInBytes"), before):
        spark.conf.set(f"spark.sql.files.{name}", value)


def test_line_numbers_do_not_hang_on_splits(spark, tmp_path, splits):
    want = set()
    for name, lines in (("a", 4000), ("b", 3), ("c", 900), ("d", 0), ("e", 1)):
        text = [f"{name} line {i} {'x' * (i % 50)}" for i in range(lines)]
        (tmp_path / f"{name}.log").write_text("".join(line + "\n" for line in text))
        want |= {(f"{name}.log", i, line) for i, line in enumerate(text)}
    for size in ("1k", "20k", "128m"):
        splits(size)
        rows = readers.read_log(spark, str(tmp_path)).collect()
        assert {(r["file_name"], r["line"], r["value"]) for r in rows} == want and len(rows) == len(want)


def test_rejected_lines_come_with_place_and_reason(spark, tmp_path, splits):
    lines = ['{"id": 1, "t": "a"}', "", '{"id": "x"}', '{"id": 2', '{"id": 3, "t": "c"}', "   ", "plain"]
    (tmp_path / "f.json").write_text("\n".join(lines) + "\n")
    splits("1k")
    kept, rejected = readers.read_checked(spark, str(tmp_path), "id long, t string")
    assert {(r["id"], r["t"], r["line"]) for r in kept.collect()} == {(1, "a", 0), (3, "c", 3)}
    assert {(r["value"], r["reason"], r["line"], r["file_name"]) for r in rejected.collect()} == {
        ('{"id": "x"}', "another type", 1, "f.json"), ('{"id": 2', "no JSON", 2, "f.json"), ("plain", "no JSON", 4, "f.json")}


def test_positions_continue_and_read_only_their_files(spark, tmp_path):
    folder = str(tmp_path / "p")
    for begin, end in ((0, 500), (500, 503), (503, 503), (503, 900)):
        df = spark.range(begin, end, 1, 7).select("id", F.concat(F.lit("t"), "id").alias("text"))
        positions.append_ordered(df.orderBy(F.rand(3)), ["id"], folder)
    schema = "id long, text string"
    assert all(r["id"] == r["gidx"] for r in positions.numbered(spark, folder, schema).collect())
    wanted = spark.createDataFrame([(g,) for g in (0, 499, 500, 502, 503, 899, 900, -1, 5000, 7, 7)], "gidx long")
    got = sorted((r["gidx"], r["id"], r["text"]) for r in positions.at_positions(spark, folder, schema, wanted).collect())
    assert got == sorted((g, g, f"t{g}") for g in (0, 499, 500, 502, 503, 899, 7, 7))
    early = wanted.where("gidx between 0 and 499").distinct()
    files = positions.files_of(positions.read_index(spark, folder), early).select("file_path").distinct().collect()
    read = positions.at_positions(spark, folder, schema, early)
    assert len(files) < positions.read_index(spark, folder).count() and read.count() == 3
    assert {f.rsplit("/", 1)[1] for f in read.inputFiles()} >= {f["file_path"].rsplit("/", 1)[1] for f in files}
    assert len([f for f in read.inputFiles() if "/data/" in f]) == len(files)
    all_read = positions.at_positions(spark, folder, schema, wanted, max_files=1)
    assert sorted((r["gidx"], r["id"], r["text"]) for r in all_read.collect()) == got
    assert positions.at_positions(spark, folder, schema, wanted.where("gidx > 4000")).count() == 0


def test_bucketed_lists_need_no_exchange(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        meanings = spark.range(300).select(F.col("id").alias("MeaningId"), F.lit("x").alias("MeaningText"))
        rows = spark.range(2000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id") % 320).alias("MeaningId"), "id")
        extensions = rows.select("MeaningId", F.lit("A").alias("ExtensionType"), F.lpad("id", 5, "0").alias("WordList"), F.lit(None).cast("string").alias("Details"))
        links = rows.where("id % 2 = 0").select("MeaningId", F.concat(F.lpad("id", 5, "0"), F.lit("|b")).alias("WordList"))
        tables = {"meanings": meanings, "extensions": extensions, "extension_links": links}
        cfg = Config(items_per_row=50)
        plain, more = extract.attach_lists(meanings, extract.extension_lists(extensions, cfg), extract.link_lists(links, cfg))
        for hot in ([], [7]):
            laid = {n: buckets.write_bucketed(df, "MeaningId", n, 4, hot=hot) for n, df in tables.items()}
            assert laid["extensions"].hot.count() == (extensions.where("MeaningId = 7").count() if hot else 0)
            usual, _ = extract.attach_bucketed(laid, "usual", cfg)
            usual.collect()
            plan = usual._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan, plan
            both = usual.unionByName(extract.attach_bucketed(laid, "hot", cfg)[0])
            assert sorted(map(str, both.select(*plain.columns).collect())) == sorted(map(str, plain.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_bucketed_lists_are_whole(spark, monkeypatch):
    """A list of more items than a row holds is whole in the query, for usual and for hot meanings."""
    rows = [(m, "A", f"{i:03}", None) for m, n in ((1, 3), (2, 11), (9, 25), (None, 4), (77, 8)) for i in range(n)]
    tables = {
        "meanings": spark.createDataFrame([(m, "x") for m in (1, 2, 3, 9, 9, None)], "MeaningId long, MeaningText string"),
        "extensions": spark.createDataFrame(rows, "MeaningId long, ExtensionType string, WordList string, Details string"),
        "extension_links": spark.createDataFrame([(m, f"{w}| b") for m, _, w, _ in rows if w > "001"], "MeaningId long, WordList string"),
    }
    monkeypatch.setattr(catalog_tables, "dictionary", lambda spark, sf: tables)
    monkeypatch.setattr(catalog_tables, "CFG", Config(items_per_row=4))
    sizes = {1: 3, 2: 11, 9: 25}
    join = lambda m, between, item, begin=0: between.join(item.format(i) for i in range(begin, sizes.get(m, 0))) or "-"
    want = sorted(str((m, join(m, ",", "A={:03}"), join(m, ";", "{:03}, b", 2))) for m in (1, 2, 3, 9, 9, None))
    for hot in ([], [2, 9]):
        monkeypatch.setattr(buckets, "hot_keys", lambda df, key, n=0: hot)
        assert sorted(str(tuple(r)) for r in catalog_tables.bucketed_lists(spark, "").collect()) == want


def test_changed_chunks(spark, tmp_path):
    folder, out = tmp_path / "in", str(tmp_path / "out")
    seen = []

    def process(lines):
        seen.append(sorted({r["file_name"] for r in lines.select("file_name").collect()}))
        return lines.select("chunk", F.upper("value").alias("value"))

    def run():
        n = manifest.process_changed(spark, str(folder), out, process, by_file=True)
        found = manifest.current(spark, out, "chunk string, value string").collect()
        return n, sorted(r["value"] for r in found)

    def write(name, *lines):
        (folder / name).write_text("".join(f"{line}\n" for line in lines))

    folder.mkdir()
    write("a", "one", "two")
    write("b", "three")
    assert run() == (2, ["ONE", "THREE", "TWO"])
    assert run() == (0, ["ONE", "THREE", "TWO"]) and len(seen) == 1
    write("a", "two", "one", "more")
    write("c d=1", "four")
    assert run() == (2, ["FOUR", "MORE", "ONE", "THREE", "TWO"]) and seen[-1] == ["a", "c%20d=1"]
    write("b", "three")
    assert run()[0] == 0
    write("a")
    (folder / "b").unlink()
    assert run() == (0, ["FOUR"])


def test_hot_keys_come_from_a_sketch(spark):
    df = spark.range(40_000).select(F.when(F.col("id") % 4 == 0, 7).when(F.col("id") % 4 == 1, None).otherwise(F.col("id")).alias("k"))
    assert skew.hot_keys(df, "k", 5_000) == [7] and skew.hot_keys(df, "k", 20_000) == []
    assert skew.hot_keys(df.limit(0), "k", 1) == []


def test_lists_of_hot_keys_and_null_keys(spark):
    rows = [("hot", i, f"v{i:05d}") for i in range(1000)] + [(None, 1, "n"), (None, 2, "m"), ("a", 5, "z"), ("a", 5, "y")]
    df = spark.createDataFrame(rows, "k string, i int, v string").repartition(5)
    got = {}
    for hot in (10, 1_000_000):
        found = skew.block_lists(df, "k", ["i"], F.col("v"), 64, max_chars=600, chars=F.length("v"), min_hot_rows=hot).collect()
        got[hot] = sorted((str(r["k"]), r["block"], tuple(r["items"])) for r in found)
    assert got[10] == got[1_000_000]
    hot = [i for k, _, items in got[10] if k == "hot" for i in items]
    assert hot == [f"v{i:05d}" for i in range(1000)] and max(len(x[2]) for x in got[10]) <= 64
    assert ("None", 0, ("n", "m")) in got[10] and ("a", 0, ("y", "z")) in got[10]


def test_native_entities_equal_the_standard_library(spark):
    samples = []
    for name in html.entities.html5:
        bare = name.rstrip(";")
        samples += [f"a &{bare}; z", f"&{bare}", f"x&{bare}y;", f"&{bare}&{bare};", f"&amp;{name}"]
    for n in [*range(300), 0xD7FF, 0xD800, 0xDFFF, 0xFDD0, 0xFFFE, 0x1FFFE, 0x10FFFF, 0x110000, 0x1F600, 10**12, 2**64, 2**70]:
        samples += [f"&#{n};", f"&#{n}", f"&#x{n:x};", f"&#X{n:X}z", f"&#0000000000{n};"]
    rng = random.Random(1)
    parts = ["&", "#", "x", "amp", "lt", ";", "not", "in", " ", "4", "e", "Ö", "&amp;", "&#", "\n", "sup1", "thetasym", "\x01", "\x02", "😀"]
    samples += ["".join(rng.choice(parts) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    df = spark.createDataFrame(list(enumerate(samples)), "i int, s string")
    plain = df.select("i", T.unescape_html(F.col("s")).alias("s"))
    assert "Python" not in plain._jdf.queryExecution().executedPlan().toString()
    assert [(r["i"], r["s"]) for r in plain.collect()] == [(i, html.unescape(s)) for i, s in enumerate(samples)]


def test_staged_tables_are_removed_on_request(spark, monkeypatch):
    monkeypatch.setattr(session, "_GIVEN", [])
    staged = [session.stage(spark.range(10), "numbers") for _ in range(2)]
    session.scratch_path(spark, "never_written")
    given = [Path(path.removeprefix("file:")) for path in session._GIVEN]
    assert staged[0].count() == 10 and [path.exists() for path in given] == [True, True, False]
    assert session.remove_staged(spark) == 2 and not any(path.exists() for path in given)


def test_items_of_order_columns_travel_once_and_given_hot_keys_need_no_sketch(spark, monkeypatch):
    df = spark.createDataFrame([(i % 7, f"w{i % 5}", None if i % 3 else "d") for i in range(200)], "k long, w string, d string")
    expected = skew.block_lists(df, "k", ["w", "d"], F.struct("w", "d"), 8, min_hot_rows=29)
    monkeypatch.setattr(skew, "hot_keys", lambda *given: pytest.fail("a sketch"))
    for hot in ([], [0, 1]):
        found = skew.block_lists(df, "k", ["w", "d"], None, 8, hot=hot)
        assert sorted(map(str, found.collect())) == sorted(map(str, expected.collect()))
        assert "_value" not in found._jdf.queryExecution().optimizedPlan().toString()
