"""The dictionary chain on a small fixture with the awkward rows, against a plain model."""

import html
import random
import re

import pytest
from pyspark.sql import functions as F

from dictforge import schemas
from dictforge.config import Config
from dictforge.operators import dataset, extract, merge, tasks, telemetry
from dictforge.plans import build
from dictforge.sources import readers, writers

LABELS = "SELECT * FROM VALUES ('type','m','Noun'),('type','','None'),('gender','f','Feminine and Noun') AS t(kind,raw,label)"


def tables_of(spark, **rows):
    ddl = {
        "words": schemas.WORDS, "meanings": schemas.MEANINGS, "sources": schemas.SOURCES,
        "extensions": schemas.EXTENSIONS, "extension_links": schemas.EXTENSION_LINKS,
    }
    return {name: spark.createDataFrame(rows.get(name, []), schema) for name, schema in ddl.items()}


@pytest.fixture(scope="module")
def small(spark):
    link = '<a href="/dictionary/sv/text?ref=1.2.">x</a>'
    return tables_of(
        spark,
        words=[(1, "अंक", None, "अङ्क", None), (2, "empty", "", None, None), (3, "one", "en", None, None)],
        sources=[(1, "src", "Source", "sa"), (2, None, "Long only", None), (3, "wordnet.indo", "Net", None)],
        meanings=[
            (10, 1, 1, f"first &amp;amp; <b>sense</b> {link}", "m", None, "sa", 2),
            (11, 1, 1, "second  4, 000", None, "f", "", 1),
            (12, 1, 1, "third", None, None, None, None),
            (13, 1, 1, "fourth", None, None, None, 2),
            (14, 1, 1, "fifth", None, None, None, 9),
            (15, 1, 2, "alone", "x", None, None, None),
            (16, 1, 3, "net sense", "m", None, None, 1),
            (17, 3, None, "A. " + "long text. " * 200, None, None, None, 1),
            (18, 3, 1, None, None, None, None, None),
        ],
        extensions=[(17, "iwn.lang.hin", "अंक", None), (17, "iwn.lang.tam", "எண்", None), (17, "iwn.SYNONYM", "a, b", "d"),
                    (17, "iwn.X", "", None)],
        extension_links=[(10, "a| b"), (10, " | ,"), (11, "c"), (12, "a,b"), (14, "z")],
    )


@pytest.fixture(scope="module")
def titles(spark):
    return spark.createDataFrame([("sv", "सामवेद")], schemas.REFERENCE_TITLES)


def test_word_records(spark, small, titles):
    records = {r["word_ord"]: r for r in build.word_records(small, titles).collect()}
    assert records[1]["metadata"]["Language"] == "sa" and records[2]["content"] == []
    first = records[1]["content"][1:]
    assert records[1]["content"][0]["Source"]["LongText"] == "Long only"
    assert [m["MeaningText"] for m in first] == ["third", "second 4, 000", "first & sense x", "fourth", "fifth", "net sense"]
    linked = first[2]
    assert [tuple(r) for r in linked["References"]] == [("sv", "1.2", "सामवेद")]
    assert [x["WordList"] for x in linked["ExtensionLinks"]] == ["a, b"]
    assert linked["Source"]["Languages"] == "sa" and linked["SeqNo"] == "2"


def test_merged_content(spark, small, titles):
    rows = build.processed_records(small, titles, spark.sql(LABELS)).where("word_ord = 1").first()["content"]
    texts = [(m["MeaningText"], m["SeqNo"], m["part_index"], m["total_parts"]) for m in rows]
    assert texts == [
        ("net sense", "1", None, None),
        ("f second 4,000\nm first & sense x\nfourth\nfifth", "1,2,2,9", 1, 2),
        ("alone", None, None, None),
        ("third", "", 2, 2),
    ]
    merged = rows[1]
    assert merged["ManagedType"] == ["Feminine", "None", "Noun"]
    assert [x["WordList"] for x in merged["ExtensionLinks"]] == ["c", "a, b", "z"]
    assert [r["Title"] for r in merged["References"]] == ["सामवेद"]
    # Later packs keep the links of their first meaning only.
    assert [x["WordList"] for x in rows[3]["ExtensionLinks"]] == ["a, b"]


def test_lists_continue_in_further_entries(spark, titles):
    tables = tables_of(
        spark,
        words=[(1, "w", "sa", None, None)],
        sources=[(1, "s", "S", None)],
        meanings=[(1, 1, 1, "plain", None, None, None, 1), (2, 1, 1, "other", None, None, None, 2), (3, 1, 1, "ext", None, None, None, 3)],
        extensions=[(3, "iwn.lang.hin", f"w{i:02d}", None) for i in range(25)],
        extension_links=[(2, f"l{i:02d}") for i in range(23)] + [(1, "l22"), (1, "own")],
    )
    cfg = Config(items_per_row=10)
    for plan in (build.word_records(tables, titles, cfg), build.processed_records(tables, titles, spark.sql(LABELS), cfg)):
        items = [m for r in plan.orderBy("block").collect() for m in r["content"]]
        ext = [e["WordList"] for m in items for e in m["Extensions"] or []]
        links = [e["WordList"] for m in items for e in m["ExtensionLinks"] or []]
        assert sorted(ext) == [f"w{i:02d}" for i in range(25)]
        assert sorted(set(links)) == [f"l{i:02d}" for i in range(23)] + ["own"]
        assert all(len(m["Extensions"] or []) <= 10 and len(m["ExtensionLinks"] or []) <= 10 + 2 for m in items)


def test_instructions(spark, small, titles):
    built = build.build_instructions(small, titles, spark.sql(LABELS))
    rows = {(r["task"], r["usr_prompt"]): r for r in built.collect()}
    cite = rows["citation", "Cite: (1/2) अंक"]
    assert cite["target"] == '"अंक" Def: f second 4,000 m first & sense x fourth fifth. - Source: सामवेद [1.2]'
    assert rows["translation", "Trans: (1/2) one"]["target"] == "Translations: HIN: अंक, TAM: எண்."
    assert rows["synonym", "Syn: (1/2) one"]["text"] == "<s>[INST] Syn: (1/2) one [/INST] Synonyms: a, b. </s>"
    assert ("translation", "Trans: (2/2) one") not in rows
    definition = rows["definition", "Def: (1/2) अंक"]
    assert definition["target"].startswith('"अंक" (also: अङ्क) Def: f second')
    assert definition["target"].endswith("Tags: Feminine, None, Noun. Citations: सामवेद [1.2].")


def test_task_goldens(spark):
    cfg = Config()
    reference = schemas.REFERENCE
    row = ("अंक", "अङ्क", "m. A mark; 4, 32, 000 + x.. Ex. अंक लेखन", [("sv", "1.2", "सामवेद"), ("zz", "9", None)],
           ["Masculine"], None, None, "HIN: अंक, TAM: எண்", 1)
    df = spark.createDataFrame(
        [row], f"WordText string, WordTextAlternate string, text string, refs array<{reference}>, ManagedType array<string>, "
        "part_index int, total_parts int, translation string, word_ord int")
    records = tasks.task_records(tasks.with_usages(df, cfg), cfg)
    got = {r["task"]: r for r in dataset.first_of_concept(dataset.valid_records(records, cfg), ["word_ord"]).collect()}
    assert got["definition"]["target"] == ('"अंक" (also: अङ्क) Def: m. A mark; 4,32,000   x. Ex: अंक लेखन '
                                           "Tags: Masculine. Citations: सामवेद [1.2], zz [9].")
    assert got["definition"]["concept_key"] == "a459a60e5370fe6afd977bbd042bf7fc"
    assert got["translation"]["target"] == "Translations: HIN: अंक, TAM: எண். Citations: सामवेद [1.2], zz [9]."
    assert got["citation"]["target"] == '"अंक" Def: m. A mark; 4,32,000   x. - Source: सामवेद [1.2] - Source: zz [9]'


def test_many_citations(spark):
    refs = [(f"c{i}", str(i), None) for i in range(11)]
    df = spark.createDataFrame([(refs,)], f"refs array<{schemas.REFERENCE}>")
    text = df.select(tasks.citation_text(F.col("refs"), 10)).first()[0]
    assert text.endswith("c9 [9]....") and "c10" not in text


def test_oversized_answers_are_marked_without_gathering(spark):
    rows = [(1, "iwn.lang.hin", "x" * 3000, None)] * 4 + [(1, "iwn.SYNONYM", "s", None), (2, "iwn.lang.hin", "y", None)]
    got = tasks.extension_answers(spark.createDataFrame(rows, schemas.EXTENSIONS), Config()).collect()
    found = {r["MeaningId"]: (r["translation"], r["synonym"]) for r in got}
    assert found[1][0].startswith("too long: 12020 .") and len(found[1][0]) == Config().max_target_chars + 1
    assert found[1][1] == "s" and found[2] == ("HIN: y", None)


def split_model(text, limit):
    """Parts of a long text, segment by segment."""
    parts, current = [], ""
    for segment in re.findall(r"[^।\n.]*[।\n.]|[^।\n.]+", text):
        if len(current) + len(segment) <= limit:
            current += segment
            continue
        if current:
            parts.append(current)
        if len(segment) > limit:
            parts.extend(segment[i : i + limit] for i in range(0, len(segment), limit))
            current = ""
        else:
            current = segment
    if current:
        parts.append(current)
    return [p.strip() for p in parts]


def test_split_against_model():
    rng = random.Random(3)
    for _ in range(400):
        text = "".join(rng.choice("ab .।\n" + "cdefgh" * rng.randint(0, 4)) for _ in range(rng.randint(1, 300))).strip()
        for limit in (5, 20, 60):
            if len(text) > limit:
                assert merge._cut(text, limit) == split_model(text, limit), (text, limit)


def test_split_isolates_metadata(spark):
    df = spark.createDataFrame([(1, "a. b. c.", ["r"]), (2, "short", ["r"])], "id int, text string, refs array<string>")
    got = [tuple(r) for r in merge.split_meanings(df, 5).select("id", "text", "refs", "part_index", "total_parts")
           .orderBy("id", "part_index").collect()]
    assert got == [(1, "a. b.", ["r"], 1, 2), (1, "c.", None, 2, 2), (2, "short", ["r"], None, None)]


@pytest.mark.parametrize("local_rows", [3, 1000])
def test_large_groups_merge_the_same(spark, local_rows):
    rng = random.Random(5)
    rows = [("w" if i % 3 else f"w{i % 7}", "s", i, str(rng.randint(0, 9)), rng.choice(["x", "yy" * 30, "z" * 200])) for i in range(120)]
    df = spark.createDataFrame(rows, "word_ord string, source_short string, meaning_ord int, seq_no string, text string").selectExpr(
        "*", "0 AS part_ord", "'' AS Type", "'' AS TypeGender", "array('t') AS ManagedType", "cast(null AS array<string>) AS refs",
        "cast(null AS array<string>) AS ExtensionLinks", "cast(null AS int) AS part_index", "cast(null AS int) AS total_parts")
    cfg = Config(max_chars_per_split=250)
    got = merge.merge_groups(df, cfg, local_rows=local_rows).collect()
    expected = {}
    for word in {r[0] for r in rows}:
        members = sorted((r for r in rows if r[0] == word), key=lambda r: (int(r[3]), r[2]))
        packs, size = [], 0
        for r in members:
            if not packs or len(packs[-1]) >= 4 or size + len(r[4]) > 250:
                packs.append([])
                size = 0
            packs[-1].append(r)
            size += len(r[4])
        for i, pack in enumerate(packs):
            expected[word, i] = ("\n".join(r[4] for r in pack), ",".join(r[3] for r in pack), len(packs))
    assert {(r["word_ord"], r["pack"]): (r["text"], r["seq_no"], r["total_parts"] or 1) for r in got} == expected


def test_titles_by_join_equal_titles_by_map(spark, monkeypatch):
    rows = spark.createDataFrame([(1, [("a", "1"), ("b", "2"), ("a", "3")]), (2, [])],
                                 "MeaningId int, refs array<struct<InternalCode:string,ReferenceCode:string>>")
    titles = spark.createDataFrame([("a", "A")], schemas.REFERENCE_TITLES)
    by_map = extract.with_titles(rows, titles).orderBy("MeaningId").collect()
    monkeypatch.setattr(extract, "fits_broadcast", lambda *a: False)
    by_join = extract.with_titles(rows, titles).orderBy("MeaningId").collect()
    assert by_map[0]["refs"] == by_join[0]["refs"] and not by_map[1]["refs"] and not by_join[1]["refs"]


def test_titles_last_wins(spark):
    titles = spark.createDataFrame([("a", "1", 1), ("a", "2", 2), ("b", None, 3)], "Code string, Title string, ord int")
    assert [tuple(r) for r in extract.title_dimension(titles).collect()] == [("a", "2")]


def test_record_files_round_trip(spark, small, titles, tmp_path):
    records = build.word_records(small, titles)
    writers.write_records(records, str(tmp_path / "records"))
    back = readers.read_records(spark, str(tmp_path / "records"), schemas.NUMBERED_WORD_RECORD, "FAILFAST")
    rows = readers.content_rows(back)
    assert rows.count() == 9
    again = merge.merge_content(rows, spark.sql(LABELS), Config(), build.WORD_COLUMNS)
    direct = build.merged_meanings(small, titles, spark.sql(LABELS), Config())
    key = ["word_ord", "text", "seq_no", "part_index", "total_parts"]
    assert sorted(map(str, again.select(*key).collect())) == sorted(map(str, direct.select(*key).collect()))
    line = (tmp_path / "records").glob("*.json")
    assert any("अंक" in path.read_text(encoding="utf-8") and "\\u" not in path.read_text(encoding="utf-8") for path in line)


def test_unescape_matches_the_standard_library(spark):
    from dictforge.functions import text as T

    samples = ["&amp;", "a & b", "&#x915;", "&copy", "&notit;", "&&lt;", "& &gt", "x&"]
    df = spark.createDataFrame([(s,) for s in samples], "s string")
    assert [r[0] for r in df.select(T.unescape_html(F.col("s"))).collect()] == [html.unescape(s) for s in samples]


def test_too_long_answers_stand_until_validation(spark, titles):
    tables = tables_of(
        spark,
        words=[(1, "w", "sa", None, None)], sources=[(1, "s", "S", None)],
        meanings=[(1, 1, 1, "some text", None, None, None, 1)],
        extensions=[(1, "iwn.lang.hin", "h" * 60, None), (1, "iwn.lang.hin", "i" * 60, None), (1, "iwn.SYNONYM", "short", None)],
        extension_links=[],
    )
    cfg = Config(max_target_chars=100)
    answers = tasks.extension_answers(tables["extensions"], cfg)
    rows = build.merged_meanings(tables, titles, spark.sql(LABELS), cfg, answers=answers)
    records = tasks.task_records(tasks.with_usages(rows, cfg), cfg)
    found = {r["task"]: r["raw_target"] for r in records.collect()}
    assert found["translation"].startswith("Translations: too long: 130 ") and len(found["translation"]) > 100
    assert found["synonym"] == "Synonyms: short."
    assert "translation" not in {r["task"] for r in dataset.valid_records(records, cfg).collect()}


def test_homographs_null_texts_and_file_order_survive(spark, tmp_path):
    word = '{"metadata":{"WordText":"w"},"content":[%s]}'
    z, a = ('{"MeaningText":"%s","Source":{"ShortText":"%s"}}' % (t, s) for t, s in (("of z", "z"), ("of a", "a")))
    (tmp_path / "b.json").write_text(word % z.replace("of z", "two") + "\n", encoding="utf-8")
    (tmp_path / "a.json").write_text(word % ",".join([z, a, '{"Type":"n"}']) + "\n\n{broken\n", encoding="utf-8")
    records = readers.read_records(spark, str(tmp_path), schemas.WORD_RECORD, with_file=True)
    rows = readers.content_rows(records)
    found = merge.merge_content(rows, spark.sql(LABELS), Config(), build.WORD_COLUMNS)
    ordered = [(r["word_ord"], r["text"]) for r in found.orderBy("word_ord", "content_ord").collect()]
    assert ordered == [(0, "of z"), (0, "of a"), (0, ""), (1, "two")]


def test_titles_read_in_list_order(spark, tmp_path):
    (tmp_path / "t.json").write_text('[{"Code":"a","Title":"z"},{"Code":"b"},{"Code":"a","Title":"b"}]', encoding="utf-8")
    read = readers.read_titles(spark, str(tmp_path / "t.json"))
    assert sorted(map(tuple, read.collect())) == [("a", "b", 2), ("a", "z", 0)]
    rows = spark.createDataFrame([(1, [("a", "1")])], "MeaningId int, refs array<struct<InternalCode:string,ReferenceCode:string>>")
    assert extract.with_titles(rows, read).first()["refs"][0]["Title"] == "b"
    assert [tuple(r) for r in extract.reference_audit(rows, read).collect()] == [("a", "b")]


def test_statistics_by_header(spark, tmp_path):
    folder = tmp_path / "run_id=r1"
    folder.mkdir()
    (folder / "one.csv").write_text("step,loss,learning_rate,epoch,timestamp\n10,2.5,0.0001,1.0,2024-01-02 03:04:05\n")
    (folder / "two.csv").write_text("Iter,TrainLoss,ValLoss\n5,nan,\n")
    steps = readers.read_stats(spark, str(tmp_path), schemas.STEP_STATS)
    row = steps.where("step is not null").first()
    assert (row["run_id"], row["step"], row["loss"], row["learning_rate"], row["epoch"], row["eval_loss"]) == ("r1", 10, 2.5, 1e-4, 1.0, None)
    own = readers.read_stats(spark, str(tmp_path)).where("Iter is not null").first()
    assert own["TrainLoss"] != own["TrainLoss"] and own["ValLoss"] is None


def test_damaged_blacklist_is_empty(spark, tmp_path):
    assert readers.read_or_empty(spark, str(tmp_path / "none"), schemas.BLACKLIST).count() == 0
    (tmp_path / "bad").mkdir()
    (tmp_path / "bad" / "part-0.parquet").write_bytes(b"not a table")
    assert readers.read_or_empty(spark, str(tmp_path / "bad"), schemas.BLACKLIST).count() == 0


def test_blacklist_of_another_run_changes_nothing(spark):
    numbered = spark.range(10).select(F.col("id").alias("gidx"))
    listed = spark.createDataFrame([("a", 1), ("b", 2)], schemas.BLACKLIST)
    cfg = Config(batch_size=1, gradient_accumulation_steps=3)
    kept = dataset.training_set(numbered, listed, cfg, run_id="b")
    assert sorted(r["gidx"] for r in kept.collect()) == [0, 1, 2, 6, 7, 8, 9]
    with pytest.raises(ValueError):
        dataset.training_set(numbered, listed, cfg)


def test_attempts_follow_each_other(spark):
    rows = [("r", 1, 1, 1.0), ("r", 0, 1, 3.0), ("r", 1, 2, 0.5), ("r", 0, 2, 2.0)]
    stats = spark.createDataFrame(rows, "run_id string, attempt int, Iter int, TrainLoss double").withColumn("ValLoss", F.lit(None).cast("double"))
    summary = telemetry.loss_summary(telemetry.loss_series(stats, "own")).first()
    assert (summary["rows"], summary["first_train_loss"], summary["last_train_loss"]) == (4, 3.0, 0.5)


def test_tasks_of_answers_take_only_meanings_with_such_an_answer(spark, titles, monkeypatch):
    tables = tables_of(
        spark,
        words=[(1, "w", "sa", None, None)], sources=[(1, "s", "S", None)],
        meanings=[(i, 1, 1, f"text {i}", None, None, None, i) for i in (1, 2, 3, 4)],
        extensions=[(1, "iwn.SYNONYM", "one", None), (2, "iwn.lang.hin", "h", None), (4, "iwn.SYNONYM", "", None)],
    )
    merged = []
    whole = merge.merge_content
    monkeypatch.setattr(merge, "merge_content", lambda rows, *more: merged.append(rows) or whole(rows, *more))
    seen = {}
    for kinds in (("synonym",), ("translation", "synonym"), ("definition", "synonym")):
        found = build.task_records(tables, titles, spark.sql(LABELS), Config(), kinds).collect()
        seen[kinds] = (merged[-1].count(), sorted((r["MeaningId"], r["task"]) for r in found))
    assert seen["synonym",] == (1, [(1, "synonym")])
    assert seen["translation", "synonym"] == (2, [(1, "synonym"), (2, "translation")])
    assert seen["definition", "synonym"][0] == 4 and (1, "synonym") in seen["definition", "synonym"][1]


def test_meanings_lie_by_word_and_are_merged_without_another_exchange(spark, titles, monkeypatch):
    """Rows by word give what rows by meaning give, repeated and absent keys and long texts too, and pass one exchange."""
    meanings = [(i, i % 7, i % 3, f"m<b>{i}</b>. " * (200 if i % 11 == 0 else 1), None, None, None, i) for i in range(60)]
    tables = tables_of(
        spark,
        words=[(w, f"w{w}", "sa", None, None) for w in (0, 1, 2, 3, 4, 5, 5)], sources=[(s, f"s{s}", "S", None) for s in (0, 1, 1)],
        meanings=[*meanings, meanings[9], (None, 1, 1, "no id", None, None, None, 1), (70, None, 1, "no word", None, None, None, 1)],
        extensions=[(i, "iwn.SYNONYM", f"e{i}", None) for i in (1, 1, 9, 30, 44, 900)],
        extension_links=[(i, f"l{i}| k") for i in (2, 9, 33, 44)],
    )
    found = []
    for even in (True, False):
        monkeypatch.setattr(extract, "lie_evenly", lambda meanings: even)
        answers = tasks.extension_answers(tables["extensions"], Config())
        merged = build.merged_meanings(tables, titles, spark.sql(LABELS), Config(), True, answers)
        order = sorted(merged.columns)
        # Groups of rows that lie by word are not dealt again.
        plan = merged._jdf.queryExecution().executedPlan().toString()
        assert ("own_part" in "".join(line for line in plan.splitlines() if "Exchange hashpartitioning" in line)) != even
        nested = build.word_records(tables, titles)
        found.append([sorted(map(str, df.collect())) for df in (merged.select(order), nested)])
    assert found[0] == found[1] and len(found[0][0]) > 20
