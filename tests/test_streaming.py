"""Streams: progress over several runs, NaN actions, the seen-set."""

import functools
import random

import pytest
from pyspark.sql import functions as F

from dictforge import schemas
from dictforge.config import Config
from dictforge.operators import ordered
from dictforge.sources import readers, writers
from dictforge.streaming import jobs

NAN = "NaN"


def alerts(spark, folder, batches, cfg, action):
    """Feed batches one by one to the same checkpoint and return all action rows."""
    for batch in batches:
        df = spark.createDataFrame(batch, "run_id string, ord long, iter long, loss string")
        writers.write_records(df.coalesce(1), f"{folder}/in", "append")
        stream = jobs.record_stream(spark, f"{folder}/in", "run_id string, ord long, iter long, loss string")
        found = jobs.nan_alerts(stream.withColumn("loss", F.col("loss").cast("double")), cfg, action)
        jobs.run_available(found, f"{folder}/out", f"{folder}/check")
    rows = spark.read.schema(jobs.ALERTS).parquet(f"{folder}/out").orderBy("run_id", "ord").collect()
    return [(r["run_id"], r["ord"], r["nan_run"], r["rollbacks"], r["action"]) for r in rows]


def series(run, losses, start=0):
    return [(run, start + i, start + i + 1, loss) for i, loss in enumerate(losses)]


def test_alert_positions_and_carried_state(spark, tmp_path):
    losses = ["1.0", NAN, NAN, NAN, "0.5", NAN, NAN, NAN]
    whole = alerts(spark, tmp_path / "a", [series("r", losses)], Config(), "rollback")
    assert whole == [("r", 3, 3, 1, "rollback"), ("r", 7, 3, 2, "rollback")]
    cut = [series("r", losses[:2]), series("r", losses[2:6], 2), series("r", losses[6:], 6)]
    assert alerts(spark, tmp_path / "b", cut, Config(), "rollback") == whole


def test_terminate_stops_a_run(spark, tmp_path):
    batches = [series("r", [NAN] * 4) + series("ok", ["1.0"] * 4), series("r", [NAN] * 9, 4)]
    assert alerts(spark, tmp_path, batches, Config(), "terminate") == [("r", 2, 3, 1, "terminate")]


def test_rollback_cap(spark, tmp_path):
    cfg = Config(max_nan_threshold=1, max_rollbacks=2)
    got = alerts(spark, tmp_path, [series("r", [NAN] * 2), series("r", [NAN] * 5, 2)], cfg, "rollback")
    assert got == [("r", 0, 1, 1, "rollback"), ("r", 1, 2, 2, "rollback"), ("r", 2, 3, 3, "stop")]


def test_alerts_fill_blacklist_and_diagnostics(spark, tmp_path):
    cfg = Config(max_nan_threshold=2)
    folder = str(tmp_path)
    writers.write_records(
        spark.createDataFrame(series("r", ["1.0", NAN, NAN, NAN, NAN]), "run_id string, ord long, iter long, loss string"), f"{folder}/in")
    stream = jobs.record_stream(spark, f"{folder}/in", "run_id string, ord long, iter long, loss string")
    found = jobs.nan_alerts(stream.withColumn("loss", F.col("loss").cast("double")), cfg, "rollback-skip")
    records = spark.range(1000).select(F.col("id").alias("gidx"), F.concat(F.lit("record "), "id").alias("text"))
    jobs.run_alerts(found, records, cfg, folder, f"{folder}/check", "rollback-skip")
    listed = readers.read_or_empty(spark, f"{folder}/blacklist", schemas.BLACKLIST)
    assert sorted(r["iter"] for r in listed.collect()) == [3, 5]
    kept = readers.read_or_empty(spark, f"{folder}/diagnostics", schemas.DIAGNOSTICS).orderBy("iter").collect()
    assert [(r["record_id"], r["text"], r["action"]) for r in kept] == [
        (128, "record 128", "rollback-skip"), (256, "record 256", "rollback-skip")]


def test_finished_files_are_not_read_again(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for part in range(3):
        writers.write_records(spark.range(part * 10, part * 10 + 10), folder, "append")
        for _ in range(2):
            jobs.run_available(jobs.record_stream(spark, folder, "id long"), out, check)
        assert spark.read.schema("id long").parquet(out).count() == (part + 1) * 10


@pytest.mark.parametrize("copies", [1, 40])
def test_first_seen(spark, tmp_path, copies):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    for _ in range(2):
        df = spark.range(50 * copies).select("id", F.lit("p").alias("usr_prompt"), (F.col("id") % 50).cast("string").alias("target"))
        writers.write_records(df, folder, "append")
        records = jobs.concept_stream(jobs.record_stream(spark, folder, "id long, usr_prompt string, target string"))
        jobs.run_available(jobs.first_seen(records, "id"), out, check)
    assert spark.read.schema("target string").parquet(out).count() == 50


@pytest.mark.parametrize("action", ["terminate", "rollback"])
@pytest.mark.parametrize("spread", [False, True])
def test_batches_of_alerts_equal_a_plain_count(spark, tmp_path, monkeypatch, action, spread):
    """Runs cut anywhere into batches, usual and spread ones, against a counter."""
    if spread:
        monkeypatch.setattr(jobs, "with_run_length", functools.partial(ordered.with_run_length, local_rows=5))
    rng = random.Random(4)
    cfg = Config(max_nan_threshold=3, max_rollbacks=2)
    rows = [(f"r{i % 3}", i, i + 1, float("nan") if rng.random() < 0.8 else 1.0) for i in range(90)]
    want, counts = [], {}
    for run, at, step, loss in rows:
        c = counts.setdefault(run, {"nan": 0, "done": 0, "stopped": False})
        if c["stopped"]:
            continue
        c["nan"] = c["nan"] + 1 if loss != loss else 0
        if c["nan"] and c["nan"] % 3 == 0:
            c["done"] += 1
            c["stopped"] = action == "terminate" or c["done"] > cfg.max_rollbacks
            want.append((run, at, step, c["nan"], c["done"], "stop" if c["done"] > cfg.max_rollbacks else action))
    state, found = spark.createDataFrame([], jobs.RUN_STATE), []
    for begin in (0, 37, 41, 80):
        end = {0: 37, 37: 41, 41: 80, 80: 90}[begin]
        batch = spark.createDataFrame(rows[begin:end], "run_id string, ord long, iter long, loss double")
        alerts, after = jobs.alerts_of_batch(batch, state, cfg, action)
        found += [tuple(r) for r in alerts.select("run_id", "ord", "iter", "nan_run", "rollbacks", "action").collect()]
        state = spark.createDataFrame(after.collect(), jobs.RUN_STATE)
    assert sorted(found) == sorted(want)


def test_first_wins_for_good(spark, tmp_path):
    folder, out, check = (str(tmp_path / n) for n in ("in", "out", "check"))
    arrivals = [[(5, "a"), (3, "a"), (9, "b")], [(1, "a"), (2, "b"), (7, "c"), (6, "c")], [(0, "c"), (4, "d")]]
    for rows in arrivals:
        df = spark.createDataFrame(rows, "id long, target string").withColumn("usr_prompt", F.lit("p"))
        writers.write_records(df.coalesce(1), folder, "append")
        records = jobs.concept_stream(jobs.record_stream(spark, folder, "id long, usr_prompt string, target string"))
        for _ in range(2):
            jobs.run_first_wins(records, ["id"], ["id", "target"], out, check)
    kept = spark.read.schema("concept_key string, id long, target string").parquet(out).collect()
    assert sorted((r["target"], r["id"]) for r in kept) == [("a", 3), ("b", 9), ("c", 6), ("d", 4)]


def test_late_rows_are_put_in_order(spark, tmp_path):
    """Rows wait for earlier ones of a later batch; those beyond the lateness move no counter."""
    cfg = Config(max_nan_threshold=3)
    rows = {i: ("r", i, i + 1, NAN if i not in (4, 9) else "1.0") for i in range(14)}
    batches = [[rows[i] for i in (0, 2, 1, 3, 7)], [rows[i] for i in (5, 4, 6, 8, 13)], [rows[i] for i in (9, 10, 12, 11)], [("r", 2, 3, "1.0")]]
    folder = str(tmp_path)
    for batch in batches:
        writers.write_records(spark.createDataFrame(batch, "run_id string, ord long, iter long, loss string").coalesce(1), f"{folder}/in", "append")
        stream = jobs.record_stream(spark, f"{folder}/in", "run_id string, ord long, iter long, loss string")
        jobs.run_nan_alerts(stream.withColumn("loss", F.col("loss").cast("double")), cfg, f"{folder}/out", f"{folder}/check", lateness=5)
    for _ in range(2):
        jobs.finish_nan_alerts(spark, cfg, f"{folder}/out")
    got = spark.read.schema(jobs.ALERTS).parquet(f"{folder}/out/alerts").orderBy("ord").collect()
    assert [(r["ord"], r["nan_run"], r["rollbacks"]) for r in got] == [(2, 3, 1), (7, 3, 2), (12, 3, 3)]
    late = spark.read.schema("run_id string, ord long").parquet(f"{folder}/out/late").collect()
    assert [r["ord"] for r in late] == [2]
