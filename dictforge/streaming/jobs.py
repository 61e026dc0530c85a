"""Structured Streaming jobs: incremental chunks, live telemetry, NaN alerts and a growing seen-set."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState

from dictforge.config import Config
from dictforge.functions import text as T
from dictforge.operators.ordered import with_run_length
from dictforge.operators.skew import SALTS, lookup_join
from dictforge.operators.telemetry import iteration_rows, parse_lines
from dictforge.schemas import TRAINING_STATS
from dictforge.session import stage
from dictforge.sources.readers import read_or_empty
from dictforge.sources.writers import append_blacklist, diagnostic_rows

# The words of a diagnostic.
ALERT_NOTE = "NaN limit hit. Action: "
UNKNOWN_RECORD = "Unknown"

FILES_PER_TRIGGER = 64


def record_stream(
    spark: SparkSession, path: str, schema: str, files_per_trigger: int = FILES_PER_TRIGGER
) -> DataFrame:
    """New record files of a folder; the file limit bounds the size of each batch."""
    return (
        spark.readStream.schema(schema)
        .option("mode", "DROPMALFORMED")
        .option("maxFilesPerTrigger", files_per_trigger)
        .json(path)
    )


def line_stream(spark: SparkSession, path: str, files_per_trigger: int = FILES_PER_TRIGGER) -> DataFrame:
    return (
        spark.readStream.option("maxFilesPerTrigger", files_per_trigger)
        .text(path)
        .select("value", F.col("_metadata.file_name").alias("file_name"))
    )


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process what has arrived since the last run and stop; finished files are not read again."""
    query = (
        stream.writeStream.format("parquet")
        .outputMode("append")
        .option("path", out)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def telemetry(lines: DataFrame, line: str = "value") -> DataFrame:
    """Loss and metric fields of the lines that carry them."""
    return parse_lines(lines, line).where(F.col("Iter").isNotNull())


def first_seen(records: DataFrame, spread: str) -> DataFrame:
    """One record of each concept key over an unbounded stream; which one is open, the seen keys never expire.

    ``first_wins`` settles which. Copies of a frequent key are first dropped within a salt, so at most ``SALTS``
    of them per batch meet in the task that owns the key.
    """
    salted = records.withColumn("_salt", F.pmod(F.xxhash64(spread), F.lit(SALTS)))
    return salted.dropDuplicates(["concept_key", "_salt"]).dropDuplicates(["concept_key"]).drop("_salt")


def first_wins(records: DataFrame, order: list[str], kept: list[str]) -> DataFrame:
    """``concept_key`` and ``kept`` of the record of each key that came first, given out once, for good.

    An earlier batch comes before a later one, whatever ``order`` says; inside a batch ``order`` decides. The state
    is one row per key, with ``order`` and ``kept`` only: name the id of a record, and join its text later. Rows of a
    key combine before the exchange, so a frequent key is one row per task. Write it in update mode.
    """
    stamped = records.select("concept_key", F.struct(
        F.current_timestamp().alias("stamp"), *order, *[c for c in kept if c not in order]
    ).alias("row"))
    # A batch has one timestamp, which a batch that runs again keeps.
    seen = stamped.groupBy("concept_key").agg(F.min("row").alias("first"), F.max("row.stamp").alias("latest"))
    return seen.where("first.stamp = latest").select("concept_key", *[F.col(f"first.{c}") for c in kept])


def run_first_wins(records: DataFrame, order: list[str], kept: list[str], folder: str, checkpoint: str) -> None:
    """Append the first records of new keys of what has arrived; each batch writes its own folder anew."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    query = (
        first_wins(records, order, kept).writeStream.outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


ALERTS = "run_id string, ord long, iter long, nan_run long, rollbacks long, action string"
_ALERT_STATE = "nan_run long, rollbacks long, stopped boolean"


def nan_alerts(losses: DataFrame, cfg: Config, action: str = "rollback") -> DataFrame:
    """Action rows of each run at which its consecutive-NaN counter reaches the threshold.

    ``losses`` needs run_id, ord, iter and loss. ``action`` is terminate, rollback or rollback-skip;
    a run stops after terminate or after more than ``max_rollbacks`` rollbacks. Within a batch the rows
    of a run are ordered by ``ord`` in one task; where a run may be too large for that, use
    ``run_nan_alerts``.
    """
    threshold, max_rollbacks = cfg.max_nan_threshold, cfg.max_rollbacks

    def watch(key: tuple, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, rollbacks, stopped = state.get if state.exists else (0, 0, False)
        if stopped:
            return
        rows = pd.concat(list(chunks)).sort_values("ord")
        flagged = rows["is_nan"].to_numpy(dtype=bool)
        at = np.arange(len(rows))
        last_valid = np.maximum.accumulate(np.where(flagged, -1, at))
        run = np.where(flagged, at - last_valid, 0) + np.where(flagged & (last_valid < 0), before, 0)
        hits = np.flatnonzero(flagged & (run % threshold == 0))
        allowed = 1 if action == "terminate" else max_rollbacks + 1 - rollbacks
        hits = hits[:allowed]
        stopped = len(hits) == allowed
        counted = rollbacks + np.arange(1, len(hits) + 1)
        state.update((int(run[-1]), int(rollbacks + len(hits)), bool(stopped)))
        if len(hits):
            last = action == "terminate" or stopped
            names = np.where(counted > max_rollbacks, "stop", action) if last else action
            yield pd.DataFrame(
                {
                    "run_id": key[0],
                    "ord": rows["ord"].to_numpy()[hits],
                    "iter": rows["iter"].to_numpy()[hits],
                    "nan_run": run[hits],
                    "rollbacks": counted,
                    "action": names,
                }
            )

    narrow = losses.select(
        "run_id", F.col("ord").cast("long").alias("ord"), F.col("iter").cast("long").alias("iter"),
        F.coalesce(F.isnan("loss"), F.lit(False)).alias("is_nan"),
    )
    return narrow.groupBy("run_id").applyInPandasWithState(
        watch, ALERTS, _ALERT_STATE, "append", "NoTimeout"
    )


RUN_STATE = "run_id string, nan_run long, rollbacks long, stopped boolean, counted long"
PENDING = "run_id string, ord long, iter long, loss double"


def alerts_of_batch(losses: DataFrame, state: DataFrame, cfg: Config, action: str) -> tuple[DataFrame, DataFrame]:
    """Alerts of one batch and the state of every run after it, for runs of any size.

    The run lengths come from the batch form (``with_run_length``), which spreads a large run over range
    partitions; what the state carries in concerns only rows before a run's first valid loss. Hits are
    ranked, and the rank is bounded by ``max_rollbacks``, so few of them pass the exchange.
    """
    rows = losses.select(
        "run_id", F.col("ord").cast("long").alias("ord"), F.col("iter").cast("long").alias("iter"),
        F.coalesce(F.isnan("loss"), F.lit(False)).alias("is_nan"),
    )
    first_valid = rows.where("not is_nan").groupBy("run_id").agg(F.min("ord").alias("_valid"))
    known = state.join(first_valid, "run_id", "full").select(
        "run_id", "_valid", F.coalesce("nan_run", F.lit(0)).alias("_carried"),
        F.coalesce("rollbacks", F.lit(0)).alias("_before"), F.coalesce("stopped", F.lit(False)).alias("_stopped"),
    )
    counted = with_run_length(rows, ["run_id"], ["ord"], F.col("is_nan"))
    joined = lookup_join(counted, known, "run_id", "left", "ord").where(~F.coalesce("_stopped", F.lit(False)))
    leading = F.col("is_nan") & (F.col("_valid").isNull() | (F.col("ord") < F.col("_valid")))
    runs = joined.withColumn(
        "nan_run", F.col("run_length") + F.when(leading, F.coalesce("_carried", F.lit(0))).otherwise(0)
    ).withColumn("_before", F.coalesce("_before", F.lit(0)))
    most = 1 if action == "terminate" else cfg.max_rollbacks + 1
    rank = F.row_number().over(Window.partitionBy("run_id").orderBy("ord"))
    hits = runs.where(F.col("is_nan") & (F.col("nan_run") % cfg.max_nan_threshold == 0)).withColumn("_rank", rank)
    hits = hits.where(F.col("_rank") <= most)
    rollbacks = F.col("_before") + F.col("_rank")
    last = rollbacks > cfg.max_rollbacks
    alerts = hits.where(F.lit(action == "terminate") | (rollbacks <= cfg.max_rollbacks + 1)).select(
        "run_id", "ord", "iter", "nan_run", rollbacks.alias("rollbacks"),
        F.when(last, "stop").otherwise(action).alias("action"),
    )
    ends = runs.groupBy("run_id").agg(F.max_by("nan_run", "ord").alias("_ends"), F.max("ord").alias("_at"))
    done = alerts.groupBy("run_id").agg(F.max("rollbacks").alias("_done"), F.max(F.col("action") == "stop").alias("_stop"))
    ended = F.coalesce("_stop", F.lit(False)) if action != "terminate" else F.col("_done").isNotNull()
    after = state.join(ends, "run_id", "full").join(done, "run_id", "left").select(
        "run_id", F.coalesce("_ends", "nan_run").alias("nan_run"),
        F.coalesce("_done", "rollbacks", F.lit(0)).cast("long").alias("rollbacks"),
        (F.coalesce("stopped", F.lit(False)) | ended).alias("stopped"),
        F.coalesce("_at", "counted").alias("counted"),
    )
    return alerts, after


def ripe_rows(rows: DataFrame, state: DataFrame, lateness: int | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Rows whose turn has come, rows that wait for earlier ones, and rows that came after their turn.

    A row waits until one of its run that is ``lateness`` places further on has arrived; without ``lateness`` none
    waits. What waits is bounded by ``lateness`` places per run.
    """
    counted = lookup_join(rows, state.select("run_id", "counted"), "run_id", "left", "ord")
    late = counted.where("ord <= counted").drop("counted")
    fresh = counted.where("counted is null or ord > counted").drop("counted")
    if lateness is None:
        return fresh, fresh.limit(0), late
    tops = fresh.groupBy("run_id").agg((F.max("ord") - lateness).alias("_until"))
    held = lookup_join(fresh, tops, "run_id", "left", "ord")
    return held.where("ord <= _until").drop("_until"), held.where("ord > _until").drop("_until"), late


def _alert_step(
    spark: SparkSession, batch: DataFrame, batch_id: int, cfg: Config, folder: str, action: str, lateness: int | None
) -> None:
    state = read_or_empty(spark, f"{folder}/state/batch={batch_id - 1}", RUN_STATE)
    waiting = read_or_empty(spark, f"{folder}/pending/batch={batch_id - 1}", PENDING)
    rows = stage(batch.select(*waiting.columns).unionByName(waiting), "losses_of_batch")
    ripe, pending, late = ripe_rows(rows, state, lateness)
    alerts, after = alerts_of_batch(stage(ripe, "ripe_losses"), state, cfg, action)
    for name, found in (("alerts", alerts), ("pending", pending), ("late", late), ("state", after)):
        found.write.mode("overwrite").parquet(f"{folder}/{name}/batch={batch_id}")


def run_nan_alerts(
    losses: DataFrame, cfg: Config, folder: str, checkpoint: str, action: str = "rollback", lateness: int | None = None
) -> None:
    """``nan_alerts`` for runs of any size: alerts, state, waiting and late rows of each batch in folders of their own.

    A batch reads what the one before left and writes ``alerts/batch=<id>``, ``state/batch=<id>`` and so on
    anew, so a batch that runs again gives the same. The state is one row per run. With ``lateness`` a row
    waits for those before it (see ``ripe_rows``), across batches; ``finish_nan_alerts`` counts what waits still. Rows
    that come after later ones were counted move no counter and stand in ``late``.
    """

    def step(batch: DataFrame, batch_id: int) -> None:
        _alert_step(batch.sparkSession, batch, batch_id, cfg, folder, action, lateness)

    query = (
        losses.writeStream.outputMode("append")
        .foreachBatch(step)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def finish_nan_alerts(spark: SparkSession, cfg: Config, folder: str, action: str = "rollback") -> None:
    """Count the rows that still wait, when no more will come; running it again changes nothing."""
    left = [spark.read.schema("run_id string, batch long").parquet(f"{folder}/{name}") for name in ("state", "pending")]
    last = left[0].unionByName(left[1]).agg(F.max("batch")).first()[0]
    if last is not None:
        _alert_step(spark, spark.createDataFrame([], PENDING), last + 1, cfg, folder, action, None)


def write_alerts(
    batch: DataFrame, batch_id: int, records: DataFrame, cfg: Config, folder: str, action: str
) -> None:
    """Diagnostics (and for a skip the blacklist) of one batch of alerts.

    Each batch writes its own folder ``batch=<id>`` anew, so a batch that runs again after a failure
    replaces its rows. The alerts, a few rows per run and batch, are measured and then broadcast to the
    records, which are neither shuffled nor read beyond their positions and the texts that match.
    """
    batch = batch.persist()
    try:
        wanted = batch.withColumn("gidx", (F.col("iter") - 1) * cfg.records_per_iteration)
        places = wanted.select("gidx").distinct()
        found = lookup_join(records.select("gidx", "text"), places, "gidx", "inner")
        hits = wanted.join(found, "gidx", "left").select(
            "run_id", "iter", F.current_timestamp().alias("ts"), F.col("gidx").alias("record_id"),
            F.coalesce("text", F.lit(UNKNOWN_RECORD)).alias("text"),
        )
        rows = diagnostic_rows(hits, f"{ALERT_NOTE}{action}", action)
        rows.write.mode("overwrite").parquet(f"{folder}/diagnostics/batch={batch_id}")
        if "skip" in action:
            append_blacklist(batch.select("run_id", "iter"), f"{folder}/blacklist")
    finally:
        batch.unpersist()


def run_stats(lines: DataFrame, folder: str, checkpoint: str) -> None:
    """Append the statistics of each batch of log lines (run_id, attempt, value, ts) to the stats table.

    A batch gives one partial row per run, attempt and iteration and writes its own folder, so a repeated
    batch replaces its rows; ``stats_table`` combines the parts of an iteration that several batches saw.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        rows = iteration_rows(parse_lines(batch))
        rows.write.mode("overwrite").parquet(f"{folder}/batch={batch_id}")

    query = (
        lines.writeStream.outputMode("append")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def stats_table(spark: SparkSession, folder: str) -> DataFrame:
    """One row per run, attempt and iteration of what ``run_stats`` has written."""
    schema = f"run_id string, attempt long, {TRAINING_STATS}"
    parts = spark.read.schema(schema).parquet(folder)
    keys = ["run_id", "attempt", "Iter"]
    return parts.groupBy(*keys).agg(*[F.max(c).alias(c) for c in parts.columns if c not in (*keys, "batch")])


def run_alerts(
    alerts: DataFrame, records: DataFrame, cfg: Config, folder: str, checkpoint: str, action: str
) -> None:
    """Append each batch of alerts to the diagnostics and, for rollback-skip, to the blacklist.

    ``records`` (gidx, text) names the record an iteration begins with.
    """

    def append(batch: DataFrame, batch_id: int) -> None:
        write_alerts(batch, batch_id, records, cfg, folder, action)

    query = (
        alerts.writeStream.outputMode("append")
        .foreachBatch(append)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()


def concept_stream(records: DataFrame) -> DataFrame:
    """Prompt and target of a record stream with their concept key."""
    return records.withColumn("concept_key", T.concept_key(F.col("usr_prompt"), F.col("target")))


