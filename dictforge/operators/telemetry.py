"""Training logs parsed, summarised and watched for runs of NaN losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dictforge.config import Config
from dictforge.operators.ordered import with_run_length
from dictforge.operators.skew import lookup_join

# The line formats of the trainer and its checkpoint names.
LOSS_LINE = r"(?i)Iter\s+(\d+):\s+(Train|Val)\s+loss\s+([nan\d\.]+)"
METRIC_LINE = (
    r"Learning Rate\s+([\d\.e-]+),\s+It/sec\s+([\d\.]+),\s+Tokens/sec\s+([\d\.]+),"
    r"\s+Trained Tokens\s+(\d+),\s+Peak mem\s+([\d\.]+)"
)
SAVED_LINE = r"Saved adapter weights to (.*) and (.*)\."
CHECKPOINT_NAME = r"(\d+)_adapters"
CHECKPOINT_SUFFIX = "_adapters.safetensors"

_METRICS = (
    ("LearningRate", "double"), ("ItSec", "double"), ("TokensSec", "double"),
    ("TrainedTokens", "long"), ("PeakMemGB", "double"),
)


def _found(line: Column, regex: str, group: int) -> Column:
    text = F.regexp_extract(line, regex, group)
    return F.when(text != "", text)


def parse_lines(lines: DataFrame, line: str = "value") -> DataFrame:
    """Typed fields of each log line; fields of other line kinds are null. Native expressions only."""
    c = F.col(line)
    fields = {
        "Iter": _found(c, LOSS_LINE, 1).try_cast("int"),
        "mode": F.initcap(_found(c, LOSS_LINE, 2)),
        "loss": F.lower(_found(c, LOSS_LINE, 3)).try_cast("double"),
        "saved_to": _found(c, SAVED_LINE, 2),
    }
    for group, (name, kind) in enumerate(_METRICS, start=1):
        fields[name] = _found(c, METRIC_LINE, group).try_cast(kind)
    return lines.withColumns(fields)


def iteration_rows(parsed: DataFrame, keys: tuple[str, ...] = ("run_id", "attempt")) -> DataFrame:
    """One row per iteration from its train, validation and metric lines; combines before the shuffle.

    ``Timestamp`` is the latest ``ts`` of the lines of an iteration, null where lines carry none.
    """
    stamp = F.max("ts") if "ts" in parsed.columns else F.lit(None)
    return parsed.where(F.col("Iter").isNotNull()).groupBy(*keys, "Iter").agg(
        F.max(F.when(F.col("mode") == "Train", F.col("loss"))).alias("TrainLoss"),
        F.max(F.when(F.col("mode") == "Val", F.col("loss"))).alias("ValLoss"),
        *[F.max(name).alias(name) for name, _ in _METRICS],
        stamp.cast("timestamp").alias("Timestamp"),
    )


def loss_series(stats: DataFrame, engine: str) -> DataFrame:
    """Either statistics layout as ``(run_id, attempt, engine, step, train_loss, val_loss)``; no attempt is 0."""
    names = stats.columns
    own_layout = "TrainLoss" in names
    step, train, val = ("Iter", "TrainLoss", "ValLoss") if own_layout else ("step", "loss", "eval_loss")
    missing = F.lit(None).cast("double")
    return stats.select(
        F.col("run_id") if "run_id" in names else F.lit("").alias("run_id"),
        (F.col("attempt").cast("long") if "attempt" in names else F.lit(0).cast("long")).alias("attempt"),
        F.lit(engine).alias("engine"),
        F.col(step).cast("long").alias("step"),
        F.col(train).alias("train_loss"),
        (F.col(val) if val in names else missing).alias("val_loss"),
    )


def with_validation(series: DataFrame) -> DataFrame:
    return series.dropna(subset=["val_loss"])


def loss_summary(series: DataFrame, keys: tuple[str, ...] = ("engine", "run_id")) -> DataFrame:
    """Rows, first, last and least train loss, and the last validation loss, of each series.

    Attempts of a run follow each other: the order is that of ``(attempt, step)``.
    """
    order = F.struct("attempt", "step")
    has_val = F.col("val_loss").isNotNull() & ~F.isnan("val_loss")
    valid_train = F.when(~F.isnan("train_loss"), F.col("train_loss"))
    return series.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.min_by("train_loss", order).alias("first_train_loss"),
        F.max_by("train_loss", order).alias("last_train_loss"),
        F.min(valid_train).alias("min_train_loss"),
        F.max_by("val_loss", F.when(has_val, order)).alias("last_val_loss"),
    )


def nan_actions(
    losses: DataFrame, cfg: Config, order: list[str], loss: str = "loss", keys: tuple[str, ...] = ("run_id",)
) -> DataFrame:
    """Rows at which the consecutive-NaN counter reaches the threshold, after which it starts again."""
    runs = with_run_length(losses, list(keys), order, F.coalesce(F.isnan(loss), F.lit(False)), "nan_run")
    threshold = cfg.max_nan_threshold
    return runs.where((F.col("nan_run") > 0) & (F.col("nan_run") % threshold == 0))


def _numbered(inventory: DataFrame, path: str) -> DataFrame:
    base = F.substring_index(path, "/", -1)
    number = F.regexp_extract(base, CHECKPOINT_NAME, 1).try_cast("long")
    return inventory.where(F.endswith(base, F.lit(CHECKPOINT_SUFFIX))).withColumn("iter", number)


def superseded_checkpoints(inventory: DataFrame, cfg: Config, run: str = "run_id", path: str = "path") -> DataFrame:
    """All but the newest checkpoints of each run.

    Only the newest few of a run pass the exchange (group limit); the oldest of them is the line below
    which everything goes, so no run is ranked as a whole.
    """
    numbered = _numbered(inventory, path).withColumn("iter", F.coalesce("iter", F.lit(0)))
    newest = Window.partitionBy(run).orderBy(F.desc("iter"), F.desc(path))
    kept = numbered.withColumn("_rank", F.row_number().over(newest)).where(
        F.col("_rank") <= cfg.keep_checkpoints
    )
    line = (
        kept.groupBy(run)
        .agg(F.min(F.struct("iter", path)).alias("_line"), F.count("*").alias("_kept"))
        .where(F.col("_kept") == cfg.keep_checkpoints)
        .select(run, "_line")
    )
    return (
        lookup_join(numbered, line, run, "inner", path)
        .where(F.struct("iter", path) < F.col("_line"))
        .drop("_line")
    )


def latest_checkpoint(inventory: DataFrame, run: str = "run_id", path: str = "path") -> DataFrame:
    numbered = _numbered(inventory, path).where(F.col("iter").isNotNull())
    return numbered.groupBy(run).agg(
        F.max("iter").alias("iter"), F.max_by(path, F.struct("iter", path)).alias(path)
    )
