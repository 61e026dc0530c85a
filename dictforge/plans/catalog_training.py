"""Queries of record numbering, blacklists, telemetry, files and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictforge import schemas
from dictforge.config import Config
from dictforge.functions import text as T
from dictforge.operators import audit, dataset, telemetry
from dictforge.operators.ordered import with_global_index
from dictforge.operators.skew import lookup_join
from dictforge.plans.catalog import query, sql_key, sql_normalize, table
from dictforge.session import scratch_path
from dictforge.sources import manifest, positions, readers, writers
from dictforge.streaming import jobs

CFG = Config(words_per_chunk=300, batch_size=2, gradient_accumulation_steps=4)
K = CFG.records_per_iteration


# ---------------------------------------------------------------------------------------------------
# Positions, chunks, blacklists


def _numbered_docs(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("lang", "source", "doc_id", "text")
    return dataset.indexed(docs, ["lang", "source", "doc_id"], CFG)


_NUMBERED = """numbered AS (SELECT doc_id, text, row_number() OVER (ORDER BY lang, source, doc_id) - 1 AS gidx FROM documents)"""
_BAD = f"bad AS (SELECT DISTINCT CAST(doc_id // {K} + 1 AS BIGINT) AS iter FROM labels WHERE toxic = 1)"


def _blacklist(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "labels").where("toxic = 1").select(F.expr(f"doc_id div {K} + 1").alias("iter"))


def _chunks_reread(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "chunks")
    writers.write_chunks(_numbered_docs(spark, sf), path, ["doc_id", "text"])
    return readers.read_records(spark, path, "doc_id long, text string, gidx long, chunk_id long", "FAILFAST")


@query(f"WITH {_NUMBERED} SELECT doc_id, text, gidx, CAST(gidx // 300 + 1 AS BIGINT) AS chunk_id FROM numbered")
def chunk_records(spark: SparkSession, sf: str) -> DataFrame:
    return _chunks_reread(spark, sf)


@query(f"""WITH {_NUMBERED}, bad AS (SELECT DISTINCT CAST(doc_id // {K} + 1 AS BIGINT) AS iter FROM labels WHERE toxic = 1)
SELECT doc_id, gidx, text FROM numbered WHERE gidx >= 3 * {K} AND gidx // {K} + 1 NOT IN (SELECT iter FROM bad)""")
def blacklist_after_reread(spark: SparkSession, sf: str) -> DataFrame:
    """The blacklist of one of two runs hits the right records of chunk files, by their stored position."""
    labels = table(spark, sf, "labels")
    listed = labels.select(F.concat(F.lit("run"), "toxic").alias("run_id"), F.expr(f"doc_id div {K} + 1").alias("iter"))
    kept = dataset.training_set(_chunks_reread(spark, sf), listed, CFG, skip_iterations=3, run_id="run1")
    return kept.select("doc_id", "gidx", "text")


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
  CAST((row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey) - 1) // 5000 + 1 AS BIGINT) AS chunk_id FROM lineitem""")
def chunk_numbers(spark: SparkSession, sf: str) -> DataFrame:
    order = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]
    items = table(spark, sf, "lineitem").select(*order)
    return dataset.indexed(items, order, Config()).select(*order, "chunk_id")


@query(f"WITH {_NUMBERED} SELECT doc_id, gidx, text FROM numbered WHERE gidx < 100")
def valid_split(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select("lang", "source", "doc_id", "text")
    return dataset.validation_split(docs, ["lang", "source", "doc_id"], CFG).select("doc_id", "gidx", "text")


@query(f"""WITH {_NUMBERED}, {_BAD}
SELECT doc_id, gidx, text FROM numbered WHERE gidx >= 3 * {K} AND gidx // {K} + 1 NOT IN (SELECT iter FROM bad)""")
def skip_and_blacklist(spark: SparkSession, sf: str) -> DataFrame:
    kept = dataset.training_set(_numbered_docs(spark, sf), _blacklist(spark, sf), CFG, skip_iterations=3)
    return kept.select("doc_id", "gidx", "text")


@query(f"WITH {_NUMBERED}, {_BAD} SELECT iter, gidx, doc_id, text FROM numbered JOIN bad ON gidx = (iter - 1) * {K}")
def iteration_record(spark: SparkSession, sf: str) -> DataFrame:
    # Keys are numbered; the texts of the few records that are wanted come afterwards.
    docs, order = table(spark, sf, "documents"), ["lang", "source", "doc_id"]
    numbered = dataset.indexed(docs.select(*order), order, CFG)
    found = dataset.iteration_records(numbered, _blacklist(spark, sf), CFG).select("iter", "gidx", "doc_id")
    return lookup_join(docs.select("doc_id", "text"), found, "doc_id", "inner").select("iter", "gidx", "doc_id", "text")


@query(f"""WITH {_NUMBERED}, {_BAD}, kept AS (SELECT count(*) AS kept FROM numbered
  WHERE gidx >= 3 * {K} AND gidx // {K} + 1 NOT IN (SELECT iter FROM bad)), n AS (SELECT count(*) AS records FROM documents)
SELECT records, kept, records - kept AS skipped, CAST(kept // {K} * 5 AS BIGINT) AS iterations,
  CAST(floor(kept // {K} * 5 * 0.03) AS BIGINT) AS warmup_steps FROM n, kept""")
def training_counts(spark: SparkSession, sf: str) -> DataFrame:
    order = ["lang", "source", "doc_id"]
    numbered = dataset.indexed(table(spark, sf, "documents").select(*order), order, CFG)
    kept = dataset.training_set(numbered, _blacklist(spark, sf), CFG, skip_iterations=3)
    return dataset.training_counts(numbered, kept, CFG)


# ---------------------------------------------------------------------------------------------------
# Training logs, rendered from events by one SQL text that both engines run


_LOSS_TEXT = """CASE WHEN event_type = 'error' THEN 'nan' ELSE concat(CAST(floor(value) AS BIGINT), '.',
    lpad(CAST(CAST(floor(value * 100) AS BIGINT) % 100 AS VARCHAR(10)), 2, '0')) END"""
LOG_LINES = f"""SELECT event_id AS line_no, concat('run', user_id % 9) AS run_id, event_id % 2 AS attempt, event_type, ts,
  CASE WHEN event_type = 'view' THEN concat('Iter ', CAST(floor(event_id / 40) AS BIGINT), ': Val loss ', {_LOSS_TEXT}, ', Val took 5.1s')
    WHEN event_type = 'signup' THEN concat('Saved adapter weights to out/adapters.safetensors and out/', lpad(CAST(event_id AS VARCHAR(20)), 7, '0'), '_adapters.safetensors.')
    WHEN event_type = 'click' AND event_id % 5 = 0 THEN 'Loading pretrained model'
    ELSE concat('iter ', CAST(floor(event_id / 40) AS BIGINT), ': train loss ', {_LOSS_TEXT}, ', Learning Rate 2.', event_id % 10, '00e-05, It/sec 1.', event_id % 7,
      ', Tokens/sec ', 200 + event_id % 90, '.5, Trained Tokens ', event_id * 3, ', Peak mem 9.', event_id % 8, ' GB') END AS value
  FROM {{events}}"""
_LINES = "lines AS (" + LOG_LINES.replace("{events}", "events") + ")"
_PARSED = rf"""{_LINES},
found AS (SELECT *, regexp_extract(value, '{telemetry.LOSS_LINE}', ['it', 'mode', 'loss']) AS l,
  regexp_extract(value, '{telemetry.METRIC_LINE}', ['lr', 'its', 'tps', 'tok', 'mem']) AS m FROM lines),
parsed AS (SELECT line_no, run_id, attempt, TRY_CAST(l.it AS INT) AS iter, lower(nullif(l.mode, '')) AS mode,
  TRY_CAST(nullif(l.loss, '') AS DOUBLE) AS loss, TRY_CAST(m.lr AS DOUBLE) AS lr, TRY_CAST(m.its AS DOUBLE) AS its, TRY_CAST(m.tps AS DOUBLE) AS tps,
  TRY_CAST(m.tok AS BIGINT) AS tok, TRY_CAST(m.mem AS DOUBLE) AS mem, ts,
  nullif(regexp_extract(value, '{telemetry.SAVED_LINE}', 2), '') AS saved_to FROM found)"""
# NaN is kept out of compared columns.
_NUM = "CASE WHEN isnan({c}) THEN -1 ELSE {c} END"


def _number(c: str):
    return F.when(F.isnan(c), -1.0).otherwise(F.col(c))


def log_lines(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(LOG_LINES, events=table(spark, sf, "events"))


@query(f"""WITH {_PARSED} SELECT line_no, iter AS "Iter", mode, {_NUM.format(c='loss')} AS loss, lr, its, tps, tok, mem, saved_to FROM parsed""")
def parse_train_log(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.parse_lines(log_lines(spark, sf)).select(
        "line_no", "Iter", F.lower("mode").alias("mode"), _number("loss").alias("loss"), F.col("LearningRate").alias("lr"),
        F.col("ItSec").alias("its"), F.col("TokensSec").alias("tps"), F.col("TrainedTokens").alias("tok"),
        F.col("PeakMemGB").alias("mem"), "saved_to",
    )


_ROWS = f"""{_PARSED},
rows AS (SELECT run_id, attempt, iter, max(CASE WHEN mode = 'train' THEN loss END) AS train_loss, max(CASE WHEN mode = 'val' THEN loss END) AS val_loss,
  max(lr) AS lr, max(its) AS its, max(tps) AS tps, max(tok) AS tok, max(mem) AS mem, epoch_us(max(ts)) AS stamp FROM parsed WHERE iter IS NOT NULL GROUP BY run_id, attempt, iter)"""


def stats_rows(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.iteration_rows(telemetry.parse_lines(log_lines(spark, sf)))


@query(f"""WITH {_ROWS} SELECT run_id, CAST(attempt AS BIGINT) AS attempt, iter AS "Iter", {_NUM.format(c='train_loss')} AS "TrainLoss",
  {_NUM.format(c='val_loss')} AS "ValLoss", lr AS "LearningRate", tok AS "TrainedTokens", stamp FROM rows""")
def loss_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _compared_rows(stats_rows(spark, sf))


def _compared_rows(rows: DataFrame) -> DataFrame:
    return rows.select(
        "run_id", "attempt", "Iter", _number("TrainLoss").alias("TrainLoss"), _number("ValLoss").alias("ValLoss"),
        "LearningRate", "TrainedTokens", F.unix_micros("Timestamp").alias("stamp"),
    )


_SERIES = f"""{_ROWS},
series AS (SELECT 'mlx' AS engine, run_id, CAST(attempt AS BIGINT) AS attempt, CAST(iter AS BIGINT) AS step, train_loss, val_loss FROM rows
  UNION ALL SELECT 'hf', concat('run', user_id % 9), 0, event_id, value, NULL FROM events WHERE event_type = 'purchase')"""


def _both_series(spark: SparkSession, sf: str) -> DataFrame:
    own = telemetry.loss_series(stats_rows(spark, sf), "mlx")
    steps = table(spark, sf, "events").where("event_type = 'purchase'").select(
        F.concat(F.lit("run"), F.col("user_id") % 9).alias("run_id"), F.col("event_id").alias("step"), F.col("value").alias("loss")
    )
    return own.unionByName(telemetry.loss_series(steps, "hf"))


@query(f"WITH {_SERIES} SELECT engine, run_id, attempt, step, {_NUM.format(c='train_loss')} AS train_loss, {_NUM.format(c='val_loss')} AS val_loss FROM series")
def loss_series(spark: SparkSession, sf: str) -> DataFrame:
    return _both_series(spark, sf).select(
        "engine", "run_id", "attempt", "step", _number("train_loss").alias("train_loss"), _number("val_loss").alias("val_loss")
    )


@query(f"WITH {_SERIES} SELECT engine, run_id, attempt, step, val_loss FROM series WHERE val_loss IS NOT NULL AND NOT isnan(val_loss)")
def validation_points(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.with_validation(_both_series(spark, sf)).select("engine", "run_id", "attempt", "step", "val_loss")


@query(f"""WITH {_SERIES}, s AS (SELECT *, {_NUM.format(c='train_loss')} AS t FROM series)
SELECT engine, run_id, count(*) AS rows, arg_min_null(t, [attempt, step]) AS first_train_loss, arg_max_null(t, [attempt, step]) AS last_train_loss,
  min(CASE WHEN NOT isnan(train_loss) THEN train_loss END) AS min_train_loss,
  arg_max(val_loss, [attempt, step]) FILTER (val_loss IS NOT NULL AND NOT isnan(val_loss)) AS last_val_loss FROM s GROUP BY engine, run_id""")
def loss_summary(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.loss_summary(_both_series(spark, sf)).select(
        "engine", "run_id", "rows", _number("first_train_loss").alias("first_train_loss"),
        _number("last_train_loss").alias("last_train_loss"), "min_train_loss", "last_val_loss",
    )


_NAN_RUNS = """flagged AS (SELECT user_id, event_id, event_type = 'error' AS bad FROM events),
islands AS (SELECT *, sum(CASE WHEN bad THEN 0 ELSE 1 END) OVER (PARTITION BY user_id ORDER BY event_id) AS island FROM flagged),
runs AS (SELECT user_id, event_id, row_number() OVER (PARTITION BY user_id, island ORDER BY event_id) AS nan_run FROM islands WHERE bad)"""


def _losses(spark: SparkSession, sf: str) -> DataFrame:
    loss = F.when(F.col("event_type") == "error", F.lit(float("nan"))).otherwise(F.col("value"))
    return table(spark, sf, "events").select("user_id", "event_id", loss.alias("loss"))


@query(f"WITH {_NAN_RUNS} SELECT user_id, event_id, nan_run FROM runs WHERE nan_run % 3 = 0")
def nan_runs(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.nan_actions(_losses(spark, sf), CFG, ["event_id"], keys=("user_id",)).select("user_id", "event_id", "nan_run")


INVENTORY = """SELECT concat('run', o_custkey % 23) AS run_id, CASE WHEN o_orderkey % 50 = 0 THEN concat('m/', o_orderkey, '/adapters.safetensors')
  WHEN o_orderkey % 51 = 0 THEN concat('m/', o_orderkey, '/x_adapters.safetensors')
  ELSE concat('m/', o_custkey % 23, '/', lpad(CAST(o_orderkey AS VARCHAR(20)), 7, '0'), '_adapters.safetensors') END AS path FROM {orders}"""
_INVENTORY = f"""inventory AS ({INVENTORY.replace('{orders}', 'orders')}),
files AS (SELECT run_id, path, TRY_CAST(regexp_extract(path, '([0-9]+)_adapters[^/]*$', 1) AS BIGINT) AS iter FROM inventory WHERE ends_with(path, '_adapters.safetensors'))"""


def inventory(spark: SparkSession, sf: str) -> DataFrame:
    return spark.sql(INVENTORY, orders=table(spark, sf, "orders"))


@query(f"""WITH {_INVENTORY} SELECT run_id, coalesce(iter, 0) AS iter, path FROM files
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY coalesce(iter, 0) DESC, path DESC) > 5""")
def checkpoint_retention(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.superseded_checkpoints(inventory(spark, sf), CFG).select("run_id", "iter", "path")


@query(f"""WITH {_INVENTORY} SELECT run_id, iter, path FROM files WHERE iter IS NOT NULL
QUALIFY row_number() OVER (PARTITION BY run_id ORDER BY iter DESC, path DESC) = 1""")
def latest_checkpoint(spark: SparkSession, sf: str) -> DataFrame:
    return telemetry.latest_checkpoint(inventory(spark, sf)).select("run_id", "iter", "path")


# ---------------------------------------------------------------------------------------------------
# Files and append tables


@query("SELECT doc_id, text, lang FROM documents")
def jsonl_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Records in several files, with blank and malformed lines between them, read back in one scan."""
    path = scratch_path(spark, "records")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    writers.write_records(docs.where("doc_id % 2 = 0"), f"{path}/part=0")
    writers.write_rolling(docs.where("doc_id % 2 = 1"), f"{path}/part=1", 200)
    broken = docs.where("doc_id % 100 = 0").select(F.when(F.col("doc_id") % 200 == 0, "").otherwise('{"doc_id": '))
    broken.write.text(f"{path}/part=2")
    rows = readers.read_records(
        spark, [f"{path}/part={i}" for i in range(3)], "doc_id long, text string, lang string", with_file=True
    )
    return rows.where("file_name IS NOT NULL and line >= 0").drop("file_name", "line")


@query("""SELECT 'kept' AS kind, doc_id, md5(text) AS value, CAST(NULL AS VARCHAR) AS reason FROM documents
UNION ALL SELECT 'rejected', NULL, concat('{"doc_id": ', doc_id), 'no JSON' FROM documents WHERE doc_id % 5 = 0
UNION ALL SELECT 'rejected', NULL, concat('{"doc_id": "', lang, doc_id, '"}'), 'another type' FROM documents WHERE doc_id % 5 = 1""")
def rejected_lines(spark: SparkSession, sf: str) -> DataFrame:
    """Lines cut short and values of another type among all records: both kinds of lines come from one scan."""
    path = scratch_path(spark, "records")
    docs = table(spark, sf, "documents").select("doc_id", "text", "lang")
    whole = F.to_json(F.struct("doc_id", "text"), {"ignoreNullFields": "true"})
    short = F.when(F.col("doc_id") % 5 == 0, F.concat(F.lit('{"doc_id": '), F.col("doc_id")))
    typed = F.when(F.col("doc_id") % 5 == 1, F.concat(F.lit('{"doc_id": "'), "lang", "doc_id", F.lit('"}')))
    lines = F.filter(F.array(whole, short, typed, F.lit("  ")), lambda x: x.isNotNull())
    docs.select(F.explode(lines).alias("value")).write.text(path)
    kept, rejected = readers.read_checked(spark, path, "doc_id long, text string")
    none = F.lit(None)
    return kept.select(F.lit("kept").alias("kind"), "doc_id", F.md5("text").alias("value"), none.cast("string").alias("reason")).unionByName(
        rejected.where("line >= 0").select(F.lit("rejected").alias("kind"), none.cast("long").alias("doc_id"), "value", "reason")
    )


@query("""WITH p AS (SELECT doc_id, text, CAST(row_number() OVER (ORDER BY length(text) > 2000, doc_id) - 1 AS BIGINT) AS gidx FROM documents)
SELECT gidx, doc_id, md5(text) AS text FROM p JOIN (SELECT DISTINCT CAST(event_id // 3 AS BIGINT) AS gidx FROM events WHERE event_type = 'error') USING (gidx)""")
def positions_after_append(spark: SparkSession, sf: str) -> DataFrame:
    """Short texts first, long ones appended behind them; the records at given positions are read by file."""
    folder = scratch_path(spark, "positions")
    docs = table(spark, sf, "documents").select("doc_id", "text")
    long = F.length("text") > 2000
    for part in (~long, long):
        positions.append_ordered(docs.where(part), ["doc_id"], folder)
    wanted = table(spark, sf, "events").where("event_type = 'error'").select(F.expr("event_id div 3").alias("gidx")).distinct()
    found = positions.at_positions(spark, folder, "doc_id long, text string", wanted)
    return found.select("gidx", "doc_id", F.md5("text").alias("text"))


@query(f"""SELECT doc_id, {sql_normalize("CASE WHEN source = (SELECT min(source) FROM documents) THEN concat('again: ', text) ELSE text END")} AS text FROM documents""")
def changed_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """A chunk per source; a first run, one after a chunk was rewritten, one after nothing changed."""
    folder, out = scratch_path(spark, "chunks"), scratch_path(spark, "processed")
    docs = table(spark, sf, "documents").select("doc_id", "text", "source")
    first = docs.agg(F.min("source")).first()[0]

    def write(rows: DataFrame, mode: str) -> None:
        rows.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy("source").json(folder)

    def process(lines: DataFrame) -> DataFrame:
        rows = lines.select("chunk", F.from_json("value", "doc_id long, text string").alias("r"))
        return rows.select("chunk", "r.doc_id", T.normalize(F.col("r.text")).alias("text"))

    write(docs, "errorifexists")
    for _ in range(2):
        manifest.process_changed(spark, folder, out, process)
        write(docs.where(F.col("source") == first).withColumn("text", F.concat(F.lit("again: "), "text")), "overwrite")
    manifest.process_changed(spark, folder, out, process)
    return manifest.current(spark, out, "chunk string, doc_id long, text string").select("doc_id", "text")


@query("""SELECT 'type' AS kind, n_name AS raw, concat('r', n_regionkey) AS label FROM nation
UNION ALL SELECT 'gender', r_name, concat('g', r_regionkey) FROM region""")
def map_dimension(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "maps")

    def as_map(name: str, key: str, prefix: str, number: str) -> DataFrame:
        entry = F.struct(key, F.concat(F.lit(prefix), number))
        return table(spark, sf, name).agg(F.map_from_entries(F.collect_list(entry)).alias("m"))

    nations = as_map("nation", "n_name", "r", "n_regionkey")
    regions = as_map("region", "r_name", "g", "r_regionkey")
    nations.select(F.col("m").alias("Types"), regions.scalar().alias("TypeGenders")).write.json(path)
    return readers.read_type_labels(spark, path)


@query("SELECT n_name AS ext_type, concat('d', n_nationkey) AS description, r_name AS category FROM nation JOIN region ON n_regionkey = r_regionkey")
def category_dimension(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "categories")
    named = table(spark, sf, "nation").join(
        table(spark, sf, "region").withColumnRenamed("r_regionkey", "n_regionkey"), "n_regionkey"
    )
    entry = F.struct("n_name", F.struct(F.concat(F.lit("d"), "n_nationkey").alias("description"), F.col("r_name").alias("category")))
    named.agg(F.map_from_entries(F.collect_list(entry)).alias("Extensions")).write.json(path)
    return readers.read_extension_categories(spark, path)


@query(f"""WITH {_ROWS} SELECT run_id, iter AS "Iter", {_NUM.format(c='train_loss')} AS "TrainLoss", {_NUM.format(c='val_loss')} AS "ValLoss",
  tok AS "TrainedTokens", stamp // 1000 AS stamp FROM rows""")
def stats_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """Statistics of two attempts appended to one CSV table and read back with their ``nan`` values."""
    path = scratch_path(spark, "stats")
    names = [part.split()[0] for part in schemas.TRAINING_STATS.split(", ")]
    rows = stats_rows(spark, sf)
    for attempt in (0, 1):
        writers.append_stats(rows.where(F.col("attempt") == attempt).select(*names, "run_id"), path)
    return readers.read_stats(spark, path).select(
        "run_id", "Iter", _number("TrainLoss").alias("TrainLoss"), _number("ValLoss").alias("ValLoss"), "TrainedTokens",
        F.unix_millis("Timestamp").alias("stamp"),
    )


@query("""SELECT concat('run', user_id % 9) AS run_id, CAST(event_id AS INT) AS step, value AS loss, event_id % 7 / 8.0 AS learning_rate,
  CASE WHEN event_id % 3 = 0 THEN event_id % 5 / 4.0 END AS eval_loss FROM events""")
def step_stats_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """The second layout: files with other columns and column orders, read by the names in their headers."""
    path = scratch_path(spark, "step_stats")
    steps = table(spark, sf, "events").select(
        F.concat(F.lit("run"), F.col("user_id") % 9).alias("run_id"), F.col("event_id").cast("int").alias("step"),
        F.col("value").alias("loss"), (F.col("event_id") % 7 / 8.0).alias("learning_rate"),
        (F.col("event_id") % 5 / 4.0).alias("eval_loss"), F.lit(None).cast("timestamp").alias("timestamp"),
    )
    layouts = (["step", "loss", "learning_rate", "timestamp"], ["eval_loss", "learning_rate", "step", "loss"])
    writers.append_stats(steps.where("step % 3 <> 0").select(*layouts[0], "run_id"), path)
    writers.append_stats(steps.where("step % 3 = 0").select(*layouts[1], "run_id"), path)
    return readers.read_stats(spark, path, schemas.STEP_STATS).select("run_id", "step", "loss", "learning_rate", "eval_loss")


@query(f"WITH {_LINES} SELECT CAST(row_number() OVER (ORDER BY line_no) - 1 AS BIGINT) AS place, value FROM lines")
def log_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """A log in several files, read back in its order by file and line."""
    path = scratch_path(spark, "log")
    lines = log_lines(spark, sf).select("line_no", "value")
    lines.repartitionByRange(5, "line_no").sortWithinPartitions("line_no").select("value").write.text(path)
    return with_global_index(readers.read_log(spark, path), ["file_name", "line"], "place").select("place", "value")


@query("SELECT event_type AS \"Type\", CAST(user_id % 3 AS VARCHAR) AS \"TypeGender\", count(*) AS meanings FROM events GROUP BY ALL")
def audit_roundtrip(spark: SparkSession, sf: str) -> DataFrame:
    """An audit written as CSV with its header and read back."""
    path = scratch_path(spark, "audit")
    found = table(spark, sf, "events").select(
        F.col("event_type").alias("Type"), (F.col("user_id") % 3).cast("string").alias("TypeGender")
    )
    writers.write_audit(audit.type_inventory(found), path)
    return readers.read_table(spark, path, "Type string, TypeGender string, meanings long", "csv", header="true")


@query("SELECT DISTINCT concat('run', user_id % 9) AS run_id, CAST(event_id // 40 AS BIGINT) AS iter FROM events")
def blacklist_append(spark: SparkSession, sf: str) -> DataFrame:
    """Two overlapping appends leave each iteration listed once."""
    path = scratch_path(spark, "blacklist")
    listed = table(spark, sf, "events").select(
        F.concat(F.lit("run"), F.col("user_id") % 9).alias("run_id"), F.expr("event_id div 40").alias("iter"), "event_type"
    )
    writers.append_blacklist(listed.where("event_type = 'error'"), path)
    writers.append_blacklist(listed, path)
    return readers.read_or_empty(spark, path, schemas.BLACKLIST)


@query("""SELECT concat('run', user_id % 9) AS run_id, max(event_id) AS iter, arg_max(substr(props, 1, 500), event_id) AS snippet,
  arg_max(event_id * 2, event_id) AS record_id FROM events WHERE event_type = 'error' GROUP BY 1""")
def diagnostics_latest(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "diagnostics")
    hits = table(spark, sf, "events").where("event_type = 'error'").select(
        F.concat(F.lit("run"), F.col("user_id") % 9).alias("run_id"), F.col("event_id").alias("iter"), "ts",
        (F.col("event_id") * 2).alias("record_id"), F.col("props").alias("text"),
    )
    for part in (0, 1):
        writers.append_rows(writers.diagnostic_rows(hits.where(F.col("iter") % 2 == part), "NaN limit hit", "rollback"), path)
    latest = readers.latest_diagnostic(readers.read_or_empty(spark, path, schemas.DIAGNOSTICS))
    return latest.select("run_id", "iter", "snippet", "record_id")


@query("""SELECT CAST(conv_id AS VARCHAR) AS timestamp, text AS prompt, role AS response, CASE WHEN turn % 2 = 1 THEN text END AS response_base
FROM conversations""")
def answers_append(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "answers")
    turns = table(spark, sf, "conversations")
    plain = turns.where("turn % 2 = 0").select(
        F.col("conv_id").cast("string").alias("timestamp"), F.col("text").alias("prompt"), F.col("role").alias("response")
    )
    both = turns.where("turn % 2 = 1").select(
        F.col("conv_id").cast("string").alias("timestamp"), F.col("text").alias("prompt"), F.col("role").alias("response"),
        F.col("text").alias("response_base"),
    )
    writers.append_answers(plain, path)
    writers.append_answers(both, path)
    return readers.read_records(spark, path, schemas.ANSWERS, "FAILFAST")


# ---------------------------------------------------------------------------------------------------
# Streams, run on what is available


@query(f"SELECT doc_id, {sql_normalize('text')} AS text FROM documents")
def stream_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """Two runs over a growing folder; the second reads only the files that came in between."""
    folder, out, check = (scratch_path(spark, name) for name in ("arriving", "processed", "progress"))
    docs = table(spark, sf, "documents").select("doc_id", "text")
    for part in (0, 1):
        writers.write_records(docs.where(F.col("doc_id") % 2 == part), folder, "append")
        chunks = jobs.record_stream(spark, folder, "doc_id long, text string", 1)
        jobs.run_available(chunks.select("doc_id", T.normalize(F.col("text")).alias("text")), out, check)
    return spark.read.schema("doc_id long, text string").parquet(out)


@query(f"""WITH {_PARSED} SELECT iter AS "Iter", mode, count(*) AS lines, max({_NUM.format(c='loss')}) AS loss, max(tok) AS tok
FROM parsed WHERE iter IS NOT NULL GROUP BY iter, mode""")
def stream_telemetry(spark: SparkSession, sf: str) -> DataFrame:
    folder, out, check = (scratch_path(spark, name) for name in ("log", "stats", "progress"))
    log_lines(spark, sf).select("value").repartition(3).write.text(folder)
    live = jobs.telemetry(jobs.line_stream(spark, folder, 1)).select("Iter", "mode", "loss", "TrainedTokens")
    jobs.run_available(live, out, check)
    rows = spark.read.schema("Iter int, mode string, loss double, TrainedTokens long").parquet(out)
    return rows.groupBy("Iter", F.lower("mode").alias("mode")).agg(
        F.count("*").alias("lines"), F.max(_number("loss")).alias("loss"), F.max("TrainedTokens").alias("tok")
    )


@query(f"""WITH {_NAN_RUNS} SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS ord, nan_run,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rollbacks FROM runs WHERE nan_run % 3 = 0""")
def stream_nan_alert(spark: SparkSession, sf: str) -> DataFrame:
    folder, out, check = (scratch_path(spark, name) for name in ("losses", "alerts", "progress"))
    losses = _losses(spark, sf).select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("ord"),
        (F.col("event_id") + 1).alias("iter"), F.col("loss").cast("string").alias("loss"),
    )
    for part in range(2):
        middle = table(spark, sf, "events").agg(F.max("event_id") / 2).scalar()
        half = losses.where((F.col("ord") <= middle) if part == 0 else (F.col("ord") > middle))
        writers.write_records(half, folder, "append")
        arriving = jobs.record_stream(spark, folder, "run_id string, ord long, iter long, loss string")
        jobs.run_nan_alerts(arriving.withColumn("loss", F.col("loss").cast("double")), CFG, out, check)
    return spark.read.schema(jobs.ALERTS).parquet(f"{out}/alerts").select("run_id", "ord", "nan_run", "rollbacks")


@query(f"""SELECT concept_key, lang, doc_id FROM (SELECT *, row_number() OVER (PARTITION BY concept_key ORDER BY part, doc_id DESC) AS place
  FROM (SELECT {sql_key('lang', 'text')} AS concept_key, lang, doc_id, coalesce(CAST(length(text) > 2000 AS INT), 0) AS part FROM documents))
WHERE place = 1""")
def stream_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """The first record of each concept: short texts arrive first, and in an arrival the largest doc_id leads."""
    folder, out, check = (scratch_path(spark, name) for name in ("records", "unique", "progress"))
    docs = table(spark, sf, "documents").select("doc_id", F.col("lang").alias("usr_prompt"), F.col("text").alias("target"))
    long = F.coalesce(F.length("target") > 2000, F.lit(False))
    for arriving in (~long, long):
        writers.write_records(docs.where(arriving), folder, "append")
        records = jobs.concept_stream(jobs.record_stream(spark, folder, "doc_id long, usr_prompt string, target string"))
        jobs.run_first_wins(records.withColumn("place", -F.col("doc_id")), ["place"], ["doc_id", "usr_prompt"], out, check)
    unique = spark.read.schema("concept_key string, doc_id long, usr_prompt string").parquet(out)
    return unique.select("concept_key", F.col("usr_prompt").alias("lang"), "doc_id")


@query(f"""WITH {_ROWS} SELECT run_id, CAST(attempt AS BIGINT) AS attempt, iter AS "Iter", {_NUM.format(c='train_loss')} AS "TrainLoss",
  {_NUM.format(c='val_loss')} AS "ValLoss", lr AS "LearningRate", tok AS "TrainedTokens", stamp FROM rows""")
def stream_stats(spark: SparkSession, sf: str) -> DataFrame:
    """Lines that arrive in two runs end as one row per run, attempt and iteration in the stats table."""
    folder, out, check = (scratch_path(spark, name) for name in ("log", "stats", "progress"))
    lines = log_lines(spark, sf).select("run_id", F.col("attempt").cast("long").alias("attempt"), "value", F.col("ts").cast("timestamp").alias("ts"), "line_no")
    for part in (0, 1):
        lines.where(F.col("line_no") % 3 % 2 == part).drop("line_no").write.mode("append").parquet(folder)
        arriving = spark.readStream.schema("run_id string, attempt long, value string, ts timestamp").parquet(folder)
        jobs.run_stats(arriving, out, check)
    return _compared_rows(jobs.stats_table(spark, out))


@query(f"""WITH {_NAN_RUNS} SELECT CAST(user_id AS VARCHAR) AS run_id, event_id AS ord, nan_run,
  row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS rollbacks FROM runs WHERE nan_run % 3 = 0""")
def stream_late_losses(spark: SparkSession, sf: str) -> DataFrame:
    """Valid losses arrive a batch after the missing ones, so every run's second batch holds earlier rows."""
    folder, out, check = (scratch_path(spark, name) for name in ("losses", "alerts", "progress"))
    losses = _losses(spark, sf).select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("ord"),
        (F.col("event_id") + 1).alias("iter"), F.col("loss").cast("string").alias("loss"),
    )
    reach = table(spark, sf, "events").agg(F.max("event_id") + 1).first()[0]
    for nan in (True, False):
        writers.write_records(losses.where(F.coalesce(F.isnan(F.col("loss").cast("double")), F.lit(False)) == nan), folder, "append")
        arriving = jobs.record_stream(spark, folder, "run_id string, ord long, iter long, loss string")
        jobs.run_nan_alerts(arriving.withColumn("loss", F.col("loss").cast("double")), CFG, out, check, lateness=reach)
    jobs.finish_nan_alerts(spark, CFG, out)
    return spark.read.schema(jobs.ALERTS).parquet(f"{out}/alerts").select("run_id", "ord", "nan_run", "rollbacks")


@query(f"""WITH {_NAN_RUNS}, hits AS (SELECT CAST(user_id AS VARCHAR) AS run_id, event_id + 1 AS iter, event_id * {K} AS record_id FROM runs WHERE nan_run % 3 = 0)
SELECT run_id, iter, record_id, md5(coalesce(text, 'Unknown')) AS text, 'rollback-skip' AS action, 1 AS listed
FROM hits LEFT JOIN documents ON doc_id = record_id""")
def stream_alert_actions(spark: SparkSession, sf: str) -> DataFrame:
    """Diagnostics and blacklist of a stream of alerts; its first batch runs twice and adds nothing."""
    losses_at, out, check, again = (scratch_path(spark, name) for name in ("losses", "alerts", "progress", "replayed"))
    losses = _losses(spark, sf).select(
        F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("ord"), (F.col("event_id") + 1).alias("iter"), "loss"
    )
    losses.write.parquet(losses_at)
    records = table(spark, sf, "documents").select(F.col("doc_id").alias("gidx"), "text")
    arriving = spark.readStream.schema("run_id string, ord long, iter long, loss double").parquet(losses_at)
    jobs.run_alerts(jobs.nan_alerts(arriving, CFG, "rollback-skip"), records, CFG, out, check, "rollback-skip")
    spark.read.parquet(f"{out}/diagnostics").where("batch = 0").select("run_id", "iter").write.parquet(again)
    jobs.write_alerts(spark.read.parquet(again), 0, records, CFG, out, "rollback-skip")
    listed = readers.read_or_empty(spark, f"{out}/blacklist", schemas.BLACKLIST).groupBy("run_id", "iter").agg(F.count("*").cast("int").alias("listed"))
    found = readers.read_or_empty(spark, f"{out}/diagnostics", schemas.DIAGNOSTICS)
    return found.join(listed, ["run_id", "iter"], "left").select(
        "run_id", "iter", "record_id", F.md5("text").alias("text"), "action", "listed"
    )
