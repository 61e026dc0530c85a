"""The corpus queries over the given tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dictforge.llm import alignment, bpe, chat, edit_counts, lm_scoring, mixing, neighbours, parsing, simhash, spelling, substring_dedup, toxicity, wavelet
from dictforge.llm.registry import ORACLES, QUERIES, query, table  # noqa: F401
from dictforge.session import scratch_path


@query()
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


RANKS, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


@query()
def op5_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = bpe.encode(table(spark, sf_dir, "documents"), RANKS, PATTERN)
    counted = encoded.select(
        "doc_id", F.octet_length("ids").cast("long").alias("size"), F.sha2("ids", 256).alias("ids_sha256"), "ids"
    )
    return bpe.decode(counted, RANKS, PATTERN).select(
        "doc_id", (F.col("size") / 4).cast("long").alias("n_tokens"), "ids_sha256",
        F.sha2("bytes", 256).alias("decoded_sha256"),
    )


@query()
def op10_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = scratch_path(spark, "token_shards")
    files = wavelet.write_shards(
        table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"), target, end_id=1
    )
    read = wavelet.read_shards(spark, target)
    digests = read.select(
        "file", "doc_id", "local_start", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.crc32("ids").alias("ids_crc32"),
    )
    return digests.join(files.select("file", "start"), "file").select(
        "doc_id", (F.col("start") + F.col("local_start")).alias("start"), "n_tokens", "ids_crc32"
    )


# The counterpart orders every source by place and cuts once, with no histogram.
OP6_SQL = r"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
    ('0x' || substr(md5(concat_ws('|', coalesce(doc_id::VARCHAR, ''), md5(coalesce(text, '')))), 1, 12))::BIGINT AS place
  FROM documents),
sources AS (
  SELECT source, s, [5, 2, 1][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM (SELECT source, sum(size)::BIGINT AS s FROM rows GROUP BY source)),
sorted AS (
  SELECT *, coalesce(sum(2.0 * s) OVER before, 0) AS capped, sum(w) OVER (ORDER BY 2.0 * s / w, source
      ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open, (SELECT 1.5 * sum(s) FROM sources) AS total
  FROM sources WINDOW before AS (ORDER BY 2.0 * s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
level AS (SELECT max((total - capped)::DOUBLE / open::DOUBLE) AS v FROM sorted
  WHERE capped + open * 2.0 * s / w >= total),
goals AS (
  SELECT source, s, least((SELECT v FROM level) * w, 2.0 * s)::DOUBLE AS target FROM sources),
left_over AS (
  SELECT *, CASE WHEN s > 0 THEN floor(target / s) ELSE 0 END AS rounds FROM goals),
cut AS (
  SELECT r.*, g.s, g.target, g.rounds, g.target - g.rounds * g.s AS rest,
    sum(size) OVER (PARTITION BY r.source ORDER BY place RANGE UNBOUNDED PRECEDING) AS upto
  FROM rows r JOIN left_over g ON r.source IS NOT DISTINCT FROM g.source),
edge AS (
  SELECT source, coalesce(max(upto) FILTER (upto <= rest), 0) AS used, min(upto) FILTER (upto > rest) AS over
  FROM cut GROUP BY source)
SELECT doc_id, size, s AS source_size, target, (size * (rounds + CASE WHEN upto <= rest
    OR (upto = over AND over - rest < rest - used) THEN 1 ELSE 0 END))::BIGINT AS taken
FROM cut JOIN edge ON cut.source IS NOT DISTINCT FROM edge.source
"""


@query(OP6_SQL)
def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


@query()
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.classify(docs, toxicity.fit_tables(docs, table(spark, sf_dir, "labels")))


@query()
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleaned = substring_dedup.remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cleaned.select("doc_id", "text", F.col("_removed").alias("removed"))


@query()
def op8_parsing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parsing.compare_edits(table(spark, sf_dir, "documents"))


OP7_SQL = """
WITH v AS (
  SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
p AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_inner_product(q.e, c.e) AS score
  FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM p)
WHERE rank <= 20
"""


@query(OP7_SQL)
def op7_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query()
def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string")
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    return chat.digests(chat.format_windows(rows, RANKS, PATTERN))


@query()
def op4_edit_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document gets a title, a new passage in its middle and a changed end."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    n = F.length(F.coalesce("text", F.lit("")))

    def change(seq: int, place: F.Column, removed: int, inserted: F.Column) -> F.Column:
        return F.struct(
            F.lit(seq).alias("seq"), place.cast("long").alias("place"), F.lit(removed).alias("removed"),
            inserted.alias("inserted"),
        )

    changes = F.array(
        change(0, F.floor(n / 2), 40, F.concat_ws(" ", F.lit("see also:"), "source", "lang")),
        change(1, F.lit(0), 0, F.concat(F.lit("No. "), F.col("doc_id").cast("string"), F.lit("\n"))),
        change(2, n - 25, 30, F.lit("and so we'll end.")),
    )
    edits = docs.select("doc_id", F.inline(changes))
    return edit_counts.count_edits(docs, edits, RANKS, PATTERN)


@query()
def op12_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_texts(table(spark, sf_dir, "documents"), RANKS, PATTERN)


@query()
def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    paths = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
    return alignment.weigh_links(table(spark, sf_dir, "documents"), *paths, RANKS, PATTERN)


# The counterpart takes near words from the words without one code point, and the crc32 bit by bit.
OP13_SQL = r"""
WITH RECURSIVE
t AS (
  SELECT list(list_reduce([i::BIGINT, 0, 0, 0, 0, 0, 0, 0, 0], lambda a, b:
    CASE WHEN a & 1 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) ORDER BY i) AS t FROM range(256) r(i)),
runs AS (
  SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[A-Za-z\x{C0}-\x{FF}]+')) AS run FROM documents),
long_runs AS (
  SELECT run, count(*) AS times, hex(encode(coalesce(doc_id::VARCHAR, '') || ':' || run)) AS bytes
  FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
  SELECT run, times, xor(4294967295, list_reduce([4294967295] || list_transform(range(length(bytes) // 2), lambda k:
      ('0x' || substr(bytes, 2 * k + 1, 2))::BIGINT), lambda a, b: xor(a >> 8, t[(xor(a, b) & 255) + 1]))) AS h
  FROM long_runs, t),
found AS (
  SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word,
    times FROM hashed),
w AS (SELECT word, sum(times)::BIGINT AS n FROM found WHERE length(word) >= 6 GROUP BY word HAVING sum(times) >= 5),
d AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (
  SELECT word, n, unnest(range(length(word))) AS i FROM w)),
near AS (
  SELECT DISTINCT a.word, b.word AS other, b.n AS other_n FROM d a JOIN d b USING (i, rest) WHERE a.word <> b.word
  UNION SELECT DISTINCT d.word, w.word, w.n FROM d JOIN w ON d.rest = w.word
  UNION SELECT DISTINCT w.word, d.word, d.n FROM d JOIN w ON d.rest = w.word),
best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, other) AS form, max(other_n) AS form_n
  FROM near GROUP BY word),
formed AS (
  SELECT w.word, n, coalesce(n_near, 0) AS n_near, CASE WHEN b.form_n >= 5 * n THEN b.form END AS form,
    CASE WHEN b.form_n >= 5 * n THEN b.form_n END AS form_n
  FROM w LEFT JOIN best b USING (word)),
chain AS (
  SELECT word, word AS at FROM formed
  UNION ALL SELECT c.word, f.form FROM chain c JOIN formed f ON c.at = f.word WHERE f.form IS NOT NULL)
SELECT f.word, f.n, f.n_near, f.form, f.form_n, c.at AS root
FROM formed f JOIN chain c USING (word) JOIN formed l ON l.word = c.at WHERE l.form IS NULL
"""


@query(OP13_SQL)
def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(table(spark, sf_dir, "documents"))
