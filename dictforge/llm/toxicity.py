"""Toxicity classifier, regularised by counterfactuals: swapping identity terms shall not move the score."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F

from dictforge.llm import batches
from dictforge.session import stage

# Terms that name groups of people; within a group any may stand for any other. A parameter of ``fit``.
IDENTITY_GROUPS: Mapping[str, Sequence[str]] = {
    "gender": ("women", "men", "girls", "boys"),
    "orientation": ("gay", "lesbian", "bisexual", "straight", "transgender"),
    "religion": ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    "origin": ("africans", "asians", "europeans", "americans", "immigrants"),
    "colour": ("black", "white", "brown"),
    "age": ("old", "young", "elderly"),
    "femmes": ("femmes", "hommes"), "frauen": ("frauen", "männer"), "mujeres": ("mujeres", "hombres"),
}
# Rows that the classifier is fitted on at most, chosen by the hash of their doc_id.
SAMPLE_ROWS = 20_000
# Words it weighs at most, the strongest by log-likelihood ratio; identity terms come first.
MAX_FEATURES = 400
# A feature occurs in so many of the sampled rows at least, and in this share of them.
MIN_ROWS_OF_WORD = 4
MIN_SHARE_OF_ROWS = 0.003
MIN_RATIO = 12.0
THRESHOLD = 0.7

# Lengths of the word beginnings that are features too, and the share of words at which one counts as dense.
STEM_CHARS = (5, 7)
DENSE_SHARE = 0.005

_WORD = re.compile(r"[^\W\d_]+")


def words_of(text: str | None) -> set[str]:
    """The different words of a text; how often one occurs does not matter."""
    return set(_WORD.findall((text or "").lower()))


def features_of(words: set[str]) -> set[str]:
    """A text's features: its words, the beginnings of its words, and those that many of its words share."""
    found = set(words)
    for n in STEM_CHARS:
        stems = Counter(w[:n] for w in words if len(w) > n)
        found.update(f"{stem}~" for stem in stems)
        dense = max(2, DENSE_SHARE * len(words))
        found.update(f"{stem}~~" for stem, times in stems.items() if times >= dense)
    return found


@dataclass
class Model:
    bias: float
    weights: dict[str, float]
    threshold: float = THRESHOLD

    def score(self, text: str | None) -> float:
        logit = self.bias + sum(self.weights[w] for w in sorted(self.weights.keys() & features_of(words_of(text))))
        return float(1 / (1 + np.exp(-np.clip(logit, -700, 700))))


def swapped(words: set[str], groups: Mapping[str, Sequence[str]], shift: int) -> set[str]:
    """``words`` with each identity term replaced by the one ``shift`` places on in its group."""
    out = set(words)
    for terms in groups.values():
        found = [t for t in terms if t in words]
        if found and shift < len(terms):
            out.difference_update(found)
            out.update(terms[(terms.index(t) + shift) % len(terms)] for t in found)
    return out


def _newton(
    x: np.ndarray, y: np.ndarray, d: np.ndarray, penalty: float, ridge: float, centre: np.ndarray
) -> np.ndarray:
    """Weights (the last is the bias) that minimise log loss + pull to ``centre`` + ``penalty`` * mean((d @ w)**2) / 2."""
    n, f = x.shape
    pull = np.append(np.full(f - 1, ridge), 1e-9)
    swaps = penalty * (d.T @ d) / len(d) if len(d) else np.zeros((f, f))
    w = np.zeros(f)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) / n + pull * (w - centre) + swaps @ w
        hessian = (x * (p * (1 - p) + 1e-9)[:, None]).T @ x / n + np.diag(pull) + swaps
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        w -= step * min(1.0, 2.0 / max(size, 1e-12))
        if size < 1e-6:
            break
    return w


def fit(
    docs: DataFrame,
    labels: DataFrame,
    groups: Mapping[str, Sequence[str]] = IDENTITY_GROUPS,
    penalty: float = 10.0,
    ridge: float = 1e-5,
    sample_rows: int = SAMPLE_ROWS,
    max_features: int = MAX_FEATURES,
    swaps: int = 3,
) -> Model:
    """Fit on ``docs`` (doc_id, text) with ``labels`` (doc_id, toxic); pass the rows to learn from only.

    At most ``sample_rows`` labelled doc_ids are used, those with the smallest hash; their ids are
    broadcast, so no text is shuffled. Each sampled row that names a group is also taken with its terms
    swapped, and the squared change of its logit is added to the loss, times ``penalty``. The ridge pulls
    a weight to the log-odds of its feature alone (of what identity terms give: to 0), so one strong
    word is evidence even if the words it was learnt from came several to a text. Of several
    labels of one doc_id the largest counts; null labels, ids and texts (empty) are no error. Without
    rows, or without both labels, the model scores every text alike.
    """
    known = labels.where("doc_id is not null and toxic is not null")
    known = known.groupBy("doc_id").agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows).toPandas()
    spark = docs.sparkSession
    sample = spark.createDataFrame(chosen.astype("int64"), "doc_id long, toxic long") if len(chosen) else (
        spark.createDataFrame([], "doc_id long, toxic long")
    )
    terms = {t for g in groups.values() for t in g}

    @F.pandas_udf("array<string>")
    def words(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(lambda t: sorted(words_of(t)))

    narrow = batches.with_batches(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    rows = stage(
        narrow.join(F.broadcast(sample), "doc_id").select("toxic", words("text").alias("words")), "toxicity_sample"
    )
    size = rows.agg(F.count("*").alias("n"), F.coalesce(F.sum("toxic"), F.lit(0)).alias("p")).first()
    n, positives = size["n"], size["p"]
    if not n:
        return Model(0.0, {})
    base = float(np.log((positives + 0.5) / (n - positives + 0.5)))

    @F.pandas_udf("array<string>")
    def features(lists: pd.Series) -> pd.Series:
        return lists.map(lambda items: sorted(features_of(set(items))))

    counts = rows.select("toxic", F.explode(features("words")).alias("word")).groupBy("word").agg(
        F.count("*").alias("rows"), F.sum("toxic").alias("toxic")
    )
    a, b, rate = F.col("toxic"), F.col("rows") - F.col("toxic"), F.lit(positives / n)

    def part(count: Column, share: Column) -> Column:
        return F.when(count > 0, count * F.log(count / (F.col("rows") * share))).otherwise(0.0)

    ratio = 2 * (part(a, rate) + part(b, 1 - rate))
    is_term = F.col("word").isin(sorted(terms))
    least = max(MIN_ROWS_OF_WORD, MIN_SHARE_OF_ROWS * n)
    strong = counts.where((F.col("rows") >= least) & ((ratio >= MIN_RATIO) | is_term))
    order = [F.desc(is_term.cast("int")), F.desc(ratio), F.asc("word")]
    chosen = strong.orderBy(*order).limit(max_features).collect() if 0 < positives < n else []
    strongest = [row["word"] for row in chosen]
    if not strongest:
        return Model(base, {})
    place = {word: i for i, word in enumerate(strongest)}

    def indexed(own: set[str]) -> list[int]:
        return [place[f] for f in features_of(own) if f in place]

    @F.pandas_udf("array<array<int>>")
    def seen(lists: pd.Series) -> pd.Series:
        """The features of a row, then those of its counterfactuals."""
        found = []
        for items in lists:
            own = set(items)
            others = [swapped(own, groups, k + 1) for k in range(swaps)] if own & terms else []
            found.append([indexed(own), *[indexed(o) for o in others if o != own]])
        return pd.Series(found)

    table = rows.select("toxic", seen("words").alias("seen")).toPandas()
    # At most sample_rows * max_features bytes.
    x = np.zeros((len(table), len(strongest) + 1), np.float32)
    differences = []
    for i, lists in enumerate(table["seen"]):
        x[i, lists[0]] = 1
        for other in lists[1:]:
            changed = np.zeros(len(strongest) + 1)
            changed[lists[0]] += 1
            changed[other] -= 1
            if changed.any():
                differences.append(changed)
    x[:, -1] = 1
    # Differences depend on the terms only, so few are distinct: weigh them by their number.
    d = np.empty((0, len(strongest) + 1))
    if differences:
        distinct, times = np.unique(np.array(differences, np.int8), axis=0, return_counts=True)
        d = distinct * np.sqrt(times / times.mean())[:, None]
    neutral = set().union(*[features_of({t}) for t in terms]) if terms else set()

    def odds(row: Row) -> float:
        seen, toxic = row["rows"], row["toxic"]
        return float(np.log((toxic + 0.5) / (positives + 1)) - np.log((seen - toxic + 0.5) / (n - positives + 1)))

    centre = np.array([0.0 if row["word"] in neutral else odds(row) for row in chosen] + [0.0])
    w = _newton(x, table["toxic"].to_numpy(np.float32), d, penalty, ridge, centre)
    return Model(float(w[-1]), dict(zip(strongest, map(float, w[:-1]), strict=True)))


def score(model: Model, text: Column) -> Column:
    """The score of each whole text, 0 to 1. Null and empty texts get the score of no evidence."""

    @F.pandas_udf("double")
    def scored(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for part in texts:
            yield part.map(model.score, na_action=None).astype("float64")

    return scored(text.cast("string"))


def held_out(doc_id: Column) -> Column:
    """Whether a document is kept from learning: crc32 of its id as text leaves 1 modulo 3; null: no."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def fit_tables(docs: DataFrame, labels: DataFrame, **settings: object) -> Model:
    """``fit`` on the rows that are not held out."""
    return fit(docs, labels.where(~held_out(F.col("doc_id"))), **settings)


def classify(docs: DataFrame, model: Model) -> DataFrame:
    """``doc_id, held_out, score, predicted`` per row; repeated rows stay repeated, no rows give none."""
    batches.small_batches(docs.sparkSession)
    scored = docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), score(model, F.col("text")).alias("score"))
    return scored.withColumn("predicted", (F.col("score") >= model.threshold).cast("int"))


def accepted(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs`` that are not predicted toxic, with all their columns."""
    batches.small_batches(docs.sparkSession)
    # The row travels as one column, so its names meet no others.
    scored = docs.select(F.struct("*").alias("_row"), score(model, F.col("text")).alias("_score"))
    return scored.where(F.col("_score") < model.threshold).select("_row.*")
