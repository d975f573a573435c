"""Counterfactually regularised toxicity classifier.

Logistic regression on words and word beginnings. Beside the labelled texts the loss sees a counterfactual of each: its
identity terms swapped for others, or where it names none, one neutral mention put in. The squared change of the score is
penalised, so that naming a group neither makes a text toxic nor clean.

The features are chosen from counts over the labelled sample, on the executors; the model is fitted on the driver from at
most `sample_rows` labelled rows (half of them toxic where there are as many, taken by the hash of the id) and at most
`max_features` features. Scoring reads whole texts of all documents, without a shuffle.

Defined results: null and empty texts get the score of a text without features; rows are scored one by one; labels that
are null or 0/1 conflicts within an id: null ones are left out, of conflicting ones 1 counts; with no usable labels every
score is 0.0; an empty table gives an empty table; other columns stay, except that those named like an output give way.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from talweg.llm import _common as c

SAMPLE_ROWS, MAX_FEATURES, MIN_COUNT = 12_000, 6_000, 3
#: Standard errors by which a feature's rates in the two classes must differ.
MIN_Z = 3.0
THRESHOLD = 0.7
#: Weights of the counterfactual and of the squared coefficients in the loss.
COUNTERFACTUAL, RIDGE = 1.0, 1e-3
#: Neutral names of groups, in the corpus' languages.
IDENTITY_TERMS = tuple(
    "women men woman man girls boys muslims muslim christians christian jews jewish hindu buddhist atheist black white asian african latino"
    " arab european american indian gay lesbian bisexual transgender straight immigrants refugees foreigners elderly young disabled deaf blind"
    " frauen männer muslime christen juden schwule lesben ausländer flüchtlinge femmes hommes musulmans chrétiens juifs homosexuels immigrés"
    " réfugiés mujeres hombres musulmanes cristianos judíos inmigrantes refugiados".split()
)
_WORD = re.compile(r"[^\W\d_]+")
_PLACE = {t: i for i, t in enumerate(IDENTITY_TERMS)}


def word_features(word: str) -> list[str]:
    """The word, and its beginnings of 4 to 6 letters."""
    return ["=" + word, *("^" + word[:n] for n in (4, 5, 6) if len(word) > n)]


def text_words(text: str | None) -> set[str]:
    return set(_WORD.findall((text or "").lower()))


def features(words: set[str]) -> set[str]:
    return {f for w in words for f in word_features(w)}


def counterfactual(words: set[str], seed: int) -> set[str]:
    """The words with identity terms swapped for others; without any, with one added."""
    named = words & _PLACE.keys()
    n, shift = len(IDENTITY_TERMS), 1 + seed % (len(IDENTITY_TERMS) - 1)
    if not named:
        return words | {IDENTITY_TERMS[seed % n]}
    return (words - named) | {IDENTITY_TERMS[(_PLACE[w] + shift) % n] for w in named}


@dataclass(frozen=True)
class Model:
    weights: dict[str, float]
    bias: float

    def score(self, words: set[str]) -> float:
        z = self.bias + sum(self.weights.get(f, 0.0) for f in sorted(features(words)))
        return float(1 / (1 + np.exp(-min(max(z, -500.0), 500.0))))


def fit(rows: list[tuple[int, list[int], list[int], list[int]]], n: int, weight: float = 1.0, counterfactual_weight: float = COUNTERFACTUAL, steps: int = 400) -> tuple[np.ndarray, float]:
    """Coefficients of n features and the bias.

    rows: (label, features, features that the counterfactual adds, features that it takes away). weight: of label 0.
    """
    if not rows:
        return np.zeros(n), -500.0
    y = np.array([r[0] for r in rows], float)
    sample = np.where(y > 0, 1.0, weight)
    sample /= sample.sum()

    def sparse(k: int) -> tuple[np.ndarray, np.ndarray]:
        return np.repeat(np.arange(len(rows)), [len(r[k]) for r in rows]), np.array([i for r in rows for i in r[k]], dtype=np.int64)

    (at, of), (at_add, of_add), (at_less, of_less) = sparse(1), sparse(2), sparse(3)
    w, b, m, v = np.zeros(n), 0.0, np.zeros(n + 1), np.zeros(n + 1)
    for step in range(1, steps + 1):  # Adam on the whole sample
        z = b + np.bincount(at, w[of], len(y))
        off = (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y) * sample
        change = np.bincount(at_add, w[of_add], len(y)) - np.bincount(at_less, w[of_less], len(y))
        pull = 2 * counterfactual_weight * change / len(y)
        g = np.bincount(of, off[at], n) + np.bincount(of_add, pull[at_add], n) - np.bincount(of_less, pull[at_less], n) + 2 * RIDGE * w / n
        g = np.append(g, off.sum())
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        move = 0.1 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-8)
        w, b = w - move[:-1], b - move[-1]
    return w, b


def training_sample(docs: DataFrame, labels: DataFrame, trainable: Column, rows: int = SAMPLE_ROWS) -> tuple[DataFrame, float]:
    """(text, label, seed) of at most `rows` labelled documents, and how many rows of label 0 one such row stands for, against label 1."""
    known = labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(F.max("toxic").alias("label")).filter(trainable)
    totals = {r[0]: r[1] for r in known.groupBy("label").count().collect()}
    part = [known.filter(F.col("label") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows // 2) for k in (0, 1)]
    taken = F.broadcast(part[0].union(part[1]))  # at most `rows` rows
    # of rows that repeat an id, the smallest text
    sample = docs.select("doc_id", "text").join(taken, "doc_id").groupBy("doc_id", "label").agg(F.min("text").alias("text"))
    took = {k: max(1, min(totals.get(k, 0), rows // 2)) for k in (0, 1)}
    return c.cut(sample.select("text", "label", F.xxhash64("doc_id").alias("seed"))), (totals.get(0, 0) / took[0]) / max(1.0, totals.get(1, 0) / took[1])


def select_features(sample: DataFrame, limit: int = MAX_FEATURES) -> list[str]:
    """The features that point most to label 1: by their log ratio times the difference of their rates, ties by name.

    None that point to label 0: a long text has many of those, which would hide its one toxic line.
    """

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: dict[int, Counter] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"]):
                seen[int(label > 0)].update(features(text_words(text)))
        names = sorted(seen[0].keys() | seen[1].keys())
        yield pd.DataFrame({"feature": names, "n0": [seen[0][f] for f in names], "n1": [seen[1][f] for f in names]})

    all0, all1 = sample.agg(F.count_if(F.col("label") == 0), F.count_if(F.col("label") > 0)).first()
    if not all0 or not all1:
        return []
    counts = sample.mapInPandas(count, "feature string, n0 long, n1 long").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    rate = lambda k, n: (k + 0.5) / F.lit(n + 1.0)
    lift = F.log(rate(F.col("n1"), all1) / rate(F.col("n0"), all0))
    share = (F.col("n0") + F.col("n1")) / F.lit(float(all0 + all1))
    error = F.sqrt(share * (1 - share) * F.lit(1 / all0 + 1 / all1))
    differs = F.col("n1") / F.lit(float(all1)) - F.col("n0") / F.lit(float(all0)) >= MIN_Z * error
    gain = lift * (F.col("n1") / F.lit(float(all1)) - F.col("n0") / F.lit(float(all0)))
    best = counts.filter((F.col("n0") + F.col("n1") >= MIN_COUNT) & (lift > 0) & differs).select("feature", F.round(gain, 9).alias("gain")).orderBy(F.desc("gain"), "feature").limit(limit)
    return [r[0] for r in best.collect()]


def train(docs: DataFrame, labels: DataFrame, trainable: Column, sample_rows: int = SAMPLE_ROWS, max_features: int = MAX_FEATURES, counterfactual_weight: float = COUNTERFACTUAL) -> Model:
    sample, weight = training_sample(docs, labels, trainable, sample_rows)
    names = select_features(sample, max_features)
    place = {f: i for i, f in enumerate(names)}

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, label, seed in zip(batch["text"], batch["label"], batch["seed"]):
                words = text_words(text)
                own, other = features(words), features(counterfactual(words, seed % (1 << 31)))
                at = lambda fs: sorted(place[f] for f in fs if f in place)
                out.append((int(seed), int(label > 0), at(own), at(other - own), at(own - other)))
            yield pd.DataFrame(out, columns=["seed", "label", "own", "more", "less"])

    rows = sample.mapInPandas(encode, "seed long, label int, own array<int>, more array<int>, less array<int>").collect() if names else []
    rows.sort()
    w, b = fit([tuple(r[1:]) for r in rows], len(names), weight, counterfactual_weight)
    return Model({f: float(x) for f, x in zip(names, w) if x}, float(b))


def score(df: DataFrame, model: Model, text: str = "text", out: str = "score") -> DataFrame:
    """df with the probability that the text is toxic."""
    shared = df.sparkSession.sparkContext.broadcast((model.weights, model.bias))  # bounded by max_features

    @F.pandas_udf("double")
    def scored(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        weights, bias = shared.value
        # most words have no weight: the memory of words is emptied when full
        memory: dict[str, tuple[str, ...]] = {}
        for batch in batches:
            result = np.empty(len(batch))
            for i, t in enumerate(batch):
                found: set[str] = set()
                for w in text_words(t):
                    known = memory.get(w)
                    if known is None:
                        if len(memory) >= 100_000:
                            memory.clear()
                        known = memory[w] = tuple(f for f in word_features(w) if f in weights)
                    if known:
                        found.update(known)
                z = bias + sum(weights[f] for f in sorted(found))
                result[i] = 1 / (1 + np.exp(-min(max(z, -500.0), 500.0)))
            yield pd.Series(result)

    return df.drop(out).withColumn(out, scored(F.col(text)))


def fold(doc_id: int) -> int:
    return zlib.crc32(str(doc_id).encode()) % 3


def fold_column(id_col: str = "doc_id") -> Column:
    return F.crc32(F.encode(F.col(id_col).cast("string"), "UTF-8")) % 3


def trained(spark: SparkSession, docs: DataFrame, sf_dir: str) -> Model:
    return train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), fold_column() != 1)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = c.documents(spark, sf_dir).select("doc_id", "text")
    scored = score(docs, trained(spark, docs, sf_dir))
    return scored.select("doc_id", F.coalesce(fold_column() == 1, F.lit(False)).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    # trained on the documents of the folder, as its labels are; the verdict is for the stage's own input
    model = trained(spark, c.documents(spark, sf_dir), sf_dir)
    return score(docs, model, out="__score").filter(F.col("__score") < THRESHOLD).select(docs.columns)
