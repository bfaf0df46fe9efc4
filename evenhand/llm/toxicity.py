"""Toxicity as an ordinal severity: a cumulative-link model of sparse text features.

The chance of a grade of k at most is the logistic function of threshold k less the text's
score; the score's weights are the same for all thresholds. Features are counts of words and
of word beginnings, as inflected and compound forms share those. Where labels only say toxic
or not, grades come from the amount of evidence: toxic training texts are split evenly by
how many of their words mark toxic texts.
"""

from __future__ import annotations

import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from evenhand.llm.common import labelled_sample, small_batches

SCORED = "severity double, grade int, toxic_chance double"
_word = re.compile(r"[^\W\d_]+")


@dataclass
class Settings:
    """sample: labelled texts of each label to fit on, at most; vocabulary: features kept; the rest is for the fit."""

    sample: int = 4000
    vocabulary: int = 1024
    beginnings: tuple[int, ...] = (4, 5)
    grades: int = 4
    steps: int = 500
    rate: float = 0.1
    decay: float = 3e-5
    least: float = 18.0  # log-likelihood that toxic texts have a feature more often; chance gives a rare word less


@dataclass
class Model:
    vocabulary: dict[str, int]
    weights: np.ndarray
    thresholds: np.ndarray
    beginnings: tuple[int, ...]

    def grades(self, score: np.ndarray) -> np.ndarray:
        """Probability of each grade for each score."""
        at_most = 1 / (1 + np.exp(-np.clip(self.thresholds[None] - score[:, None], -500, 500)))
        return np.diff(np.hstack([np.zeros((len(score), 1)), at_most, np.ones((len(score), 1))]))


def counted(text: str | None, beginnings: tuple[int, ...]) -> Counter[str]:
    """Occurrences of words and word beginnings (marked by a hyphen) of the whole text in lower case."""
    words = Counter(_word.findall(text.lower())) if text else Counter()
    out = Counter(words)
    for word, n in words.items():
        for k in beginnings:
            if len(word) > k:
                out[word[:k] + "-"] += n
    return out


def _occurring(beginnings: tuple[int, ...]):
    def occurring(batches):
        counts: dict[int, Counter[str]] = {0: Counter(), 1: Counter()}
        for batch in batches:
            for text, label in zip(batch["text"], batch["label"], strict=True):
                counts[int(label)].update(counted(text, beginnings).keys())
        for label, found in counts.items():
            pairs = list(found.items())
            for k in range(0, len(pairs), 20_000):
                yield pd.DataFrame(pairs[k : k + 20_000], columns=["feature", "n"]).assign(label=label)[["feature", "label", "n"]]

    return occurring


def fit_arrays(x: np.ndarray, y: np.ndarray, settings: Settings | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Weights and rising thresholds of the cumulative-link model with the greatest penalised likelihood."""
    s = settings or Settings()
    k, size = s.grades - 1, x.shape[1]
    onehot = np.eye(s.grades)[y]
    share = np.clip(onehot.mean(0).cumsum()[:-1], 1e-3, 1 - 1e-3)
    start = np.log(share / (1 - share))
    # the first threshold and the logarithms of the gaps keep the others in order
    free = np.concatenate([np.zeros(size), start[:1], np.log(np.maximum(np.diff(start), 0.1))])
    m, v = np.zeros_like(free), np.zeros_like(free)
    for t in range(1, s.steps + 1):
        w, gaps = free[:size], np.exp(free[size + 1 :])
        theta = np.concatenate([free[size : size + 1], free[size] + np.cumsum(gaps)])
        at_most = 1 / (1 + np.exp(-np.clip(theta[None] - (x @ w)[:, None], -30, 30)))
        padded = np.hstack([np.zeros((len(x), 1)), at_most, np.ones((len(x), 1))])
        chance = np.maximum((np.diff(padded) * onehot).sum(1), 1e-9)
        slope = at_most * (1 - at_most)
        up = onehot[:, :k] * slope / chance[:, None]
        down = onehot[:, 1:] * slope / chance[:, None]
        by_theta = -(up - down).mean(0)
        by_score = (up - down).sum(1) / len(x)
        g = np.concatenate([x.T @ by_score + s.decay * w, [by_theta.sum()], by_theta[::-1].cumsum()[::-1][1:] * gaps])
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        free = free - s.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return free[:size], np.concatenate([free[size : size + 1], free[size] + np.cumsum(np.exp(free[size + 1 :]))])


def fit(df: DataFrame, labels: DataFrame, label: str = "toxic", key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> Model | None:
    """The model of labelled texts (label 0 or 1; others and nulls don't teach); None if a label has none.

    At most settings.sample texts of each label are drawn. Their features are counted where
    they are; the vocabulary's counts and the sample's few vocabulary words go to the driver.
    """
    s = settings or Settings()
    rows = small_batches(df).select(F.col(key).alias("doc_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    marks = labels.select(F.col(key).alias("doc_id"), F.col(label).cast("int").alias("label")).filter("label IN (0, 1)")
    sample = labelled_sample(rows, marks, "label", s.sample)
    sizes = {r["label"]: r["count"] for r in sample.groupBy("label").count().collect()}
    if len(sizes) < 2:
        return None
    counts = sample.mapInPandas(_occurring(s.beginnings), "feature string, label int, n long")
    counts = counts.groupBy("feature").agg(F.sum(F.when(F.col("label") == 1, F.col("n")).otherwise(0)).alias("toxic"), F.sum(F.when(F.col("label") == 0, F.col("n")).otherwise(0)).alias("clean"))
    share = sizes[1] / (sizes[0] + sizes[1])
    n = F.col("toxic") + F.col("clean")
    part = lambda seen, due: F.when(seen > 0, seen * F.log(seen / due)).otherwise(0.0)
    gain = part(F.col("toxic"), n * share) + part(F.col("clean"), n * (1 - share))
    best = counts.withColumn("gain", gain).filter((F.col("toxic") > n * share) & (F.col("gain") >= s.least))
    best = best.orderBy(F.desc("gain"), "feature").limit(s.vocabulary).collect()
    vocabulary = {r["feature"]: k for k, r in enumerate(best)}
    if not vocabulary:
        return None
    beginnings = s.beginnings

    def vectors(texts: pd.Series) -> pd.Series:
        return pd.Series([{vocabulary[f]: float(n) for f, n in counted(t, beginnings).items() if f in vocabulary} for t in texts])

    drawn = sample.select("label", F.pandas_udf(vectors, "map<int,double>")("text").alias("counts")).collect()
    x, y = np.zeros((len(drawn), len(vocabulary))), np.array([r["label"] for r in drawn])
    for k, r in enumerate(drawn):
        for f, n in r["counts"].items():
            x[k, f] = n
    whole = np.array([not f.endswith("-") for f in vocabulary])  # words, not their beginnings
    amount = np.where(y > 0, x[:, whole].sum(1), 0) if whole.any() else x.sum(1)
    cuts = np.quantile(amount[y > 0], np.arange(1, s.grades - 1) / (s.grades - 1))
    y = np.where(y > 0, 1 + np.searchsorted(cuts, amount, "left"), 0)
    weights, thresholds = fit_arrays(np.log1p(x), y, s)
    return Model(vocabulary, weights, thresholds, s.beginnings)


def scored(text: Column, model: Model | None) -> Column:
    """Struct of severity (expected grade), grade (the likeliest) and toxic_chance (of a grade above 0)."""
    if model is None:
        return F.struct(F.lit(0.0).alias("severity"), F.lit(0).alias("grade"), F.lit(0.0).alias("toxic_chance"))

    def score(texts: pd.Series) -> pd.DataFrame:
        values = np.zeros(len(texts))
        for k, t in enumerate(texts):
            found = [(model.vocabulary[f], n) for f, n in counted(t, model.beginnings).items() if f in model.vocabulary]
            if found:
                values[k] = sum(model.weights[f] * np.log1p(n) for f, n in found)
        chances = model.grades(values)
        return pd.DataFrame({"severity": chances @ np.arange(chances.shape[1]), "grade": chances.argmax(1).astype(np.int32), "toxic_chance": 1 - chances[:, 0]})

    return F.pandas_udf(score, SCORED)(text)


def grade(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, severity, grade, toxic_chance and toxic (chance of 0.5 at least) of each row, over whole texts.

    Null and empty texts have no features and get the model's answer to that. Repeated rows
    each get a result, an empty table an empty one; without a model (no label to learn from)
    all severities are 0; other columns take no part.
    """
    rows = small_batches(df).select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.select(F.col("key").alias(key), scored(F.col("text"), model).alias("x")).select(key, "x.*")
    return found.withColumn("toxic", F.col("toxic_chance") >= 0.5)
