"""Quality by positive-unlabelled learning.

A linear model over counts of a text's characters, words and lines, fitted by minimising the
non-negative unbiased risk: trusted positives, unlabelled web text and a class prior, with
logistic loss. The prior is estimated from how a classifier of positives against unlabelled
texts ranks both: among the texts above a threshold, the least ratio of the unlabelled share
to the positive share bounds the share of positives from above.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass
from operator import eq

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from evenhand.llm.common import SHARES, labelled_sample, share, small_batches

_UPPER, _LOWER, _DIGIT = slice(65, 91), slice(97, 123), slice(48, 58)
_PLAIN = np.zeros(256, bool)
_PLAIN[[9, 10, 13, 32, 44, 46]] = True  # white space, comma, full stop
for _s in (_UPPER, _LOWER, _DIGIT, slice(128, 256)):
    _PLAIN[_s] = True
N_FEATURES = 13


@dataclass
class Settings:
    """sample: positives and unlabelled texts to fit on, at most so many each; the rest is for the fit."""

    sample: int = 10_000
    steps: int = 600
    rate: float = 0.05
    decay: float = 6.0  # of the squared weights, divided by the number of texts
    clip: float = 6.0
    least: float = 0.02  # share of positives above a threshold from which a ratio counts for the prior


@dataclass
class Model:
    center: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    prior: float
    clip: float

    def score(self, features: np.ndarray) -> np.ndarray:
        z = np.clip((features - self.center) / self.scale, -self.clip, self.clip)
        return 1 / (1 + np.exp(-np.clip(expanded(z) @ self.weights + self.bias, -500, 500)))


def features(text: str | None) -> list[float]:
    """Shares and sizes that tell prose from junk; of the whole text, all 0 for an empty one."""
    if not text:
        return [0.0] * N_FEATURES
    data = np.frombuffer(text.encode(), np.uint8)
    counts = np.bincount(data, minlength=256)
    n = len(data)
    letters = int(counts[_LOWER].sum() + counts[_UPPER].sum())
    words = text.split()
    n_words = max(1, len(words))
    kinds = Counter(words)
    lines = [x for x in text.split("\n") if x]
    symbols = int(counts[~_PLAIN].sum())
    return [
        np.log1p(n),
        counts[_UPPER].sum() / max(1, letters),
        counts[_DIGIT].sum() / n,
        symbols / n,
        symbols / n_words,
        (counts[44] + counts[46]) / n_words,
        sum(map(eq, words, words[1:])) / n_words,
        np.log(n_words / max(1, len(kinds))) - 0.35 * np.log(n_words),
        max(kinds.values(), default=0) / n_words if len(words) >= 8 else 0.0,
        np.log1p(n / n_words),
        1 - len(set(lines)) / max(1, len(lines)),
        counts[128:].sum() / n,
        counts[10] / n_words,
    ]


def expanded(z: np.ndarray) -> np.ndarray:
    """Each feature and how far it lies from the middle, either way."""
    return np.hstack([z, np.maximum(z - 1, 0), np.maximum(-z - 1, 0)])


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def _descend(gradient, size: int, settings: Settings) -> np.ndarray:
    """Adam from 0; gradient gives that of the risk at the parameters."""
    w, m, v = np.zeros(size), np.zeros(size), np.zeros(size)
    for t in range(1, settings.steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= settings.rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-8)
    return w


def estimated_prior(positive: np.ndarray, unlabelled: np.ndarray, settings: Settings | None = None) -> float:
    """Share of positives among the unlabelled, from scores of both that rank positives high."""
    s = settings or Settings()
    cuts = np.quantile(positive, np.linspace(0, 1 - s.least, 400))
    above = lambda x: 1 - np.searchsorted(np.sort(x), cuts, "left") / len(x)
    p, u = above(positive), above(unlabelled)
    slack = np.sqrt(np.log(400) / 2) * (1 / np.sqrt(len(positive)) + 1 / np.sqrt(len(unlabelled)))
    best = int(np.argmin((u + slack) / p))  # the slack keeps small shares from deciding by chance
    return float(np.clip(u[best] / p[best], 0.01, 0.99))


def fit_arrays(positive: np.ndarray, unlabelled: np.ndarray, settings: Settings | None = None) -> Model:
    """The model from features of trusted positives and of unlabelled texts."""
    s = settings or Settings()
    center = np.median(positive, 0)
    scale = np.maximum((np.quantile(positive, 0.9, axis=0) - np.quantile(positive, 0.1, axis=0)) / 2.56, 1e-2)
    of = lambda x: np.hstack([expanded(np.clip((x - center) / scale, -s.clip, s.clip)), np.ones((len(x), 1))])
    p, u = of(positive), of(unlabelled)
    decay = s.decay / min(len(p), len(u))

    def prior_from(pa: np.ndarray, ua: np.ndarray, pb: np.ndarray, ub: np.ndarray) -> float:
        """By a classifier of one half of the texts that ranks the other."""
        w = _descend(lambda w: -pa.T @ _sigmoid(-pa @ w) / len(pa) + ua.T @ _sigmoid(ua @ w) / len(ua) + decay * w, pa.shape[1], s)
        return estimated_prior(pb @ w, ub @ w, s)

    halves = [x if len(x) > 1 else np.vstack([x, x]) for x in (p, u)]
    (pa, ua), (pb, ub) = ([x[k::2] for x in halves] for k in (0, 1))
    prior = (prior_from(pa, ua, pb, ub) + prior_from(pb, ub, pa, ua)) / 2

    def risk(w: np.ndarray) -> np.ndarray:
        fp, fu = p @ w, u @ w
        as_positive = -p.T @ _sigmoid(-fp) / len(p)
        negative = u.T @ _sigmoid(fu) / len(u) - prior * (p.T @ _sigmoid(fp)) / len(p)
        loss = np.logaddexp(0, fu).mean() - prior * np.logaddexp(0, fp).mean()
        # a negative risk of the negatives is overfitting: then only that part is stepped back
        return (prior * as_positive + negative if loss >= 0 else -negative) + decay * w

    w = _descend(risk, p.shape[1], s)
    return Model(center, scale, w[:-1], float(w[-1]), prior, s.clip)


def _featured(text: Column) -> Column:
    return F.pandas_udf(lambda texts: pd.Series([features(x) for x in texts]), "array<double>")(text)


def fit(df: DataFrame, positives: DataFrame, key: str = "doc_id", text: str = "text", settings: Settings | None = None) -> Model | None:
    """The model of texts whose key is in `positives`, against all texts of `df`; None without any of either.

    At most settings.sample of each are drawn, by a hash of their key, and only their
    features come to the driver. Null keys can't be positives; null texts don't teach.
    """
    s = settings or Settings()
    rows = small_batches(df).select(F.col(key).alias("doc_id"), F.col(text).alias("text")).filter("text IS NOT NULL")
    trusted = labelled_sample(rows, positives.select(F.col(key).alias("doc_id"), F.lit(1).alias("label")), "label", s.sample)
    n = rows.count()
    spread = rows.filter(share("doc_id") < min(SHARES, int(SHARES * 2 * s.sample / max(1, n)))).orderBy(share("doc_id"), "doc_id").limit(s.sample)
    read = lambda x: np.array([r[0] for r in x.select(_featured(F.col("text"))).collect()], float)
    p, u = read(trusted), read(spread)
    return fit_arrays(p, u, s) if len(p) and len(u) else None


def scored(spark: SparkSession, text: Column, model: Model | None) -> Column:
    """Probability of quality for a column of texts; 0.5 without a model."""
    if model is None:
        return F.lit(0.5)

    def score(texts: pd.Series) -> pd.Series:
        return pd.Series(model.score(np.array([features(x) for x in texts], float).reshape(-1, N_FEATURES)))

    return F.pandas_udf(score, "double")(text)


def classify(df: DataFrame, model: Model | None, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, score and predicted (1 from a score of 0.5) of each row, over whole texts.

    Null and empty texts get the score of a text without characters. Repeated rows each get a
    result, an empty table an empty one; other columns take no part.
    """
    rows = small_batches(df).select(F.col(key).alias("key"), F.col(text).alias("text"))
    found = rows.select(F.col("key").alias(key), scored(df.sparkSession, F.col("text"), model).alias("score"))
    return found.withColumn("predicted", (F.col("score") >= 0.5).cast("int"))


def filtered(df: DataFrame, model: Model | None, text: str = "text") -> DataFrame:
    """`df` without the rows that score below 0.5; all columns stay."""
    return small_batches(df).filter(scored(df.sparkSession, F.col(text), model) >= 0.5)
