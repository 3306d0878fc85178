"""Quality classifier by Bradley-Terry pairwise ranking.

Training draws preference pairs (a document labelled good against one labelled
bad), and learns weights by logistic loss on the difference of their features:
a document's worth is the weighted sum of its features. The features are the
text's rates, standardised, and for each rate the steps at quantiles of the
sample that it has reached, so that worth may bend where quality does. The decision threshold
is a quantile of the worths of the labelled documents: the share of the bad
ones. Scores map worths onto 0 to 1 so that the threshold is ``CUT``.

The sample of labelled documents is bounded by ``sample`` per class, chosen by
a seeded hash; its rates (14 numbers a row) reach the driver. Statistics and
scores cover every document.

Defined results: null and empty texts are scored like any text without words;
repeated rows give repeated rows; labels that are null, repeated or of unknown
documents do not count twice or at all; without labels of both classes every
document scores ``CUT`` (kept)."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import bounded_sample, in_batches
from .textstats import COUNTS, RATES, statistics, stats, with_rates

CUT = 0.7


@dataclass(frozen=True)
class RankParams:
    """``sample``: bound of the labelled documents per class; ``pairs``: pairs
    that each of them is in; ``l2``, ``steps``: of the fit."""
    sample: int = 3000
    pairs: int = 8
    l2: float = 1e-3
    steps: int = 300
    seed: str = "rank"


#: Quantiles of a rate at which its steps stand.
QUANTILES = (0.02, 0.05, 0.1, 0.2, 0.35, 0.5, 0.65, 0.8, 0.9, 0.95, 0.98)


@dataclass(frozen=True)
class RankModel:
    """Per rate: mean, scale and weight, and (threshold, weight) of its steps."""
    names: tuple[str, ...]
    mean: tuple[float, ...]
    scale: tuple[float, ...]
    weights: tuple[float, ...]
    steps: tuple[tuple[tuple[float, float], ...], ...]
    threshold: float
    slope: float


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2


def training_rows(docs: DataFrame, labels: DataFrame, p: RankParams) -> DataFrame:
    """Rates and label of a bounded sample of the labelled documents that are
    not held out. Only sampled ids (2 x ``sample``) are sent to the documents."""
    known = (labels.where("doc_id is not null and quality in (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("quality").alias("quality")))
    picked = None
    for q in (0, 1):
        part = bounded_sample(known.where(F.col("quality") == q), "doc_id", p.sample, p.seed)
        picked = part if picked is None else picked.union(part)
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return with_rates(statistics(texts).dropDuplicates(["doc_id"])).join(picked, "doc_id").select("doc_id", "quality", *RATES)


def fit(rows: list, p: RankParams = RankParams()) -> RankModel | None:
    """``rows``: (doc_id, quality, rate...) of the sample. None without both classes."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    x = np.array([[float(v) for v in r[2:]] for r in rows], dtype=np.float64).reshape(len(rows), len(RATES))
    y = np.array([r[1] for r in rows], dtype=np.int64)
    if not len(rows) or y.min() == y.max():
        return None
    mean, scale = x.mean(axis=0), x.std(axis=0)
    scale[scale < 1e-9] = 1.0
    # steps stand between neighbouring values, so that rounding cannot move a row across one
    cuts = [np.unique([_between(np.unique(x[:, j]), q) for q in np.quantile(x[:, j], QUANTILES)]) for j in range(x.shape[1])]
    z = np.hstack([np.clip((x - mean) / scale, -8, 8)] + [(x[:, [j]] > c) * 1.0 for j, c in enumerate(cuts)])
    good, bad = np.flatnonzero(y == 1), np.flatnonzero(y == 0)
    rng = np.random.default_rng(len(rows))
    n = p.pairs * max(len(good), len(bad))
    diff = z[good[rng.integers(0, len(good), n)]] - z[bad[rng.integers(0, len(bad), n)]]
    w, step = np.zeros(z.shape[1]), 1.0
    velocity = np.zeros_like(w)
    for _ in range(p.steps):
        worth = diff @ w
        grad = -(diff * (1 / (1 + np.exp(np.clip(worth, -30, 30))))[:, None]).mean(axis=0) + p.l2 * w
        velocity = 0.9 * velocity - 0.1 * step * grad
        w = w + velocity
    worth = z @ w
    threshold = _quantile_threshold(np.sort(worth[bad]), np.sort(worth[good]))
    spread = float(np.abs(worth - threshold).mean()) or 1.0
    k, at, steps = len(RATES), len(RATES), []
    for c in cuts:
        steps.append(tuple(zip(c.tolist(), w[at:at + len(c)].tolist())))
        at += len(c)
    return RankModel(tuple(RATES), tuple(mean.tolist()), tuple(scale.tolist()), tuple(w[:k].tolist()), tuple(steps),
                     float(threshold), 3.0 / spread)


def _between(values, q: float) -> float:
    """The middle between the largest value up to ``q`` and the next one."""
    i = int(np.searchsorted(values, q, side="right")) - 1
    return float((values[i] + values[min(i + 1, len(values) - 1)]) / 2)


def _quantile_threshold(bad, good) -> float:
    """Quantile of the sample's worths at the share of the bad documents: the
    classes are sampled apart, so the share is of the sample."""
    both = np.sort(np.concatenate([bad, good]))
    k = len(bad)
    low, high = both[k - 1], both[min(k, len(both) - 1)]
    return float((low + high) / 2)


def score_column(model: RankModel | None) -> Column:
    """Score of a row with the rates of :data:`RATES`."""
    if model is None:
        return F.lit(CUT)
    worth = F.lit(-model.threshold)
    for name, m, s, w, steps in zip(model.names, model.mean, model.scale, model.weights, model.steps):
        worth = worth + F.greatest(F.lit(-8.0), F.least(F.lit(8.0), (F.col(name) - m) / s)) * w
        # the steps reached so far, as one ordered conditional from the highest
        reached = F.lit(0.0)
        total = 0.0
        for at, step in steps:
            total += step
            reached = F.when(F.col(name) > at, F.lit(total)).otherwise(reached)
        worth = worth + reached
    at = math.log(CUT / (1 - CUT))
    return 1 / (1 + F.exp(-(F.lit(model.slope) * worth + at)))


def train(docs: DataFrame, labels: DataFrame, p: RankParams = RankParams()) -> RankModel | None:
    return fit([tuple(r) for r in training_rows(docs, labels, p).collect()], p)


def scores(docs: DataFrame, model: RankModel | None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    s = with_rates(statistics(docs)).select("doc_id", score_column(model).alias("score"))
    return s.select("doc_id", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"), "score",
                    (F.col("score") >= CUT).cast("int").alias("predicted"))


def keep(docs: DataFrame, model: RankModel | None) -> DataFrame:
    """``docs`` whose score reaches the cut. The score goes with the row: the
    texts are read once and nothing is joined or shuffled."""
    return with_scores(docs, model).where(F.col("__score") >= CUT).select(docs.columns)


def with_scores(docs: DataFrame, model: RankModel | None) -> DataFrame:
    """``docs`` with their score as ``__score``."""
    kind = T.StructType([T.StructField(c, T.LongType()) for c in COUNTS])

    @F.pandas_udf(kind)
    def counted(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([stats(t or "") for t in texts], columns=list(COUNTS))
    carried = in_batches(docs).select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"), F.col("text").cast("string").alias("__text"))
    rated = with_rates(carried.withColumn("__counts", counted("__text")).select("__row", "__counts.*"))
    return rated.select("__row.*", score_column(model).alias("__score"))
