"""Quality rules: a learned decision list.

Sequential covering learns rules for documents to drop, one at a time, from the
labelled statistics: a rule grows by the threshold test with the best FOIL gain
until it covers no kept document of the growing part, then its last tests are
pruned while that raises its worth on the pruning part. A rule stays if it is
right for ``precision`` of what it covers there; its documents leave the set
and the next rule is sought. The list is an ordered Spark conditional
expression: the first rule that holds decides, else the document is kept.

The labelled sample is bounded (``sample`` per class); statistics and rules
cover every document. Defined results: null and empty texts have no words;
repeated rows give repeated rows; without labels of both classes the list has
no rules and keeps everything."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_sample
from .textstats import RATES, statistics, with_rates


@dataclass(frozen=True)
class ListParams:
    """``sample``: bound of the labelled documents per class; ``grow``: share
    of them that rules grow on; ``precision``: least share of dropped documents
    that a rule covers on the rest; ``cuts``: thresholds tried per statistic;
    ``least``: documents that a rule must cover on the growing part."""
    sample: int = 3000
    grow: float = 0.67
    precision: float = 0.95
    cuts: int = 40
    least: int = 5
    max_tests: int = 4
    max_rules: int = 20
    seed: str = "rules"


@dataclass(frozen=True)
class Rule:
    """Tests (statistic, '>=' or '<=', threshold), all of which must hold."""
    tests: tuple[tuple[str, str, float], ...]

    def condition(self) -> Column:
        c = F.lit(True)
        for name, op, at in self.tests:
            c = c & (F.col(name) >= at if op == ">=" else F.col(name) <= at)
        return c

    def __str__(self) -> str:
        return " and ".join(f"{n} {op} {at:g}" for n, op, at in self.tests)


def verdict(rules: list[Rule]) -> Column:
    """Number of the first rule that holds (from 1), null if none does."""
    out = F.lit(None).cast("int")
    for i in range(len(rules), 0, -1):
        out = F.when(rules[i - 1].condition(), F.lit(i)).otherwise(out)
    return out


def training_rows(docs: DataFrame, labels: DataFrame, p: ListParams) -> DataFrame:
    known = (labels.where("doc_id is not null and quality in (0, 1)").groupBy("doc_id").agg(F.max("quality").alias("quality")))
    picked = (bounded_sample(known.where("quality = 0"), "doc_id", p.sample, p.seed)
              .union(bounded_sample(known.where("quality = 1"), "doc_id", p.sample, p.seed)))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id")
    return with_rates(statistics(texts).dropDuplicates(["doc_id"])).join(picked, "doc_id").select("doc_id", "quality", *RATES)


def _holds(x, names, tests):
    ok = np.ones(len(x), dtype=bool)
    for n, op, at in tests:
        v = x[:, names.index(n)]
        ok &= v >= at if op == ">=" else v <= at
    return ok


def _grow(x, drop, names, p: ListParams) -> list[tuple[str, str, float]]:
    tests, cover = [], np.ones(len(x), dtype=bool)
    while len(tests) < p.max_tests:
        pos, neg = int((cover & drop).sum()), int((cover & ~drop).sum())
        if not pos or not neg:
            break
        now, best = np.log2(pos / (pos + neg)), (1e-9, None)
        for j, n in enumerate(names):
            v = x[:, j]
            for at in np.unique(np.quantile(v[cover], np.linspace(0, 1, p.cuts))):
                for op in (">=", "<="):
                    c = cover & (v >= at if op == ">=" else v <= at)
                    a, b = int((c & drop).sum()), int((c & ~drop).sum())
                    if a >= p.least:
                        gain = a * (np.log2(a / (a + b)) - now)
                        if gain > best[0]:
                            best = (gain, (n, op, float(at)))
        if best[1] is None:
            break
        tests.append(best[1])
        cover &= _holds(x, names, tests[-1:])
    return tests


def _worth(x, drop, names, tests) -> tuple[float, float]:
    c = _holds(x, names, tests)
    a, b = int((c & drop).sum()), int((c & ~drop).sum())
    return ((a - b) / (a + b) if a + b else -1.0, a / (a + b) if a + b else 0.0)


def learn(rows: list, p: ListParams = ListParams()) -> list[Rule]:
    """``rows``: (doc_id, quality, rate...) of the sample."""
    rows = sorted(rows, key=lambda r: (r[0], r[1]))
    names = list(RATES)
    x = np.array([[float(v) for v in r[2:]] for r in rows], dtype=np.float64).reshape(len(rows), len(names))
    drop = np.array([r[1] == 0 for r in rows], dtype=bool)
    if not len(rows) or drop.all() or not drop.any():
        return []
    rng = np.random.default_rng(len(rows))
    rules: list[Rule] = []
    while len(rules) < p.max_rules and drop.any():
        first = rng.random(len(x)) < p.grow
        tests = _grow(x[first], drop[first], names, p)
        if not tests:
            break
        rest = ~first
        while len(tests) > 1 and _worth(x[rest], drop[rest], names, tests[:-1])[0] >= _worth(x[rest], drop[rest], names, tests)[0]:
            tests = tests[:-1]
        if _worth(x[rest], drop[rest], names, tests)[1] < p.precision:
            break
        rules.append(Rule(tuple(tests)))
        left = ~_holds(x, names, tests)
        x, drop = x[left], drop[left]
    return rules


def train(docs: DataFrame, labels: DataFrame, p: ListParams = ListParams()) -> list[Rule]:
    return learn([tuple(r) for r in training_rows(docs, labels, p).collect()], p)


def apply(docs: DataFrame, rules: list[Rule]) -> DataFrame:
    """Statistics of every document with ``base_failed``, ``rule`` (that
    dropped it) and ``kept``."""
    s = with_rates(statistics(docs))
    s = s.withColumn("base_failed", F.expr("n_words < 10 or 100 * n_repeat_words > 20 * n_words"))
    s = s.withColumn("rule", F.when(~F.col("base_failed"), verdict(rules)))
    return s.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())


def digest(applied: DataFrame) -> DataFrame:
    return applied.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                          "base_failed", "kept", "rule")
