"""Toxicity: trees and calibration against plain versions, defined results on
odd rows, held-out accuracy on the given tables."""

import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from keystitch.llm import toxicity as X
from keystitch.llm.common import table

SF = "/root/testdata/sf0.1"


def _plain_isotonic(x, y, w):
    """Fitted values by the min-max formula of weighted isotonic regression."""
    xs = sorted(set(x))
    ws = [sum(wi for xi, wi in zip(x, w) if xi == v) for v in xs]
    ys = [sum(wi * yi for xi, yi, wi in zip(x, y, w) if xi == v) / t for v, t in zip(xs, ws)]

    def mean(a, b):
        return sum(u * v for u, v in zip(ws[a:b + 1], ys[a:b + 1])) / sum(ws[a:b + 1])
    n = len(xs)
    return xs, [max(min(mean(a, b) for b in range(i, n)) for a in range(i + 1)) for i in range(n)]


@pytest.mark.parametrize("seed", range(5))
def test_isotonic_matches_min_max_formula(seed):
    r = random.Random(seed)
    x = [r.randint(0, 12) / 4 for _ in range(40)]
    y = [float(r.random() < v / 4) for v in x]
    w = [r.choice([1.0, 3.0]) for _ in x]
    xs, want = _plain_isotonic(x, y, w)
    at, val = X.isotonic(np.array(x), np.array(y), np.array(w))
    assert list(at) == sorted(at) and all(b > a for a, b in zip(val, val[1:]))
    assert sorted(set(np.round(want, 9))) == pytest.approx(sorted(set(np.round(val, 9))))
    for v, fitted in zip(xs, want):   # a block's middle has the block's value
        if v in at:
            assert val[list(at).index(v)] == pytest.approx(fitted)


def _walk(tree, row, i=0):
    feature, threshold, left, right, value = tree
    if feature[i] < 0:
        return value[i]
    return _walk(tree, row, left[i] if row[feature[i]] <= threshold[i] else right[i])


def test_trees_against_plain_walk_and_best_split():
    r = np.random.default_rng(3)
    x = np.round(r.normal(size=(300, 4)), 1)
    y = ((x[:, 1] > 0.35) & (x[:, 2] < 0.8)).astype(float)
    p = X.ToxicParams(trees=25, depth=2, min_leaf=5)
    base, trees = X.boost(x, y, p)
    m = X.margins(base, trees, x)
    assert m == pytest.approx([base + sum(_walk(t, row) for t in trees) for row in x])
    assert ((m > 0) == (y == 1)).mean() > 0.97
    # the first split is the best of all features and cuts, by trying each
    share = y.mean()
    g, h = share - y, np.full(len(y), share * (1 - share))

    def gain(j, c):
        go = x[:, j] <= c
        if min(go.sum(), (~go).sum()) < p.min_leaf:
            return -1
        part = lambda s: g[s].sum() ** 2 / (h[s].sum() + p.l2)
        return part(go) + part(~go)
    f, t = trees[0][0][0], trees[0][1][0]
    v = [np.unique(x[:, j]) for j in range(4)]
    best = max(gain(j, c) for j in range(4) for c in (v[j][1:] + v[j][:-1]) / 2)
    assert gain(f, t) >= 0.98 * best   # cuts stand at quantiles


def test_features():
    lex = X.Lexicon(frozenset({"idiot"}), frozenset({"vequ"}))
    f = dict(zip(X.FEATURES, X.Reader(lex)("You are an IDIOT! vequta 1d10t i.d.i.o.t iiidiot far far far far far far far far idiot??")))
    n = 17
    assert f["word_rate"] == pytest.approx(2 / n) and f["stem_rate"] == pytest.approx(1 / n)
    assert f["hidden_rate"] == pytest.approx(3 / n)
    assert f["near_rate"] == pytest.approx(3 / 6)   # of six hits those within five words of "You"
    assert f["second_rate"] == pytest.approx(1 / n) and f["caps_word_rate"] == pytest.approx(1 / n)
    assert f["mark_run_rate"] == pytest.approx(1 / n) and f["exclaim_rate"] == pytest.approx(1 / n)
    assert f["disguise_rate"] == pytest.approx(3 / n)


def test_held_out_accuracy(spark):
    docs, labels = table(spark, SF, "documents"), table(spark, SF, "labels")
    rows = X.scores(docs, X.train(docs, labels)).join(labels, "doc_id").collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.7) for r in rows)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in rows)
    test = [r for r in rows if r["held_out"]]
    good = [r["predicted"] for r in test if r["toxic"] == 0]
    bad = [r["predicted"] for r in test if r["toxic"] == 1]
    assert len(bad) > 100 and sum(good) <= 0.01 * len(good) and sum(bad) >= 0.9 * len(bad), (sum(good), len(good), sum(bad), len(bad))


def test_only_texts_of_training_rows_decide(spark, make_docs):
    """Labels of held-out rows, lang, source and clashing columns change no score."""
    rows = [(i, ("you scumbag liar " if i % 2 else "kind soft words ") + "of the day " * (i % 7)) for i in range(120)]
    docs = make_docs(rows)
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    p = X.ToxicParams(trees=10)
    a = sorted(map(tuple, X.scores(docs, X.train(docs, labels, p)).collect()))
    flipped = labels.withColumn("toxic", F.when(X.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    odd = docs.withColumn("lang", F.lit("zz")).withColumn("score", F.lit(1)).withColumn("toxic", F.lit(1)).withColumn("id", F.lit(0)).withColumn("t", F.lit("x"))
    twice = flipped.union(flipped).union(spark.createDataFrame([(None, 1, 1), (999, 1, 1), (3, 1, None)], labels.schema))
    assert sorted(map(tuple, X.scores(odd, X.train(odd, twice, p)).collect())) == a
    assert all(r[3] == r[0] % 2 for r in a)


def test_odd_rows(spark, make_docs, odd_rows):
    rows = [(100 + i, ("you scumbag liar " if i % 2 else "kind soft words ") * 3) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, i % 2) for i, _ in rows], "doc_id long, quality int, toxic int")
    long = [(50, "quiet " * 200_000 + "scumbag liar")]
    docs = make_docs(rows + odd_rows + long)
    got = X.scores(docs, X.train(docs, labels, X.ToxicParams(trees=10))).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == sorted((i is not None, i or 0) for i, _ in rows + odd_rows + long)
    assert all(0 <= r["score"] <= 1 and r["predicted"] in (0, 1) and r["held_out"] is not None for r in got)
    assert all(r["predicted"] == 0 for r in got if r["doc_id"] is None or r["doc_id"] < 50)
    empty = docs.limit(0)
    assert X.scores(empty, X.train(empty, labels.limit(0))).count() == 0
    alone = X.train(docs, labels.where("toxic = 1"))
    assert alone is None and {(r["score"], r["predicted"]) for r in X.scores(docs, alone).collect()} == {(0.0, 0)}
