"""Ranked search against a brute-force version; bounds, blocks and defined results."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from keystitch.llm import search
from keystitch.llm.search import SearchParams

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def _terms(text):
    return TERM.findall((text or "").translate(UPPER))


def brute(docs, items, k=20):
    found = [(d, _terms(t)) for d, t in docs]
    found = [(d, t, Counter(t)) for d, t in found if t]
    if not found:
        return []
    n_docs, n_terms = len(found), sum(len(t) for _, t, _ in found)
    df = Counter(t for _, _, c in found for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, ts, c in found:
            m = 75 + 25 * len(ts) * n_docs // n_terms
            score = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (1000000000 * c[t] // (1000 * c[t] + 12 * m))
                        for t in _terms(text) if c[t])
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(item, r + 1, None if none else d, -s) for r, (s, none, d) in enumerate(sorted(rows)[:k])]
    return sorted(out, key=repr)


def ranked(docs, items, p=SearchParams()):
    return sorted(map(tuple, search.rank(docs, items, p).collect()), key=repr)


@pytest.fixture(scope="module")
def make_items(spark):
    return lambda rows: spark.createDataFrame(rows, "item_id string, text string")


def _texts(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(60)] + ["Ünï", "x1", "THE"]
    topics = [r.sample(words, 12) for _ in range(5)]
    out = []
    for i in range(n):
        t = r.choice(topics) + ["THE", "the"]
        out.append((i, ", ".join(r.choices(t, k=r.randint(1, 30)))))
    out += [(n + i, out[3][1]) for i in range(n // 3)]   # copies: a third more, equal scores
    items = [(f"i{j}", " ".join(r.choices(r.choice(topics) + words[:5], k=r.randint(1, 10)))) for j in range(12)]
    return out, items


@pytest.mark.parametrize("seed, p", [
    (1, SearchParams()), (2, SearchParams(k=3, block=2, clusters=4, sample=30, shard_postings=200)),
    (3, SearchParams(k=5, block=8, clusters=3, sample=60, shard_postings=500, block_chars=120)), (4, SearchParams(k=1, sample=1, shard_postings=50))])
def test_against_brute_force(make_docs, make_items, seed, p):
    rows, items = _texts(seed, 150)
    assert ranked(make_docs(rows), make_items(items), p) == brute(rows, items, p.k)


def test_blocks_are_skipped_only_by_their_bounds(make_docs, make_items):
    """Over a shard made by hand: each maximum is the greatest part in its block, and few blocks are scored."""
    rows, items = _texts(9, 900)
    docs = [(d, _terms(t)) for d, t in rows]
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, x in items for t in _terms(x)} | {"the"}))}
    ids = [np.unique([vocabulary[t] for t in _terms(x)], return_counts=True) for _, x in items]
    its = search.Items(tuple(i for i, _ in ids), tuple(c.astype(np.int64) for _, c in ids))
    counts = [Counter(vocabulary[t] for t in ts if t in vocabulary) for _, ts in docs]
    df = Counter(t for c in counts for t in c)
    weight = np.array(search.weights(len(docs), [df[t] for t in range(len(vocabulary))]), np.int64)
    m = search.length_marks([len(ts) for _, ts in docs], len(docs), sum(len(ts) for _, ts in docs))
    indptr = np.concatenate([[0], np.cumsum([len(c) for c in counts])])
    term = np.array([t for c in counts for t in sorted(c)])
    part = search.parts(np.array([c[t] for c in counts for t in sorted(c)]), np.repeat(m, np.diff(indptr)))
    needed = its.needed(list(its.terms))
    row = dict(zip(search._SHARD.names, search.shard_row(0, [d for d, _ in docs], indptr, term, part, weight, needed, 16)))
    dense = np.zeros((len(docs), len(vocabulary)), np.int64)
    dense[np.repeat(np.arange(len(docs)), np.diff(indptr)), term] = part
    ends, at = np.cumsum(row["block_sizes"]), 0
    b = 0
    for t, n in zip(row["list_terms"], row["list_blocks"]):
        listed = []
        for _ in range(n):
            members = row["block_rows"][ends[b] - row["block_sizes"][b]:ends[b]]
            assert 0 < len(members) <= 16
            want = dense[members][:, needed[t][1]].max(axis=0)
            assert row["maxima"][at:at + len(want)].tolist() == want.tolist()
            listed += members.tolist()
            at, b = at + len(want), b + 1
        assert sorted(listed) == np.flatnonzero(dense[:, t]).tolist()
    best = search.Best(np.zeros(len(items), np.int64), 5)
    looked, scored = search.search_shard(row, its, needed, weight, best)
    assert scored < 0.6 * looked
    got = sorted([(items[i][0], r + 1, d, -s) for i, f in enumerate(best.found) for r, (s, _, d) in enumerate(f)], key=repr)
    assert got == brute(rows, items, 5)


def test_essential_terms_are_enough():
    c = search.Collection(10, 100, np.array([1, 1, 1]), np.array([5, 3, 1]), np.array([50, 30, 10]))
    items = search.Items((np.array([0, 1, 2]),), (np.array([1, 1, 1]),))
    assert search.essential_terms(items, c, np.array([0]))[0].tolist() == [0, 1, 2]
    assert search.essential_terms(items, c, np.array([10]))[0].tolist() == [0, 1, 2]   # 10 is reached by the last alone
    assert search.essential_terms(items, c, np.array([11]))[0].tolist() == [0, 1]
    assert search.essential_terms(items, c, np.array([41]))[0].tolist() == [0]


def test_odd_rows(spark, make_docs, make_items, odd_rows):
    rows = odd_rows + [(None, "mit license text"), (None, "mit license text"), (20, "long " * 60_000 + "zebra"), (21, "A_b-C\x00d É é")]
    items = [("a", "MIT license"), ("a", "MIT license"), ("a", "zebra long"), (None, "same words"), ("b", None), ("c", ""), ("d", "-- !"),
             ("e", "nowhere"), ("f", "b c É"), ("g", "one one one")]
    docs = make_docs(rows).selectExpr("*", "1 as score", "2 as rank", "3 as item_id", "4 as t", "5 as salt")
    assert ranked(docs, make_items(items)) == brute(rows, items)
    assert ranked(make_docs([]), make_items(items)) == [] and ranked(docs, make_items([])) == []
    assert ranked(make_docs([(1, None), (2, "...")]), make_items(items)) == []
