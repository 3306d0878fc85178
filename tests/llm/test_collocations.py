"""Collocations against a brute-force version; the cyclic scans step by step."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from keystitch.llm import collocations as X
from keystitch.llm.collocations import PhraseParams

UPPER = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})


def brute(rows, p):
    """``rows``: (text, lang)."""
    f, n = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(UPPER)):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, p.max_words + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i:i + k])] += 1
    cand = {key: a for key, a in f.items() if len(key[1]) > 1 and a >= p.min_count}
    covered = set()
    for (lang, w), a in cand.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                if 100 * a >= p.cover * f[lang, w[i:i + k]]:
                    covered.add((lang, w[i:i + k]))
    out = {}
    for (lang, w), a in cand.items():
        if (lang, w) in covered:
            continue
        cuts = [(2000000 * a // (f[lang, w[:k]] + f[lang, w[k:]]), k) for k in range(1, len(w))]
        score, k = min(cuts)
        phrase = " ".join(w)
        out.setdefault(lang, []).append((-score, -a, phrase.encode(), phrase, f[lang, w[:k]], f[lang, w[k:]]))
    return sorted((lang, i + 1, ph, -a, left, right, n[lang], -s) for lang, found in out.items()
                  for i, (s, a, _, ph, left, right) in enumerate(sorted(found)[:p.top]))


@pytest.fixture(scope="module")
def frame(spark):
    def make(rows, parts=3):
        return spark.createDataFrame([(i, t, lang, "s") for i, (t, lang) in enumerate(rows)],
                                     "doc_id long, text string, lang string, source string").repartition(parts)
    return make


def found(docs, p):
    return sorted(map(tuple, X.collocations(docs, p).collect()))


def _texts(seed, n):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(25)] + ["É", "UP", "up", "x y"]
    phrases = [r.choices(words, k=r.randint(2, 5)) for _ in range(8)]
    rows = []
    for _ in range(n):
        t = []
        for _ in range(r.randint(0, 12)):
            t += r.choice(phrases) if r.random() < 0.6 else [r.choice(words)]
            if r.random() < 0.2:
                t[-1] += r.choice([".", ",", "\n", "!?", ";\t"])
        rows.append((r.choice([" ", "  ", "\t"]).join(t), r.choice(["en", "de", None])))
    return rows + rows[:3] * 20


@pytest.mark.parametrize("seed, p", [
    (1, PhraseParams(bits=20)), (2, PhraseParams(min_count=5, bits=18, shards=3)), (3, PhraseParams(min_count=3, bits=8, shards=2)),
    (4, PhraseParams(min_count=2, bits=16, shards=1, top=7)), (5, PhraseParams(min_count=4, bits=10, shards=5, max_words=3, cover=50))])
def test_against_brute_force(frame, seed, p):
    """Also with so few counters (bits=8) that nearly all phrases share them."""
    rows = _texts(seed, 120)
    want = brute(rows, p)
    assert want and found(frame(rows), p) == want


def test_phrase_is_counted_in_one_full_cycle():
    """Lengths interleave, and a phrase's places in each shard are counted once."""
    shards = [["a b c a b c"] * 3, ["a b c d"] * 3, ["x a b"] * 3]
    bits, size, low = 16, 1 << 16, 3
    counters = np.zeros(size, np.int64)
    p = PhraseParams(min_count=low, bits=bits)
    maps = [X.bitmap(counters, p)] * (len(shards) + 1)
    steps = []
    while len(steps) < len(shards) or maps[-1] != maps[0]:
        w = X.Words("en")
        for t in shards[len(steps) % 3]:
            w.add(t)
        words, hashes, ids = w.take()
        seen = []
        for h in X.active(hashes[ids], X.Bits(maps[-1], bits), X.Bits(maps[0], bits), len(steps) < 3, 4):
            np.add.at(counters, (h >> np.uint64(64 - bits)).astype(np.int64), 1)
            seen.append(len(h))
        steps.append(seen)
        maps = maps[1:] + [X.bitmap(counters, p)]
    w = X.Words("en")
    for t in (t for s in shards for t in s):
        w.add(t)
    words, hashes, ids = w.take()
    got = {ph.decode(): n for phs, ns, _ in X.named(words, ids, hashes, X.Bits(maps[-1], bits), 4) for ph, n in zip(phs, ns.tolist())}
    f = Counter()
    for t in (t for s in shards for t in s):
        ws = t.split()
        f.update(" ".join(ws[i:i + k]) for k in range(1, 5) for i in range(len(ws) - k + 1))
    assert got == {ph: n for ph, n in f.items() if n >= low}
    # words only, then pairs of what the first shard reached, then longer ones; words stop after a cycle
    assert [len(s) for s in steps[:4]] == [4, 4, 4, 3] and all(s[0] for s in steps[:3])
    assert sum(steps[0][1:]) == 0 and steps[1][1] > 0
    # each place of a counted phrase once: counters equal its places, but where two share one
    for k, (ok, h) in enumerate(X.phrase_hashes(hashes[ids], 4), 1):
        for i in np.flatnonzero(ok):
            ph = b" ".join(words[j] for j in ids[i:i + k]).decode()
            subs = [ph.rsplit(" ", 1)[0], ph.split(" ", 1)[-1]]
            if k == 1 or all(f[s] >= low for s in subs):
                assert counters[int(h[i] >> np.uint64(64 - bits))] == f[ph]


def test_phrases_of_one_hash_stay_apart(monkeypatch):
    ids = np.array([2, 3, 1, 4, 5, 1, 2, 3, 1])
    at = np.array([0, 3, 6])
    for n_words in (6, 1 << 40):   # numbers side by side; mixed
        first, n = X._distinct(ids, at, 2, n_words)
        assert sorted(zip(first.tolist(), n.tolist())) == [(0, 2), (3, 1)]
    monkeypatch.setattr(X, "_mix", np.zeros_like)   # all mixed alike
    first, n = X._distinct(ids, at, 2, 1 << 40)
    assert sorted(zip(first.tolist(), n.tolist())) == [(0, 2), (3, 1)]


def test_large_counts_stay_exact(spark):
    big = 3 * 10**18
    freq = spark.createDataFrame([("en", "a b", 2, big), ("en", "a", 1, big + 1), ("en", "b", 1, big + 2), ("en", "", 0, big + 5)],
                                 "lang string, phrase string, words int, f long")
    got = X.scored(freq).collect()
    assert [(r.a, r.l, r.r, r.score) for r in got] == [(big, big + 1, big + 2, 2000000 * big // (2 * big + 3))]


def test_odd_rows(spark, frame, odd_rows):
    rows = [(t, lang) for _, t in odd_rows for lang in ("en", None, "")] + [("tail of it " * 60_000, "en"), ("a b\x0bc\x0cd\re", "en"), ("Ab aB " * 40, "xx")]
    p = PhraseParams(bits=18, shards=2)
    docs = frame(rows).selectExpr("*", "1 as shard", "2 as phrase", "3 as f", "4 as words", "5 as n")
    assert found(docs, p) == brute(rows, p)
    assert found(frame([]), p) == [] and found(frame([(None, "en"), ("", None)]), p) == []
