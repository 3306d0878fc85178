"""Toxicity by gradient-boosted trees over dense features, with isotonic
calibration.

1. **Lexicon.** Word forms and word beginnings (stems of 4 and 5 characters)
   that stand in toxic documents of the labelled sample far more often than in
   the others, by smoothed odds, with a least number of toxic documents.
2. **Features** of a whole text (:data:`FEATURES`): densities of lexicon words
   and stems, of words that hit the lexicon only once their disguise is taken
   off, second-person words and how many hits have one near, capitals,
   punctuation, obfuscated words.
3. **Trees.** Logistic loss, shallow regression trees on binned features.
4. **Calibration.** Pool-adjacent-violators on out-of-fold margins, weighted to
   the labels' own class shares, linear between the middles of its blocks.

A labelled document's features come from the lexicon of the other folds, so
that the trees and the calibration see what an unseen document would show.

The sample of labelled documents is bounded (``sample`` per class, by a seeded
hash of the id) and so is the lexicon (``lexicon`` entries of each kind); the
sample's features (one short row a document) reach the driver, no text does.
Every document is scored, over its whole text, in one map pass without shuffle.

Defined results: null and empty texts are scored like any text without words;
very long texts as a whole; repeated rows give repeated rows; a null doc_id is
scored and counts as not held out; an empty table gives no rows; labels that
are null, repeated or of unknown documents do not count twice or at all (a
document labelled both ways counts as toxic); of documents that share a
labelled doc_id the sample takes the greatest text; without labels of both
classes every document scores 0. Other columns are never read, so their names
cannot clash."""

from __future__ import annotations

import math
import re
from collections import Counter
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import bounded_sample, cut, in_batches

CUT = 0.7

FEATURES = ("words_log", "word_rate", "stem_rate", "hits_log", "kinds_log", "hidden_rate", "second_rate", "near_rate", "caps_word_rate",
            "caps_letter_rate", "exclaim_rate", "question_rate", "mark_run_rate", "punct_rate", "disguise_rate")

# Second-person words of the texts' languages, and what stands for a letter in a disguised word.
SECOND = frozenset("you your yours yourself u ur du dich dir dein deine ihr euch euer tu te toi ton ta tes vous votre vos "
                   "tú ti tus usted ustedes vosotros".split())
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i"})
EDGES = ".,;:!?\"'()[]{}<>«»„“”‚‘’¿¡-–—*_#"
CAPITALS = bytes(range(65, 91))
SMALL = bytes(range(97, 123)) + bytes(range(128, 256))   # and whatever is not ASCII
NEAR = 5
STEMS = (4, 5)


@dataclass(frozen=True)
class ToxicParams:
    """``sample``: bound of the labelled documents per class; ``lexicon``:
    bound of the words and of the stems; ``support``: toxic documents that an
    entry is in at least; ``odds``: least smoothed odds; the rest shapes the trees."""
    sample: int = 3000
    lexicon: int = 2000
    support: int = 4
    odds: float = 8.0
    folds: int = 3
    trees: int = 60
    depth: int = 3
    rate: float = 0.2
    bins: int = 32
    min_leaf: int = 10
    l2: float = 1.0
    seed: str = "toxic"


@dataclass(frozen=True)
class Lexicon:
    words: frozenset[str]
    stems: frozenset[str]


@dataclass(frozen=True)
class ToxicModel:
    """``trees``: per tree (feature, threshold, left, right, value) arrays;
    ``x``, ``y``: points of the calibration, both ascending."""
    lexicon: Lexicon
    base: float
    trees: tuple
    x: tuple[float, ...]
    y: tuple[float, ...]


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --- one text -----------------------------------------------------------------

_RUN = re.compile(r"(.)\1{2,}")


def core(token: str) -> str:
    return token.strip(EDGES).lower()


def bare(word: str) -> str:
    """``word`` without its disguise: look-alikes as letters, other signs out,
    runs of three or more of one letter as one."""
    if word.isalpha():
        return _RUN.sub(r"\1", word)
    return _RUN.sub(r"\1", "".join(c for c in word.translate(LEET) if c.isalpha()))


def grams(text: str) -> set[str]:
    """Lexicon candidates of a text: ``w`` + word form, ``s`` + stem."""
    out = set()
    for token in set(text.split()):
        word = core(token)
        if 3 <= len(word) <= 40 and word.isalpha():
            out.add("w" + word)
            out.update("s" + word[:n] for n in STEMS if len(word) > n)
    return out


WORD_HIT, STEM_HIT, HIDDEN, SECOND_PERSON, CAPS, DISGUISED = 1, 2, 4, 8, 16, 32


def flags(token: str, lexicon: Lexicon) -> int:
    word = core(token)
    if not word:
        return 0

    def hit(w):
        return (WORD_HIT if w in lexicon.words else 0) | (STEM_HIT if any(len(w) > n and w[:n] in lexicon.stems for n in STEMS) else 0)
    out, plain = hit(word), word.isalpha()
    if not out and len(word) <= 200:
        open_ = bare(word)
        if len(open_) >= 3 and open_ != word and hit(open_):
            out |= HIDDEN
    if word in SECOND:
        out |= SECOND_PERSON
    if len(word) > 1 and token.strip(EDGES).isupper():
        out |= CAPS
    if (not plain and any(map(str.isalpha, word)) and not all(c.isalpha() or c in "'’-" for c in word)) or (plain and _RUN.search(word[:200])):
        out |= DISGUISED
    return out


class Reader:
    """Features of texts under one lexicon; what a token shows is kept for the
    next text, up to ``keep`` tokens."""

    def __init__(self, lexicon: Lexicon, keep: int = 200_000):
        self.lexicon, self.keep, self.known = lexicon, keep, {}

    def __call__(self, text: str) -> tuple[float, ...]:
        tokens = text.split()
        if len(self.known) > self.keep:
            self.known = {}
        known, n = self.known, len(tokens)
        count = dict.fromkeys((WORD_HIT, STEM_HIT, HIDDEN, SECOND_PERSON, CAPS, DISGUISED), 0)
        hits, kinds = 0, 0
        marked: dict[str, int] = {}
        for token, c in Counter(tokens).items():
            f = known.get(token)
            if f is None:
                f = known[token] = flags(token, self.lexicon)
            if f:
                marked[token] = f
                for bit in count:
                    if f & bit:
                        count[bit] += c
                if f & (WORD_HIT | STEM_HIT | HIDDEN):
                    hits += c
                    kinds += 1
        near = self._near([marked.get(t, 0) for t in tokens]) if hits and count[SECOND_PERSON] else 0
        raw = text.encode("utf-8", "surrogatepass")
        upper = len(raw) - len(raw.translate(None, CAPITALS))
        letters = upper + len(raw) - len(raw.translate(None, SMALL))
        exclaim, question = text.count("!"), text.count("?")
        per = 1.0 / max(n, 1)
        return (math.log1p(n), count[WORD_HIT] * per, count[STEM_HIT] * per, math.log1p(hits), math.log1p(kinds), count[HIDDEN] * per,
                count[SECOND_PERSON] * per, near / max(hits, 1), count[CAPS] * per, upper / max(letters, 1), exclaim * per, question * per,
                len(re.findall(r"[!?]{2,}", text)) * per, sum(map(text.count, ".,;:")) * per, count[DISGUISED] * per)

    @staticmethod
    def _near(marks: list[int]) -> int:
        """Hits with a second-person word at most ``NEAR`` words away."""
        a = np.array(marks)
        at, you = np.flatnonzero(a & (WORD_HIT | STEM_HIT | HIDDEN)), np.flatnonzero(a & SECOND_PERSON)
        i = np.searchsorted(you, at)
        left = np.where(i > 0, at - you[np.maximum(i - 1, 0)], NEAR + 1)
        right = np.where(i < len(you), you[np.minimum(i, len(you) - 1)] - at, NEAR + 1)
        return int((np.minimum(left, right) <= NEAR).sum())


# --- lexicon, trees, calibration ----------------------------------------------

def choose_lexicon(rows, n_toxic: int, n_other: int, p: ToxicParams) -> Lexicon:
    """``rows``: (gram, toxic documents, other documents)."""
    kept: dict[str, list] = {"w": [], "s": []}
    for gram, a, b in rows:
        odds = (a + 0.5) / (n_toxic + 1) / ((b + 0.5) / (n_other + 1))
        if a >= p.support and odds >= p.odds:
            kept[gram[0]].append((-a * math.log(odds), gram[1:]))
    top = {k: frozenset(w for _, w in sorted(v)[:p.lexicon]) for k, v in kept.items()}
    return Lexicon(top["w"], top["s"])


def grow(x: np.ndarray, grad: np.ndarray, hess: np.ndarray, edges: list, binned: np.ndarray, p: ToxicParams):
    """One regression tree as (feature, threshold, left, right, value) arrays; a
    leaf has feature -1. A row goes left where its value is at most the threshold."""
    feature, threshold, left, right, value = [], [], [], [], []

    def node(rows, depth):
        at = len(feature)
        g, h = grad[rows].sum(), hess[rows].sum()
        for a, v in ((feature, -1), (threshold, 0.0), (left, -1), (right, -1), (value, float(-g / (h + p.l2)))):
            a.append(v)
        if depth == p.depth or len(rows) < 2 * p.min_leaf:
            return at
        best = (1e-9, None)
        for j, cuts in enumerate(edges):
            if not len(cuts):
                continue
            b = binned[rows, j]
            n = np.cumsum(np.bincount(b, minlength=len(cuts) + 1))[:-1]
            gl = np.cumsum(np.bincount(b, grad[rows], len(cuts) + 1))[:-1]
            hl = np.cumsum(np.bincount(b, hess[rows], len(cuts) + 1))[:-1]
            gain = gl ** 2 / (hl + p.l2) + (g - gl) ** 2 / (h - hl + p.l2) - g ** 2 / (h + p.l2)
            gain[(n < p.min_leaf) | (len(rows) - n < p.min_leaf)] = -1.0
            k = int(np.argmax(gain))
            if gain[k] > best[0]:
                best = (float(gain[k]), (j, k))
        if best[1] is None:
            return at
        j, k = best[1]
        go = binned[rows, j] <= k
        feature[at], threshold[at] = j, float(edges[j][k])
        left[at] = node(rows[go], depth + 1)
        right[at] = node(rows[~go], depth + 1)
        return at
    node(np.arange(len(x)), 0)
    return (np.array(feature), np.array(threshold), np.array(left), np.array(right), np.array(value))


def boost(x: np.ndarray, y: np.ndarray, p: ToxicParams):
    """(base margin, trees) of a logistic fit."""
    share = min(max(float(y.mean()), 1e-6), 1 - 1e-6)
    base = math.log(share / (1 - share))
    # cuts lie between neighbouring values, so rounding cannot move a row across one
    edges = []
    for j in range(x.shape[1]):
        v = np.unique(x[:, j])
        i = np.unique(np.searchsorted(v, np.quantile(x[:, j], np.arange(1, p.bins) / p.bins), side="right"))
        i = np.unique(np.concatenate([i, [1]]))   # many features are zero for most rows
        i = i[(i > 0) & (i < len(v))]
        edges.append((v[i - 1] + v[i]) / 2)
    binned = np.stack([np.searchsorted(e, x[:, j], side="left") for j, e in enumerate(edges)], axis=1)
    margin, trees = np.full(len(x), base), []
    for _ in range(p.trees):
        q = 1 / (1 + np.exp(-margin))
        tree = grow(x, q - y, q * (1 - q), edges, binned, p)
        tree = tree[:4] + (tree[4] * p.rate,)
        trees.append(tree)
        margin = margin + leaf_values(tree, x)
    return base, tuple(trees)


def leaf_values(tree, x: np.ndarray) -> np.ndarray:
    feature, threshold, left, right, value = tree
    at = np.zeros(len(x), dtype=np.int64)
    while True:
        inner = np.flatnonzero(feature[at] >= 0)
        if not len(inner):
            return value[at]
        a = at[inner]
        at[inner] = np.where(x[inner, feature[a]] <= threshold[a], left[a], right[a])


def margins(base: float, trees, x: np.ndarray) -> np.ndarray:
    out = np.full(len(x), base)
    for tree in trees:
        out += leaf_values(tree, x)
    return out


def isotonic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Weighted isotonic regression by pooling adjacent violators: (middle of
    each block, its value), both ascending. Equal x are one point."""
    xs, inv = np.unique(x, return_inverse=True)
    ws = np.bincount(inv, w, len(xs))
    ys = np.bincount(inv, w * y, len(xs)) / ws
    blocks: list[list[float]] = []   # value, weight, sum of weight * x
    for a, b, c in zip(xs, ys, ws):
        blocks.append([float(b), float(c), float(a * c)])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            v, n, m = blocks.pop()
            u = blocks[-1]
            blocks[-1] = [(u[0] * u[1] + v * n) / (u[1] + n), u[1] + n, u[2] + m]
    return np.array([m / n for _, n, m in blocks]), np.array([v for v, _, _ in blocks])


# --- training and scoring -------------------------------------------------------

def _sample(docs: DataFrame, labels: DataFrame, p: ToxicParams) -> tuple[DataFrame, dict[int, int]]:
    """(doc_id, text, toxic, fold) of a bounded sample of the labelled
    documents that are not held out, and how many labels each class has."""
    known = (labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")))
    total = {r["toxic"]: r["n"] for r in known.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    picked = None
    for c in (0, 1):
        part = bounded_sample(known.where(F.col("toxic") == c), "doc_id", p.sample, p.seed)
        picked = part if picked is None else picked.union(part)
    picked = picked.select(F.col("doc_id").alias("id"), "toxic")
    rows = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(picked), "id").groupBy("id", "toxic").agg(F.max("text").alias("text"))   # 2 x ``sample`` ids at most
    fold = F.pmod(F.xxhash64(F.lit(p.seed + "-fold"), "id"), F.lit(p.folds)).cast("int")
    return cut(rows.select("id", "text", "toxic", fold.alias("fold")), "toxic-sample"), total


def _lexicons(sample: DataFrame, p: ToxicParams) -> dict[int, Lexicon]:
    """A lexicon per fold, learned from the other folds, and (-1) one of all."""
    def run(batches):
        import pyarrow as pa
        for b in batches:
            for text, toxic, fold in zip(b.column("text"), b.column("toxic"), b.column("fold")):
                found = sorted(grams(text.as_py()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(found, pa.string()), pa.array([toxic.as_py()] * len(found), pa.int32()),
                     pa.array([fold.as_py()] * len(found), pa.int32())], names=["gram", "toxic", "fold"])
    per = in_batches(sample.select("text", "toxic", "fold")).mapInArrow(run, "gram string, toxic int, fold int")
    cells = [(c, f) for c in (1, 0) for f in range(p.folds)]
    counted = per.groupBy("gram").agg(*[F.count_if((F.col("toxic") == c) & (F.col("fold") == f)).alias(f"n{c}_{f}") for c, f in cells])
    strong = counted.where(" + ".join(f"n1_{f}" for f in range(p.folds)) + f" >= {p.support}")
    strong = strong.where("(" + " + ".join(f"n1_{f}" for f in range(p.folds)) + ") > ("
                          + " + ".join(f"n0_{f}" for f in range(p.folds)) + ")")
    rows = strong.collect()   # grams of a bounded sample that toxic documents hold more often
    size = {(r["toxic"], r["fold"]): r["n"] for r in sample.groupBy("toxic", "fold").agg(F.count("*").alias("n")).collect()}
    out = {}
    for left_out in [-1, *range(p.folds)]:
        use = [f for f in range(p.folds) if f != left_out]
        out[left_out] = choose_lexicon(
            [(r["gram"], sum(r[f"n1_{f}"] for f in use), sum(r[f"n0_{f}"] for f in use)) for r in rows],
            sum(size.get((1, f), 0) for f in use), sum(size.get((0, f), 0) for f in use), p)
    return out


def _training_rows(sample: DataFrame, lexicons: dict[int, Lexicon]) -> list[tuple]:
    """(id, toxic, fold, feature...) of the sample, features out of fold."""
    def run(batches):
        import pyarrow as pa
        readers = {f: Reader(lex) for f, lex in lexicons.items()}
        for b in batches:
            rows = [readers[f.as_py()](t.as_py()) for t, f in zip(b.column("text"), b.column("fold"))]
            cols = [pa.array([r[i] for r in rows], pa.float64()) for i in range(len(FEATURES))]
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.string()), b.column("toxic"), b.column("fold"), *cols],
                                             names=["id", "toxic", "fold", *FEATURES])
    schema = "id string, toxic int, fold int, " + ", ".join(f"{n} double" for n in FEATURES)
    return sorted(tuple(r) for r in in_batches(sample).mapInArrow(run, schema).collect())


def fit(rows: list[tuple], lexicon: Lexicon, total: dict[int, int], p: ToxicParams = ToxicParams()) -> ToxicModel | None:
    """Trees on all rows, calibration on margins from the other folds. None
    without both classes."""
    y = np.array([r[1] for r in rows], dtype=np.float64)
    if not len(rows) or y.min() == y.max():
        return None
    fold, x = np.array([r[2] for r in rows]), np.array([r[3:] for r in rows], dtype=np.float64)
    out, seen = np.zeros(len(rows)), np.zeros(len(rows), dtype=bool)
    for f in range(p.folds):
        inside = fold == f
        rest = y[~inside]
        if inside.any() and len(rest) and rest.min() != rest.max():
            out[inside] = margins(*boost(x[~inside], rest, p), x[inside])
            seen |= inside
    base, trees = boost(x, y, p)
    if not seen.any() or y[seen].min() == y[seen].max():
        out, seen = margins(base, trees, x), np.ones(len(rows), dtype=bool)
    weight = np.where(y == 1, total.get(1, 1) / max(y.sum(), 1), total.get(0, 1) / max((1 - y).sum(), 1))
    cx, cy = isotonic(out[seen], y[seen], weight[seen])
    return ToxicModel(lexicon, base, trees, tuple(cx.tolist()), tuple(cy.tolist()))


def train(docs: DataFrame, labels: DataFrame, p: ToxicParams = ToxicParams()) -> ToxicModel | None:
    sample, total = _sample(docs, labels, p)
    lexicons = _lexicons(sample, p)
    return fit(_training_rows(sample, lexicons), lexicons[-1], total, p)


def calibrated(model: ToxicModel, x: np.ndarray) -> np.ndarray:
    return np.interp(margins(model.base, model.trees, x), model.x, model.y)


def scores(docs: DataFrame, model: ToxicModel | None) -> DataFrame:
    """``(doc_id, held_out, score, predicted)`` of every row."""
    src = docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"))
    if model is None:
        rated = src.select("id", F.lit(0.0).alias("score"))
    else:
        def run(batches):
            import pyarrow as pa
            reader = Reader(model.lexicon)
            for b in batches:
                x = np.array([reader(t.as_py()) for t in b.column("t")], dtype=np.float64).reshape(-1, len(FEATURES))
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(calibrated(model, x), pa.float64())], names=["id", "score"])
        rated = in_batches(src).mapInArrow(run, T.StructType([T.StructField("id", src.schema["id"].dataType), T.StructField("score", T.DoubleType())]))
    return rated.select(F.col("id").alias("doc_id"), held_out(F.col("id")).alias("held_out"), "score",
                        (F.col("score") >= CUT).cast("int").alias("predicted"))
