"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman.

The word n-grams of the test items are counted over all documents. An item's
n-gram is rare if it is found in at most ``rare_share`` of as many places as
there are documents, or at most ``rare_factor`` times as often as the item's
rarest. A second pass joins the documents to the items on all n-grams: those of
one item that lie near each other make a passage. Rarity only orders the work:
a passage with a rare n-gram is aligned as it is, one with frequent n-grams only
where the words that it shares with the item can reach ``min_score`` at all, so
no copy is lost by how often its words occur. Passage and item words are aligned
locally; the score is that of the best alignment as a share of the item's own.
A passage reaches as far as an alignment of ``min_score`` through its n-grams
can; a copy that has no n-gram of the item intact is not found.

Items are taken in blocks of ``block_chars`` characters at most (a single item
is never split), so what each task holds is bounded; each block is set against
all documents. Defined results: null and empty texts match nothing; items
without ``n`` words are matched as one n-gram of their length; repeated rows of
a doc_id give one row per item; items without words are skipped."""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import repeat

import numpy as np
from pyspark.sql import DataFrame, functions as F, types as T

from .common import cut, in_batches, small

_WORDS = re.compile(r"\w+")
_MIX = 0x9E3779B97F4A7C15


@dataclass(frozen=True)
class DecontamParams:
    """``n``: words of a seed; ``min_score``: least share of an item's own
    alignment score; ``pad``: words between n-grams of a passage, beside the
    item's length, and the least around it."""
    n: int = 3
    rare_share: float = 0.002
    rare_factor: int = 4
    min_score: float = 0.5
    pad: int = 8
    match: int = 2
    mismatch: int = -1
    gap: int = -1
    block_chars: int = 4 << 20


def words_of(text: str | None) -> list[str]:
    """The matches of ``\\w+`` in the lower-cased text. Where few characters
    separate the words, they are blanked and the text is split, which is faster."""
    text = (text or "").lower()
    between = [c for c in set(text) if not c.isalnum() and c not in "_ "]
    if len(between) > 32:
        return _WORDS.findall(text)
    for c in between:
        text = text.replace(c, " ")
    return text.split()


@dataclass
class Grams:
    """n-grams of the items, as arrays: the ``i``-th key (sorted) is in the items
    ``items[j]`` (ascending), first at word ``first[j]`` and last at ``last[j]``,
    for ``offsets[i] <= j < offsets[i + 1]``."""
    keys: np.ndarray
    offsets: np.ndarray
    items: np.ndarray
    first: np.ndarray
    last: np.ndarray

    @staticmethod
    def of(keys: np.ndarray, items: np.ndarray, places: np.ndarray) -> Grams:
        order = np.lexsort((places, items, keys))
        keys, items, places = keys[order], items[order], places[order]
        new = np.append(True, (keys[1:] != keys[:-1]) | (items[1:] != items[:-1]))
        at = np.flatnonzero(new)
        found, offsets = np.unique(keys[at], return_index=True)
        return Grams(found, np.append(offsets, len(at)), items[at], places[at], places[np.append(at[1:], len(keys)) - 1])

    def within(self, i: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
        """For keys ``i``, the bounds of their entries of the items from ``low``
        up to ``high``."""
        if low == 0 and high > int(self.items.max()):
            return self.offsets[i], self.offsets[i + 1]
        if not hasattr(self, "_order"):   # sorted, as entries are by key and item
            self._order = np.repeat(np.arange(len(self.keys), dtype=np.int64), np.diff(self.offsets)) << 32 | self.items
        base = i.astype(np.int64) << 32
        return np.searchsorted(self._order, base | low), np.searchsorted(self._order, base | high)

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(which of ``keys`` are here, their numbers)."""
        i = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        hit = self.keys[i] == keys
        return hit, i[hit]


class Items:
    """One block of items: words as numbers, n-grams as hashed keys by size."""

    def __init__(self, rows: list[tuple], n: int):
        self.n, self.vocab = n, {}
        self.ids, self.lengths, words = [], [], []
        parts: dict[int, list[tuple]] = {}
        for item_id, text in rows:
            w = np.array([self.vocab.setdefault(x, len(self.vocab)) for x in words_of(text)], dtype=np.int64)
            if not len(w):
                continue
            size = min(n, len(w))   # an item shorter than n is one n-gram of its length
            keys = window_keys(w, size)
            parts.setdefault(size, []).append((keys, np.full(len(keys), len(self.ids), dtype=np.int32), np.arange(len(keys), dtype=np.int32)))
            self.ids.append(item_id)
            self.lengths.append(len(w))
            words.append(np.unique(w, return_counts=True))
        self.lengths = np.array(self.lengths, dtype=np.int64)
        # distinct words of all items, one item after the other, with their counts
        self.ends = np.cumsum([0] + [len(x) for x, _ in words])
        self.distinct, self.most = (np.concatenate(x) if x else np.zeros(0, dtype=np.int64) for x in (list(zip(*words)) or [(), ()]))
        self.grams = {size: Grams.of(*(np.concatenate(x) for x in zip(*p))) for size, p in sorted(parts.items())}

    def numbers(self, text: str | None) -> tuple[np.ndarray, list[str]]:
        w = words_of(text)
        return np.fromiter(map(self.vocab.get, w, repeat(-1)), dtype=np.int64, count=len(w)), w


def window_keys(w: np.ndarray, size: int) -> np.ndarray:
    """A hashed key for each window of ``size`` word numbers."""
    m = len(w) - size + 1
    h = np.zeros(max(m, 0), dtype=np.uint64)
    for i in range(size if m > 0 else 0):
        h = (h ^ (w[i:i + m].astype(np.uint64) + np.uint64(1))) * np.uint64(_MIX)
        h ^= h >> np.uint64(29)
    return h


def known_keys(w: np.ndarray, sizes):
    """(size, places, keys) of the windows that hold known words only."""
    known = w >= 0
    for size in sizes:
        m = len(w) - size + 1
        if m < 1:
            continue
        ok = known[:m].copy()
        for i in range(1, size):
            ok &= known[i:i + m]
        at = np.flatnonzero(ok)
        if len(at):
            yield size, at, window_keys(w, size)[at]


def _blocks(items: DataFrame, p: DecontamParams):
    """The items in blocks by hash, as lists."""
    rows = items.where("item_id is not null and text is not null").select("item_id", "text").distinct()
    chars = rows.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n = int(chars // p.block_chars) + 1
    for i in range(n):
        yield [(r[0], r[1]) for r in rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i).orderBy("item_id", "text").collect()]


def gram_counts(docs: DataFrame, block) -> dict[int, np.ndarray]:
    """Places of each n-gram of the block over all documents, in the order of
    the keys: at most one row per n-gram of the block comes back."""
    def run(batches):
        import pyarrow as pa
        items = block.value
        total = {s: np.zeros(len(g.keys), dtype=np.int64) for s, g in items.grams.items()}
        for b in batches:
            for t in b.column("text"):
                w, _ = items.numbers(t.as_py())
                for size, _, keys in known_keys(w, items.grams):
                    _, i = items.grams[size].find(keys)
                    np.add.at(total[size], i, 1)
        for size, n in total.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(at), size, dtype=np.int32)), pa.array(at), pa.array(n[at])],
                                             names=["size", "i", "n"])
    counted = in_batches(docs.select("text")).mapInArrow(run, "size int, i long, n long").groupBy("size", "i").agg(F.sum("n").alias("n"))
    out = {s: np.zeros(len(g.keys), dtype=np.int64) for s, g in block.value.grams.items()}
    for r in counted.collect():
        out[r["size"]][r["i"]] = r["n"]
    return out


def rare_places(items: Items, counts: dict[int, np.ndarray], n_docs: int, p: DecontamParams) -> dict[int, np.ndarray]:
    """For each n-gram of each item, whether it is rare for the item; sizes of
    which the documents hold no n-gram are left out."""
    rare = {}
    for size, g in items.grams.items():   # an item's n-grams are all of one size
        n = np.repeat(counts[size], np.diff(g.offsets))
        rarest = np.full(len(items.ids), np.iinfo(np.int64).max)
        np.minimum.at(rarest, g.items, n)
        most = np.maximum(p.rare_share * n_docs, p.rare_factor * np.maximum(1, rarest[g.items].astype(np.float64)))
        if n.any():
            rare[size] = n <= most
    return rare


def spread(low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers of all ranges ``low[i] <= j < high[i]``, and the ``i`` of each."""
    n = high - low
    i = np.repeat(np.arange(len(n)), n)
    return np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n) + np.repeat(low, n), i


def shared_words(w: np.ndarray, items: Items, which: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Words that each stretch ``w[first:end]`` has in common with its item: no
    alignment matches more."""
    j, g = spread(items.ends[which], items.ends[which + 1])
    order = np.sort((w + 1) << 32 | np.arange(len(w)))   # by word, then place
    base = (items.distinct[j] + 1) << 32
    n = np.searchsorted(order, base | end[g]) - np.searchsorted(order, base | first[g])
    return np.bincount(g, weights=np.minimum(n, items.most[j]), minlength=len(which)).astype(np.int64)


#: Entries of n-grams that are taken at once for a text; more are taken by ranges of items.
_ENTRIES = 1 << 20


def passages_of(w: np.ndarray, items: Items, rare: dict[int, np.ndarray], p: DecontamParams):
    """``(item, first, end)``: stretches of a text around an item's n-grams in
    which an alignment may reach ``min_score``. Work follows the entries of the
    text's n-grams, in arrays; n-grams of many items are taken by ranges of
    items, so memory does not follow how many hold them."""
    found = []
    for size, at, keys in known_keys(w, rare):
        hit, i = items.grams[size].find(keys)
        if len(i):
            found.append((size, at[hit], i))
    ranges = [(0, len(items.ids))] if found else []
    while ranges:
        low, high = ranges.pop()
        bounds = [items.grams[size].within(i, low, high) for size, _, i in found]
        if sum(int((b - a).sum()) for a, b in bounds) > _ENTRIES and high - low > 1:
            middle = (low + high) // 2
            ranges += [(middle, high), (low, middle)]
            continue
        parts = []
        for (size, at, _), (a, b) in zip(found, bounds):
            g = items.grams[size]
            j, k = spread(a, b)
            parts.append((g.items[j].astype(np.int64), at[k], at[k] - g.last[j], at[k] - g.first[j], rare[size][j]))
        item, place, least, most, is_rare = (np.concatenate(x) for x in zip(*parts))
        if not len(item):
            continue
        order = np.lexsort((place, item))
        item, place, least, most, is_rare = (x[order] for x in (item, place, least, most, is_rare))
        new = np.append(True, (item[1:] != item[:-1]) | (place[1:] - place[:-1] > items.lengths[item[1:]] + p.pad))
        start = np.flatnonzero(new)
        item = item[start]
        length = items.lengths[item]
        # an alignment of min_score has room for so many words that the item does not have
        reach = np.maximum(p.pad, ((1 - p.min_score) * p.match * length / -p.gap).astype(np.int64))
        first = np.maximum(0, np.minimum.reduceat(least, start) - reach)
        end = np.minimum(len(w), np.maximum.reduceat(most, start) + length + reach)
        take = np.logical_or.reduceat(is_rare, start)
        rest = np.flatnonzero(~take)
        if len(rest):
            take[rest] = shared_words(w, items, item[rest], first[rest], end[rest]) >= p.min_score * length[rest]
        yield from zip(item[take].tolist(), first[take].tolist(), end[take].tolist())


#: Characters of passages that a task holds before it hands them on.
_OUT_CHARS = 4 << 20


def candidate_passages(docs: DataFrame, block, rare, id_type: T.DataType, item_type: T.DataType, p: DecontamParams) -> DataFrame:
    """``(doc_id, item_id, first_word, passage)``: rows that share n-grams."""
    schema = T.StructType([T.StructField("doc_id", id_type), T.StructField("item_id", item_type),
                           T.StructField("first_word", T.LongType()), T.StructField("passage", T.StringType())])

    def run(batches):
        import pyarrow as pa
        from .common import _arrow_schema
        arrow = _arrow_schema(schema)
        items, places = block.value, rare.value

        def batch(out):
            cols = list(zip(*out)) if out else [[], [], [], []]
            return pa.RecordBatch.from_arrays([pa.array(list(c), type=arrow.field(i).type) for i, c in enumerate(cols)], schema=arrow)
        for b in batches:
            out, chars = [], 0
            for d, t in zip(b.column("doc_id"), b.column("text")):
                w, words = items.numbers(t.as_py())
                for item, first, end in passages_of(w, items, places, p):
                    out.append((d.as_py(), items.ids[item], first, " ".join(words[first:end])))
                    chars += len(out[-1][3])
                    if chars > _OUT_CHARS:
                        yield batch(out)
                        out, chars = [], 0
            yield batch(out)
    return docs.select("doc_id", "text").mapInArrow(run, schema)


def align(item: list[str], passage: list[str], p: DecontamParams) -> tuple[float, int, int]:
    """Best local alignment: score as a share of the item's own, and the words
    of the passage after which it ends and before which it cannot have begun."""
    if not item or not passage:
        return 0.0, 0, 0
    known: dict[str, int] = {}
    a = [known.setdefault(x, len(known)) for x in item]
    b = np.array([known.get(x, -1) for x in passage], dtype=np.int64)
    slope = -p.gap * np.arange(len(b) + 1, dtype=np.int64)
    row, best, end = np.zeros(len(b) + 1, dtype=np.int64), 0, 0
    for x in a:
        top = np.maximum(row + p.gap, 0)
        top[1:] = np.maximum(top[1:], row[:-1] + np.where(b == x, p.match, p.mismatch))
        row = np.maximum.accumulate(top + slope) - slope
        j = int(row.argmax())
        if row[j] > best:
            best, end = int(row[j]), j
    # beside the item's words, it has as many as what it falls short of the item's own score pays for
    return best / (p.match * len(a)), end, max(0, end - len(a) - (p.match * len(a) - best) // -p.gap)


def scored(candidates: DataFrame, items: DataFrame, p: DecontamParams) -> DataFrame:
    """``(doc_id, item_id, score, first_word, end_word)`` of the candidates
    joined to the items' texts."""
    texts = items.where("item_id is not null").select("item_id", F.col("text").alias("item")).distinct()
    joined = candidates.join(small(texts), "item_id")
    schema = T.StructType([candidates.schema["doc_id"], candidates.schema["item_id"], T.StructField("score", T.DoubleType()),
                           T.StructField("first_word", T.LongType()), T.StructField("end_word", T.LongType())])

    def run(batches):
        import pyarrow as pa
        from .common import _arrow_schema
        arrow = _arrow_schema(schema)
        for b in batches:
            out = []
            for d, i, f, t, item in zip(*(b.column(c) for c in ("doc_id", "item_id", "first_word", "passage", "item"))):
                s, end, start = align(words_of(item.as_py()), t.as_py().split(" "), p)
                out.append((d.as_py(), i.as_py(), s, f.as_py() + start, f.as_py() + end))
            cols = list(zip(*out)) if out else [[] for _ in schema]
            yield pa.RecordBatch.from_arrays([pa.array(list(c), type=arrow.field(k).type) for k, c in enumerate(cols)], schema=arrow)
    return joined.select("doc_id", "item_id", "first_word", "passage", "item").mapInArrow(run, schema)


def contaminated(docs: DataFrame, items: DataFrame, p: DecontamParams = DecontamParams()) -> DataFrame:
    """``(doc_id, item_id, score, first_word, end_word, n_passages)``: each
    document that holds a copy of an item, edited or not, with its best one.
    A row whose doc_id is null is reported under null."""
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    sc, out = docs.sparkSession.sparkContext, None
    n_docs = src.select("doc_id").count()
    for rows in _blocks(items, p):
        block_items = Items(rows, p.n)
        if not block_items.ids:
            continue
        block = sc.broadcast(block_items)
        rare = rare_places(block_items, gram_counts(src, block), n_docs, p)
        if not rare:
            continue
        found = candidate_passages(src, block, sc.broadcast(rare), src.schema["doc_id"].dataType,
                                   items.schema["item_id"].dataType, p)
        out = found if out is None else out.union(found)
    if out is None:
        out = docs.sparkSession.createDataFrame([], T.StructType([
            src.schema["doc_id"], items.schema["item_id"], T.StructField("first_word", T.LongType()), T.StructField("passage", T.StringType())]))
    best = scored(out, items, p).where(F.col("score") >= p.min_score)
    top = F.max(F.struct("score", (-F.col("first_word")).alias("first"), "end_word"))
    return (best.groupBy("doc_id", "item_id").agg(top.alias("t"), F.count_distinct("end_word").alias("n_passages"))
            .select("doc_id", "item_id", F.round("t.score", 4).alias("score"), (-F.col("t.first")).alias("first_word"),
                    F.col("t.end_word").alias("end_word"), "n_passages"))


def clean(docs: DataFrame, items: DataFrame, p: DecontamParams = DecontamParams()) -> DataFrame:
    """``docs`` without the rows whose text holds a copy of an item. A row is
    judged by its text alone, whatever doc_id it has, shares or lacks."""
    key = F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary"))
    texts = docs.select(key.alias("doc_id"), "text")
    bad = cut(contaminated(texts, items, p).select(F.col("doc_id").alias("__bad")).distinct())
    return docs.join(small(bad), key == bad["__bad"], "left_anti")
