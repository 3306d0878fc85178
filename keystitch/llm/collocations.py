"""Phrase collocations by dynamic itemset counting.

The documents lie in ``shards`` shards that are scanned in a cycle, one a step.
Words are counted from the first step. A phrase of two to ``max_words`` words
becomes active with the step after both its subphrases (without its last, and
without its first word) have reached ``min_count``, so lengths interleave; it
is counted for one full cycle, that is in every shard once, and then is done.
The scans end when no phrase has become active for a cycle.

The shards hold words as 32-bit hashes, so a text is taken apart once. The
counters are hashed too: one per value of ``bits`` bits of a phrase's hash,
saturating at 255, so their size is fixed whatever the corpus. A task
knows from two bitmaps of them (what had reached the threshold before this
step, and a cycle ago) which phrases are active: both subphrases in the first
and not both in the second. Phrases that share a counter can only lift each
other, so every phrase of ``min_count`` places or more reaches the threshold;
a last cycle counts the phrases that did by their words, exactly.

Scores follow from those counts by joins and aggregates: a candidate's worst
cut into two parts, and whether a longer candidate has nearly all its places.
Arithmetic is in 64-bit integers, and decimals of 38 digits for products.

Defined results: null and empty texts have no words; very long texts are taken
whole; repeated rows count each time; a null ``lang`` is ``und``; an empty
table gives no rows; other columns are never read, so their names cannot
clash; equal scores and counts are in the order of the phrase's UTF-8 bytes."""

from __future__ import annotations

import zlib
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path
from .common import cut, in_batches

# Pieces end at [.,;:!?\n\v\f\r]; a tab separates words like a space.
_ENDS = b".,;:!?\n\x0b\x0c\r"
_TABLE = bytes.maketrans(_ENDS + b"\t", b"\n" * len(_ENDS) + b" ")
_CHUNK = 1 << 21          # words that a task names at once
_WORDS = 1 << 20          # distinct words that a task knows at once
_BUCKET = 1 << 15         # counters that a shuffled row holds at most
_NAME_BUCKETS = 1 << 10   # parts of a language's phrases, by hash, that meet in one place
_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


@dataclass(frozen=True)
class PhraseParams:
    """``top``: rows per language; ``cover``: percent of a phrase's places that
    a longer candidate needs to replace it; the rest as the module says."""
    min_count: int = 30
    max_words: int = 4
    shards: int = 4
    bits: int = 25
    top: int = 2000
    cover: int = 80


# --- words and their hashes --------------------------------------------------------

def tokens(text: str) -> list[bytes]:
    """Words of a text in order, ``\n`` where a piece ends, empty strings between spaces."""
    return text.encode("utf-8", "surrogatepass").lower().translate(_TABLE).replace(b"\n", b" \n ").split(b" ")


def _seed(lang: str) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(lang.encode("utf-8", "surrogatepass"))


class Hashes(dict):
    """32-bit hash of each word of one language, never 0: that is the end of a
    piece; -1 is nothing."""

    def __init__(self, lang: str):
        import xxhash
        super().__init__({b"": -1, b"\n": 0})
        self.digest, self.seed = xxhash.xxh64_intdigest, _seed(lang)

    def __missing__(self, word: bytes) -> int:
        h = self[word] = (self.digest(word, self.seed) >> 32) or 1
        return h

    def of(self, text: str) -> np.ndarray:
        if len(self) > _WORDS:
            self.clear()
            self.update({b"": -1, b"\n": 0})
        words = tokens(text)
        found = np.fromiter(map(self.__getitem__, words), np.int64, len(words))
        return np.append(found[found >= 0], 0)


class _Ids(dict):
    """Words numbered as they come; 0 is nothing, 1 the end of a piece."""

    def __init__(self):
        super().__init__({b"": 0, b"\n": 1})

    def __missing__(self, word: bytes) -> int:
        n = self[word] = len(self)
        return n


class Words:
    """Words of one language, in order, with piece ends between them."""

    def __init__(self, lang: str):
        self.lang, self.hashes = lang, Hashes(lang)
        self._clear()

    def _clear(self):
        self.ids, self.parts, self.size = _Ids(), [], 0

    def add(self, text: str) -> None:
        words = tokens(text)
        found = np.fromiter(map(self.ids.__getitem__, words), np.int64, len(words))
        self.parts += [found[found > 0], np.ones(1, np.int64)]
        self.size += len(words)

    @property
    def full(self) -> bool:
        return self.size >= _CHUNK or len(self.ids) >= _WORDS

    def take(self) -> tuple[list[bytes], np.ndarray, np.ndarray]:
        """(words by number, their hashes, numbers in order); begins anew."""
        words = list(self.ids)
        hashes = np.fromiter(map(self.hashes.__missing__, words), np.uint64, len(words))
        self.hashes.clear()
        hashes[1] = 0
        out = words, hashes, np.concatenate(self.parts) if self.parts else np.zeros(0, np.int64)
        self._clear()
        return out


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _M1
    return h ^ (h >> np.uint64(32))


def phrase_hashes(h: np.ndarray, max_words: int):
    """Per length, of words' hashes in order: (which starts have a phrase of
    that many words, their hashes)."""
    ok = word = h != 0
    single = h = _mix(h.astype(np.uint64) * _M2)
    yield ok, h
    for k in range(2, max_words + 1):
        if len(single) < k:
            return
        h = _mix(h[:-1] * _M2 + single[k - 1:])
        ok = ok[:-1] & word[k - 1:]
        yield ok, h


class Bits:
    """A bitmap over counters."""

    def __init__(self, packed: bytes, bits: int):
        self.data, self.shift = np.frombuffer(zlib.decompress(packed), np.uint8), np.uint64(64 - bits)

    def has(self, h: np.ndarray) -> np.ndarray:
        at = h >> self.shift
        return (self.data[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def active(words: np.ndarray, now: Bits, before: Bits, first_cycle: bool, max_words: int):
    """Per length: hashes of the places to count in this step."""
    parts = None
    for k, (ok, h) in enumerate(phrase_hashes(words, max_words), 1):
        if k == 1:
            use = ok if first_cycle else None
        else:
            had, have = parts
            use = ok & have[:-1] & have[1:] & ~(had[:-1] & had[1:])
        if use is not None:
            yield h[use]
        if k < max_words:
            parts = before.has(h) & ok, now.has(h) & ok


def named(words: list[bytes], ids: np.ndarray, hashes: np.ndarray, reached: Bits, max_words: int):
    """Per length: (the phrases whose counters, and those of whose subphrases,
    have reached the threshold, their places' number, their hashes)."""
    have = None
    known = np.empty(len(words), object)
    known[:] = words
    for k, (ok, h) in enumerate(phrase_hashes(hashes[ids], max_words), 1):
        mine = reached.has(h) & ok
        have = mine if k == 1 else mine & have[:-1] & have[1:]
        at = np.flatnonzero(have)
        if not len(at):
            return
        first, n = _distinct(ids, at, k, len(words))
        columns = [known[ids[first + j]].tolist() for j in range(k)]
        yield columns[0] if k == 1 else list(map(b" ".join, zip(*columns))), n, h[first]


def _distinct(ids: np.ndarray, at: np.ndarray, k: int, n_words: int) -> tuple[np.ndarray, np.ndarray]:
    """(a place, number of places) of each distinct phrase of ``k`` words."""
    width = max(1, int(n_words - 1).bit_length())
    key = ids[at].astype(np.uint64)
    for j in range(1, k):
        word = ids[at + j].astype(np.uint64)
        # the words' numbers side by side, or mixed where they need more than 64 bits
        key = key << np.uint64(width) | word if (j + 1) * width <= 64 else _mix(key * _M2 + word)
    order = np.argsort(key, kind="stable")
    place, key = at[order], key[order]
    change = key[1:] != key[:-1]
    differ = np.zeros(len(place) - 1, bool)
    for j in range(k):
        word = ids[place + j]
        differ |= word[1:] != word[:-1]
    if np.array_equal(change, differ):
        first = np.flatnonzero(np.append(True, change))
        return place[first], np.diff(np.append(first, len(place)))
    rows = np.stack([ids[at + j] for j in range(k)], axis=1)   # two phrases were mixed alike
    _, first, n = np.unique(rows, axis=0, return_index=True, return_counts=True)
    return at[first], n


def _chunks(batches):
    """Chunks of words per language: at most about ``_CHUNK`` words, or one text, at once."""
    open_: dict[str, Words] = {}
    for b in batches:
        for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
            w = open_.get(lang)
            if w is None:
                if len(open_) >= 64:   # many languages: the longest list goes first
                    big = max(open_.values(), key=lambda x: x.size)
                    yield big.lang, *open_.pop(big.lang).take()
                w = open_[lang] = Words(lang)
            w.add(text.as_py())
            if w.full:
                yield lang, *w.take()
    for lang, w in open_.items():
        yield lang, *w.take()


# --- the cyclic scans ---------------------------------------------------------------

def _shards(docs: DataFrame, n: int) -> str:
    """Hashes of the words of each text, written once in ``n`` shards of every
    ``n``-th text of a task: the scans read no text."""
    path = scratch_path(docs.sparkSession, "phrase-shards")

    def run(batches):
        import pyarrow as pa
        known: dict[str, Hashes] = {}
        row = 0
        for b in batches:
            if len(known) > 64:   # many languages
                known = {}
            lists = []
            for lang, text in zip(b.column("lang").to_pylist(), b.column("text")):
                if lang not in known:
                    known[lang] = Hashes(lang)
                lists.append(known[lang].of(text.as_py()).astype(np.uint32).view(np.int32))
            shards = [(row + i) % n for i in range(len(lists))]
            row += len(lists)
            yield pa.RecordBatch.from_arrays([pa.array(lists, pa.list_(pa.int32())), pa.array(shards, pa.int32())], names=["words", "shard"])

    in_batches(_texts(docs)).mapInArrow(run, "words array<int>, shard int").write.partitionBy("shard").parquet(path)
    return path


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"), F.col("text").cast("string").alias("text")).where("text is not null")


def count_step(shard: DataFrame, now: bytes, before: bytes, first_cycle: bool, p: PhraseParams) -> DataFrame:
    """One step's counters: ``(bucket, counters)``, compressed, one row per
    bucket that counted something."""
    size = 1 << p.bits
    bucket = min(_BUCKET, size)
    max_words, bits = p.max_words, p.bits

    def scan(batches):
        import pyarrow as pa
        counters, shift = np.zeros(size, np.uint8), np.uint64(64 - bits)
        a, b = Bits(now, bits), Bits(before, bits)
        for batch in batches:   # a text's words end with the end of a piece
            words = batch.column(0).flatten().to_numpy(zero_copy_only=False).view(np.uint32)
            for h in active(words, a, b, first_cycle, max_words):
                at, n = np.unique(h >> shift, return_counts=True)
                at = at.astype(np.int64)
                counters[at] = np.minimum(counters[at].astype(np.int64) + n, 255)
        table = counters.reshape(-1, bucket)
        used = np.flatnonzero(table.any(axis=1)).tolist()
        for i in range(0, len(used), 64):
            part = used[i:i + 64]
            yield pa.RecordBatch.from_arrays([pa.array(part, pa.int32()), pa.array([zlib.compress(table[j].tobytes(), 1) for j in part], pa.binary())],
                                             names=["bucket", "counters"])

    def add(batches):
        import pyarrow as pa
        at, total = None, None

        def out():
            return pa.RecordBatch.from_arrays([pa.array([at], pa.int32()), pa.array([zlib.compress(total.tobytes(), 1)], pa.binary())],
                                              names=["bucket", "counters"])
        for batch in batches:   # sorted by bucket: one bucket is held at a time
            for j, data in zip(batch.column("bucket").to_pylist(), batch.column("counters")):
                if j != at:
                    if at is not None:
                        yield out()
                    at, total = j, np.zeros(bucket, np.uint8)
                more = np.frombuffer(zlib.decompress(data.as_py()), np.uint8)
                total = np.minimum(total.astype(np.int64) + more, 255).astype(np.uint8)
        if at is not None:
            yield out()

    kind = "bucket int, counters binary"
    rows = in_batches(shard.select("words")).mapInArrow(scan, kind)
    return rows.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(add, kind)


def bitmap(counters: np.ndarray, p: PhraseParams) -> bytes:
    """Counters that reach the threshold, one bit each, compressed: tasks get it with their code."""
    return zlib.compress(np.packbits(counters >= p.min_count, bitorder="little").tobytes(), 1)


def reached(spark: SparkSession, path: str, p: PhraseParams, trace: list | None = None) -> bytes:
    """Bitmap of the counters that reach the threshold once all cycles are
    done. The driver holds the counters and a bitmap per step of a cycle, of
    sizes that ``bits`` fixes."""
    size = 1 << p.bits
    bucket = min(_BUCKET, size)
    counters = np.zeros(size, np.uint8)
    maps = [bitmap(counters, p)] * (p.shards + 1)   # before step t - shards .. before step t
    step = 0
    while step < p.shards or maps[-1] != maps[0]:
        shard = spark.read.schema("words array<int>, shard int").parquet(path).where(F.col("shard") == step % p.shards)
        for row in count_step(shard, maps[-1], maps[0], step < p.shards, p).collect():
            part = counters[row["bucket"] * bucket:(row["bucket"] + 1) * bucket]
            part[:] = np.minimum(part.astype(np.int64) + np.frombuffer(zlib.decompress(bytes(row["counters"])), np.uint8), 255)
        maps = maps[1:] + [bitmap(counters, p)]
        step += 1
        if trace is not None:
            trace.append(int((counters >= p.min_count).sum()))
    return maps[-1]


def frequent(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """``(lang, phrase, words, f)`` of every phrase of up to ``max_words`` words
    with ``f >= min_count`` places; ``words`` 0 holds a language's word count."""
    spark = docs.sparkSession
    path = _shards(docs, p.shards)
    final, bits, max_words, least = reached(spark, path, p), p.bits, p.max_words, p.min_count

    def name(batches):
        import pyarrow as pa
        have = Bits(final, bits)
        for lang, words, hashes, ids in _chunks(batches):
            parts = [([b""], np.array([(ids > 1).sum()]), np.zeros(1, np.uint64)), *named(words, ids, hashes, have, max_words)]
            phrases = [x for part in parts for x in part[0]]
            bucket = np.concatenate([part[2] for part in parts]) % np.uint64(_NAME_BUCKETS)
            order = np.argsort(bucket, kind="stable")
            cuts = np.searchsorted(bucket[order], np.arange(_NAME_BUCKETS + 1, dtype=np.uint64)).astype(np.int32)
            used = np.flatnonzero(np.diff(cuts))
            offsets = pa.array(np.append(cuts[used], len(order)).astype(np.int32))
            values = pa.array(list(map(phrases.__getitem__, order.tolist())), pa.binary())
            counts = pa.array(np.concatenate([part[1] for part in parts])[order].astype(np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(used)), pa.array(used.astype(np.int32)), pa.ListArray.from_arrays(offsets, values),
                 pa.ListArray.from_arrays(offsets, counts)], names=["lang", "bucket", "phrases", "counts"])

    def add(batches):   # sorted: a language's bucket comes in one piece
        import pyarrow as pa
        at, total, whole = None, {}, True

        def out(done):
            # what has all its places here and is too rare goes; a part's counts are added up below
            kept = [(w, n) for w, n in total.items() if n >= least or not w or not (done and whole)]
            return pa.RecordBatch.from_arrays(
                [pa.array([at[0]] * len(kept), pa.string()), pa.array([w for w, _ in kept], pa.binary()).cast(pa.string()),
                 pa.array([w.count(b" ") + 1 if w else 0 for w, _ in kept], pa.int32()), pa.array([n for _, n in kept], pa.int64())],
                names=["lang", "phrase", "words", "f"])
        for b in batches:
            phrases, counts = b.column(2).flatten().to_pylist(), b.column(3).flatten().to_pylist()
            ends = np.cumsum(b.column(2).value_lengths().to_numpy()).tolist()
            lo = 0
            for key, hi in zip(zip(b.column(0).to_pylist(), b.column(1).to_pylist()), ends):
                if key != at:
                    if at is not None:
                        yield out(True)
                    at, total, whole = key, {}, True
                for w, n in zip(phrases[lo:hi], counts[lo:hi]):
                    total[w] = total.get(w, 0) + n
                lo = hi
                if len(total) > _WORDS:
                    yield out(False)
                    total, whole = {}, False
        if at is not None:
            yield out(True)

    rows = in_batches(_texts(docs)).mapInArrow(name, "lang string, bucket int, phrases array<binary>, counts array<long>")
    rows = rows.repartition("lang", "bucket").sortWithinPartitions("lang", "bucket").mapInArrow(add, "lang string, phrase string, words int, f long")
    counted = rows.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f"))
    return cut(counted.where((F.col("f") >= p.min_count) | (F.col("words") == 0)), "phrases")


# --- scores ---------------------------------------------------------------------------

def scored(freq: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """Candidates with their worst cut, those that a longer one covers dropped:
    ``(lang, phrase, a, l, r, score)``."""
    known = freq.where("words > 0").select("lang", "phrase", "words", "f")
    cand = known.where("words > 1").select("lang", "phrase", "words", F.col("f").alias("a"), F.split("phrase", " ").alias("w"))
    join = lambda start, n: F.array_join(F.slice("w", start, n), " ")
    # each part of each cut, looked up once
    cuts = cand.select("lang", "phrase", "a", "words", "w", F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    sides = cuts.select("lang", "phrase", "a", "k", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), join(F.lit(1), F.col("k")).alias("part")),
        F.struct(F.lit(1).alias("side"), join(F.col("k") + 1, F.col("words") - F.col("k")).alias("part")))).alias("x"))
    sides = sides.select("lang", "phrase", "a", "k", "x.side", "x.part").join(
        known.select("lang", F.col("phrase").alias("part"), "f"), ["lang", "part"])
    both = sides.groupBy("lang", "phrase", "a", "k").agg(F.max(F.expr("if(side = 0, f, null)")).alias("l"), F.max(F.expr("if(side = 1, f, null)")).alias("r"))
    score = F.expr("(cast(2000000 as decimal(18,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))")
    worst = both.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("x"))
    worst = worst.select("lang", "phrase", "a", "x.l", "x.r", "x.score")
    # the most places of a longer candidate around a phrase
    inner = cand.where("words > 2").select("lang", "a", "w", "words", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("n"))
    inner = inner.select("lang", "a", "w", "n", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("n") + 1)).alias("i"))
    around = inner.select("lang", join(F.col("i"), F.col("n")).alias("phrase"), "a").groupBy("lang", "phrase").agg(F.max("a").alias("longer"))
    wide = lambda c: F.col(c).cast("decimal(19,0)")
    covered = F.coalesce(wide("longer") * 100 >= wide("a") * p.cover, F.lit(False))
    return worst.join(around, ["lang", "phrase"], "left").where(~covered).drop("longer")


def collocations(docs: DataFrame, p: PhraseParams = PhraseParams()) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: each language's ``top`` phrases."""
    freq = frequent(docs, p)
    w = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), F.asc("phrase"))
    best = scored(freq, p).withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= p.top)
    total = freq.where("words = 0").select("lang", F.col("f").alias("n"))
    return best.join(total, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
