"""Ranked lexical search through posting lists in geometric blocks.

Documents are scored against items by a BM25-like sum of integers (see
:func:`weights` and :func:`parts`). The index holds, per *shard* of similar
documents, a forward row per document and, per term, the posting list cut into
blocks of similar documents. Each block stores the coordinatewise maximum of
its documents' parts. For an item, the sum of its weights over a block's maxima
is an upper bound of every score in the block, so a block is skipped exactly
when that bound is below the item's present ``k``-th score; the documents of
all other blocks are scored in full. Results are exact.

Plan:

1. One pass over the documents keeps, of each text, its length and the counts
   of the terms that items use (their vocabulary is what a pass may hold:
   items come in blocks of ``block_chars`` of text). Each task adds one row
   with its document frequencies; these are summed in Spark.
2. Centroids are fitted on a bounded sample of those rows (``sample``,
   ``clusters``). The sample's own k-th scores are the first thresholds: they
   are scores of real documents. Terms of an item whose greatest parts together
   stay below its threshold cannot lift a document over it alone, so only the
   lists of the other, *essential* terms need blocks.
3. Documents go to shards of about ``shard_postings`` postings: places on a
   line of clusters, a cluster taking the share that it has in the sample and a
   document a random place in its cluster's share. A hot cluster (copies of
   one text) spans many shards.
4. A shard's lists are clustered each by itself: documents go to the most
   similar of some leaders, and blocks are cut within a leader's documents.
5. A pass over the shards keeps the best ``k`` of each item per task, its
   thresholds growing from shard to shard; a window ranks what the tasks found.

Defined results: null texts and texts without a term match nothing and count
nowhere; very long texts are taken whole; items without a term have no rows;
repeated documents are ranked one by one; repeated items give repeated rows; a
null doc_id ranks after the others of its score; empty tables give no rows;
other columns are never read, so their names cannot clash."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from .common import bounded_sample, cut, in_batches

# What separates terms: ASCII but letters and digits. Letters are lower-cased before.
_SEPARATORS = bytes(c for c in range(128) if not (48 <= c <= 57 or 97 <= c <= 122))
_SPACED = bytes.maketrans(_SEPARATORS, b" " * len(_SEPARATORS))
_DIMS = 64


@dataclass(frozen=True)
class SearchParams:
    """``k``: documents per item; ``block``: postings of a block at most;
    the others as the module says."""
    k: int = 20
    block: int = 64
    clusters: int = 64
    sample: int = 2000
    shard_postings: int = 1 << 17
    block_chars: int = 4 << 20
    seed: str = "search"


def terms(text: str | None) -> list[bytes]:
    """Terms of a whole text, only A-Z lower-cased."""
    return (text or "").encode("utf-8", "surrogatepass").lower().translate(_SPACED).split(b" ")


def term_list(text: str | None) -> list[bytes]:
    return [t for t in terms(text) if t]


def weights(n_docs: int, dfs: list[int]) -> list[int]:
    return [math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1))) for df in dfs]


def length_marks(lengths: list[int], n_docs: int, n_terms: int) -> np.ndarray:
    """``m`` of documents of these lengths (Python's integers: products may pass 64 bits)."""
    return np.array([75 + 25 * n * n_docs // n_terms for n in lengths], dtype=np.int64)


def parts(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What an occurrence count is worth per unit of its term's weight, below a million."""
    tf = tf.astype(np.int64)
    return (1_000_000_000 * tf) // (1000 * tf + 12 * m)


# --- pass 1: forward rows and document frequencies ------------------------------

_FORWARD = T.StructType([T.StructField("kind", T.IntegerType()), T.StructField("doc_id", T.LongType()), T.StructField("n", T.LongType()),
                         T.StructField("salt", T.LongType()), T.StructField("terms", T.ArrayType(T.IntegerType())),
                         T.StructField("counts", T.ArrayType(T.LongType())), T.StructField("tops", T.ArrayType(T.LongType())),
                         T.StructField("shorts", T.ArrayType(T.LongType()))])
_DOC, _TASK = 0, 1


def forward_rows(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """A row (kind 0) per document that holds a term of the vocabulary: its
    number of terms, the vocabulary's terms in it and their counts; a row (kind
    1) per task: documents in ``salt``, their terms in ``n``, per term the
    documents, the greatest count and the least length."""
    size = len(vocabulary)

    def run(batches):
        import pyarrow as pa
        import xxhash
        from pyspark import TaskContext
        task, row = TaskContext.get().partitionId(), 0
        df, top, short = np.zeros(size, np.int64), np.zeros(size, np.int64), np.full(size, np.iinfo(np.int64).max)
        n_docs = n_terms = 0
        get = vocabulary.get

        def out(kind, ids, ns, salts, lists, counts, tops=None, shorts=None):
            longs, n = pa.list_(pa.int64()), len(ns)
            return pa.RecordBatch.from_arrays(
                [pa.array([kind] * n, pa.int32()), pa.array(ids, pa.int64()), pa.array(ns, pa.int64()), pa.array(salts, pa.int64()),
                 pa.array(lists, pa.list_(pa.int32())), pa.array(counts, longs), pa.array(tops or [None] * n, longs),
                 pa.array(shorts or [None] * n, longs)], names=_FORWARD.names)
        for b in batches:
            ids, ns, salts, lists, counts = [], [], [], [], []
            for doc_id, text in zip(b.column("id").to_pylist(), b.column("t")):
                row += 1
                words = terms(text.as_py())
                n = len(words) - words.count(b"")
                if not n:
                    continue
                n_docs, n_terms = n_docs + 1, n_terms + n
                found = [i for i in map(get, words) if i is not None]
                if not found:
                    continue
                at, c = np.unique(np.array(found, np.int32), return_counts=True)
                df[at] += 1
                top[at] = np.maximum(top[at], c)
                short[at] = np.minimum(short[at], n)
                ids.append(doc_id)
                ns.append(n)
                salts.append(xxhash.xxh64_intdigest(b"%d:%d" % (task, row)) >> 1)
                lists.append(at)
                counts.append(c)
            if ids:
                yield out(_DOC, ids, ns, salts, lists, counts)
        if n_docs:
            at = np.flatnonzero(df)
            yield out(_TASK, [None], [n_terms], [n_docs], [at.astype(np.int32)], [df[at]], [top[at]], [short[at]])

    src = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("t")).where("t is not null")
    return in_batches(src).mapInArrow(run, _FORWARD)


@dataclass(frozen=True)
class Collection:
    """Statistics of all documents, per term of the vocabulary where arrays."""
    n_docs: int
    n_terms: int
    df: np.ndarray
    weight: np.ndarray
    greatest: np.ndarray   # bound of weight * part in any document


def collection(forward: DataFrame, size: int) -> Collection:
    per_task = forward.where(F.col("kind") == _TASK)
    n_docs, n_terms = per_task.agg(F.coalesce(F.sum("salt"), F.lit(0)), F.coalesce(F.sum("n"), F.lit(0))).first()
    rows = (per_task.select(F.explode(F.arrays_zip("terms", "counts", "tops", "shorts")).alias("x")).groupBy("x.terms")
            .agg(F.sum("x.counts"), F.max("x.tops"), F.min("x.shorts")).collect())   # at most one row per term of the vocabulary
    df, top, short = np.zeros(size, np.int64), np.ones(size, np.int64), np.zeros(size, np.int64)
    for t, d, a, b in rows:
        df[t], top[t], short[t] = d, a, b
    weight = np.array(weights(n_docs, df.tolist()), np.int64)
    bound = parts(top, length_marks(short.tolist(), n_docs, n_terms)) if n_terms else top
    return Collection(n_docs, n_terms, df, weight, weight * bound * (df > 0))


# --- similarity ------------------------------------------------------------------

def _directions(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Per term of the vocabulary: its dimension and sign in the projection."""
    h = np.arange(size, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    h ^= h >> np.uint64(29)
    return (h % np.uint64(_DIMS)).astype(np.int64), np.where((h >> np.uint64(40)) & np.uint64(1), 1.0, -1.0)


def project(indptr: np.ndarray, term: np.ndarray, part: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Unit vectors of documents in :data:`_DIMS` dimensions."""
    dim, sign = _directions(len(weight))
    n = len(indptr) - 1
    doc = np.repeat(np.arange(n), np.diff(indptr))
    flat = np.bincount(doc * _DIMS + dim[term], sign[term] * weight[term] * part, n * _DIMS).reshape(n, _DIMS)
    return flat / np.maximum(np.linalg.norm(flat, axis=1, keepdims=True), 1e-9)


def centroids(x: np.ndarray, k: int, rounds: int = 6) -> np.ndarray:
    """Spherical k-means from the first ``k`` distinct rows, ordered so that
    neighbours are alike."""
    _, first = np.unique(np.round(x, 6), axis=0, return_index=True)
    c = x[np.sort(first)[:k]]
    for _ in range(rounds):
        mine = np.argmax(x @ c.T, axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, mine, x)
        norm = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(norm > 1e-9, sums / np.maximum(norm, 1e-9), c)
    order, left = [], list(range(len(c)))
    while left:   # a chain of nearest neighbours
        at = left[0] if not order else max(left, key=lambda j: float(c[order[-1]] @ c[j]))
        order.append(at)
        left.remove(at)
    return c[order]


# --- items -----------------------------------------------------------------------

@dataclass(frozen=True)
class Items:
    """A block of items: per item its terms and how often it has each."""
    terms: tuple[np.ndarray, ...]
    counts: tuple[np.ndarray, ...]

    def needed(self, essential: list[np.ndarray]) -> dict[int, tuple[np.ndarray, np.ndarray]]:
        """Per essential term: the items it is essential to, and all terms of those."""
        of: dict[int, list[int]] = {}
        for i, ts in enumerate(essential):
            for t in ts.tolist():
                of.setdefault(t, []).append(i)
        return {t: (np.array(items), np.unique(np.concatenate([self.terms[i] for i in items]))) for t, items in of.items()}


def essential_terms(items: Items, c: Collection, least: np.ndarray) -> list[np.ndarray]:
    """Per item the terms without which no document can reach ``least``."""
    out = []
    for ts, qs, low in zip(items.terms, items.counts, least):
        bound = c.greatest[ts] * qs
        order = np.argsort(bound, kind="stable")
        spare = np.cumsum(bound[order]) < low
        out.append(np.sort(ts[order[~spare]]))
    return out


# --- a shard ---------------------------------------------------------------------

_SHARD = T.StructType([T.StructField("shard", T.LongType()), T.StructField("ids", T.ArrayType(T.LongType()))]
                      + [T.StructField(n, T.ArrayType(T.IntegerType())) for n in
                         ("indptr", "terms", "parts", "list_terms", "list_blocks", "block_sizes", "block_rows", "maxima")])


def list_blocks(rows: np.ndarray, vectors: np.ndarray, block: int) -> list[np.ndarray]:
    """A posting list's documents in blocks of similar ones: each goes to the
    most similar of some leaders, a leader's documents are cut at ``block``."""
    if len(rows) <= block:
        return [rows]
    n = -(-len(rows) // block)
    x = vectors[rows]
    lead = x[np.linspace(0, len(rows) - 1, n).astype(np.int64)]
    likeness = x @ lead.T
    mine = np.argmax(likeness, axis=1)
    order = np.lexsort((-likeness[np.arange(len(rows)), mine], mine))
    out = []
    for part in np.split(rows[order], np.flatnonzero(np.diff(mine[order])) + 1):
        out += [part[i:i + block] for i in range(0, len(part), block)]
    return out


def shard_row(shard: int, ids: list, indptr: np.ndarray, term: np.ndarray, part: np.ndarray, weight: np.ndarray,
              needed: dict[int, tuple[np.ndarray, np.ndarray]], block: int) -> list:
    """Forward rows and blocked posting lists of a shard."""
    vectors = project(indptr, term, part, weight)
    doc = np.repeat(np.arange(len(ids)), np.diff(indptr))
    local = np.unique(term)
    dense = np.zeros((len(ids), len(local) + 1), np.int32)   # last column: terms the shard has not
    col = np.searchsorted(local, term)
    dense[doc, col] = part
    by_term = np.argsort(col, kind="stable")
    starts = np.searchsorted(col[by_term], np.arange(len(local) + 1))
    lists, counts, sizes, rows, maxima = [], [], [], [], []
    for j, t in enumerate(local.tolist()):
        if t not in needed:
            continue
        coords = needed[t][1]
        at = np.searchsorted(local, coords)
        at = np.where((at < len(local)) & (local[np.minimum(at, len(local) - 1)] == coords), at, len(local))
        blocks = list_blocks(doc[by_term[starts[j]:starts[j + 1]]], vectors, block)
        lists.append(t)
        counts.append(len(blocks))
        for b in blocks:
            sizes.append(len(b))
            rows.append(b)
            maxima.append(dense[b][:, at].max(axis=0))
    flat = lambda xs: np.concatenate(xs) if xs else np.zeros(0, np.int32)
    return [shard, ids, indptr, term, part, lists, counts, sizes, flat(rows), flat(maxima)]


class Best:
    """The best ``k`` (score, document) of each item so far, and thresholds."""

    def __init__(self, least: np.ndarray, k: int):
        self.k, self.least, self.found = k, least.copy(), [[] for _ in least]

    def add(self, item: int, scores, ids) -> None:
        self.found[item] += [(-s, d is None, d or 0) for s, d in zip(scores, ids)]

    def settle(self, item: int) -> None:
        """Keep the best; the k-th score is the threshold from now on."""
        f = self.found[item] = sorted(self.found[item])[:self.k]
        if len(f) == self.k:
            self.least[item] = max(self.least[item], -f[-1][0])


def search_shard(row: dict, items: Items, needed: dict, weight: np.ndarray, best: Best) -> tuple[int, int]:
    """Add a shard's documents to ``best``; (blocks looked at, blocks scored)."""
    ids, indptr, term, part = row["ids"], np.array(row["indptr"]), np.array(row["terms"]), np.array(row["parts"], np.int64)
    local, doc = np.unique(term), np.repeat(np.arange(len(ids)), np.diff(indptr))
    dense = np.zeros((len(ids), len(local)), np.int64)
    dense[doc, np.searchsorted(local, term)] = part * weight[term]
    sizes, rows, maxima = np.array(row["block_sizes"], np.int64), np.array(row["block_rows"], np.int64), np.array(row["maxima"], np.int64)
    ends = np.cumsum(sizes)
    # bounds of all blocks for the items that their term is essential to
    open_: dict[int, list] = {}
    at_block = at_max = looked = 0
    for t, n in zip(row["list_terms"], row["list_blocks"]):
        whose, coords = needed[t]
        top = maxima[at_max:at_max + n * len(coords)].reshape(n, len(coords)) * weight[coords]
        at_max += n * len(coords)
        for i in whose.tolist():
            bound = top[:, np.searchsorted(coords, items.terms[i])] @ items.counts[i]
            looked += n
            for b in np.flatnonzero((bound >= best.least[i]) & (bound > 0)).tolist():
                open_.setdefault(i, []).append((int(bound[b]), at_block + b))
        at_block += n
    scored = 0
    for i, blocks in open_.items():
        blocks.sort(reverse=True)
        have = np.searchsorted(local, items.terms[i])
        ok = (have < len(local)) & (local[np.minimum(have, len(local) - 1)] == items.terms[i])
        have, q = have[ok], items.counts[i][ok]
        seen = np.zeros(len(ids), bool)
        at = 0
        while at < len(blocks) and blocks[at][0] >= best.least[i]:
            step = [b for bound, b in blocks[at:at + (1 if at == 0 else 8)] if bound >= best.least[i]]
            at += len(step)
            scored += len(step)
            docs = np.unique(np.concatenate([rows[ends[b] - sizes[b]:ends[b]] for b in step]))
            docs = docs[~seen[docs]]
            seen[docs] = True
            score = dense[np.ix_(docs, have)] @ q
            good = (score >= best.least[i]) & (score > 0)
            best.add(i, score[good].tolist(), [ids[d] for d in docs[good].tolist()])
            best.settle(i)
    return looked, scored


# --- the operator ------------------------------------------------------------------

def rank(docs: DataFrame, items: DataFrame, p: SearchParams = SearchParams()) -> DataFrame:
    """``(item_id, rank, doc_id, score)``: the ``k`` best documents of each item."""
    spark = docs.sparkSession
    kind = items.schema["item_id"].dataType
    texts = (items.select("item_id", F.col("text").cast("string").alias("text")).where("text is not null")
             .groupBy("item_id", "text").agg(F.count("*").alias("copies")))
    texts = cut(texts, "search-items")
    chars = texts.agg(F.coalesce(F.sum(F.length("text")), F.lit(0))).first()[0]
    n_blocks = max(1, -(-chars // p.block_chars))
    out = None
    for b in range(n_blocks):   # a block's items are bounded text
        block = texts.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks)) == b).orderBy("item_id", "text").collect()
        found = _rank_block(spark, docs, block, kind, p)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        return spark.createDataFrame([], T.StructType([T.StructField("item_id", kind), T.StructField("rank", T.IntegerType()),
                                                       T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    return out


def _rank_block(spark: SparkSession, docs: DataFrame, block: list, kind, p: SearchParams) -> DataFrame | None:
    listed = [(r, term_list(r["text"])) for r in block]
    listed = [(r, t) for r, t in listed if t]
    if not listed:
        return None
    vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in listed for t in ts}))}
    ids = [np.unique([vocabulary[t] for t in ts], return_counts=True) for _, ts in listed]
    items = Items(tuple(i for i, _ in ids), tuple(c.astype(np.int64) for _, c in ids))
    forward = cut(forward_rows(docs, vocabulary), "search-forward")
    c = collection(forward, len(vocabulary))
    if not c.n_docs:
        return None
    index, needed, least = build(forward, items, c, p)
    return _search(spark, index, listed, items, needed, least, c, kind, p)


def build(forward: DataFrame, items: Items, c: Collection, p: SearchParams):
    """(index of shards, what each list serves, first thresholds)."""
    rows = forward.where(F.col("kind") == _DOC).select("doc_id", "n", "salt", "terms", "counts")
    sample = bounded_sample(rows, "salt", p.sample, p.seed).collect()   # at most ``sample`` rows, each bounded by the vocabulary
    sample.sort(key=lambda r: r["salt"])
    indptr = np.concatenate([[0], np.cumsum([len(r["terms"]) for r in sample])]).astype(np.int64)
    term = np.array([t for r in sample for t in r["terms"]], np.int64)
    m = np.repeat(length_marks([r["n"] for r in sample], c.n_docs, c.n_terms), np.diff(indptr))
    part = parts(np.array([t for r in sample for t in r["counts"]], np.int64), m)
    # thresholds: k-th scores among the sample's documents
    doc = np.repeat(np.arange(len(sample)), np.diff(indptr))
    least = np.zeros(len(items.terms), np.int64)
    query = np.zeros(len(c.weight), np.int64)
    for i, (ts, qs) in enumerate(zip(items.terms, items.counts)):
        query[ts] = qs
        score = np.zeros(len(sample), np.int64)
        np.add.at(score, doc, query[term] * c.weight[term] * part)
        query[ts] = 0
        if len(score) >= p.k:
            least[i] = np.sort(score)[-p.k]
    needed = items.needed(essential_terms(items, c, least))
    x = project(indptr, term, part, c.weight)
    centre = centroids(x, p.clusters) if len(sample) else np.zeros((1, _DIMS))
    share = np.bincount(np.argmax(x @ centre.T, axis=1), minlength=len(centre)) + 1.0
    share /= share.sum()
    before = np.concatenate([[0.0], np.cumsum(share)[:-1]])
    n_shards = max(1, -(-int(c.df.sum()) // p.shard_postings))
    n_docs, n_terms, weight = c.n_docs, c.n_terms, c.weight

    def place(batches):
        import pyarrow as pa
        for b in batches:
            ns, term_col, count_col = b.column("n").to_pylist(), b.column("terms"), b.column("counts")
            indptr = np.concatenate([[0], np.cumsum(term_col.value_lengths().to_numpy())]).astype(np.int64)
            term, tf = term_col.flatten().to_numpy(), count_col.flatten().to_numpy()
            part = parts(tf, np.repeat(length_marks(ns, n_docs, n_terms), np.diff(indptr)))
            mine = np.argmax(project(indptr, term, part, weight) @ centre.T, axis=1)
            u = b.column("salt").to_numpy() / float(1 << 63)
            shard = np.minimum(((before[mine] + share[mine] * u) * n_shards).astype(np.int64), n_shards - 1)
            lists = pa.ListArray.from_arrays(pa.array(indptr, pa.int32()), pa.array(part, pa.int32()))
            yield pa.RecordBatch.from_arrays([pa.array(shard), b.column("doc_id"), b.column("salt"), term_col, lists],
                                             names=["shard", "doc_id", "salt", "terms", "parts"])

    placed = in_batches(rows).mapInArrow(place, "shard long, doc_id long, salt long, terms array<int>, parts array<int>")
    block = p.block

    def pack(group):
        import pyarrow as pa
        group = group.sort_by("salt").combine_chunks()
        term_col, part_col = group.column("terms").combine_chunks(), group.column("parts").combine_chunks()
        indptr = np.concatenate([[0], np.cumsum(term_col.value_lengths().to_numpy())]).astype(np.int32)
        row = shard_row(group.column("shard")[0].as_py(), group.column("doc_id").to_pylist(), indptr, term_col.flatten().to_numpy(),
                        part_col.flatten().to_numpy(), weight, needed, block)
        arrays = [pa.array([row[0]], pa.int64()), pa.array([row[1]], pa.list_(pa.int64()))]
        arrays += [pa.array([np.asarray(v, np.int32)], pa.list_(pa.int32())) for v in row[2:]]
        return pa.Table.from_arrays(arrays, names=_SHARD.names)

    return cut(placed.groupBy("shard").applyInArrow(pack, _SHARD), "search-index"), needed, least


def _search(spark, index, listed, items, needed, least, c, kind, p) -> DataFrame:
    weight, k = c.weight, p.k

    def run(batches):
        import pyarrow as pa
        best = Best(least, k)
        for b in batches:
            for j in range(b.num_rows):
                row = {}
                for name in _SHARD.names[1:]:
                    v = b.column(name)[j].values
                    row[name] = v.to_pylist() if name in ("ids", "list_terms", "list_blocks") else v.to_numpy()
                search_shard(row, items, needed, weight, best)
        rows = [(i, -s, None if none else d) for i, f in enumerate(best.found) for s, none, d in f]
        yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.int64()),
                                          pa.array([r[2] for r in rows], pa.int64())], names=["item", "score", "doc_id"])

    found = index.mapInArrow(run, "item int, score long, doc_id long")
    w = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(i, r["item_id"], r["copies"]) for i, (r, _) in enumerate(listed)], T.StructType([
        T.StructField("item", T.IntegerType()), T.StructField("item_id", kind), T.StructField("copies", T.LongType())]))
    out = ranked.join(F.broadcast(names), "item")   # a block of items: bounded text
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))).select("item_id", "rank", "doc_id", "score")
