"""SimHash near-duplicates through a byte-position inverted index.

A document's fingerprint has one bit per bit position of its shingles' XXH64
values, set where over half of the shingles set it. Two fingerprints that
differ in at most ``d`` bits agree in at least ``8 - d`` of their eight bytes.
The inverted index therefore lists fingerprints under the bytes they have at
given positions. A list for a single byte would hold a 256th of the corpus, so
a posting joins ``k`` positions: among the first ``d + k`` positions a pair at
distance ``d`` shares at least ``k``, so it meets in one of the
``C(d + k, k)`` lists (for d = 2, k = 5: 21 lists of 40 bits). In a list the
shared positional bytes of each pair are tallied over all eight positions,
pairs below the guaranteed ``8 - d`` go, and the bit distance verifies the
rest.

Lists longer than ``hot`` fingerprints are not paired. Their members differ
only in the bytes outside the posting, and there two of them lie within two
bits exactly if a value one bit (or none) from both exists: each member is
listed under those values (25 for 40 fixed bits), and members of one value are
linked in a star. That is exact at any length, and a value's members are at
most 25. Equal fingerprints are one row throughout.

Defined results: null and empty texts have fingerprint zero and are linked
like any other; repeated rows give repeated rows; a null doc_id never becomes
a component's id unless the component has no other; very long texts are taken
whole; an empty table gives no rows; only doc_id and text are read, so other
columns' names cannot clash (``keep_one`` returns all columns as they are)."""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import cut, in_batches
from .components import connected_components

_CHUNK = 1 << 16


def fingerprint_of(text: str | None, shingle: int = 3, seed: int = 42) -> int:
    """Signed 64-bit fingerprint of a whole text."""
    import numpy as np
    import xxhash
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII case and white space only
    if not words:
        return 0
    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    starts = (ends - sizes).tolist()
    ends = ends.tolist()
    k = min(shingle, len(words))
    digest = xxhash.xxh64_intdigest
    n = len(words) - k + 1
    ones = np.zeros(64, np.int64)
    for at in range(0, n, _CHUNK):
        to = min(n, at + _CHUNK)
        h = np.array([digest(joined[s:e], seed) for s, e in zip(starts[at:to], ends[at + k - 1:to + k - 1])], dtype="<u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * ones > n).astype(np.uint8), bitorder="little").view("<i8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, seed: int = 42) -> DataFrame:
    """``(doc_id, fp)``: one row per row of ``docs``."""
    src = docs.select("doc_id", F.col("text").cast("string").alias("text"))
    schema = T.StructType([src.schema["doc_id"], T.StructField("fp", T.LongType())])

    def run(batches):
        import pyarrow as pa
        for b in batches:
            fp = pa.array([fingerprint_of(t.as_py(), shingle, seed) for t in b.column("text")], pa.int64())
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), fp], names=["doc_id", "fp"])
    return in_batches(src).mapInArrow(run, schema)


def _byte(fp: Column, p: int) -> Column:
    return F.shiftrightunsigned(fp, 8 * p).bitwiseAND(F.lit(255))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _shared_bytes(x: Column, y: Column) -> Column:
    return sum(((_byte(x, p) == _byte(y, p)).cast("int") for p in range(8)), F.lit(0))


def _postings(max_bits: int, joined: int) -> list[tuple[int, int]]:
    """(list id, mask of the positions that it fixes)."""
    out = []
    for i, sub in enumerate(combinations(range(max_bits + joined), joined)):
        out.append((i, _signed(sum(255 << (8 * p) for p in sub))))
    return out


def near_links(distinct: DataFrame, max_bits: int = 2, hot: int = 64) -> DataFrame:
    """Links ``(a, b)`` between distinct fingerprints ``fp`` that connect all
    that differ in ``max_bits`` (0 to 2) bits or fewer, and only those."""
    if not 0 <= max_bits <= 2:
        raise ValueError("max_bits must be 0, 1 or 2: longer lists are split exactly for these distances")
    if max_bits == 0:
        return distinct.select(F.col("fp").alias("a"), F.col("fp").alias("b")).limit(0)
    lists = _postings(max_bits, 5)
    index = distinct.select("fp", F.explode(F.array([
        F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("k")) for i, m in lists])).alias("p")
    ).select("fp", "p.i", "p.k")
    sizes = cut(index.groupBy("i", "k").agg(F.count("*").alias("n")).where("n > 1"))
    short = index.join(sizes.where(F.col("n") <= hot), ["i", "k"]).groupBy("i", "k").agg(F.collect_list("fp").alias("fps"))
    near = lambda x, y: ((x < y) & (_shared_bytes(x, y) >= 8 - max_bits)
                         & (F.bit_count(x.bitwiseXOR(y)) <= max_bits))
    pairs = short.select(F.explode(F.flatten(F.transform("fps", lambda x: F.transform(
        F.filter("fps", lambda y: near(x, y)), lambda y: F.struct(x.alias("a"), y.alias("b"))))) ).alias("l")).select("l.*")
    long = index.join(sizes.where(F.col("n") > hot), ["i", "k"])
    return pairs.union(_star_links(long, lists, max_bits)).distinct()


def _star_links(members: DataFrame, lists: list[tuple[int, int]], max_bits: int) -> DataFrame:
    """Links within long lists through the values between two members."""
    fp, picks = F.col("fp"), None
    for i, mask in lists:
        free = [_signed(1 << b) for b in range(64) if not (mask >> b) & 1]
        if max_bits == 2:   # the value itself and each one bit away
            values = F.array([fp] + [fp.bitwiseXOR(F.lit(b)) for b in free])
        else:               # one bit taken away; kept apart by that bit
            values = F.array([fp.bitwiseAND(F.lit(~b)) for b in free])
        picks = F.when(F.col("i") == i, values) if picks is None else picks.when(F.col("i") == i, values)
    between = members.select("i", "fp", F.posexplode(picks).alias("bit", "mid"))
    keys = ["i", "mid"] if max_bits == 2 else ["i", "bit", "mid"]
    stars = between.groupBy(*keys).agg(F.min("fp").alias("a"), F.collect_list("fp").alias("fps"))
    return stars.select("a", F.explode(F.filter("fps", lambda x: x != F.col("a"))).alias("b"))


def components_of(fps: DataFrame, max_bits: int = 2, hot: int = 64) -> DataFrame:
    """``(fp, component_id)`` of ``(doc_id, fp)`` rows: the smallest doc_id
    reachable over links of ``max_bits`` or fewer."""
    distinct = cut(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(near_links(distinct, max_bits, hot))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root"))
    ids = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    return rooted.join(ids, "root").select("fp", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, seed: int = 42, max_bits: int = 2, hot: int = 64) -> DataFrame:
    """``(doc_id, fp, component_id)``, one row per row of ``docs``."""
    fps = cut(fingerprints(docs, shingle, seed))
    return fps.join(components_of(fps, max_bits, hot), "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, shingle: int = 3, seed: int = 42, max_bits: int = 2, hot: int = 64, bits: int = 1 << 26) -> DataFrame:
    """``docs`` with one row of each component: that of the smallest doc_id, of
    rows that share it the one whose text hashes lowest, of rows alike in both
    any one. Each row is judged by its own text, whatever doc_id it has or
    shares; one without a doc_id stays only where its component has no other.

    The decisions are made on narrow rows. A bitmap of ``bits`` bits (a fixed
    size, sent to every task) tells which rows may have to go; only these,
    about as many as there are to remove, are shuffled to look their decision
    up. The others pass through with their texts."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    known = F.coalesce(F.col("doc_id"), F.lit(0).cast(docs.schema["doc_id"].dataType))
    key = F.struct(F.col("doc_id").isNull().alias("none"), known.alias("doc_id"), F.xxhash64(text).alias("h1"), F.hash(text).alias("h2"))
    fps = cut(fingerprints(docs.select(key.alias("doc_id"), "text"), shingle, seed).select(F.col("doc_id").alias("key"), "fp"))
    rows = cut(fps.groupBy("key", "fp").agg(F.count("*").alias("n")))   # equal rows once
    distinct = cut(rows.groupBy("fp").agg(F.min(F.struct("key", "n")).alias("low"), F.count("*").alias("n_keys")))
    roots = connected_components(near_links(distinct.select("fp"), max_bits, hot))
    rooted = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "low", "n_keys", F.coalesce("root", "fp").alias("root"))
    first = cut(rooted.groupBy("root").agg(F.min("low").alias("low"), F.sum("n_keys").alias("n_keys")))
    # all but the first row of each component, and first rows that stand there more than once
    stays = first.select("low.*")
    alone = first.where((F.col("n_keys") == 1) & (F.col("low.n") == 1)).select(F.col("low.key").alias("key"))
    doubtful = cut(rows.select("key").join(alone, "key", "left_anti")
                   .join(stays.select("key", F.lit(True).alias("stays"), "n"), "key", "left")
                   .where("stays is null or n > 1").select("key", F.coalesce("stays", F.lit(False)).alias("stays")), "doubtful")
    at = lambda k: F.pmod(F.xxhash64(k), F.lit(bits))
    per = min(bits, 32768)
    parts = (doubtful.select(at(F.col("key")).alias("at")).select(F.floor(F.col("at") / per).cast("long").alias("__part"), F.pmod("at", F.lit(per)).alias("bit"))
             .groupBy("__part").agg(F.bitmap_construct_agg("bit").alias("__bits")))
    found = docs.withColumn("__key", key).withColumn("__at", at(F.col("__key"))).withColumn("__part", F.floor(F.col("__at") / per).cast("long"))
    found = found.join(F.broadcast(parts), "__part", "left")   # bits / 8 bytes
    bit = F.pmod(F.col("__at"), F.lit(per))
    byte = F.conv(F.hex(F.substring(F.col("__bits"), (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    hit = F.col("__bits").isNotNull() & (F.pmod(F.floor(byte / F.pow(F.lit(2), F.pmod(bit, F.lit(8)))), F.lit(2)) == 1)
    marked = found.withColumn("__hit", hit)
    columns = [F.col(f"`{c}`") for c in docs.columns]
    through = marked.where("not __hit").select(columns)
    looked = marked.where("__hit").join(doubtful.select(F.col("key").alias("__key"), F.col("stays").alias("__stays")), "__key", "left")
    other = looked.where("__stays is null").select(columns)   # shares a bit only
    once = looked.where("__stays").dropDuplicates(["__key"]).select(columns)
    return through.unionByName(other).unionByName(once)
