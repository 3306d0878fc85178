"""Mixing sources to target weights by capped water-filling, DataFrame
functions only.

Sources share the corpus's size by weight; a source's target stops at
``max_epochs`` times its own size, and the excess is shared by weight among the
others until none is above. The level rises monotonically: each round is one
aggregation over the table of sources (one row each), of which four numbers
reach the driver. A document is then repeated by the whole part of its source's
target over size; the rest of the target is filled with one more repetition of
documents in a seeded order, up to the document that no longer fits. The gap
that it leaves is filled with later documents, class by class of sizes (powers
of two, longest first), in the same order up to the first of the class that no
longer fits. Last, one more document is taken if that comes nearer to the
target: the next of a class, or the one that did not fit at first instead of
what filled its gap. Without repeated rows a source misses its target by at most
half of the document that did not fit at first, and by less than twice the
shortest of the later documents that fit the gap and are left out.

Finding these places takes histograms of the order per source (and class) and
running sums within one bucket of each, so that no source is sorted as a whole.
What is gathered of a source to fill the gap is at most the gap's words in each
class, which follows the longest document and not the corpus.

Defined results: null text has size 0; null source is a source, last; a null
doc_id is ordered by its text; repeated rows are repeated, all or none of them
(they are one place of the order, of their sizes' sum); with no words all
targets are 0."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from .common import WORD, cut, small

#: Buckets of the seeded order in each source.
BUCKETS = 4096


def ranked_sources(sizes: DataFrame) -> DataFrame:
    """``(source, source_size)`` with ``rank`` from 0 by code point, null last.
    A distributed sort numbers the rows; only one row per partition is summed."""
    ordered = cut(sizes.orderBy(F.col("source").asc_nulls_last()).withColumn("at", F.monotonically_increasing_id()))
    part = F.shiftright("at", 33)
    counts = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n"))
    before = counts.select("part", (F.sum("n").over(Window.orderBy("part")) - F.col("n")).alias("before"))
    return (ordered.withColumn("part", part).join(F.broadcast(before), "part")
            .select("source", "source_size", (F.col("before") + F.col("at") - F.shiftleft(F.col("part"), 33)).alias("rank")))


def targets(sizes: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3) -> DataFrame:
    """``(source, source_size, weight, target)`` of ``(source, source_size)``."""
    w = F.array(*[F.lit(int(x)) for x in weights])
    src = cut(ranked_sources(sizes).withColumn("weight", w[(F.col("rank") % len(weights)).cast("int")].cast("long")))
    cap = F.col("source_size") * max_epochs
    total = src.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]
    level, filled = (0.0, None)
    while True:   # ends: every round caps a source more or is the last
        above = F.col("weight") * F.lit(level) > cap if filled is not None else F.lit(False)
        spent, share, n = src.agg(F.coalesce(F.sum(F.when(above, cap)), F.lit(0)),
                                  F.coalesce(F.sum(F.when(~above, F.col("weight"))), F.lit(0)),
                                  F.count(F.when(above, 1))).first()
        if n == filled:
            break
        filled, level = n, ((total - spent) / share if share else level)
    return src.select("source", "source_size", "weight",
                      F.when(F.col("weight") * F.lit(level) > cap, cap.cast("double"))
                      .otherwise(F.col("weight") * F.lit(level)).alias("target"))


def mix(docs: DataFrame, weights: Sequence[int] = (5, 2, 1), max_epochs: int = 3, seed: str = "mix") -> DataFrame:
    """``docs`` with ``size``, ``source_size``, ``target`` and ``repetitions``
    (0 to ``max_epochs``); a row for each row."""
    size = F.coalesce(F.regexp_count(F.col("text"), F.lit(WORD)), F.lit(0)).cast("long")
    # 52 bits of a hash of the seed and the id (a text without one: of the text)
    key = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.concat(F.lit("-"), F.col("text")), F.lit(""))))
    u = F.conv(F.substring(key, 1, 13), 16, 10).cast("long")
    mine = ["size", "source_size", "target", "repetitions"]
    named = docs.withColumns({"__size": size, "__u": u, "__bucket": F.shiftright(u, 40).cast("int")})
    # what the plan works on: without the texts
    narrow = cut(named.select("doc_id", "source", "__size", "__u", "__bucket"))
    hist = cut(narrow.groupBy("source", "__bucket").agg(F.sum("__size").alias("n")))
    plan = targets(hist.groupBy("source").agg(F.sum("n").alias("source_size")), weights, max_epochs)
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(F.lit(0)).cast("long")
    plan = cut(plan.withColumn("whole", whole).withColumn("rest", F.col("target") - F.col("whole") * F.col("source_size")))
    # the bucket in which each source's rest ends: a source has BUCKETS rows here at most
    run = Window.partitionBy("source").orderBy("__bucket")
    ends = (hist.join(plan, hist["source"].eqNullSafe(plan["source"])).select(hist["source"], "__bucket", "n", "rest")
            .withColumn("below", F.sum("n").over(run) - F.col("n"))
            .where((F.col("below") < F.col("rest")) & (F.col("below") + F.col("n") >= F.col("rest")))
            .groupBy("source").agg(F.max("__bucket").alias("end_bucket"), F.max("below").alias("below")))
    rule = cut(plan.alias("p").join(ends.alias("e"), F.expr("p.source <=> e.source"), "left")
               .selectExpr("p.*", "coalesce(e.end_bucket, -1) as end_bucket", "coalesce(e.below, 0) as below"))
    # running sums within the ending bucket only, up to and with a place of the order
    place = F.struct("__u", "doc_id", "__size")
    last = (narrow.alias("d").join(small(rule).alias("r"), F.expr("d.source <=> r.source and d.__bucket = r.end_bucket"))
            .select("d.source", "d.doc_id", "d.__size", "d.__u", "r.rest", "r.below")
            .withColumn("upto", F.col("below") + F.sum("__size").over(Window.partitionBy("source").orderBy("__u", "doc_id", "__size"))))
    fits = F.col("upto") <= F.col("rest")
    cuts = last.groupBy("source").agg(
        F.max(F.when(fits, place)).alias("upto"), F.max(F.when(fits, F.col("upto"))).alias("filled"),
        F.min(F.when(~fits, place)).alias("over"), F.min(F.when(~fits, F.col("upto") - F.col("rest"))).alias("over_by"))
    rule = cut(rule.alias("r").join(cuts.alias("c"), F.expr("r.source <=> c.source"), "left")
               .selectExpr("r.*", "c.upto", "c.over", "c.over_by",
                           "if(r.end_bucket < 0, 0D, r.rest - coalesce(c.filled, r.below)) as gap"))
    return _apply(named, _fill_gaps(narrow, rule), docs.columns, mine)


def _size_class(size):
    """Binary digits of a size."""
    return F.length(F.bin(size))


def _later(size, u_place):
    """Whether a document comes after those taken first (of rule ``r``) and fits the gap."""
    return ((size > 0) & (size <= F.col("r.gap")) & (F.col("d.__bucket") >= F.col("r.end_bucket"))
            & ((F.col("d.__bucket") > F.col("r.end_bucket")) | F.col("r.upto").isNull() | (u_place > F.col("r.upto"))))


def _fill_gaps(narrow: DataFrame, rule: DataFrame) -> DataFrame:
    """``rule`` with ``uptos`` (class of sizes → last place of the order that is
    taken to fill the gap), and ``upto`` moved by one where that is nearer."""
    mine = F.struct("d.__u", "d.doc_id", "d.__size")
    later = (narrow.alias("d").join(small(rule).alias("r"), F.expr("d.source <=> r.source"))
             .where(_later(F.col("d.__size"), mine))
             .select("d.source", _size_class(F.col("d.__size")).alias("class"), "d.__bucket", "d.__u", "d.doc_id", "d.__size", "r.gap"))
    # the buckets of each class in which its words reach the gap
    hist = later.groupBy("source", "class", "__bucket").agg(F.sum("__size").alias("n"), F.first("gap").alias("gap"))
    below = F.sum("n").over(Window.partitionBy("source", "class").orderBy("__bucket")) - F.col("n")
    bound = cut(hist.withColumn("below", below).where("below < gap").groupBy("source", "class").agg(F.max("__bucket").alias("upto_bucket")))
    run = F.sum("__size").over(Window.partitionBy("source", "class").orderBy("__u", "doc_id", "__size"))
    near = cut(later.alias("l").join(small(bound).alias("b"), F.expr("l.source <=> b.source and l.class = b.class and l.__bucket <= b.upto_bucket"))
               .select("l.source", "l.class", "l.__u", "l.doc_id", "l.__size", "l.gap").withColumn("run", run)
               .where(F.col("run") - F.col("__size") < F.col("gap")))
    # longest class first: as many of its places as fit what the classes before have left
    classes = (near.groupBy("source", "class").agg(F.first("gap").alias("gap"), F.collect_set("run").alias("runs"))
               .groupBy("source").agg(F.first("gap").alias("gap"), F.sort_array(F.collect_list(F.struct("class", "runs")), asc=False).alias("classes")))
    filled = classes.selectExpr("source", """aggregate(classes, named_struct('gap', gap,
            'taken', cast(array() as array<struct<class: int, words: bigint, more: bigint>>)), (s, c) ->
          transform(array(coalesce(array_max(filter(c.runs, r -> r <= s.gap)), 0L)), words -> named_struct('gap', s.gap - words,
            'taken', concat(s.taken, array(named_struct('class', c.class, 'words', words, 'more', array_min(filter(c.runs, r -> r > words)) - words)))))[0]) as f""")
    # the class whose next place is shortest (of equal ones the lowest class), and by how much it exceeds the gap left
    filled = cut(filled.selectExpr("source", "f.gap as left_gap", "f.taken as taken",
                                   "array_min(transform(filter(f.taken, t -> t.more is not null), t -> named_struct('more', t.more, 'class', t.class))) as next"))
    rule = cut(rule.alias("r").join(filled.alias("f"), F.expr("r.source <=> f.source"), "left")
               .selectExpr("r.*", "coalesce(f.left_gap, r.gap) as left_gap", "f.taken", "f.next", "f.next.more - f.left_gap as next_by"))
    over = "over_by < least(left_gap, coalesce(next_by, left_gap))"
    rule = cut(rule.selectExpr("* except (upto, taken)", f"if({over}, over, upto) as upto", f"""if({over}, null, transform(taken,
        t -> named_struct('class', t.class, 'words', t.words + if(next_by < left_gap and t.class = next.class, t.more, 0L)))) as taken"""))
    words = rule.select("source", F.explode("taken").alias("t")).select("source", "t.class", "t.words")
    uptos = (near.alias("n").join(small(words).alias("w"), F.expr("n.source <=> w.source and n.class = w.class and n.run <= w.words"))
             .groupBy("n.source", "n.class").agg(F.max(F.struct("n.__u", "n.doc_id", "n.__size")).alias("upto"))
             .groupBy("source").agg(F.map_from_entries(F.collect_list(F.struct("class", "upto"))).alias("uptos")))
    return cut(rule.alias("r").join(uptos.alias("u"), F.expr("r.source <=> u.source"), "left")
               .selectExpr("r.source", "r.source_size", "r.target", "r.whole", "r.end_bucket", "r.upto", "r.gap", "u.uptos"))


def _apply(named: DataFrame, rule: DataFrame, columns: list[str], mine: list[str]) -> DataFrame:
    """The rule of each source on its documents: sent to each task where it is
    small, else a shuffled join, of which adaptive execution splits hot sources."""
    joined = named.alias("d").join(small(rule).alias("r"), F.expr("d.source <=> r.source"))
    place = F.struct("d.__u", "d.doc_id", "d.__size")
    size = F.col("d.__size")
    more = (F.when(F.col("d.__bucket") < F.col("r.end_bucket"), 1)
            .when((F.col("d.__bucket") == F.col("r.end_bucket")) & F.col("r.upto").isNotNull() & (place <= F.col("r.upto")), 1)
            .when(_later(size, place) & (place <= F.try_element_at(F.col("r.uptos"), _size_class(size))), 1).otherwise(0))
    out = {"size": F.col("d.__size"), "source_size": F.col("r.source_size"), "target": F.col("r.target"),
           "repetitions": F.col("r.whole") + more}
    return joined.select(*[F.col(f"d.`{c}`") for c in columns if c not in mine], *[out[m].alias(m) for m in mine])


def digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("repetitions") * F.col("size")).alias("taken"))
