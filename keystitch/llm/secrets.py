"""Secret scans with two character Markov models, DataFrame functions only.

Fixed patterns find the base spans. Beyond them, every token of at least
``min_chars`` is scored: the log-likelihood of its character transitions under
a model of random strings, less that under a model of ordinary identifiers.
Both models are first-order chains over 65 symbols, counted with Spark from
labelled samples: ordinary strings are the words of a bounded sample of the
documents (base spans taken out) in the forms identifiers take, random strings
are encodings of seeded hashes. The counted table has at most 2 x 65 x 65 rows,
whatever the input; scoring reads it as a literal array.

Defined results: null and empty texts have no spans; repeated rows give
repeated rows; with no documents the models are flat and add nothing."""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import bounded_sample, let, matches, prefix

# Fixed patterns (ASCII letters in either case where written so) and least lengths.
ASSIGN = (r"""([Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]"""
          r"""|[Aa][Pp][Ii]_?[Kk][Ee][Yy])["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
MIN_VALUE, MIN_ACCESS, MIN_HEX = 12, 18, 16

#: Symbols of the chains; anything else counts as the last one.
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789_-+"
SPAN = "array<struct<start:bigint,kind:int,end:bigint>>"


@dataclass(frozen=True)
class SecretParams:
    """``sample_docs``: bound of the documents that the ordinary chain is
    counted from; ``min_chars``: least token; ``min_total``/``min_mean``: least
    log-likelihood ratio of a token and per transition."""
    sample_docs: int = 400
    min_chars: int = 20
    min_total: float = 14.0
    min_mean: float = 0.7
    seed: str = "secrets"


def _no_spans() -> Column:
    return F.array().cast(SPAN)


def _as_spans(found: Column, kind: str) -> Column:
    return F.transform(found, lambda m: F.struct(m["start"].alias("start"), F.lit(KINDS.index(kind)).alias("kind"), m["end"].alias("end")))


def base_spans(text: Column) -> Column:
    """Base spans of a text, sorted by start, then kind."""
    rx = F.lit(ASSIGN)
    # the value of a match is what follows its separator
    value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    assign = F.when((text.contains("=") | text.contains(":")) & text.rlike(ASSIGN), _as_spans(
        F.filter(matches(text, rx, F.length), lambda m: F.length(value(m["value"])) >= MIN_VALUE), "assign"))
    access = F.when(text.contains("AKIA"), _as_spans(
        F.filter(matches(text, F.lit(ACCESS), F.length), lambda m: F.length(m["value"]) >= MIN_ACCESS), "access"))
    # runs are maximal, so runs of the least length are the matches that stay
    long_hex = f"[0-9a-f]{{{MIN_HEX},}}"
    hexes = F.when(text.rlike(long_hex), _as_spans(matches(text, F.lit(long_hex), F.length), "hex"))
    parts = [F.coalesce(x.cast(SPAN), _no_spans()) for x in (assign, access, hexes)]
    return F.sort_array(F.concat(*parts))


def labelled_strings(docs: DataFrame, p: SecretParams) -> DataFrame:
    """``(random, s, n)``: labelled strings and how often each was seen."""
    ids = bounded_sample(docs.select("doc_id").where("doc_id is not null"), "doc_id", p.sample_docs, p.seed).distinct()
    sample = (docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
              .join(F.broadcast(ids), "doc_id").dropDuplicates(["doc_id"]))   # sample_docs ids at most
    plain = F.regexp_replace(F.regexp_replace(F.regexp_replace("text", ASSIGN, " "), ACCESS, " "), f"[0-9a-f]{{{MIN_HEX},}}", " ")
    words = (sample.select(F.explode(F.regexp_extract_all(plain, F.lit("[A-Za-z]{2,}"), F.lit(0))).alias("w"))
             .groupBy("w").agg(F.count("*").alias("n")))
    small, tail = F.lower("w"), F.pmod(F.xxhash64(F.lit(p.seed), "w"), F.lit(10000)).cast("string")
    forms = F.array(F.col("w"), small, F.upper("w"), F.initcap(small), F.concat(small, F.lit("_"), small),
                    F.concat(small, F.initcap(small)), F.concat(small, F.lit("-"), small), F.concat(F.upper("w"), F.lit("_"), F.upper("w")),
                    F.concat(small, F.lit("_"), tail), F.concat(small, F.lit("-"), tail, F.lit("-"), tail))
    ordinary = words.select(F.lit(False).alias("random"), F.explode(forms).alias("s"), "n")
    hashed = lambda k: F.sha2(F.concat_ws(":", F.lit(p.seed), F.lit(k), F.col("doc_id").cast("string")), 256)
    codes = F.array(F.base64(F.unhex(hashed(1))), F.base64(F.unhex(hashed(2))), hashed(3),
                    F.concat(*[F.conv(F.substring(hashed(4), 1 + 12 * i, 12), 16, 36) for i in range(4)]),
                    F.lower(F.concat(*[F.conv(F.substring(hashed(5), 1 + 12 * i, 12), 16, 36) for i in range(4)])))
    chance = sample.select(F.lit(True).alias("random"), F.explode(codes).alias("s"), F.lit(1).cast("long").alias("n"))
    return ordinary.union(chance.withColumn("s", F.regexp_replace("s", "=+$", "")))


def _code(ch: Column) -> Column:
    at = F.instr(F.lit(ALPHABET), ch)
    return F.when((ch == "") | (at == 0), F.lit(len(ALPHABET) - 1)).otherwise(at - 1)


def transitions(s: Column) -> Column:
    """Codes of a string's neighbouring characters, as one number each."""
    n = len(ALPHABET)
    codes = F.transform(F.filter(F.split(s, ""), lambda c: c != ""), _code)
    return let(codes, lambda c: F.zip_with(F.slice(c, F.lit(1), F.greatest(F.size(c) - 1, F.lit(0))),
                                           F.slice(c, F.lit(2), F.greatest(F.size(c) - 1, F.lit(0))), lambda x, y: x * n + y))


@dataclass(frozen=True)
class MarkovModel:
    """Log-likelihood ratio (random less ordinary) of each transition."""
    ratio: tuple[float, ...]


def train(docs: DataFrame, p: SecretParams = SecretParams()) -> MarkovModel:
    """Counts transitions of the labelled strings; at most 2 x 65 x 65 rows come back."""
    counted = (labelled_strings(docs, p).select("random", "n", F.explode(transitions(F.col("s"))).alias("t"))
               .groupBy("random", "t").agg(F.sum("n").alias("n")).collect())
    n = len(ALPHABET)
    logs = {}
    for label in (False, True):
        seen = {r["t"]: r["n"] for r in counted if r["random"] == label}
        rows = [sum(seen.get(a * n + b, 0) for b in range(n)) for a in range(n)]
        logs[label] = [math.log((seen.get(a * n + b, 0) + 0.5) / (rows[a] + 0.5 * n)) for a in range(n) for b in range(n)]
    return MarkovModel(tuple(round(r - o, 4) for r, o in zip(logs[True], logs[False])))


def log_ratio(s: Column, model: MarkovModel) -> Column:
    """Summed log-likelihood ratio of a string."""
    table = F.split(F.lit(",".join(f"{x:.4f}" for x in model.ratio)), ",").cast("array<double>")
    return F.aggregate(transitions(s), F.lit(0.0), lambda acc, t: acc + table[t])


def _random_spans(text: Column, base: Column, model: MarkovModel, p: SecretParams) -> Column:
    token = f"[A-Za-z0-9+/_=-]{{{p.min_chars},}}"

    def odd(m):
        n = F.length(m["value"]) - 1
        total = log_ratio(m["value"], model)
        return m["value"].rlike("[A-Za-z]") & let(total, lambda t: (t >= p.min_total) & (t >= p.min_mean * n))
    found = F.when(text.rlike(token), let(F.filter(matches(text, F.lit(token), F.length), odd), lambda ms: F.when(
        F.size(ms) == 0, _no_spans()).otherwise(_as_spans(_clear(ms, base), "random").cast(SPAN))))
    return F.coalesce(found, _no_spans())


def _clear(found: Column, base: Column) -> Column:
    """``found`` without what overlaps a base span, in one sorted sweep: a span
    is clear if no base span that starts before its end reaches beyond its
    start. At equal places the span comes first, as touching is no overlap."""
    longs = lambda x, at, is_base: F.struct(x[at].cast("long").alias("at"), F.lit(is_base).alias("base"),
                                            x["start"].cast("long").alias("start"), x["end"].cast("long").alias("end"))
    both = F.array_sort(F.concat(F.transform(found, lambda m: longs(m, "end", 0)), F.transform(base, lambda b: longs(b, "start", 1))))
    none = F.lit(-1).cast("long")
    return let(both, lambda xs: let(
        prefix(F.transform(xs, lambda x: F.when(x["base"] == 1, x["end"]).otherwise(none)), none, lambda a, b: F.greatest(a, b)),
        lambda reach: F.filter(xs, lambda x, i: (x["base"] == 0) & (F.get(reach, i) <= x["start"]))))


def scan(docs: DataFrame, model: MarkovModel, p: SecretParams = SecretParams()) -> DataFrame:
    """``docs`` with ``secret_spans``: ``array<struct<start, kind, end>>``
    sorted by start, then kind (an index into :data:`KINDS`)."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.withColumn("secret_spans", let(text, lambda t: let(base_spans(t), lambda base: F.sort_array(
        F.concat(base, _random_spans(t, base, model, p))))))


def redact(docs: DataFrame, model: MarkovModel, p: SecretParams = SecretParams(), mark: str = "[SECRET]") -> DataFrame:
    """``docs`` with each stretch covered by spans replaced by ``mark`` and
    ``n_chars`` set to the new length; other rows and columns as they were."""
    found = scan(docs.select("*"), model, p)
    spans, text = F.col("secret_spans"), F.col("text")

    # sorted by start: a span opens a stretch if none before it reaches its start
    def stretches(xs):
        return let(prefix(F.transform(xs, lambda x: x["end"]), F.lit(-1).cast("long"), lambda a, b: F.greatest(a, b)), lambda reach:
                   F.filter(F.transform(xs, lambda x, i: F.struct(x["start"].alias("start"), reach[i].alias("from"),
                                                                 (x["start"] > reach[i]).alias("opens"))), lambda x: x["opens"]))

    def rebuilt(opens, end):
        # the text between the stretches, joined by the mark
        n = F.size(opens)
        gaps = F.transform(F.sequence(F.lit(0), n), lambda i: let(
            F.when(i == 0, F.lit(0).cast("long")).otherwise(F.when(i == n, end).otherwise(F.get(opens, i)["from"])), lambda a: let(
                F.when(i == n, F.length(text).cast("long")).otherwise(F.get(opens, i)["start"]),
                lambda b: F.substring(text, (a + 1).cast("int"), (b - a).cast("int")))))
        return F.array_join(gaps, mark)
    new = let(spans, lambda xs: let(stretches(xs), lambda opens: rebuilt(opens, F.array_max(F.transform(xs, lambda x: x["end"])))))
    out = found.withColumn("text", F.when(F.size(spans) > 0, new).otherwise(text))
    if "n_chars" in docs.columns:
        out = out.withColumn("n_chars", F.when(F.size(spans) > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return out.select(docs.columns)


def digest(found: DataFrame) -> DataFrame:
    """One row per document of ``scan``'s rows: counts, digest and spans."""
    names = F.array(*[F.lit(k) for k in KINDS])
    shown = lambda xs: F.array_join(F.transform(xs, lambda x: F.concat_ws(":", names[x["kind"]], x["start"].cast("string"), x["end"].cast("string"))), ",")
    spans = F.col("secret_spans")
    base = F.filter(spans, lambda x: x["kind"] < 3)
    n = lambda k: F.size(F.filter(spans, lambda x: x["kind"] == k)).cast("long")
    return found.select("doc_id", n(0).alias("n_assign"), n(1).alias("n_access"), n(2).alias("n_hex"),
                        F.sha2(shown(base), 256).alias("base_sha256"), shown(spans).alias("spans"), n(3).alias("n_random"))
