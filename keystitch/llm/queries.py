"""Registered queries of the training-data operators, one per operator, each
over its whole table, with DuckDB twins where SQL expresses them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from . import collocations, decision_list, decontam, licenses, mixing, pii, quality, search, secrets, simhash, tokens, toxicity, warc
from .common import table

#: Path of the token counts' vocabulary (a parameter; never copied here).
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn
    return add


@_query("op1_pii")
def op1_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of every document."""
    return pii.digest(table(spark, sf_dir, "documents"))


@_query("op2_decontamination")
def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold a copy of a benchmark item, with the item."""
    return decontam.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op3_token_counts")
def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Unigram token counts of every document."""
    return tokens.token_counts(table(spark, sf_dir, "documents"), VOCABULARY)


@_query("op4_quality_rules")
def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict of the learned decision list on every document."""
    docs = table(spark, sf_dir, "documents")
    rules = decision_list.train(docs, table(spark, sf_dir, "labels"))
    return decision_list.digest(decision_list.apply(docs, rules))


@_query("op5_secrets")
def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets of every document."""
    docs = table(spark, sf_dir, "documents")
    return secrets.digest(secrets.scan(docs.select("doc_id", "text"), secrets.train(docs)))


@_query("op6_warc", """
WITH p AS (SELECT page_id, url, coalesce(html, '') AS payload FROM pages),
d AS (SELECT page_id, url, CAST(strlen(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest, sha256(payload) AS same FROM p),
m AS (SELECT *, max(page_id) OVER (PARTITION BY same) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to
FROM m
""")
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The pages, written as WARC archives and read back."""
    return warc.round_trip(table(spark, sf_dir, "pages"))


@_query("op7_quality_classifier")
def op7_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    docs = table(spark, sf_dir, "documents")
    return quality.scores(docs, quality.train(docs, table(spark, sf_dir, "labels")))


@_query("op8_mixing", r"""
WITH RECURSIVE d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         CAST('0x' || substr(md5('mix:' || coalesce(CAST(doc_id AS VARCHAR), '-' || text, '')), 1, 13) AS BIGINT) AS u
  FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
             CASE (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END AS weight
      FROM d GROUP BY source),
tot AS (SELECT sum(source_size) AS total FROM s),
lvl AS (
  SELECT 0 AS k, CAST(-1 AS BIGINT) AS n_before, CAST(0 AS BIGINT) AS n,
         coalesce(CAST((SELECT total FROM tot) AS DOUBLE) / nullif((SELECT sum(weight) FROM s), 0), 0.0) AS level
  UNION ALL
  SELECT k + 1, n, (SELECT count(*) FROM s WHERE s.weight * l.level > 3 * s.source_size),
         coalesce(CAST((SELECT total FROM tot) - (SELECT coalesce(sum(3 * s.source_size), 0) FROM s WHERE s.weight * l.level > 3 * s.source_size) AS DOUBLE)
                  / nullif((SELECT sum(s.weight) FROM s WHERE NOT s.weight * l.level > 3 * s.source_size), 0), l.level)
  FROM lvl l WHERE l.n_before <> l.n),
f AS (SELECT level FROM lvl ORDER BY k DESC LIMIT 1),
t AS (SELECT source, source_size,
             CASE WHEN weight * (SELECT level FROM f) > 3 * source_size THEN CAST(3 * source_size AS DOUBLE)
                  ELSE weight * (SELECT level FROM f) END AS target FROM s),
w AS (SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole FROM t),
r AS (SELECT d.*, w.source_size, w.target, w.whole, w.target - w.whole * w.source_size AS rest,
             dense_rank() OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id NULLS FIRST, d.size) AS place,
             sum(d.size) OVER (PARTITION BY d.source ORDER BY d.u, d.doc_id NULLS FIRST, d.size) AS upto
      FROM d JOIN w ON d.source IS NOT DISTINCT FROM w.source),
m AS (SELECT source, any_value(rest) - coalesce(max(upto) FILTER (upto <= rest), 0) AS gap, coalesce(max(place) FILTER (upto <= rest), 0) AS last,
             min(place) FILTER (upto > rest) AS over, min(upto - rest) FILTER (upto > rest) AS over_by FROM r GROUP BY source),
c AS (SELECT *, sum(size) OVER (PARTITION BY source, class ORDER BY place) AS run
      FROM (SELECT r.source, len(bin(r.size)) AS class, r.place, r.size FROM r JOIN m ON r.source IS NOT DISTINCT FROM m.source
            WHERE r.place > m.last AND r.size > 0 AND r.size <= m.gap)),
g AS (SELECT source, 64 AS class, CAST(0 AS HUGEINT) AS words, gap AS left_gap FROM m
      UNION ALL
      SELECT source, class - 1, n, left_gap - n FROM (
        SELECT g.*, coalesce((SELECT max(c.run) FROM c WHERE c.source IS NOT DISTINCT FROM g.source AND c.class = g.class - 1 AND c.run <= g.left_gap), 0) AS n
        FROM g WHERE g.class > 1)),
x AS (SELECT g.*, (SELECT min(c.run) FROM c WHERE c.source IS NOT DISTINCT FROM g.source AND c.class = g.class AND c.run > g.words) - g.words AS more FROM g),
y AS (SELECT source, min(left_gap) AS left_gap, min({'more': more, 'class': class}) FILTER (more IS NOT NULL) AS next FROM x GROUP BY source),
z AS (SELECT m.source, m.last, m.over, coalesce(m.over_by < least(y.left_gap, coalesce(y.next.more - y.left_gap, y.left_gap)), false) AS takes_over,
             CASE WHEN y.next.more - y.left_gap < y.left_gap THEN y.next.class END AS next_class
      FROM m JOIN y ON m.source IS NOT DISTINCT FROM y.source),
e AS (SELECT DISTINCT c.source, c.place FROM c JOIN x ON c.source IS NOT DISTINCT FROM x.source AND c.class = x.class
      JOIN z ON c.source IS NOT DISTINCT FROM z.source
      WHERE NOT z.takes_over AND c.run <= x.words + CASE WHEN z.next_class = c.class THEN x.more ELSE 0 END)
SELECT r.doc_id, r.size, r.source_size, r.target,
       CAST(r.size * (r.whole + CASE WHEN r.place <= CASE WHEN z.takes_over THEN z.over ELSE z.last END OR e.place IS NOT NULL THEN 1 ELSE 0 END) AS BIGINT) AS taken
FROM r JOIN z ON r.source IS NOT DISTINCT FROM z.source
LEFT JOIN e ON r.source IS NOT DISTINCT FROM e.source AND r.place = e.place
""")
def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a mix to the target weights takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.digest(mixing.mix(docs))


@_query("op9_licenses")
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License mentions of every document."""
    return licenses.digest(licenses.scan(table(spark, sf_dir, "documents").select("doc_id", "text")))


@_query("op10_simhash")
def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, seed=42, max_bits=2).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@_query("op11_toxicity")
def op11_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity score of every document."""
    docs = table(spark, sf_dir, "documents")
    return toxicity.scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


@_query("op12_ranked_search", r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, terms, CAST(len(terms) AS HUGEINT) AS n FROM (
       SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents) WHERE len(terms) > 0),
i AS (SELECT row_number() OVER () AS k, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
q AS (SELECT k, item_id, term, count(*) AS times FROM (SELECT k, item_id, unnest(terms) AS term FROM i) GROUP BY ALL),
tot AS (SELECT CAST(count(*) AS HUGEINT) AS n_docs, sum(n) AS n_terms FROM d),
p AS (SELECT r, doc_id, n, term, CAST(count(*) AS HUGEINT) AS tf FROM (SELECT r, doc_id, n, unnest(terms) AS term FROM d) GROUP BY ALL),
v AS (SELECT term, CAST(floor(1000 * ln(CAST(2 * max(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE))) AS HUGEINT) AS w
      FROM p, tot WHERE term IN (SELECT term FROM q) GROUP BY term),
s AS (SELECT k, item_id, r, doc_id,
             sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * (75 + (25 * n * n_docs) // n_terms)))) AS score
      FROM q JOIN v USING (term) JOIN p USING (term), tot GROUP BY ALL),
o AS (SELECT k, item_id, doc_id, score, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM s WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 20
""")
def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best documents of every benchmark item."""
    return search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@_query("op13_collocations", r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
k AS (SELECT unnest([1, 2, 3, 4]) AS words),
g AS (SELECT lang, words, w, unnest(range(1, len(w) - words + 2)) AS i FROM w, k WHERE len(w) >= words),
f AS (SELECT lang, words, array_to_string(w[i:i + words - 1], ' ') AS phrase, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE words = 1 GROUP BY lang),
c AS (SELECT lang, words, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE words > 1 AND f >= 30),
cuts AS (SELECT *, unnest(range(1, words)) AS k FROM c),
s AS (SELECT cuts.lang, cuts.phrase, cuts.words, cuts.w, a, k, x.f AS l, y.f AS r, (CAST(2000000 AS HUGEINT) * a) // (CAST(x.f AS HUGEINT) + y.f) AS score FROM cuts
      JOIN f x ON x.lang = cuts.lang AND x.phrase = array_to_string(cuts.w[1:k], ' ')
      JOIN f y ON y.lang = cuts.lang AND y.phrase = array_to_string(cuts.w[k + 1:cuts.words], ' ')),
worst AS (SELECT * FROM s QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
kept AS (SELECT * FROM worst t WHERE NOT EXISTS (
      SELECT 1 FROM c o WHERE o.lang = t.lang AND o.words > t.words AND 100 * o.a >= 80 * t.a AND contains(' ' || o.phrase || ' ', ' ' || t.phrase || ' '))),
o AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM kept)
SELECT o.lang, rank, phrase, a, l, r, n.n, CAST(score AS BIGINT) AS score FROM o JOIN n ON n.lang = o.lang WHERE rank <= 2000
""")
def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The strongest phrases of each language."""
    return collocations.collocations(table(spark, sf_dir, "documents"))
