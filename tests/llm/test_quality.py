"""Quality rules, quality ranking and token counts."""

import functools
import zlib

import pytest
from pyspark.sql import functions as F

import brute
from keystitch.llm import decision_list, quality, queries, textstats, tokens

SF = "/root/testdata/sf0.01"


def test_rules_base_is_the_contract(make_docs, sample_docs, odd_rows):
    rows = sample_docs + [r for r in odd_rows if r[0] not in (5, 6, 7)] + [
        (50, "a b c d e a b c d e"), (51, "a a a a a a a"), (52, "x\n x\nx\n\n\nx \n"), (53, "a b c d e f a b c d e g b c d e f"), (54, "\x1c a\x85b c")]
    texts = {r[0]: r[1] for r in rows}
    got = decision_list.digest(decision_list.apply(make_docs(rows), [])).collect()
    assert len(got) == len(rows)
    for g in got:
        want = brute.rules_base(texts[g.doc_id])
        assert (g.n_words, g.word_chars, g.n_symbols, g.n_dup_lines, g.n_repeat_words, g.base_failed) == want, g.doc_id
        assert g.kept == (not want[-1])


def test_rules_learn_and_emit_a_conditional(spark, make_docs):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    rules = decision_list.train(docs, labels)
    assert rules and all(1 <= len(r.tests) <= 4 for r in rules)
    assert str(decision_list.verdict(rules)).count("WHEN") == len(rules)
    got = decision_list.digest(decision_list.apply(docs, rules)).join(labels, "doc_id").collect()
    assert sum(g.kept for g in got if g.quality == 0) == 0
    kept = [g.kept for g in got if g.quality == 1 and not g.base_failed]
    assert sum(kept) >= 0.99 * len(kept)


def test_rules_verdict_is_the_first_rule_that_holds(spark):
    rules = [decision_list.Rule((("a", ">=", 2.0), ("b", "<=", 1.0))), decision_list.Rule((("a", ">=", 1.0),))]
    df = spark.createDataFrame([(2.0, 1.0), (2.0, 3.0), (0.0, 0.0)], "a double, b double")
    assert [r[0] for r in df.select(decision_list.verdict(rules)).collect()] == [1, 2, None]


def test_ranking_on_held_out_labels(spark):
    got = queries.op7_quality_classifier(spark, SF).join(spark.read.parquet(f"{SF}/labels.parquet"), "doc_id").collect()
    assert all(g.held_out == (zlib.crc32(str(g.doc_id).encode()) % 4 == 2) for g in got)
    held = [g for g in got if g.held_out]
    assert sum(g.predicted == g.quality for g in held) >= 0.97 * len(held)
    good, bad = [g.score for g in held if g.quality == 1], [g.score for g in held if g.quality == 0]
    wins = sum((a > b) + 0.5 * (a == b) for a in good for b in bad)
    assert wins >= 0.98 * len(good) * len(bad)
    assert all(0 <= g.score <= 1 and g.predicted == (g.score >= 0.7) for g in got)


def test_ranking_learns_only_from_allowed_labels(spark, make_docs, sample_docs):
    labels = spark.read.parquet("/root/testdata/sf0.001/labels.parquet").withColumn("doc_id", F.col("doc_id") + 10**6)
    docs = make_docs(sample_docs)
    flipped = labels.withColumn("quality", F.when(quality.held_out(F.col("doc_id")), 1 - F.col("quality")).otherwise(F.col("quality")))
    assert quality.train(docs, labels) == quality.train(docs, flipped)
    assert quality.train(docs.repartition(5), labels) == quality.train(docs, labels)


def test_quality_odd_rows_and_empty_tables(spark, make_docs, odd_rows):
    labels = spark.createDataFrame([(4, 1, 0), (4, None, 0), (None, 0, 0), (11, 0, 0), (999, 0, 0)], "doc_id long, quality int, toxic int")
    rows = [r for r in odd_rows if r[0] not in (5, 6, 7)]
    docs = make_docs(rows).selectExpr("*", "1 as n_words", "2 as score", "3 as quality", "4 as __counts")
    assert quality.scores(docs, quality.train(docs, labels)).count() == len(rows)
    assert quality.keep(docs, None).count() == len(rows) and quality.keep(docs, None).columns == docs.columns
    assert decision_list.apply(docs, decision_list.train(docs, labels)).count() == len(rows)
    none, no_labels = make_docs([]), labels.limit(0)
    assert quality.train(none, labels) is None and quality.train(docs, no_labels) is None
    assert quality.scores(none, None).collect() == [] and decision_list.train(docs, no_labels) == []
    assert {r.predicted for r in quality.scores(docs, None).collect()} == {1}


def test_repeat_words_by_brute_force():
    for text in ("a b c d e", "a b a b a b a b a", "p q r s t u p q r s t", "a " * 30):
        assert textstats.stats(text)[4] == brute.rules_base(text)[4]


@functools.cache
def vocabulary():
    return tokens.Unigram.from_ranks(queries.VOCABULARY)


def plain_count(word: bytes, model) -> int:
    """Forward scores of one word, without the trie."""
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] + model.score[word[s:end]], -(-best[s][1] + 1)) for s in range(end) if word[s:end] in model.score]
        best.append(max(options))
    return -best[-1][1]


def test_token_counts_by_brute_force(make_docs, sample_docs, odd_rows):
    rows = [(d, t[:3000] if t else t) for d, t, *_ in sample_docs[:40]] + [r for r in odd_rows if r[0] in (None, 1, 2, 3, 4, 8)]
    texts = {r[0]: (r[1] or "").encode() for r in rows}
    got = tokens.token_counts(make_docs(rows), queries.VOCABULARY).collect()
    assert len(got) == len(rows)
    for g in got:
        raw = texts[g.doc_id]
        words = tokens.PRE_TOKEN.findall(raw)
        assert b"".join(words) == raw and g.n_bytes == len(raw) and g.n_pretokens == len(words)
        assert g.n_tokens == sum(plain_count(w, vocabulary()) for w in words)


def test_token_trie_shares_prefixes():
    words = {b" the", b" there", b" therefore", b"", b" thence", b"\xff\x00", b" " * 40}
    assert tokens.trie_counts(words, vocabulary()) == {w: plain_count(w, vocabulary()) for w in words}


def test_token_counts_of_an_empty_table(make_docs):
    assert tokens.token_counts(make_docs([]), queries.VOCABULARY).collect() == []


@pytest.mark.parametrize("rows", [[], [(1, 0, 0.0)]])
def test_fit_without_both_classes(rows):
    full = [(d, q) + (x,) * len(textstats.RATES) for d, q, x in rows]
    assert quality.fit(full) is None and decision_list.learn(full) == []
