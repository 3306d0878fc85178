"""Statistics of whole texts, one row per document: what the quality rules and
the quality classifier look at. Nothing of a document but its text is read."""

from __future__ import annotations

from operator import eq

from pyspark.sql import DataFrame, types as T

from .common import map_texts

SYMBOLS = "#*$%&|<>"
SPACES = " \t\n\x0b\x0c\r"

# Name and type of each statistic, in the order :func:`stats` returns them.
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_chars", "n_lines", "n_upper_words",
          "n_distinct_words", "n_alpha_words", "n_stops", "n_digits", "n_marks", "longest_word", "top_word", "n_same_next")


def repeat_words(joined: bytes, starts: list[int], ends: list[int], window: int = 5) -> int:
    """Words that lie in a window of ``window`` words found twice or more."""
    n = len(starts) - window + 1
    if n < 2:
        return 0
    keys = [joined[s:e] for s, e in zip(starts[:n], ends[window - 1:])]
    if len(set(keys)) == n:
        return 0
    seen: dict[bytes, int] = {}
    for k in keys:
        seen[k] = seen.get(k, 0) + 1
    total, reached = 0, 0
    for i, k in enumerate(keys):
        if seen[k] > 1:
            total += i + window - max(i, reached)
            reached = i + window
    return total


def stats(text: str) -> tuple[int, ...]:
    """The counts of :data:`COUNTS` for a whole text."""
    raw = text.encode("utf-8", "surrogatepass")
    words = raw.split()   # bytes: the six ASCII white-space characters only
    n = len(words)
    word_chars = len(text) - sum(map(text.count, SPACES))
    symbols = sum(map(text.count, SYMBOLS))
    lines = [x for x in text.split("\n") if x.strip(SPACES)]
    starts, ends, at = [], [], 0
    for w in words:
        starts.append(at)
        at += len(w)
        ends.append(at)
        at += 1
    repeated = repeat_words(b" ".join(words), starts, ends)
    counts: dict[bytes, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    upper = alpha = stops = 0
    for w, c in counts.items():
        body = w.strip(b".,;:!?\"'()[]")
        if body.isalpha() or not body.isascii():
            alpha += c
            if len(body) > 1 and body.isupper():
                upper += c
        if w[-1:] in (b".", b",", b"!", b"?"):
            stops += c
    digits = sum(text.count(c) for c in "0123456789")
    marks = sum(map(text.count, "!?"))
    return (n, word_chars, symbols, len(lines) - len(set(lines)), repeated, len(text), len(lines), upper, len(counts), alpha,
            stops, digits, marks, max(map(len, counts), default=0), max(counts.values(), default=0),
            sum(map(eq, words, words[1:])))


def statistics(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the counts of :data:`COUNTS`, one row per row of ``docs``."""
    return map_texts(docs, stats, [(c, T.LongType()) for c in COUNTS])


# Rates derived from the counts, as SQL expressions; 0 where there are no words or lines.
RATES = {
    "words_log": "ln(1 + n_words)",
    "mean_word": "coalesce(try_divide(word_chars, n_words), 0)",
    "symbol_rate": "coalesce(try_divide(n_symbols, n_words), 0)",
    "dup_line_rate": "coalesce(try_divide(n_dup_lines, n_lines), 0)",
    "repeat_rate": "coalesce(try_divide(n_repeat_words, n_words), 0)",
    "upper_rate": "coalesce(try_divide(n_upper_words, n_words), 0)",
    "distinct_rate": "coalesce(try_divide(n_distinct_words, n_words), 0)",
    "alpha_rate": "coalesce(try_divide(n_alpha_words, n_words), 0)",
    "stop_rate": "coalesce(try_divide(n_stops, n_words), 0)",
    "digit_rate": "coalesce(try_divide(n_digits, word_chars), 0)",
    "mark_rate": "coalesce(try_divide(n_marks, n_words), 0)",
    "longest_log": "ln(1 + longest_word)",
    "top_word_rate": "coalesce(try_divide(top_word, n_words), 0)",
    "same_next_rate": "coalesce(try_divide(n_same_next, n_words), 0)",
}


def with_rates(df: DataFrame) -> DataFrame:
    return df.selectExpr("*", *[f"cast({e} as double) as {n}" for n, e in RATES.items()])
