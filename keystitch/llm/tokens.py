"""Token counts under a unigram model by trie-shared dynamic programming.

A vocabulary file of a public byte-level tokenizer gives the pieces; a piece's
log-probability follows its rank (Zipf-Mandelbrot: ``-ln(rank + shift)``, less
the normaliser). A pre-token's count is the number of pieces of its best
segmentation, fewest pieces among equals. The best score of a prefix depends on
that prefix only, so the distinct pre-tokens of a batch are put in a trie: each
node (shared prefix) is scored once, and the counts at the terminal nodes are
kept and summed per document. Counting is local to the rows: no shuffle, and
no pre-token of the corpus is gathered anywhere.

Pre-tokens: runs without ASCII white space with the one space before them, and
other white-space runs; together they are the whole text. Every byte is a
piece, so every text has a count. Defined results: null and empty texts have
no tokens; repeated rows give repeated rows."""

from __future__ import annotations

import base64
import math
import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, types as T

from .common import in_batches

#: A space belongs to the word after it; a longer white-space run is one pre-token.
PRE_TOKEN = re.compile(rb"\x20?[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: Terminal counts that a worker keeps between batches before it starts anew.
KEPT = 1 << 20


@dataclass(frozen=True)
class Unigram:
    """Log-probabilities of pieces, and all their suffixes."""
    score: dict[bytes, float]
    tails: frozenset[bytes]

    @staticmethod
    def from_ranks(path: str, shift: float = 2.7) -> Unigram:
        """``path``: lines of base64 piece and rank (public rank files)."""
        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        norm = math.log(sum(1 / (r + shift) for r in ranks.values()))
        score = {p: -math.log(r + shift) - norm for p, r in ranks.items()}
        low = min(score.values()) - 1.0
        for b in range(256):
            score.setdefault(bytes([b]), low)
        return Unigram(score, frozenset(p[i:] for p in score for i in range(len(p))))


def trie_counts(words, model: Unigram) -> dict[bytes, int]:
    """Pieces of each distinct word. The trie is walked in sorted order: what
    is kept is the path to the current node, with the forward score and count
    of each node on it; only nodes below the branching point are computed."""
    out: dict[bytes, int] = {}
    best, count, last = [0.0], [0], b""
    score, tails = model.score, model.tails
    for word in sorted(words):
        shared, most = 0, min(len(last), len(word))
        while shared < most and last[shared] == word[shared]:
            shared += 1
        del best[shared + 1:], count[shared + 1:]
        for end in range(shared + 1, len(word) + 1):
            top, fewest, start = -math.inf, 0, end - 1
            while start >= 0 and (piece := word[start:end]) in tails:
                s = score.get(piece)
                if s is not None:
                    s += best[start]
                    n = count[start] + 1
                    if s > top or (s == top and n < fewest):
                        top, fewest = s, n
                start -= 1
            best.append(top)
            count.append(fewest)
        out[word] = count[-1]
        last = word
    return out


def token_counts(docs: DataFrame, vocabulary: str) -> DataFrame:
    """``(doc_id, n_bytes, n_pretokens, n_tokens)``, one row per row."""
    src = docs.select("doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(Unigram.from_ranks(vocabulary))  # the size of a vocabulary
    schema = T.StructType([src.schema["doc_id"]] + [T.StructField(n, T.LongType()) for n in ("n_bytes", "n_pretokens", "n_tokens")])

    def run(batches):
        import pyarrow as pa
        from .common import _arrow_schema
        arrow = _arrow_schema(schema)
        kept: dict[bytes, int] = {}
        for b in batches:
            if len(kept) > KEPT:
                kept = {}
            fresh: set[bytes] = set()
            raws = [(t.as_py() or "").encode("utf-8", "surrogatepass") for t in b.column("text")]
            for raw in raws:
                fresh.update(PRE_TOKEN.findall(raw))
            kept.update(trie_counts(fresh.difference(kept), model.value))
            sizes, words, tokens = [], [], []
            for raw in raws:
                found = PRE_TOKEN.findall(raw)
                sizes.append(len(raw))
                words.append(len(found))
                tokens.append(sum(map(kept.__getitem__, found)))
            yield pa.RecordBatch.from_arrays([b.column("doc_id").cast(arrow.field(0).type)] + [pa.array(c, pa.int64()) for c in (sizes, words, tokens)],
                                             schema=arrow)
    return in_batches(src).mapInArrow(run, schema)
