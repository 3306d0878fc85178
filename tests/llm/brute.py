"""Brute-force versions: plain Python over whole texts, written from the
contracts and sharing no code with the operators."""

import hashlib
import re
from collections import defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def luhn(s):
    d = [int(c) for c in s][::-1]
    return sum(x if i % 2 == 0 else sum(divmod(2 * x, 10)) for i, x in enumerate(d)) % 10 == 0


def pii_base(text):
    text = text or ""
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", m.start(), m.end()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", m.start(), m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 13 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", m.start(), m.end()))
    return out


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def sha256(s):
    return hashlib.sha256(s.encode()).hexdigest()


def secrets_base(text):
    text = text or ""
    out = []
    kw = "(" + "|".join("".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in w) for w in ("password", "passwd", "secret", "token")) \
        + "|[Aa][Pp][Ii]_?[Kk][Ee][Yy])"
    for m in re.finditer(kw + r"""["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", text):
        if len(m[2]) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
    for m in re.finditer("AKIA[A-Z0-9]+", text):
        if len(m[0]) >= 18:
            out.append((m.start(), 1, "access", m.end()))
    for m in re.finditer("[0-9a-f]+", text):
        if len(m[0]) >= 16:
            out.append((m.start(), 2, "hex", m.end()))
    return [(k, s, e) for s, _, k, e in sorted(out)]


def ascii_lower(s):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in s)


def licenses_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", ascii_lower(text or ""))
    places = []
    for phrase, label in (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl")):
        p = phrase.split()
        places += [(i, label) for i in range(len(words) - len(p) + 1) if words[i:i + len(p)] == p]
    at = [i for i, _ in places]
    return len(words), len(at), min(at, default=None), max(at, default=None), ",".join(sorted({x for _, x in places}))


def rules_base(text):
    text = text or ""
    words = WORD.findall(text)
    n_chars = sum(map(len, words))
    symbols = sum(c in "#*$%&|<>" for c in text)
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    at = defaultdict(list)
    for i in range(len(words) - 4):
        at[tuple(words[i:i + 5])].append(i)
    covered = {j for places in at.values() if len(places) > 1 for i in places for j in range(i, i + 5)}
    n, r = len(words), len(covered)
    return n, n_chars, symbols, dup, r, n < 10 or 100 * r > 20 * n


def fingerprint(text, k=3):
    words = WORD.findall(ascii_lower(text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(len(words) - k + 1)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(rows, bits=2):
    """{doc index: smallest doc_id reachable} of (doc_id, fingerprint) rows."""
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i
    first = {}
    for i, (_, f) in enumerate(rows):
        parent[root(i)] = root(first.setdefault(f, i))
    fps = list(first)
    for a in range(len(fps)):
        for b in range(a):
            if bin(fps[a] ^ fps[b]).count("1") <= bits:
                parent[root(first[fps[a]])] = root(first[fps[b]])
    low = {}
    for i, (d, _) in enumerate(rows):
        r = root(i)
        if d is not None:
            low[r] = min(d, low.get(r, d))
    return [low.get(root(i)) for i in range(len(rows))]
