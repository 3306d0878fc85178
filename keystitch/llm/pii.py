"""Personal data: patterns propose spans, checksums confirm them, context words
adjust the score.

The base kinds (email, ip, card, phone) are kept whatever their score. The
other kinds need a score of ``ACCEPT``: a pattern's prior, more where a checksum
confirms it (it is dropped where the checksum fails), more or less for words
nearby. Proposals that overlap a base span are dropped.

The proposers are written so that a text costs time in proportion to its
length, long runs of one character class included: the email proposer starts
from each '@', the digit patterns start only where a run of digits does.

An IBAN needs a country that has them, that country's length, and mod-97. A
checksum alone does not outweigh a word that speaks against it: ``ACCEPT`` lies
above a confirmed span's score less such a word's. Context words are those of
the texts' four languages.

Defined results: null and empty texts have no spans; very long texts are taken
whole; repeated rows give repeated rows; an empty table gives no rows; only
doc_id and text are read, so other columns' names cannot clash."""

from __future__ import annotations

import hashlib
import re

from pyspark.sql import DataFrame, types as T

from .common import map_texts

BASE_KINDS = ("email", "ip", "card", "phone")
KINDS = BASE_KINDS + ("iban", "ssn", "national_phone")
ACCEPT = 0.65
#: Code points on either side in which context words count.
CONTEXT = 48

# Prior score, what a confirming checksum adds, and words that raise the score (fixed values).
PRIORS = {"email": 0.9, "ip": 0.6, "card": 0.4, "phone": 0.6, "iban": 0.4, "ssn": 0.4, "national_phone": 0.35}
CONFIRMED = {"card": 0.4, "iban": 0.4}
_CALLING = ("phone", "tel", "telephone", "call", "mobile", "cell", "fax", "whatsapp", "telefon", "ruf", "rufen", "anruf", "anrufen", "handy", "mobil",
            "téléphone", "appel", "appeler", "appelez", "portable", "teléfono", "llamar", "llame", "llama", "móvil", "celular")
RAISING = {
    "email": ("email", "e-mail", "mail", "contact", "kontakt", "courriel", "correo", "contacto"),
    "ip": ("ip", "address", "host", "server", "login", "adresse", "serveur", "servidor", "dirección"),
    "card": ("card", "credit", "debit", "visa", "mastercard", "payment", "cvv", "expiry", "karte", "kreditkarte", "zahlung", "carte", "crédit",
             "paiement", "tarjeta", "crédito", "pago"),
    "phone": _CALLING,
    "iban": ("iban", "account", "bank", "transfer", "swift", "bic", "konto", "überweisung", "bankverbindung", "compte", "banque", "virement",
             "cuenta", "banco", "transferencia"),
    "ssn": ("ssn", "social", "security", "taxpayer", "sozialversicherung", "sécurité", "sociale", "seguridad"),
    "national_phone": _CALLING,
}
LOWERING = ("isbn", "version", "order", "invoice", "sku", "part", "serial", "model", "bestellung", "rechnung", "artikel", "seriennummer",
            "commande", "facture", "série", "pedido", "factura", "serie")

# Countries with IBANs and their lengths (fixed values).
IBAN_LENGTHS = {k: int(n) for k, n in (x.split(":") for x in (
    "AD:24 AE:23 AL:28 AT:20 AZ:28 BA:20 BE:16 BG:22 BH:22 BI:27 BR:29 BY:28 CH:21 CR:22 CY:28 CZ:24 DE:22 DJ:27 DK:18 DO:28 EE:20 EG:29 ES:24 FI:18 "
    "FK:18 FO:18 FR:27 GB:22 GE:22 GI:23 GL:18 GR:27 GT:28 HR:21 HU:28 IE:22 IL:23 IQ:23 IS:26 IT:27 JO:30 KW:30 KZ:20 LB:28 LC:32 LI:21 LT:20 LU:20 "
    "LV:21 LY:25 MC:27 MD:24 ME:22 MK:19 MN:20 MR:27 MT:31 MU:30 NI:28 NL:18 NO:15 OM:23 PK:24 PL:28 PS:29 PT:25 QA:29 RO:24 RS:22 RU:33 SA:24 SC:31 "
    "SD:18 SE:24 SI:19 SK:24 SM:27 SO:23 ST:25 SV:28 TL:23 TN:24 TR:26 UA:29 VA:22 VG:24 XK:20 YE:30").split())}
RAISE, LOWER = 0.3, -0.2

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_DIGIT = re.compile(r"[0-9]")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:\x20?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_NATIONAL = re.compile(r"(?<![0-9+(])\(?[0-9]{3}\)?[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9-])")
_WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)*")


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (d * 2 - 9 if d > 4 else d * 2)
    return total % 10 == 0


def mod97(iban: str) -> bool:
    moved = iban[4:] + iban[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97 == 1


def _only_digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def emails(text: str):
    """Leftmost non-overlapping ``local@domain.part``: only a run of local
    characters that ends at an '@' can start one."""
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        m = _DOMAIN.match(text, at + 1) if start < at else None
        if m:
            yield start, m.end()
            done = m.end()
            at = text.find("@", done)
        else:
            done = at + 1   # nothing can start at or reach back over this '@'
            at = text.find("@", done)


def _iban_end(body: str) -> int:
    """Length of the leading part that has its country's length, ends where a
    group or the match does, and is confirmed by mod-97; 0 if there is none."""
    want = IBAN_LENGTHS.get(body[:2])
    if want is None:
        return 0
    n = 0
    for e, c in enumerate(body, 1):
        n += c != " "
        if n == want:
            whole = e == len(body) or body[e] == " "
            return e if whole and mod97(body[:e].replace(" ", "")) else 0
    return 0


def proposals(text: str):
    """``(kind, start, end, confirmed)`` in code points; those that a checksum
    or a count refutes are left out."""
    for s, e in emails(text):
        yield "email", s, e, False
    if not _DIGIT.search(text):
        return
    for m in _IP.finditer(text):
        if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or "0") <= 255 for p in m[0].split(".")):
            yield "ip", m.start(), m.end(), False
    for m in _CARD.finditer(text):
        if len(m[0]) >= 13 and 13 <= len(d := _only_digits(m[0])) <= 19 and luhn(d):
            yield "card", m.start(), m.end(), True
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 9 <= len(_only_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end(), False
    m = _IBAN.search(text)
    while m:
        n = _iban_end(m[0])
        if n:
            yield "iban", m.start(), m.start() + n, True
        # what lies beyond the confirmed part, or after the first group, is tried again
        m = _IBAN.search(text, m.start() + (n or 1))
    if "-" in text:
        for m in _SSN.finditer(text):
            if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
                yield "ssn", m.start(), m.end(), False
    for m in _NATIONAL.finditer(text):
        yield "national_phone", m.start(), m.end(), False


def score(text: str, kind: str, start: int, end: int, confirmed: bool) -> float:
    near = text[max(0, start - CONTEXT):start] + " " + text[end:end + CONTEXT]
    words = {w.lower() for w in _WORD.findall(near)}
    s = PRIORS[kind] + (CONFIRMED.get(kind, 0.0) if confirmed else 0.0)
    s += RAISE if not words.isdisjoint(RAISING[kind]) else 0.0
    s += LOWER if not words.isdisjoint(LOWERING) else 0.0
    return round(min(1.0, max(0.0, s)), 2)


def find(text: str | None) -> list[tuple[str, int, int, float]]:
    """Spans of a text by kind as listed, then start."""
    text = text or ""
    found = [(k, s, e, score(text, k, s, e, c)) for k, s, e, c in proposals(text)]
    base = sorted((s, e) for k, s, e, _ in found if k in BASE_KINDS)
    starts = [s for s, _ in base]
    reach, furthest = [], 0
    for _, e in base:
        furthest = max(furthest, e)
        reach.append(furthest)

    def clear(s, e):
        from bisect import bisect_left
        i = bisect_left(starts, e)
        return i == 0 or reach[i - 1] <= s
    out = [x for x in found if x[0] in BASE_KINDS or (x[3] >= ACCEPT and clear(x[1], x[2]))]
    return sorted(out, key=lambda x: (KINDS.index(x[0]), x[1]))


def scan(docs: DataFrame) -> DataFrame:
    """``(doc_id, spans)`` with ``array<struct<kind, start, end, score>>``."""
    span = T.StructType([T.StructField("kind", T.StringType()), T.StructField("start", T.LongType()),
                         T.StructField("end", T.LongType()), T.StructField("score", T.DoubleType())])
    return map_texts(docs, lambda t: ([dict(zip(("kind", "start", "end", "score"), x)) for x in find(t)],),
                     [("spans", T.ArrayType(span))])


def _digest(text: str) -> tuple:
    spans = find(text)
    shown = lambda xs: ",".join(f"{k}:{s}:{e}" for k, s, e, _ in xs)
    base = [x for x in spans if x[0] in BASE_KINDS]
    n = [sum(x[0] == k for x in spans) for k in BASE_KINDS]
    return (*n, hashlib.sha256(shown(base).encode()).hexdigest(), shown(spans), len(spans) - len(base),
            max((x[3] for x in spans), default=None))


def digest(docs: DataFrame) -> DataFrame:
    """Counts, digest and spans per document."""
    return map_texts(docs, _digest, [
        ("n_email", T.LongType()), ("n_ip", T.LongType()), ("n_card", T.LongType()), ("n_phone", T.LongType()),
        ("base_sha256", T.StringType()), ("spans", T.StringType()), ("n_added", T.LongType()), ("top_score", T.DoubleType())])
