"""License scans by ordered signature rules, DataFrame functions only.

A text is lower-cased (A-Z) and cut into words of ASCII letters, digits and
characters beyond ASCII. A rule is a regular expression over the words (one
space between), keywords of which the words must hold one for it to be tried, a label,
a priority and a score. The rules are the product of the names below with the
templates, in priority order, and a few signatures of license bodies. What a
rule finds is an interval of words; an interval that lies in one of the same or
a higher priority is suppressed, equal intervals go to the earlier rule.

Defined results: null, empty and word-less texts have no words and labels;
repeated rows give repeated rows."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from .common import let, matches, prefix

#: Words of a text as given; lower-casing A-Z does not change their limits.
WORDS = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
BETWEEN = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"

# Base phrases and their labels (fixed values).
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Names by label: a pattern over words, without the word "license" around it (fixed values).
NAMES = {
    "mit": "(?:the )?(?:mit|expat)",
    "mit-0": "mit no attribution|mit 0",
    "x11": "x11|mit x11",
    "isc": "isc|internet systems consortium",
    "0bsd": "0bsd|zero clause bsd|bsd zero clause",
    "bsd-2-clause": "bsd 2 clause|2 clause bsd|simplified bsd|freebsd",
    "bsd-3-clause": "bsd 3 clause|3 clause bsd|new bsd|modified bsd",
    "bsd-4-clause": "bsd 4 clause|4 clause bsd|original bsd",
    "bsd": "bsd",
    "apache-1.0": "apache (?:software )?(?:license )?(?:version |v)?1 0",
    "apache-1.1": "apache (?:software )?(?:license )?(?:version |v)?1 1",
    "apache-2.0": "apache (?:software )?(?:license )?(?:version |v)?2(?: 0)?",
    "gpl-1.0": "(?:gnu )?(?:gpl|general public license) ?(?:version |v)?1(?: 0)?",
    "gpl-2.0": "(?:gnu )?(?:gpl|general public license) ?(?:version |v)?2(?: 0)?",
    "gpl-3.0": "(?:gnu )?(?:gpl|general public license) ?(?:version |v)?3(?: 0)?",
    "lgpl-2.0": "(?:gnu )?(?:lgpl|library general public license) ?(?:version |v)?2(?: 0)?",
    "lgpl-2.1": "(?:gnu )?(?:lgpl|lesser general public license) ?(?:version |v)?2 1",
    "lgpl-3.0": "(?:gnu )?(?:lgpl|lesser general public license) ?(?:version |v)?3(?: 0)?",
    "agpl-3.0": "(?:gnu )?(?:agpl|affero general public license) ?(?:version |v)?3(?: 0)?",
    "gfdl-1.1": "(?:gnu )?(?:gfdl|free documentation license) ?(?:version |v)?1 1",
    "gfdl-1.2": "(?:gnu )?(?:gfdl|free documentation license) ?(?:version |v)?1 2",
    "gfdl-1.3": "(?:gnu )?(?:gfdl|free documentation license) ?(?:version |v)?1 3",
    "mpl-1.0": "(?:mozilla public license|mpl) ?(?:version |v)?1 0",
    "mpl-1.1": "(?:mozilla public license|mpl) ?(?:version |v)?1 1",
    "mpl-2.0": "(?:mozilla public license|mpl) ?(?:version |v)?2(?: 0)?",
    "epl-1.0": "(?:eclipse public license|epl) ?(?:version |v)?1 0",
    "epl-2.0": "(?:eclipse public license|epl) ?(?:version |v)?2(?: 0)?",
    "eupl-1.1": "(?:european union public licen[cs]e|eupl) ?(?:version |v)?1 1",
    "eupl-1.2": "(?:european union public licen[cs]e|eupl) ?(?:version |v)?1 2",
    "cddl-1.0": "(?:common development and distribution license|cddl) ?(?:version |v)?1 0",
    "cddl-1.1": "(?:common development and distribution license|cddl) ?(?:version |v)?1 1",
    "cpl-1.0": "common public license(?: version)?(?: 1 0)?",
    "osl-3.0": "(?:open software license|osl) ?(?:version |v)?3 0",
    "afl-3.0": "(?:academic free license|afl) ?(?:version |v)?3 0",
    "artistic-1.0": "artistic (?:license )?(?:version )?1 0",
    "artistic-2.0": "artistic (?:license )?(?:version )?2 0",
    "bsl-1.0": "boost software license(?: version)?(?: 1 0)?",
    "busl-1.1": "business source license(?: version)?(?: 1 1)?",
    "sspl-1.0": "server side public license(?: version)?(?: 1)?",
    "elastic-2.0": "elastic license ?(?:version )?2 0",
    "zlib": "zlib|zlib libpng",
    "libpng": "libpng|png reference library",
    "unlicense": "the unlicense|unlicense org",
    "wtfpl": "wtfpl|do what the fuck you want to public license",
    "psf-2.0": "python software foundation|psf 2 0",
    "php-3.01": "php (?:license )?(?:version )?3 01",
    "postgresql": "postgresql",
    "ncsa": "university of illinois ncsa|ncsa open source",
    "openssl": "openssl",
    "ofl-1.1": "(?:sil )?open font license(?: version)?(?: 1 1)?",
    "ms-pl": "microsoft public license|ms pl",
    "ms-rl": "microsoft reciprocal license|ms rl",
    "odbl-1.0": "open database license|odbl",
    "odc-by-1.0": "open data commons attribution|odc by",
    "pddl-1.0": "public domain dedication and license|pddl",
    "cc0-1.0": "cc0(?: 1 0)?|cc zero|creative commons zero",
    "cc-by-1.0": "(?:cc|creative commons) (?:by|attribution) 1 0",
    "cc-by-2.0": "(?:cc|creative commons) (?:by|attribution) 2 0",
    "cc-by-2.5": "(?:cc|creative commons) (?:by|attribution) 2 5",
    "cc-by-3.0": "(?:cc|creative commons) (?:by|attribution) 3 0",
    "cc-by-4.0": "(?:cc|creative commons) (?:by|attribution) 4 0",
    "cc-by-sa-3.0": "(?:cc|creative commons) (?:by sa|attribution share ?alike) 3 0",
    "cc-by-sa-4.0": "(?:cc|creative commons) (?:by sa|attribution share ?alike) 4 0",
    "cc-by-nc-3.0": "(?:cc|creative commons) (?:by nc|attribution non ?commercial) 3 0",
    "cc-by-nc-4.0": "(?:cc|creative commons) (?:by nc|attribution non ?commercial) 4 0",
    "cc-by-nd-4.0": "(?:cc|creative commons) (?:by nd|attribution no ?deriv(?:ative)?s) 4 0",
    "cc-by-nc-sa-4.0": "(?:cc|creative commons) (?:by nc sa|attribution non ?commercial share ?alike) 4 0",
    "cc-by-nc-nd-4.0": "(?:cc|creative commons) (?:by nc nd|attribution non ?commercial no ?deriv(?:ative)?s) 4 0",
}

# Keywords, one of which a line must hold for a name's rules to be tried, where they are not the label's first part (fixed values).
KEYWORDS = {
    "mit": ("mit", "expat"), "isc": ("isc", "internet systems consortium"), "0bsd": ("bsd",),
    "gpl": ("gpl", "general public license"), "lgpl": ("lgpl", "library general", "lesser general"), "agpl": ("agpl", "affero"),
    "gfdl": ("gfdl", "free documentation license"), "mpl": ("mpl", "mozilla"), "epl": ("epl", "eclipse"),
    "eupl": ("eupl", "european union"), "cddl": ("cddl", "common development"), "cpl": ("cpl", "common public license"),
    "osl": ("osl", "open software license"), "afl": ("afl", "academic free"), "bsl": ("bsl", "boost"), "busl": ("busl", "business source"),
    "sspl": ("sspl", "server side public"), "libpng": ("png",), "wtfpl": ("wtfpl", "do what the"), "psf": ("psf", "python software foundation"),
    "ncsa": ("ncsa",), "ofl": ("ofl", "open font license"), "ms": ("microsoft", "ms pl", "ms rl"), "odbl": ("odbl", "open database license"),
    "odc": ("odc by", "open data commons"), "pddl": ("pddl", "public domain dedication"), "cc0": ("cc0", "cc zero", "creative commons zero"),
    "cc": ("cc by", "cc attribution", "creative commons"),
}

# Signatures of license bodies: pattern over words, label (fixed values).
BODIES = (
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("permission to use copy modify and or distribute this software for any purpose", "isc"),
    ("redistributions of source code must retain the above copyright notice", "bsd"),
    ("neither the name of .{1,60} nor the names of its contributors", "bsd-3-clause"),
    ("this program is free software you can redistribute it and or modify it", "gpl"),
    ("this library is free software you can redistribute it and or modify it", "lgpl"),
    ("you may not use this file except in compliance with the license", "apache"),
    ("this source code form is subject to the terms of the mozilla public license", "mpl-2.0"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("released into the public domain|dedicated to the public domain", "public-domain"),
    ("all rights reserved", "all-rights-reserved"),
    ("gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("gnu affero general public license", "agpl"),
    ("creative commons", "cc"),
)

# Templates around a name: pattern, priority, score (fixed values). "By" a name
# alone says who did it; "by the <name> license" is the fourth.
TEMPLATES = (
    ("spdx license identifier (?:{id})", 3, 1.0),
    ("(?:licensed|released|distributed|published|available|provided|covered) (?:to you )?under (?:the )?(?:terms of )?"
     "(?:the )?(?:{name})(?: licen[cs]e)?", 3, 0.95),
    ("(?:see|under|subject to) (?:the )?(?:terms of )?(?:the )?(?:{name}) licen[cs]e", 2, 0.85),
    ("(?:{name}) licen[cs]e", 2, 0.8),
    ("(?:{name})", 2, 0.75),   # of names that hold the word themselves
)

@dataclass(frozen=True)
class Rule:
    pattern: str
    label: str
    priority: int
    keywords: tuple[str, ...]
    score: float
    #: What a text with a match holds from the start of a word on: a pattern that other rules share, one that follows it.
    needs: tuple[str, str]


def rules() -> list[Rule]:
    """The ordered rules: templates over names by priority, then bodies."""
    out = []
    for pattern, priority, score in TEMPLATES:
        for label, name in NAMES.items():
            ident = "|".join({label.replace("-", " ").replace(".", " "): 0, label.replace("-", " ").replace(".", " ") + " (?:only|or later)": 0})
            first = label.split("-")[0]
            if pattern == "(?:{name})" and "licen" not in name:
                continue
            head = pattern.split("(?:{name})")[0]
            needs = ("licen[cs]", "") if "licen" in pattern.removesuffix("(?: licen[cs]e)?").replace("licensed|", "") else (head, name)
            out.append(Rule(pattern.format(name=name, id=ident), label, priority, KEYWORDS.get(first, (first,)), score, needs))
    for p, label in BODIES:
        words = tuple(x.split(" .")[0] for x in p.split("|"))
        out.append(Rule(p, label, 1, words, 0.7, ("", "|".join(words))))
    return sorted(out, key=lambda r: -r.priority)


def gate(table: list[Rule]) -> str:
    """A pattern for texts as given: one without a match has no match of a rule
    and no base phrase."""
    parts: dict[str, dict[str, None]] = {"": {p: None for p, _ in PHRASES}}
    for r in table:
        parts.setdefault(r.needs[0], {})[r.needs[1]] = None
    spaced = lambda p: p.replace(" ", f"(?:{BETWEEN})")
    each = "|".join(f"{spaced(head)}(?:{'|'.join(map(spaced, rest))})" for head, rest in parts.items())
    return f"(?i)(?<!{WORDS[:-1]})(?:{each})"


def _count_words(s: Column) -> Column:
    return F.regexp_count(s, F.lit("[^ ]+"))


def _whole(pattern) -> Column:
    """The pattern between spaces, as the words are set."""
    if isinstance(pattern, str):
        return F.lit(f"(?<= )(?:{pattern})(?= )")
    return F.concat(F.lit("(?<= )(?:"), pattern, F.lit(")(?= )"))


FOUND = "array<struct<start:bigint,end:bigint,priority:int,rule:int>>"


def base_places(line: Column) -> Column:
    """Places of the base phrases: ``array<struct<start, end, value>>`` in words."""
    return matches(line, _whole("|".join(p for p, _ in PHRASES)), _count_words)


def rule_places(line: Column, table: list[Rule]) -> Column:
    """Places of all rules whose keyword the line holds, in words."""
    sets: dict[tuple[str, ...], list[Column]] = {}   # a set of keywords is looked for once, not for each of its rules
    for i, r in enumerate(table):
        sets.setdefault(r.keywords, []).append(F.struct(F.lit(r.pattern).alias("pattern"), F.lit(r.priority).alias("priority"), F.lit(i).alias("rule")))
    rows = F.array(*[F.struct(F.array(*[F.lit(k) for k in ks]).alias("keywords"), F.array(*rs).alias("rules")) for ks, rs in sets.items()])
    held = F.filter(rows, lambda r: F.exists(r["keywords"], lambda k: F.contains(line, k)))
    tried = F.flatten(F.transform(held, lambda r: r["rules"]))
    each = F.transform(tried, lambda r: F.when(
        F.rlike(line, _whole(r["pattern"])), F.transform(matches(line, _whole(r["pattern"]), _count_words), lambda m: F.struct(
            m["start"].alias("start"), m["end"].alias("end"), r["priority"].alias("priority"), r["rule"].alias("rule")))))
    return F.flatten(F.filter(each, lambda x: x.isNotNull()))


def suppress(found: Column, priorities: tuple[int, ...] = (1, 2, 3)) -> Column:
    """``found`` without the intervals that lie in one of their priority or above."""
    def sorted_by_start(xs):
        # longer first, then higher priority, then earlier rule: a container stands before what it contains
        return F.transform(F.array_sort(F.transform(xs, lambda x: F.struct(
            x["start"].alias("start"), (-x["end"]).alias("back"), (-x["priority"]).alias("below"), x["rule"].alias("rule")))),
            lambda x: F.struct(x["start"].alias("start"), (-x["back"]).alias("end"), (-x["below"]).alias("priority"), x["rule"].alias("rule")))

    def kept(xs):
        def reach(p):   # the furthest end so far among intervals of at least this priority
            ends = F.transform(xs, lambda x: F.when(x["priority"] >= p, x["end"]).otherwise(F.lit(-1).cast("long")))
            return prefix(ends, F.lit(-1).cast("long"), lambda a, b: F.greatest(a, b))
        return let(F.array(*[reach(p) for p in priorities]), lambda rs: F.filter(xs, lambda x, i: ~(
            F.get(F.get(rs, x["priority"] - priorities[0]), i) >= x["end"])))
    return F.when(F.size(found) == 0, found).otherwise(let(sorted_by_start(found), kept))


def scan(docs: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    """``docs`` with ``n_words``, ``base`` (places of the base phrases) and
    ``found`` (places of the rules that are not suppressed)."""
    table = rules() if table is None else table
    text = F.coalesce(F.col("text"), F.lit(""))
    # translate, as lower() would also change letters beyond ASCII
    line = F.translate(F.concat(F.lit(" "), F.array_join(F.regexp_extract_all(text, F.lit(WORDS), F.lit(0)), " "), F.lit(" ")),
                        "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    places = F.when(text.rlike(gate(table)), let(line, lambda line: F.struct(
        base_places(line).alias("base"), suppress(rule_places(line, table)).alias("found"))))
    return docs.withColumns({"n_words": F.regexp_count(text, F.lit(WORDS)).cast("long"), "__places": places}).select(
        *[F.col(f"`{c}`") for c in docs.columns if c not in ("n_words", "base", "found")], "n_words",
        F.col("__places.base").alias("base"), F.col("__places.found").alias("found"))


def digest(scanned: DataFrame, table: list[Rule] | None = None) -> DataFrame:
    table = rules() if table is None else table
    labels = F.array(*[F.lit(r.label) for r in table])
    scores = F.array(*[F.lit(r.score) for r in table])
    phrase = F.create_map(*[F.lit(x) for pair in PHRASES for x in pair])
    base, found = F.col("base"), F.col("found")
    n = F.coalesce(F.size(base), F.lit(0)).cast("long")
    n = F.when(base.isNull(), F.lit(0).cast("long")).otherwise(n)
    names = F.coalesce(F.array_distinct(F.transform(base, lambda b: phrase[b["value"]])), F.array().cast("array<string>"))
    more = F.coalesce(F.transform(found, lambda x: labels[x["rule"]]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform(found, lambda x: scores[x["rule"]])), F.lit(0.0))
    return scanned.select(
        "doc_id", "n_words", n.alias("n_base"),
        F.array_min(F.transform(base, lambda b: b["start"])).alias("first_word"),
        F.array_max(F.transform(base, lambda b: b["start"])).alias("last_word"),
        F.array_join(F.array_sort(names), ",").alias("base_labels"),
        F.array_join(F.array_sort(F.array_distinct(F.concat(names, more))), ",").alias("labels"),
        F.greatest(best, F.when(n > 0, F.lit(0.5)).otherwise(F.lit(0.0))).alias("score"))
