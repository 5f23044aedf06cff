"""License scans by ordered signature rules, in DataFrame functions only; no shuffle.

A rule is a phrase over words with a label, a priority and a keyword that every match of it holds.
A text is first reduced to its words (`[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`, A-Z lower-cased), each between spaces
of its own. A scan goes three steps: texts without any gate word are done; of the others, each
rule whose keyword occurs runs its regex; a detection that lies inside one of at least its own
priority is suppressed. Of equal intervals the higher priority stays, then the earlier rule.

Base rules count their places before suppression, and their labels always stay. The score is the
highest priority of what is left, as a share of 1. A null text has no words; it and texts without
a detection get 0 places, empty labels and score 0. Repeated rows are scanned alike, extra columns
are ignored, an empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from starmart.llm.common import fold_case

# Fixed values of the contract: phrase and label.
BASE = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]

# label, name, versions. A name is a phrase: `word?` may be missing, `a|b` is either.
NAMES = [
    ("agpl", "gnu? affero general public license|licence", "3"), ("lgpl", "gnu? lesser general public license|licence", "2 3"),
    ("lgpl", "gnu? library general public license|licence", "2"), ("gpl", "gnu? general public license|licence", "1 2 3"),
    ("gfdl", "gnu? free documentation license|licence", "1"), ("apache", "apache software? license|licence", "1 2"),
    ("mit", "mit license|licence", ""), ("mit", "expat license|licence", ""), ("x11", "x11 license|licence", ""),
    ("bsd", "new|modified|simplified|original? bsd license|licence", ""), ("bsd-2", "bsd 2 clause license|licence", ""),
    ("bsd-3", "bsd 3 clause license|licence", ""), ("isc", "isc license|licence", ""), ("mpl", "mozilla public license|licence", "1 2"),
    ("epl", "eclipse public license|licence", "1 2"), ("cddl", "common development and distribution license|licence", "1"),
    ("cpl", "common public license|licence", "1"), ("eupl", "european union public license|licence", "1"),
    ("osl", "open software license|licence", "1 2 3"), ("afl", "academic free license|licence", "1 2 3"),
    ("artistic", "artistic license|licence", "1 2"), ("zlib", "zlib license|licence", ""), ("boost", "boost software license|licence", "1"),
    ("psf", "python software foundation license|licence", "2"), ("php", "php license|licence", "3"), ("ruby", "ruby license|licence", ""),
    ("unlicense", "unlicense", ""), ("wtfpl", "do what the fuck you want to public license|licence", "2"),
    ("ofl", "sil open font license|licence", "1"), ("odbl", "open database license|licence", "1"),
    ("pddl", "public domain dedication and license|licence", "1"), ("ms-pl", "microsoft public license|licence", ""),
    ("ms-rl", "microsoft reciprocal license|licence", ""), ("upl", "universal permissive license|licence", "1"),
    ("ncsa", "university of illinois ncsa open source license|licence", ""), ("cc0", "creative commons zero", "1"),
    ("cc-by-nc-nd", "creative commons attribution noncommercial noderivatives|noderivs", "2 3 4"),
    ("cc-by-nc-sa", "creative commons attribution noncommercial sharealike", "2 3 4"),
    ("cc-by-nc", "creative commons attribution noncommercial", "2 3 4"), ("cc-by-nd", "creative commons attribution noderivatives|noderivs", "2 3 4"),
    ("cc-by-sa", "creative commons attribution sharealike", "2 3 4"), ("cc-by", "creative commons attribution", "2 3 4"),
]
# Short forms, with the versions that may follow.
SHORT = [
    ("agpl", "agpl", "3"), ("lgpl", "lgpl", "2 3"), ("gpl", "gpl", "1 2 3"), ("apache", "apache", "1 2"), ("mpl", "mpl", "1 2"),
    ("epl", "epl", "1 2"), ("cddl", "cddl", "1"), ("mit", "mit", ""), ("isc", "isc", ""), ("bsd-2", "bsd 2 clause", ""),
    ("bsd-3", "bsd 3 clause", ""), ("zlib", "zlib", ""), ("cc0", "cc0", "1"), ("cc-by-nc-nd", "cc by nc nd", "2 3 4"),
    ("cc-by-nc-sa", "cc by nc sa", "2 3 4"), ("cc-by-nc", "cc by nc", "2 3 4"), ("cc-by-nd", "cc by nd", "2 3 4"), ("cc-by-sa", "cc by sa", "2 3 4"), ("cc-by", "cc by", "2 3 4"),
]
NOTICES = [
    ("all-rights-reserved", "all rights reserved", "reserved"), ("public-domain", "released into the public domain", "domain"),
    ("public-domain", "dedicated to the public domain", "domain"), ("proprietary", "proprietary and confidential", "proprietary"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy", "hereby"),
    ("bsd", "redistribution and use in source and binary forms with or without modification", "redistribution"),
    ("isc", "permission to use copy modify and or? distribute this software for any purpose", "permission"),
]
# Priorities: an identifier tag, a grant of a named version, a grant, a named version, a name, a notice.
TAG, GRANT_VERSION, GRANT, VERSION, NAME, NOTICE = 100, 95, 90, 80, 60, 50
GRANTS = "licensed|released|distributed|available|published under the? terms? of? the?"
# One of these stands in every match of every rule.
GATES = (" licen", " unlicense ", " spdx ", " cc ", " cc0 ", " creative ", " reserved ", " domain ", " proprietary ", " hereby ", " redistribution ",
         " permission ", " licensed ", " released ", " distributed ", " available ", " published ")


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    keyword: str
    regex: str
    base: bool = False


def pattern(phrase: str) -> str:
    """The regex of a phrase, where every word stands between two spaces of its own."""
    out = []
    for token in phrase.split():
        words = token.removesuffix("?").split("|")
        one = f" {words[0]} " if len(words) == 1 else f" (?:{'|'.join(words)}) "
        out.append(f"(?:{one})?" if token.endswith("?") else one)
    return "".join(out)


def _keyword(name: str) -> str:
    return max((t for t in name.split() if "?" not in t and "|" not in t), key=len)


def rules() -> list[Rule]:
    out = [Rule(label, GRANT, _keyword(phrase), pattern(phrase), True) for phrase, label in BASE]
    for label, name, versions in NAMES + SHORT:
        key = _keyword(name)
        short = (label, name, versions) in SHORT
        for v in versions.split():
            versioned = pattern(f"{name} {'license|licence? ' if short else ''}version|v? {v}")
            out += [Rule(f"{label}-{v}", TAG, key, pattern("spdx license identifier") + versioned),
                    Rule(f"{label}-{v}", GRANT_VERSION, key, pattern(GRANTS) + versioned)]
            if not short or label.startswith("cc"):
                out.append(Rule(f"{label}-{v}", VERSION, key, versioned))
        out += [Rule(label, TAG, key, pattern(f"spdx license identifier {name}")), Rule(label, GRANT, key, pattern(f"{GRANTS} {name}"))]
        if not short or label.startswith("cc"):
            out.append(Rule(label, NAME, key, pattern(name)))
    return out + [Rule(label, NOTICE, key, pattern(phrase)) for label, phrase, key in NOTICES]


def _sql(text: str) -> str:
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def scan(docs: DataFrame, catalog: list[Rule] | None = None) -> DataFrame:
    """doc_id, n_words, found: every detection (label, base, priority, start, last, kept) of a document, first to last."""
    catalog = rules() if catalog is None else catalog
    listed = ",".join(f"struct({i} AS rule, {_sql(r.label)} AS label, {r.base} AS base, {r.priority} AS priority, "
                      f"{_sql(f' {r.keyword} ')} AS keyword, {_sql(r.regex)} AS regex)" for i, r in enumerate(catalog))
    levels = sorted({r.priority for r in catalog})
    words = F.regexp_replace(fold_case(F.col("text")), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]++", "  ")
    words = F.trim(words)
    words = F.when(words == "", F.lit("")).otherwise(F.concat(F.lit(" "), words, F.lit(" ")))
    gate = F.lit(False)
    for g in GATES:
        gate = gate | F.col("words").contains(g)
    spaces = "cast(length({0}) - length(replace({0}, ' ', '')) AS bigint)"    # two for each word
    kind = "array<struct<start: bigint, back: bigint, down: int, rule: int, last: bigint, label: string, base: boolean>>"
    start = f"(acc.at + {spaces.format('m.before')})"
    end = f"({start} + {spaces.format('m.match')})"
    detections = f"""
      flatten(transform(filter(array({listed}), r -> contains(words, r.keyword)), r -> aggregate(
        filter(zip_with(split(words, r.regex), regexp_extract_all(words, r.regex, 0), (before, match) -> struct(before, match)),
               m -> m.match is not null),
        struct(0L AS at, cast(array() AS {kind}) AS out),
        (acc, m) -> struct({end} AS at, array_append(acc.out, struct(
          {start} div 2 AS start, 1 - {end} div 2 AS back, -r.priority AS down, r.rule AS rule,
          {end} div 2 - 1 AS last, r.label AS label, r.base AS base)) AS out),
        acc -> acc.out)))"""
    # in order of start, then length, priority and rule, whatever holds a detection comes before it
    reach = "array(" + ",".join(f"if(-d.down >= {p}, greatest(acc.reach[{i}], d.last), acc.reach[{i}])" for i, p in enumerate(levels)) + ")"
    level = "CASE -d.down " + " ".join(f"WHEN {p} THEN {i}" for i, p in enumerate(levels)) + " END"
    kept = f"""
      aggregate(sort_array(found), struct(array({','.join(['-1L'] * len(levels))}) AS reach,
          cast(array() AS array<struct<label: string, base: boolean, priority: int, start: bigint, last: bigint, kept: boolean>>) AS out),
        (acc, d) -> struct({reach} AS reach, array_append(acc.out, struct(
            d.label AS label, d.base AS base, -d.down AS priority, d.start AS start, d.last AS last,
            acc.reach[{level}] < d.last AS kept)) AS out),
        acc -> acc.out)"""
    return (docs.select("doc_id", words.alias("words"))
            .select("doc_id", F.expr(f"{spaces.format('words')} div 2").alias("n_words"),
                    F.when(gate, F.expr(detections)).otherwise(F.array().cast(kind)).alias("found"))
            .select("doc_id", "n_words", F.expr(kept).alias("found")))


def report(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score."""
    joined = "array_join(array_sort(array_distinct(transform(filter(found, d -> {0}), d -> d.label))), ',')"
    places = "transform(filter(found, d -> d.base), d -> d.start)"
    return scan(docs).select(
        "doc_id", "n_words", F.expr(f"cast(size({places}) AS bigint)").alias("n_base"),
        F.expr(f"array_min({places})").alias("first_word"), F.expr(f"array_max({places})").alias("last_word"),
        F.expr(joined.format("d.base")).alias("base_labels"), F.expr(joined.format("d.base OR d.kept")).alias("labels"),
        F.expr("coalesce(array_max(transform(filter(found, d -> d.kept), d -> d.priority)) / 100D, 0D)").alias("score"))
