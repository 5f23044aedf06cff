"""License scans against plain code over word lists."""

import re

from starmart.llm import licenses


def plain(text, catalog):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({i: i + 32 for i in range(65, 91)}))
    joined = "".join(f" {w} " for w in words)
    found = []
    for i, r in enumerate(catalog):
        for m in re.finditer(r.regex, joined):
            start, end = joined.count(" ", 0, m.start()) // 2, joined.count(" ", 0, m.end()) // 2 - 1
            found.append((start, end, r.priority, i, r))
    kept = [f for f in found if not any(
        g[0] <= f[0] and g[1] >= f[1] and g[2] >= f[2] and (g[0], -g[1], -g[2], g[3]) < (f[0], -f[1], -f[2], f[3]) for g in found)]
    base = [f for f in found if f[4].base]
    return (len(words), len(base), min((f[0] for f in base), default=None), max((f[0] for f in base), default=None),
            ",".join(sorted({f[4].label for f in base})), ",".join(sorted({f[4].label for f in base} | {f[4].label for f in kept})),
            max((f[2] for f in kept), default=0) / 100)


TEXTS = [
    "Released under the MIT License.", "under the  mit-license under THE mit license", "Licensed under the Apache License, Version 2.0.",
    "Licensed under CC BY-NC 4.0.", "cc by nc cc by nc", "SPDX-License-Identifier: GPL-3.0 or later", "under the mit licenses",
    "This work is licensed under the GNU General Public License, version 3.", "the GNU Lesser General Public Licence v2 and all rights reserved",
    "CC0 1.0", "Creative Commons Attribution-NonCommercial-ShareAlike 4.0", "available under the terms of the Mozilla Public License 2.0",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "word " * 9000 + "under the mit license", "x" * 40_000,
]


def test_against_plain(documents, odd):
    catalog = licenses.rules()
    assert len(catalog) > 300
    rows = [*enumerate(TEXTS), (90, " ".join(TEXTS[:12])), (91, None)]
    docs = documents(*[(i, t, "s") for i, t in rows])
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels, r.labels, r.score) for r in licenses.report(docs).collect()}
    for i, t in rows:
        assert got[i] == plain(t, catalog), t
    assert len(licenses.report(odd).collect()) == 12
    assert licenses.report(documents()).count() == 0


def test_gates_let_every_match_through(documents):
    """A text made of the shortest match of each rule is scanned."""
    texts = []
    for r in licenses.rules():
        t = re.sub(r"\(\?:[^()]*\)\?", "", r.regex)
        texts.append(re.sub(r"\(\?:([^()|]*)[^()]*\)", r"\1", t))
    docs = documents(*[(i, t, "s") for i, t in enumerate(texts)])
    assert licenses.scan(docs).where("size(found) = 0").count() == 0
