"""Line dedup against plain Python."""

import random
from collections import defaultdict

from starmart.llm import lines


def plain(rows, min_sites):
    sites, first = defaultdict(set), {}
    for i, text, source in rows:
        for n, line in enumerate((text or "").split("\n")):
            key = line.translate({9: " ", 11: " ", 12: " ", 13: " "}).strip(" ")
            if key and text is not None:
                if source is not None:
                    sites[key].add(source)
                place = (i is None, i or 0, n)
                first[key] = min(first.get(key, place), place)
    out = []
    for i, text, _ in rows:
        kept = []
        for n, line in enumerate((text or "").split("\n")):
            key = line.translate({9: " ", 11: " ", 12: " ", 13: " "}).strip(" ")
            if not key or len(sites[key]) < min_sites or first[key] == (i is None, i or 0, n):
                kept.append(line)
        out.append((i, None if text is None else "\n".join(kept)))
    return sorted(out, key=str)


def test_against_plain(documents):
    pick = random.Random(2)
    common = [f"common line {i}" for i in range(12)]
    rows = [(i, "\n".join(pick.choice([*common, "", " ", f"own {i} {pick.random()}", f" {common[0]}\t"]) for _ in range(pick.randint(1, 9))),
             pick.choice(["a", "b", "c", "d", "e", "f", None])) for i in range(60)]
    got = sorted(((r.doc_id, r.text) for r in lines.dedup(documents(*rows), 5).collect()), key=str)
    assert got == plain(rows, 5)


def test_threshold_is_exact(documents):
    rows = [(i, f"four\nfive {i}" if i < 4 else f"never {i}\nfour" if i == 9 else "x", "abcd"[i % 4]) for i in range(10)]
    rows += [(20 + i, "on five sites", "abcde"[i]) for i in range(5)]
    got = {r.doc_id: r.n_removed for r in lines.report(documents(*rows)).collect()}
    assert {i for i, n in got.items() if n} == {21, 22, 23, 24}


def test_odd_rows(odd):
    out = lines.dedup(odd)
    assert out.columns == [*odd.columns, "lines_removed_"] and out.count() == 12
    assert {(r.doc_id, r.text) for r in out.collect()} == {(r.doc_id, r.text) for r in odd.collect()}


def test_all_lines_lost_and_empty_table(documents):
    rows = documents(*[(i, "one line", s) for i, s in enumerate("abcdef")])
    got = {r.doc_id: (r.n_lines, r.n_removed, r.text) for r in lines.report(rows).collect()}
    assert got[0] == (1, 0, "one line") and got[5] == (1, 1, "")
    assert lines.report(documents()).count() == 0
