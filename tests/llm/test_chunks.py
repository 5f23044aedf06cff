"""Content-defined chunks: round trips, shared passages, edits."""

import random

import pyarrow as pa
from pyspark.sql import functions as F

from starmart.llm import chunks
from conftest_llm import prose


def pieces(*texts):
    data, row, start, end = chunks.cuts(pa.array(list(texts), pa.string()))
    out = [[] for _ in texts]
    for r, a, b in zip(row, start, end):
        out[r].append(data[a:b].tobytes().decode())
    return out


def test_cuts_restore_texts_and_depend_on_neighbours_only():
    texts = [prose(1, 300), None, "", "é" * 3000, "ab" * 2000, prose(2, 3) + "ß€😀" * 50, "\n"]
    assert ["".join(p) for p in pieces(*texts)] == [t or "" for t in texts]
    assert pieces(texts[0])[0] == pieces("other text", texts[0], "more")[1]
    before, after = pieces(texts[0])[0], pieces(texts[0][:500] + "inserted" + texts[0][500:])[0]
    assert len(set(before) - set(after)) <= 4


def test_passages_are_found_and_others_left(documents):
    pick, rows, shared = random.Random(3), [], [prose(100 + i, 55) for i in range(6)]
    for i in range(60):
        text = prose(i, pick.randint(5, 150))
        if i % 2 == 0:
            text += pick.choice(" \n") + shared[i % 6] + ". " + prose(1000 + i, pick.randint(1, 80))
        rows.append((i, text, "s"))
    got = {r.doc_id: r for r in chunks.report(documents(*rows)).collect()}
    assert set(got) == set(range(0, 60, 2))
    raw = {i: t.encode() for i, t, _ in rows}
    for i, r in got.items():
        passage = shared[i % 6].encode()
        assert set(r.shared_with) <= {j for j in range(0, 60, 6) for j in [j + i % 6] if j != i}
        for s in r.spans:
            assert raw[i][s.start:s.end] in b" " + passage + b". " or raw[i][s.start:s.end] in b"\n" + passage + b". "
    left = {r.doc_id: r.text for r in chunks.without_repeats(documents(*rows)).collect()}
    assert all(left[i] == t for i, t, _ in rows if i % 2 or i < 6)
    assert all(len(t) - len(left[i]) > 150 for i, t, _ in rows if i % 2 == 0 and i >= 6)


def test_large_group_of_copies(documents):
    text = prose(7, 80)
    rows = chunks.report(documents(*[(i, text, "s") for i in range(300)])).collect()
    assert len(rows) == 300 and {r.n_repeated for r in rows} == {len(text)}
    left = chunks.without_repeats(documents(*[(i, text, "s") for i in range(300)]))
    assert left.agg(F.sum(F.length("text"))).first()[0] == len(text)


def test_odd_rows(odd, documents):
    assert chunks.report(odd).count() == 0           # repetition within one document is not across documents
    left = chunks.without_repeats(odd)
    assert left.columns == odd.columns and sorted(map(str, left.collect())) == sorted(map(str, odd.collect()))
    t = prose(3, 90)
    got = chunks.report(documents((None, t, "s"), (5, t + " end", "s"), (5, t, "s"), (5, t, "s"))).collect()
    assert sorted(str(r.doc_id) for r in got) == ["5", "5", "5", "None"]
    assert chunks.report(documents()).count() == chunks.without_repeats(documents()).count() == 0


def kinds(seed):
    """Passages of some 160 to 330 bytes: words, periods of 1 to 8 bytes, a pipe table, short words, two-byte letters, no spaces."""
    pick = random.Random(seed)
    size = pick.randint(160, 330)
    letters = "abcdefghiklmnoprstuvw"
    texts = [prose(seed + 5000, 80), "the " * 90, "".join(pick.choice(letters) for _ in range(pick.randint(1, 8))) * 400,
             "| 1 | 2 " * 20 + prose(seed + 6000, 60), " ".join(pick.choice(letters) for _ in range(200)),
             "".join(pick.choice("äöüßé ") for _ in range(200)), "".join(pick.choice(letters) for _ in range(400))]
    return [t.encode()[:size].decode(errors="ignore") for t in texts]


def test_every_passage_of_160_bytes_holds_a_seed(spark):
    for seed in range(60):
        for passage in kinds(seed):
            if len(passage.encode()) < 160:
                continue
            a, b = [prose(2 * seed + i, 40) + " " + passage + " " + prose(900 + 2 * seed + i, 40) for i in (0, 1)]
            grams = []
            for text in (a, b):
                data, _, start, _ = chunks.cuts(pa.array([text]))
                low = len(text[:text.index(passage)].encode())
                high = low + len(passage.encode())
                grams.append({data[s:s + chunks.GRAM].tobytes() for s in start if low <= s and s + chunks.GRAM <= high})
            assert grams[0] & grams[1], passage


def test_short_periodic_and_whole_texts(documents):
    shared = [p for seed in range(8) for p in kinds(seed) if len(p.encode()) >= 160]
    rows = []
    for i, p in enumerate(shared):
        p = "{" + p + "}"
        rows += [(2 * i + j, prose(7000 + 2 * i + j, 30) + " " + p + " " + prose(8000 + 2 * i + j, 30), "s") for j in (0, 1)]
    n = len(rows)
    rows += [(n, "Short.", "s"), (n + 1, "Short.", "s"), (n + 2, "Short", "s"), (n + 3, prose(1, 15), "s"), (n + 4, prose(1, 15) + " x", "s")]
    got = {r.doc_id: r for r in chunks.report(documents(*rows)).collect()}
    assert set(got) == set(range(n + 2))
    for i, text, _ in rows[:n]:
        raw, passage = text.encode(), shared[i // 2].encode()
        low = raw.index(b"{" + passage + b"}")
        covered = sum(min(s.end, low + len(passage) + 2) - max(s.start, low) for s in got[i].spans if s.end > low and s.start < low + len(passage) + 2)
        assert covered == len(passage) + 2 and got[i].n_repeated <= len(passage) + 6, (text, got[i])
        assert got[i].shared_with
    assert got[n].n_repeated == got[n + 1].n_repeated == 6 and got[n].shared_with == [n + 1]
