"""Spelling variants against all pairs of words in plain code."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from conftest_llm import prose
from starmart.llm import spelling
from starmart.llm.common import prepare

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_words(rows):
    n = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 199 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            n[run] += 1
    return {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}


def one_edit(a, b):
    a, b = sorted((a, b), key=len)
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) == len(a) + 1 and any(b[:i] + b[i + 1:] == a for i in range(len(b)))


def plain(n):
    near = {w: [v for v in n if abs(len(v) - len(w)) <= 1 and one_edit(w, v)] for w in n}
    form = {}
    for w, others in near.items():
        first = min(others, key=lambda v: (-n[v], v), default=None)
        form[w] = first if first is not None and n[first] >= 5 * n[w] else None

    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {w: (form[w], root(w), n[w], len(near[w]), n[form[w]] if form[w] else None) for w in n}


def got(df):
    assert df.columns == ["word", "form", "root", "n", "n_near", "form_n"]
    rows = df.collect()
    assert len({r.word for r in rows}) == len(rows)
    return {r.word: tuple(r)[1:] for r in rows}


def mutated(seed, size, alphabet="abcdeé"):
    pick = random.Random(seed)
    found = {}
    for _ in range(size):
        word = "".join(pick.choice(alphabet) for _ in range(pick.randint(6, 9)))
        for _ in range(pick.randint(1, 5)):
            found[word] = max(5, int(5 ** pick.uniform(1, 5)))
            i = pick.randrange(len(word))
            word = pick.choice([word[:i] + pick.choice(alphabet) + word[i:], word[:i] + pick.choice(alphabet) + word[i + 1:], word[:i] + word[i + 1:]])
    return {w: k for w, k in found.items() if len(w) >= 6}


def vocabulary(spark, n):
    prepare(spark)
    return spark.createDataFrame(list(n.items()), "word string, n long")


@pytest.mark.parametrize("cell,sample", [(20_000, 1 << 15), (25, 500), (10, 40)])
def test_against_all_pairs(spark, cell, sample):
    """One cell, many cells, and tops grown from a sample of few words."""
    n = mutated(3, 500)
    assert got(spelling.group(vocabulary(spark, n), cell=cell, sample=sample)) == plain(n)


def test_many_words_of_equal_letters(spark):
    """Anagrams share one vector: cells are dealt over tasks, leaves compared by places left out."""
    pick, n = random.Random(5), {}
    while len(n) < 300:
        letters = list("aabbccd" + pick.choice(["", "", "e", "d"]))
        pick.shuffle(letters)
        n["".join(letters)] = pick.randint(5, 4000)
    assert got(spelling.group(vocabulary(spark, n), cell=20)) == plain(n)


def test_documents(documents):
    pick = random.Random(8)
    base = [w for w in prose(4, 400).split() if len(w) >= 5][:120]
    rows = []
    for i in range(150):
        words = [pick.choice(base) for _ in range(60)]
        for k in range(0, 60, 9):
            w = words[k]
            words[k] = w[:2] + pick.choice("xyÉß÷") + w[3:]
        rows.append((i if i else None, " ".join(words).title() if i % 3 else "-".join(words) + "1" + words[0], "s"))
    rows += [(200, None, "s"), (201, "", None), (202, "q" * 3000 + " " + "q" * 2999 + "z", "s"), (203, ("wörter " * 9 + "wörterr ") * 2, "s")] * 6
    want = plain_words([(i, t) for i, t, _ in rows])
    assert {r.word: r.n for r in spelling.words(documents(*rows)).collect()} == want
    assert got(spelling.report(documents(*rows))) == plain(want)


def test_empty_table(documents):
    assert spelling.report(documents()).count() == 0


def test_hashes_without_a_place():
    codes = spelling.letters(["abcab", "xbcab", "abcxb"])[0].reshape(3, 5)
    gap, of = spelling.without_one(codes, gap=True)
    assert gap[of == 0][0] == gap[of == 1][0] and gap[of == 0][3] == gap[of == 2][3]
    assert len(set(gap[of == 0])) == 5
    closed, _ = spelling.without_one(codes, gap=False)
    assert (closed[:1] == spelling.whole_hash(np.array([[98, 99, 97, 98]], np.uint32))).all()
