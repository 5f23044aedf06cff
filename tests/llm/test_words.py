"""Word codes against plain Python."""

import re

import numpy as np
import pyarrow as pa
import pytest

from starmart.llm.words import LETTERS, SPACED, Words, row_sets, slices

TEXTS = ["One two  TWO\tthree", None, "", "a", "É é, ß-ß one", "one\x00two", "x " * 500, " lead and trail ", "one two two three"]


@pytest.mark.parametrize("kind, words", [(SPACED, r"[^\x20\x09-\x0D]+"), (LETTERS, r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")])
def test_words(kind, words):
    got, codes = Words(pa.array(TEXTS), kind), {}
    for row, text in enumerate(TEXTS):
        want = re.findall(words, (text or "").translate({i: i + 32 for i in range(65, 91)}))
        span = range(got.first[row], got.first[row + 1])
        assert [got.data[got.starts[i]:got.ends[i]].tobytes().decode() for i in span] == want
        for i, w in zip(span, want):
            assert codes.setdefault(w, got.codes[i]) == got.codes[i]
    assert len(set(codes.values())) == len(codes)


def test_shingles():
    got = Words(pa.array(TEXTS), SPACED)
    codes, first = row_sets(*got.shingles(3))
    sizes = []
    for text in TEXTS:
        w = (text or "").lower().split()
        sizes.append(len({tuple(w[i:i + 3]) for i in range(max(len(w) - 2, 1))}) if w else 0)
    assert np.diff(first).tolist() == sizes
    fewer, again = Words(pa.array(["a b", "a", "b a", "a b"]), SPACED).shingles(3)
    assert len(set(fewer.tolist())) == 3 and fewer[0] == fewer[3] and again.tolist() == [0, 1, 2, 3, 4]


def test_slices_keep_all_rows():
    batch = pa.RecordBatch.from_arrays([pa.array(["x" * 700_000, None, "y" * 700_000, "z" * 3_000_000, ""])], ["text"])
    parts = list(slices(iter([batch, batch.slice(0, 0)])))
    assert [p.num_rows for p in parts] == [2, 1, 1, 1]
    assert Words(parts[2].column("text"), SPACED).counts().tolist() == [1]
