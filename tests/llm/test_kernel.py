"""The vectorised words, lines and windows against plain Python."""

import brute
import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from gridcast.llm import kernel as K

ALPHABET = st.sampled_from(list(" \t\n\r\x0b\x0cabcé日.A"))
TEXTS = st.lists(st.one_of(st.none(), st.text(ALPHABET, max_size=30)), max_size=8)


@settings(max_examples=150, deadline=None)
@given(TEXTS, st.integers(1, 40))
def test_words_and_lines(texts, limit):
    column = pa.array(texts, pa.string())
    seen_words, seen_lines = {}, {}
    for t in K.chunks(column, limit):
        for w in range(len(t.start)):
            seen_words.setdefault(t.lo + int(t.doc[w]), []).append(t.data[t.start[w] : t.end[w]].tobytes().decode())
        start, end, doc = t.lines()
        for s, e, d in zip(start, end, doc, strict=True):
            seen_lines.setdefault(t.lo + int(d), []).append(t.data[s:e].tobytes().decode())
    for i, text in enumerate(texts):
        assert seen_words.get(i, []) == brute.words(text)
        assert seen_lines.get(i) == (text or "").split("\n")


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(ALPHABET, max_size=40), max_size=6), st.integers(1, 4))
def test_window_hashes_agree_with_words(texts, length):
    column = pa.array(texts, pa.string())
    by_value, by_words = {}, {}
    for t in K.chunks(column):
        at = K.starts_of(t, length)
        for value, p, d in zip(K.Windows(t.word_hashes())(at, length).tolist(), at, t.doc[at], strict=True):
            words = tuple(brute.words(texts[t.lo + d])[p - t.first[d] : p - t.first[d] + length])
            assert by_value.setdefault(value, words) == words
            assert by_words.setdefault(words, value) == value
    assert len(by_words) == len({w for x in texts for w in (tuple(brute.words(x)[i : i + length]) for i in range(len(brute.words(x)) - length + 1))})


def test_sliced_arrays_and_long_texts():
    column = pa.array(["aa bb", None, "cc", "d " * 100_000]).slice(1)
    found = [(t.lo, t.count.tolist()) for t in K.chunks(column, 64)]
    assert [c for _, counts in found for c in counts] == [0, 1, 100_000]
    assert np.array_equal(K.powers(10)[0][:3] * K.powers(10)[1][:3], np.ones(3, np.uint64))
