"""Spans, hashes and sets against plain Python."""

import random
import re

import numpy as np
import pyarrow as pa

from pubgrade.llm import words

TEXTS = ["a b", None, "", " lead and trail ", "x", "\n\n", "a b a b a b", "Ünï cödé  two", "end"]


def test_spans_equal_pattern(monkeypatch):
    monkeypatch.setattr(words, "STEP_BYTES", 12)
    found = []
    for _, buffer, offsets in words.steps(pa.array(TEXTS)):
        starts, ends, firsts = words.spans(buffer, offsets)
        each = [buffer[a:b].tobytes().decode() for a, b in zip(starts, ends)]
        found += [each[a:b] for a, b in zip(firsts[:-1], firsts[1:])]
    assert found == [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in TEXTS]


def test_sliced_array():
    rows = [(r, b.tobytes()) for r, b, _ in words.steps(pa.array(TEXTS).slice(3, 2))]
    assert rows == [(slice(0, 2), b" lead and trail x")]


def test_equal_words_have_equal_hashes_anywhere():
    rng = random.Random(3)
    vocabulary = ["a", "b", "ab", "ba", "aa", "aaa", "A", "é", "word", "words"]
    texts = [" ".join(rng.choices(vocabulary, k=30)) for _ in range(40)]
    seen = {}
    for _, buffer, offsets in words.steps(pa.array(texts)):
        hashes, _ = words.word_hashes(buffer, offsets, lower=False)
        for word, h in zip(" ".join(texts).split(), hashes.tolist()):
            assert seen.setdefault(word, h) == h
    assert len(set(seen.values())) == len(vocabulary)


def test_shingles():
    h = np.array([1, 2, 3, 1, 2, 3, 1], np.uint64)
    assert len(words.shingles(h, 3)) == 3 and len(words.shingles(h, 5)) == 3
    assert len(words.shingles(h[:2], 4)) == 1 and len(words.shingles(h[:0], 4)) == 0
    assert words.shingles(h[:2], 4) != words.shingles(h[:1], 4)
