"""Phrases against plain counting: overlaps, pieces, ties, suppression, split tiles, small chunks."""

import random
import re
from collections import Counter

import numpy as np
import pytest

from pubgrade.llm import collocations


def brute_force(rows, least, top):
    counts, totals = {}, Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", lowered):
            w = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(w)
            for size in range(1, 5):
                for i in range(len(w) - size + 1):
                    counts.setdefault(lang, Counter())[tuple(w[i : i + size])] += 1
    for lang, own in counts.items():
        longer = {p: f for p, f in own.items() if f >= least}
        found = []
        for p, a in longer.items():
            if len(p) < 2 or any(100 * f >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, f in longer.items() if len(q) > len(p)):
                continue
            score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
            found.append((-score, -a, " ".join(p).encode(), l, r))
        for rank, (score, a, phrase, l, r) in enumerate(sorted(found)[:top], 1):
            yield (lang, rank, phrase.decode(), -a, l, r, totals[lang], -score)


def spoken(seed, n, vocabulary):
    rng = random.Random(seed)
    return " ".join(rng.choices(vocabulary, weights=[1 / (k + 1) for k in range(len(vocabulary))], k=n)) + rng.choice([". ", ", ", "\n", " "])


WORDS = ["the", "The", "of", "é", "new", "york", "a", "b.c", "x"] + [f"w{k}" for k in range(30)]
ROWS = [("".join(spoken(k * 7 + j, 20, WORDS) for j in range(6)), ["en", "de", None, "und"][k % 4]) for k in range(120)]
ROWS += [("new york city hall, " * 40, "en"), ("a a a a a a. " * 20, "fr"), ("ab c\tq r " * 9, "fr"), (None, "en"), ("", None), (" ,;. \n", "xx"), ("one", "yy")] + [("same same row", "zz")] * 9


@pytest.mark.parametrize("sizes", [{}, {"chunk_bytes": 2000, "bucket_cells": 50}])
def test_phrases_equal_plain_counting(docs, sizes):
    df = docs(*[(i, text, lang, "s") for i, (text, lang) in enumerate(ROWS)])
    for least, top in ((5, 2000), (8, 25))[len(sizes) // 2 :]:
        got = [tuple(r) for r in collocations.find_collocations(df, least=least, top=top, **sizes).collect()]
        assert sorted(got) == sorted(brute_force(ROWS, least, top))


def test_long_text_and_empty_tables(docs):
    text = ("alpha beta " * 3 + "gamma ") * 60_000
    got = {(r.phrase, r.a, r.n) for r in collocations.find_collocations(docs((1, text, "en", "s")), chunk_bytes=1000).collect()}
    assert ("alpha beta alpha beta", 120_000, 420_000) in got
    assert collocations.find_collocations(docs((1, text, "en", "s")).where("false")).count() == 0
    assert collocations.find_collocations(docs((1, "too rare", "en", "s"))).count() == 0


def test_codes_hold_ids_of_31_bits(spark):
    a, b = np.array([0, 5, 255, 256, 70_000, 2**31 - 1]), np.array([2**31 - 1, 0, 256, 255, 1, 2**31 - 2])
    codes = collocations.tile_codes(a, b)
    df = spark.createDataFrame([(int(c),) for c in codes], "code long").coalesce(1)
    rows = df.select(collocations._first(df.code).alias("a"), collocations._second(df.code).alias("b")).collect()
    assert [(r.a, r.b) for r in rows] == list(zip(a.tolist(), b.tolist()))


def test_full_and_sparse_tiles_count_alike():
    rng = np.random.default_rng(5)
    tiles, expected = collocations.Tiles(), Counter()
    for size in (40_000, 300, 0, 65_000, 20):
        ids = rng.integers(0, 400, (2, size))
        codes, counts = collocations.count_cells(collocations.tile_codes(*ids))
        expected.update(dict(zip(codes.tolist(), counts.tolist())))
        tiles.add(codes, counts)
    assert tiles.dense
    codes, counts = tiles.cells()
    assert dict(zip(codes.tolist(), counts.tolist())) == expected and (np.diff(codes) > 0).all()


def test_tiles_of_frequent_words_are_split():
    buckets = collocations.Buckets(10**12, 10**6, 200, collocations.BUCKET_CELLS)
    head = collocations.tile_codes(np.array([0]), np.array([1]))
    assert buckets.parts(head >> collocations.TILE_BITS)[0] > 1000
    assert len({int(buckets.of(head, chunk)[0]) for chunk in range(1000)}) == 1000
    tail = collocations.tile_codes(np.array([10**9]), np.array([1]))
    assert buckets.parts(tail >> collocations.TILE_BITS)[0] == 1
