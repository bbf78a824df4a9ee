"""Token counts and token files against the tokenizer library."""

import random
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from pubgrade.llm import token_counts, token_files, words
from pubgrade.llm.tables import scratch_path

BYTE, WORD = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("word_bpe_49k.json")
PARTS = ["<|endoftext|>", "<|startoftext|>", "<|endof", " ", "  ", "\n", "\t", " ", "　", "\x85", " ", "é", "É", "é", "ß", "日本", "12", "½"]
PARTS += ["don't", "'ll", "a", "B", ".", "###", "\x1c", "᠎", "​", "﻿", "\U0001f600", "́", "\x0b", "\r", "\x01", "ΑΣ", "İ", "Word,", "words."]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(2)
    return ["".join(rng.choices(PARTS, k=rng.randint(0, 14))) for _ in range(4000)] + ["", "x" * 3000]


def lines(texts, one):
    return [v for _, buffer, offsets in words.steps(pa.array(texts)) for v in one(buffer, offsets)]


def test_counts(texts, monkeypatch):
    monkeypatch.setattr(token_counts, "KEPT_UNITS", 500)  # forgets and starts anew
    model = token_counts.Counter(BYTE)
    expected = [len(e) for e in Tokenizer.from_file(BYTE).encode_batch(texts, add_special_tokens=False)]
    assert lines(texts, model.batch) == expected


def test_counts_of_all_code_points():
    texts = [f"a{chr(k)}1 {chr(k)} b{chr(k)} c" for k in range(0x20000) if not 0xD800 <= k < 0xE000]
    expected = [len(e) for e in Tokenizer.from_file(BYTE).encode_batch_fast(texts, add_special_tokens=False)]
    assert lines(texts, token_counts.counter(BYTE).batch) == expected


def test_count_rows(docs, edge_rows):
    found = token_counts.count_tokens(docs(*edge_rows), BYTE, limit=3).collect()
    library = Tokenizer.from_file(BYTE)
    expected = []
    for doc, text in edge_rows:
        n = len(library.encode(text or "", add_special_tokens=False))
        expected.append((doc, len((text or "").encode()), n, n > 3))
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)


def test_ids(texts, monkeypatch):
    monkeypatch.setattr(token_files, "KEPT_WORDS", 300)
    model = token_files.Encoder(WORD, 2)

    def each(buffer, offsets):
        ids, sizes = model.batch(buffer, offsets)
        return [part.tolist() for part in np.split(ids, np.cumsum(sizes)[:-1])]

    expected = [e.ids + [2] for e in Tokenizer.from_file(WORD).encode_batch(texts, add_special_tokens=False)]
    assert lines(texts, each) == expected


def test_files(spark, docs, edge_rows):
    rows = [r for r in edge_rows if r[0] is not None] + [(100 + i, f"text number {i} " * i) for i in range(50)]
    files = token_files.write_token_files(docs(*rows), scratch_path(spark, "ids"), WORD, end_id=2, length=64)
    library = Tokenizer.from_file(WORD)
    expected, start = [], 0
    found = sorted(map(tuple, token_files.read_token_files(files).collect()), key=lambda r: r[1])
    assert [r[0] for r in found] == sorted(d for d, _ in rows)
    pool = {}
    for doc, text in rows:
        pool.setdefault(doc, []).append(library.encode(text or "", add_special_tokens=False).ids + [2])
    for doc, begin, n, crc in found:
        assert begin == start
        match = [ids for ids in pool[doc] if len(ids) == n and zlib.crc32(np.array(ids, "<u4").tobytes()) == crc]
        pool[doc].remove(match[0])
        start += n
    assert not any(pool.values())
    # random access: sequences of equal length, masked where filled up
    for row in files.collect():
        file = token_files.TokenFile(row.path)
        last = -(-row.n_tokens // 64) - 1
        assert len(file.sequence(0)) == 64 and file.mask(last).sum() == row.n_tokens - last * 64
        assert not file.sequence(0).flags.owndata


def test_no_documents(spark, docs):
    empty = docs((1, "a")).where("false")
    files = token_files.write_token_files(empty, scratch_path(spark, "ids"), WORD, end_id=2)
    assert token_files.read_token_files(files).count() == 0 and token_counts.count_tokens(empty, BYTE).count() == 0
