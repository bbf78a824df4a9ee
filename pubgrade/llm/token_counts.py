"""Token counts under a byte-level BPE vocabulary, without identifiers.

A piece of text starts with one symbol per byte; a heap holds the ranks of
adjacent pairs and a linked list the symbols left. The pair of lowest rank is
popped and merged until none is left: the count is the number of initial symbols
minus the number of merges. Counts of distinct units (blanks and the word after
them) are kept between batches, so the heap runs once per unit and worker.

Rows: doc_id, n_bytes, n_tokens, over_limit. Null and empty texts have no tokens.
Strings of special tokens inside a text count as one token each, as in the
tokenizer library's default. Rows are independent: repeated ids or rows are
counted each, a null doc_id stays null, other columns of the input are ignored,
and an empty table gives no rows.
"""

import json
import re
from collections.abc import Iterator
from heapq import heapify, heappop, heappush
from itertools import pairwise

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame

from pubgrade.llm import words

#: Units whose counts a worker keeps (16 bytes each); beyond, it starts anew.
KEPT_UNITS = 2_000_000
KEPT_PIECES = 500_000

#: Fixed value: white space as the library's patterns understand it.
SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
#: Fixed value: the splitting pattern of byte-level vocabularies, with white space written out.
PIECE = rf"'s|'t|'re|'ve|'m|'ll|'d| ?\p{{L}}+| ?\p{{N}}+| ?[^{SPACE}\p{{L}}\p{{N}}]+|[{SPACE}]+(?![^{SPACE}])|[{SPACE}]+"


def byte_symbols() -> list[str]:
    """The character that stands for each byte in byte-level vocabularies: itself if printable, else the next free one from 256 on."""
    printable = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in printable else chr(next(spare)) for b in range(256)]


class Counter:
    """Token counts of texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or spec["normalizer"] or spec["pre_tokenizer"]["type"] != "ByteLevel" or spec["pre_tokenizer"]["add_prefix_space"]:
            raise ValueError(f"not a plain byte-level BPE vocabulary: {path}")
        ids = model["vocab"]
        self.first = [ids[c] for c in byte_symbols()]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        #: by left symbol: right symbol -> rank; by rank: the merged symbol
        self.pairs: list[dict[int, int]] = [{} for _ in range(max(ids.values()) + 1)]
        for rank, (a, b) in enumerate(merges):
            self.pairs[ids[a]][ids[b]] = rank
        self.made = [ids[a + b] for a, b in merges]
        special = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.special = re.compile("|".join(map(re.escape, special))) if special else None
        self.marks = [s.encode() for s in special]
        self.pieces = regex.compile(PIECE)
        self.kept: dict[bytes, int] = {}
        self.hashes, self.counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)

    def merge(self, piece: bytes) -> int:
        """Tokens of one piece."""
        n = len(piece)
        pairs, made = self.pairs, self.made
        shift = n.bit_length()
        low = (1 << shift) - 1
        symbols = [self.first[b] for b in piece]
        ranks = [pairs[a].get(b, -1) for a, b in pairwise(symbols)]  # of the pair that begins at each symbol
        ranks.append(-1)
        heap = [r << shift | i for i, r in enumerate(ranks) if r >= 0]
        heapify(heap)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        left = n
        while heap:
            top = heappop(heap)
            i = top & low
            if ranks[i] != top >> shift:
                continue  # one of the two has been merged meanwhile
            merged = symbols[i] = made[top >> shift]
            j = after[i]
            ranks[j] = -1
            k = after[i] = after[j]
            left -= 1
            if k < n:
                before[k] = i
                rank = ranks[i] = pairs[merged].get(symbols[k], -1)
                if rank >= 0:
                    heappush(heap, rank << shift | i)
            else:
                ranks[i] = -1
            h = before[i]
            if h >= 0:
                rank = ranks[h] = pairs[symbols[h]].get(merged, -1)
                if rank >= 0:
                    heappush(heap, rank << shift | h)
        return left

    def plain(self, text: str) -> int:
        """Tokens of a text without special strings."""
        total = 0
        for piece in self.pieces.findall(text):
            raw = piece.encode()
            count = self.kept.get(raw)
            if count is None:
                count = self.merge(raw)
                if len(self.kept) >= KEPT_PIECES:
                    self.kept.clear()
                if len(raw) <= 64:
                    self.kept[raw] = count
            total += count
        return total

    def text(self, text: str) -> int:
        if self.special is None:
            return self.plain(text)
        return sum(map(self.plain, self.special.split(text))) + len(self.special.findall(text))

    def batch(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Tokens of every text of a step."""
        _, ends, _ = words.spans(buffer, offsets)
        cuts = np.union1d(ends, offsets)
        starts, ends = cuts[:-1], cuts[1:]
        hashes, where, inverse = np.unique(words.hash_spans(buffer, starts, ends), return_index=True, return_inverse=True)
        sums = np.zeros(len(starts) + 1, np.int64)
        np.cumsum(self._known(hashes, where, buffer, starts, ends)[inverse], out=sums[1:])
        total = np.diff(sums[np.searchsorted(starts, offsets)])
        for i in self._odd(buffer, offsets):
            total[i] = self.text(buffer[offsets[i] : offsets[i + 1]].tobytes().decode())
        return total

    def _known(self, hashes, where, buffer, starts, ends) -> np.ndarray:
        at = np.searchsorted(self.hashes, hashes)
        if len(self.hashes):
            new = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes)
        else:
            new = np.arange(len(hashes))
        if len(new):
            if len(self.hashes) + len(new) > KEPT_UNITS:
                self.hashes, self.counts = self.hashes[:0], self.counts[:0]
                new, at = np.arange(len(hashes)), np.zeros(len(hashes), np.int64)
            units = [buffer[starts[k] : ends[k]].tobytes().decode() for k in where[new]]
            counts = np.fromiter(map(self.plain, units), np.int64, len(units))
            self.hashes, self.counts = np.insert(self.hashes, at[new], hashes[new]), np.insert(self.counts, at[new], counts)
            at = np.searchsorted(self.hashes, hashes)
        return self.counts[at]

    def _odd(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """Texts that don't fall into units at their blanks: with special strings, or white space outside ASCII."""
        raw = buffer.tobytes()
        found = []
        for mark in self.marks:
            at = raw.find(mark)
            while at >= 0:
                found.append(at)
                at = raw.find(mark, at + 1)
        lead = np.flatnonzero((buffer == 0xC2) | (buffer == 0xE1) | (buffer == 0xE2) | (buffer == 0xE3))
        one, two, three = buffer[lead], *(buffer[np.minimum(lead + k, len(buffer) - 1)] for k in (1, 2))
        space = (one == 0xC2) & ((two == 0x85) | (two == 0xA0))
        space |= (one == 0xE1) & (two == 0x9A) & (three == 0x80)
        space |= (one == 0xE2) & (two == 0x80) & ((three <= 0x8A) | (three == 0xA8) | (three == 0xA9) | (three == 0xAF))
        space |= (one == 0xE2) & (two == 0x81) & (three == 0x9F)
        space |= (one == 0xE3) & (two == 0x80) & (three == 0x80)
        return np.unique(np.searchsorted(offsets, [*found, *lead[space]], "right") - 1)


_counters: dict[str, Counter] = {}


def counter(path: str) -> Counter:
    """The worker's counter for a vocabulary."""
    if path not in _counters:
        _counters[path] = Counter(path)
    return _counters[path]


def count_tokens(docs: DataFrame, path: str, limit: int = 512) -> DataFrame:
    """One row per document; ``path`` is a vocabulary file that every executor has."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = counter(path)
        for batch in batches:
            for rows, buffer, offsets in words.steps(batch.column(1)):
                tokens = model.batch(buffer, offsets)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(rows.start, len(tokens)), pa.array(np.diff(offsets)), pa.array(tokens), pa.array(tokens > limit)],
                    names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
                )

    return docs.select("doc_id", "text").mapInArrow(count, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
