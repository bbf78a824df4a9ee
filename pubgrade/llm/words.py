"""Words of whole Arrow batches as numpy arrays: spans, hashes and sets.

A batch of texts is one byte buffer with offsets, so finding and hashing all its
words needs no Python loop. A short span is hashed eight bytes at a time, each mixed
into what came before; a long one by BLAKE2. Equal bytes give equal hashes wherever
they stand, and n different spans share one with a chance of about n * n / 2^65.
Runs of hashed words are hashed as polynomials modulo 2^64 (``prefix``, ``span_hash``):
enough for runs of some dozen values that are hashes themselves, but not for letters
or long runs, where patterns such as abba baab collide whatever the base.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: Bytes of text that one step works on; a longer text is one step of its own.
STEP_BYTES = 1_000_000
#: Spans longer than this are hashed one by one.
SHORT = 64

#: The blanks of the word pattern [^\x20\x09-\x0D]+.
BLANKS = b" \t\n\x0b\x0c\r"
IS_BLANK = np.zeros(256, dtype=bool)
IS_BLANK[list(BLANKS)] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power(kind: str, n: int) -> np.ndarray:
    """Powers 0 to n of the base or of its inverse."""
    if len(_powers[kind]) <= n:
        size = max(n + 1, STEP_BYTES + 1)
        factors = np.full(size, _BASE if kind == "up" else _INVERSE, np.uint64)
        factors[0] = 1
        _powers[kind] = np.cumprod(factors, dtype=np.uint64)
    return _powers[kind]


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(32))
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(29)
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(32)
    return h


def prefix(values: np.ndarray) -> np.ndarray:
    """Prefix sums from which ``span_hash`` takes the hash of any span."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * _power("up", len(values))[: len(values)], out=sums[1:])
    return sums


def span_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    h = (sums[ends] - sums[starts]) * _power("down", len(sums))[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0x94D049BB133111EB))


def hash_spans(buffer: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of byte spans."""
    sizes = ends - starts
    hashes = mix(sizes.astype(np.uint64) * np.uint64(0x94D049BB133111EB))
    # eight bytes from every position on, the first one lowest
    eight = np.ndarray((len(buffer),), "<u8", np.concatenate([buffer, np.zeros(8, np.uint8)]), strides=(1,))
    rows, done = np.flatnonzero((sizes > 0) & (sizes <= SHORT)), 0
    while len(rows):
        left = sizes[rows] - done
        beyond = np.uint64(64) - np.uint64(8) * np.minimum(left, 8).astype(np.uint64)
        values = eight[starts[rows] + done] << beyond
        hashes[rows] = mix(hashes[rows] * np.uint64(_BASE) + values)
        rows, done = rows[left > 8], done + 8
    for i in np.flatnonzero(sizes > SHORT).tolist():
        hashes[i] = int.from_bytes(hashlib.blake2b(buffer[starts[i] : ends[i]].tobytes(), digest_size=8).digest(), "little")
    return hashes


def steps(texts: pa.Array, size: int = STEP_BYTES) -> Iterator[tuple[slice, np.ndarray, np.ndarray]]:
    """Row slices with their bytes and offsets; a null counts as an empty text."""
    texts = texts.cast(pa.large_binary())
    if texts.null_count:
        texts = texts.fill_null(b"")
    _, offsets, data = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1] if n else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1
        last = min(max(last, first + 1), n)
        yield slice(first, last), data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


def spans(buffer: np.ndarray, offsets: np.ndarray, is_blank: np.ndarray = IS_BLANK) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of all words, and the position of every text's first word (with the total as last)."""
    blank = is_blank[buffer]
    before = np.ones(len(buffer), bool)
    before[1:] = blank[:-1]
    after = np.ones(len(buffer), bool)
    after[:-1] = blank[1:]
    inner = offsets[(offsets > 0) & (offsets < len(buffer))]
    before[inner] = True
    after[inner - 1] = True
    word = ~blank
    starts = np.flatnonzero(word & before)
    ends = np.flatnonzero(word & after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(buffer: np.ndarray, offsets: np.ndarray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words and the position of every text's first word."""
    starts, ends, firsts = spans(buffer, offsets)
    return hash_spans(LOWER[buffer] if lower else buffer, starts, ends), firsts


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct hashes of the runs of ``size`` words, sorted; a shorter text is one run of all its words."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    runs = np.full(n - width + 1, width, np.uint64)
    for k in range(width):
        runs = mix(runs * np.uint64(0x2545F4914F6CDD1D) + hashes[k : n - width + 1 + k])
    return np.unique(runs)


def flat_lists(rows: list[np.ndarray], kind: pa.DataType) -> pa.ListArray:
    """Arrays of numbers as one Arrow list column."""
    ends = np.cumsum([0, *map(len, rows)])
    values = np.concatenate([*rows, np.zeros(0, np.uint64)]).view(np.int64)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values, kind))
