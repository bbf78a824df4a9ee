"""Token ids as Arrow files of equal-length sequences.

The ids of all documents, in ascending order of doc_id and each followed by an end
id, form one stream; it is cut into files, and in a file into sequences of equal
length. Every file is an Arrow file (random access) with two columns of
fixed-size lists: ``ids`` and ``mask`` (false where the last sequence of a file is
filled up). A second file beside it holds the index: doc_id, start in the file,
n_tokens. Numbers lie in the file as in memory, so a mapped file gives any
sequence without a copy. Ids take 16 bits where the vocabulary allows it.

A null text is an empty one (only the end id). Null ids come first, rows that
repeat an id follow each other in the order of a text hash. An empty table gives
no files; other columns are ignored.
"""

import json
import re
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from pubgrade.llm import words
from pubgrade.llm.tables import cut_lineage

SEQUENCE = 2048
#: Sequences in one record batch of a file.
BATCH_SEQUENCES = 128
#: Distinct words whose ids a worker keeps; beyond, it starts anew.
KEPT_WORDS = 2_000_000

KEPT_BASES = 400_000

#: Letters that no normal form changes, and ASCII punctuation without the apostrophe and the brackets of special strings.
_LETTERS = re.compile(r"([A-Za-zÀ-ÖØ-öø-ÿ]+)([!-&(-/:;=?@\[-`{-~]*)")


class Encoder:
    """Ids of texts; each distinct word is encoded once by the tokenizer library.

    Fits vocabularies that drop white space and never join across it: the ids of a
    text are then the ids of its words.
    """

    def __init__(self, path: str, end_id: int):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        if not json.dumps(spec["pre_tokenizer"]).count('"Removed"') or spec["post_processor"]:
            raise ValueError(f"a vocabulary that keeps white space or adds tokens: {path}")
        self.library = Tokenizer.from_file(path)
        self.library.no_padding()
        self.library.no_truncation()
        vocabulary = self.library.get_vocab()
        self.kind = np.uint16 if max(vocabulary.values()) < 1 << 16 else np.uint32
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        mark = spec["model"]["end_of_word_suffix"] or ""
        self.ends[[i for token, i in vocabulary.items() if token.endswith(mark)]] = True
        self.end_id = end_id
        self.bases: dict[str, bytes] = {}
        self.tails: dict[str, bytes] = {}
        self._clear()

    def _clear(self) -> None:
        self.hashes, self.starts, self.sizes = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.pool, self.used = np.full(1 << 16, self.end_id, self.kind), 1  # the end id lies at 0

    def _each(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, self.kind).tobytes() for e in self.library.encode_batch_fast(texts, add_special_tokens=False)]

    def _letters(self, bases: list[str]) -> list[bytes]:
        """Ids of words that are one piece each: every piece ends with a token that has the end mark."""
        ids = np.array(self.library.encode_batch_fast([" ".join(bases)], add_special_tokens=False)[0].ids, self.kind)
        cuts = (np.flatnonzero(self.ends[ids]) + 1) * ids.itemsize
        if len(cuts) != len(bases):
            return self._each(bases)
        raw = ids.tobytes()
        return [raw[a:b] for a, b in zip([0, *cuts.tolist()], cuts.tolist())]

    def words(self, chunks: list[str]) -> list[bytes]:
        """Ids of each word. Letters with ASCII punctuation after them are two pieces, looked up apart."""
        split = [_LETTERS.fullmatch(c) for c in chunks]
        if len(self.bases) > KEPT_BASES:
            self.bases.clear()
        pairs = [(m[1].lower(), m[2]) if m else None for m in split]
        new = [b for b in dict.fromkeys(p[0] for p in pairs if p) if b not in self.bases]
        if new:
            self.bases.update(zip(new, self._letters(new)))
        tails = [t for t in dict.fromkeys(p[1] for p in pairs if p) if t not in self.tails]
        self.tails.update(zip(tails, self._each(tails)))
        others = iter(self._each([c for c, p in zip(chunks, pairs) if not p]))
        found = [self.bases[p[0]] + self.tails[p[1]] if p else next(others) for p in pairs]
        if len(self.tails) > KEPT_BASES:
            self.tails.clear()
        return found

    def _learn(self, at: np.ndarray, hashes: np.ndarray, chunks: list[str]) -> None:
        ids = self.words(chunks)
        flat = np.frombuffer(b"".join(ids), self.kind)
        sizes = np.fromiter(map(len, ids), np.int64, len(ids)) // flat.itemsize
        if self.used + len(flat) > len(self.pool):
            self.pool = np.concatenate([self.pool[: self.used], np.zeros(max(len(flat), self.used), self.kind)])
        self.pool[self.used : self.used + len(flat)] = flat
        starts = self.used + np.cumsum(sizes) - sizes
        self.used += len(flat)
        self.hashes, self.starts, self.sizes = np.insert(self.hashes, at, hashes), np.insert(self.starts, at, starts), np.insert(self.sizes, at, sizes)

    def batch(self, buffer: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """All ids of a step with the end ids, and the number of each text's ids."""
        starts, ends, firsts = words.spans(buffer, offsets)
        hashes, where, inverse = np.unique(words.hash_spans(buffer, starts, ends), return_index=True, return_inverse=True)
        if len(self.hashes) + len(hashes) > KEPT_WORDS and len(self.hashes):
            self._clear()
        at = np.searchsorted(self.hashes, hashes)
        new = np.arange(len(hashes))
        if len(self.hashes):
            new = np.flatnonzero(self.hashes[np.minimum(at, len(self.hashes) - 1)] != hashes)
        if len(new):
            self._learn(at[new], hashes[new], [buffer[starts[k] : ends[k]].tobytes().decode() for k in where[new]])
            at = np.searchsorted(self.hashes, hashes)
        sizes = np.insert(self.sizes[at][inverse], firsts[1:], 1) if len(hashes) else np.ones(len(offsets) - 1, np.int64)
        places = np.insert(self.starts[at][inverse], firsts[1:], 0) if len(hashes) else np.zeros(len(offsets) - 1, np.int64)
        sums = np.concatenate([[0], np.cumsum(sizes)])
        ids = self.pool[np.repeat(places - sums[:-1], sizes) + np.arange(sums[-1])]
        bounds = sums[firsts + np.arange(len(firsts))]  # every text before has one end id
        return ids, np.diff(bounds)


_encoders: dict[tuple, Encoder] = {}


def encoder(path: str, end_id: int) -> Encoder:
    if (path, end_id) not in _encoders:
        _encoders[path, end_id] = Encoder(path, end_id)
    return _encoders[path, end_id]


def _store(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path)


@dataclass
class _Writer:
    """One file of sequences and its index."""

    path: str
    kind: np.dtype
    length: int

    def __post_init__(self) -> None:
        store, place = _store(self.path)
        store.create_dir(place.rpartition("/")[0], recursive=True)
        self.schema = pa.schema(
            [("ids", pa.list_(pa.from_numpy_dtype(self.kind), self.length)), ("mask", pa.list_(pa.bool_(), self.length))]
        )
        self.file = pa.ipc.new_file(store.open_output_stream(place + ".arrow"), self.schema)
        self.index = pa.ipc.new_file(store.open_output_stream(place + ".index.arrow"), INDEX)
        self.rest, self.total, self.docs = np.zeros(0, self.kind), 0, 0

    def _sequences(self, ids: np.ndarray, real: int) -> None:
        mask = pa.array(np.arange(len(ids)) < real)
        lists = [pa.FixedSizeListArray.from_arrays(values, self.length) for values in (pa.array(ids), mask)]
        self.file.write_batch(pa.RecordBatch.from_arrays(lists, schema=self.schema))

    def add(self, doc_ids: pa.Array, ids: np.ndarray, sizes: np.ndarray) -> None:
        starts = self.total + np.cumsum(sizes) - sizes
        self.index.write_batch(pa.RecordBatch.from_arrays([doc_ids.cast(pa.int64()), pa.array(starts), pa.array(sizes)], schema=INDEX))
        self.total += len(ids)
        self.docs += len(sizes)
        self.rest = np.concatenate([self.rest, ids])
        step = self.length * BATCH_SEQUENCES
        while len(self.rest) >= step:
            self._sequences(self.rest[:step], step)
            self.rest = self.rest[step:]

    def close(self, pad: int) -> None:
        if real := len(self.rest):
            self._sequences(np.concatenate([self.rest, np.full(-real % self.length, pad, self.kind)]), real)
        self.file.close()
        self.index.close()


INDEX = pa.schema([("doc_id", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64())])


def write_token_files(docs: DataFrame, folder: str, path: str, end_id: int, length: int = SEQUENCE) -> DataFrame:
    """Writes the files to a shared folder; gives (part, path, n_docs, n_tokens, start), one row per file.

    Range partitioning puts the documents in order over the tasks, and each task
    writes one file. A repeated or lost attempt leaves a file of another name behind;
    only files named in the returned table, which is stored, count.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model, part, out = encoder(path, end_id), TaskContext.get().partitionId(), None
        for batch in batches:
            for rows, buffer, offsets in words.steps(batch.column(1)):
                if out is None:
                    out = _Writer(f"{folder}/part-{part:06d}-{uuid.uuid4().hex}", model.kind, length)
                out.add(batch.column(0).slice(rows.start, len(offsets) - 1), *model.batch(buffer, offsets))
        if out is not None:
            out.close(end_id)
            yield pa.RecordBatch.from_pylist([{"part": part, "path": out.path, "n_docs": out.docs, "n_tokens": out.total}])

    keys = [F.col("doc_id"), F.xxhash64("text")]
    ordered = docs.select("doc_id", "text").repartitionByRange(*keys).sortWithinPartitions(*keys)
    files = cut_lineage(ordered.mapInArrow(write, "part long, path string, n_docs long, n_tokens long"), "token-files")
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    return files.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


class TokenFile:
    """Random access to one written file; ``sequence`` and ``mask`` are views of the mapped file where it is local."""

    def __init__(self, path: str):
        store, place = _store(path)
        local = isinstance(store, fs.LocalFileSystem)
        self.file = pa.ipc.open_file(pa.memory_map(place + ".arrow") if local else store.open_input_file(place + ".arrow"))
        self.index = pa.ipc.open_file(store.open_input_file(place + ".index.arrow"))
        self.length = self.file.schema.field("ids").type.list_size
        self.batches = self.file.num_record_batches
        self.per_batch = self.file.get_batch(0).num_rows if self.batches else 1  # all but the last are alike

    def batch(self, k: int) -> np.ndarray:
        """Ids of a batch as (sequences x length)."""
        ids = self.file.get_batch(k).column(0)
        return ids.flatten().to_numpy(zero_copy_only=True).reshape(-1, self.length)

    def sequence(self, k: int) -> np.ndarray:
        return self.batch(k // self.per_batch)[k % self.per_batch]

    def mask(self, k: int) -> np.ndarray:
        lists = self.file.get_batch(k // self.per_batch).column(1)
        return lists[k % self.per_batch].values.to_numpy(zero_copy_only=False)

    def documents(self) -> Iterator[pa.RecordBatch]:
        for k in range(self.index.num_record_batches):
            yield self.index.get_batch(k)

    def checksums(self) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
        """Index batches with the CRC-32 of each document's ids as little-endian 32-bit numbers, read in one pass."""
        k, at, view = 0, 0, np.zeros(0, np.uint32)  # next batch; ids of the view used so far
        for docs in self.documents():
            sums = np.zeros(len(docs), np.int64)
            for i, n in enumerate(docs.column(2).to_numpy()):
                crc = 0
                while n:
                    if at == len(view):
                        view, at, k = self.batch(k).reshape(-1).astype("<u4"), 0, k + 1
                    taken = view[at : at + n]
                    crc, at, n = zlib.crc32(taken, crc), at + len(taken), n - len(taken)
                sums[i] = crc
            yield docs, sums


def read_token_files(files: DataFrame) -> DataFrame:
    """Every document of the written files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                for docs, sums in TokenFile(path).checksums():
                    starts = pa.array(docs.column(1).to_numpy() + start)
                    yield pa.RecordBatch.from_arrays([docs.column(0), starts, docs.column(2), pa.array(sums)], names=["doc_id", "start", "n_tokens", "ids_crc32"])

    tasks = max(files.count(), 1)
    spread = files.select("path", "start").repartition(tasks)
    return spread.mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")
