"""Passages that repeat across documents, found as runs of sentences.

A sentence ends with a word that closes with . ! or ?, a full stop, question or
exclamation mark of another script (and up to three further ASCII signs), at a line
break or with its text. Sentences of more than ``PIECE`` words are cut before the
words whose hash is the smallest of some ``PIECE`` neighbouring words of the sentence,
so equal words are cut alike wherever the sentence begins and ends, into pieces of at
most ``PIECE`` words. A run begins at any piece and is the shortest that holds
``SENTENCES`` whole sentences and ``WORDS`` words, or pieces of ``LONG`` words; the
shortest such runs that end at any piece count as well. So every shared passage of 50
words holds a run, and is covered but for at most ``PIECE`` words at either end where
it breaks a sentence off. Runs are hashed over their lower-cased words, and all hashes
of the corpus are joined. The first occurrence of a run (by doc_id, then by place)
stays; pieces covered by any other one are removed. Words of more than 24 bytes count
as several and end at a full stop inside them, for scripts without blanks; in these a
sentence without blanks is not cut.

Only hashes are shuffled to find the repeated ones; their places follow in a second
pass. A run found everywhere arrives as one row per task in the first, and the
second is a join that Spark can split.

Rows (``find_repeats``): one per document that loses sentences or parts of them, with
doc_id, n_sentences, n_removed (sentences that lose words), removed (first and last
sentence of each stretch of these), first_doc_ids (where the first occurrences are) and
the text that is left. Null and empty texts have no sentences. Rows that are equal in doc_id and text are one document
and share one result each; rows with equal ids and other texts are different documents.
Null ids come first. Empty tables give no rows; other columns are ignored here and kept
by ``remove_repeats``.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.llm import words
from pubgrade.llm.tables import cut_lineage, fresh_name

SENTENCES, WORDS, LONG = 3, 20, 30
#: Longest sentence that is not cut: a passage of 50 words that breaks off one at either end still holds LONG words.
PIECE = 10

#: Full stops, question and exclamation marks of other scripts, of two or three bytes: ideographic, full width,
#: half width, danda, double danda, Arabic, Urdu, Armenian, Ethiopic, Khmer.
_STOPS = [c.encode() for c in "\u3002\uff0e\uff01\uff1f\uff61\u0964\u0965\u061f\u06d4\u0589\u1362\u1367\u17d4\u17d5"]
_LEADS = np.zeros(256, bool)
_LEADS[[c[0] for c in _STOPS]] = True
_CLOSES = np.zeros(256, bool)
_CLOSES[list(b".!?")] = True
_SIGN = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def _stops(buffer: np.ndarray) -> np.ndarray:
    """Places of the last bytes of other scripts' full stops."""
    at, found = np.flatnonzero(_LEADS[buffer]), []
    for stop in _STOPS if len(at) else ():
        fits = at[at + len(stop) <= len(buffer)]
        for k, byte in enumerate(stop):
            fits = fits[buffer[fits + k] == byte]
        found.append(fits + len(stop) - 1)
    return np.sort(np.concatenate([at[:0], *found]))


class Sentences:
    """Pieces of the sentences of a step: word and byte borders, the sentence of every piece and the place of every text's first piece."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray):
        self.buffer, self.offsets = buffer, offsets
        self.starts, self.ends, firsts = words.spans(buffer, offsets)
        stops = _stops(buffer)
        if len(stops):
            after = stops[stops + 1 < len(buffer)] + 1
            own = np.searchsorted(self.starts, after, "right") - 1
            inner = after[(self.starts[own] < after) & (after < self.ends[own]) & ~_SIGN[buffer[after]]]
            self.starts, self.ends = (np.sort(np.concatenate([x, inner])) for x in (self.starts, self.ends))
            firsts = np.searchsorted(self.starts, offsets)
        n = len(self.starts)
        closes, signs = np.zeros(n, bool), np.ones(n, bool)
        closing = _CLOSES[buffer]
        closing[stops] = True
        for k in range(1, 5):
            inside = self.ends - k >= self.starts
            at = np.maximum(self.ends - k, 0)
            closes |= signs & inside & closing[at]
            signs &= inside & _SIGN[buffer[at]]
        lines = np.concatenate([[0], np.cumsum(buffer == 10)])
        closes[:-1] |= lines[self.starts[1:]] > lines[self.ends[:-1]]
        last = firsts[1:][firsts[1:] > firsts[:-1]] - 1
        closes[last] = True
        self.each = words.hash_spans(words.LOWER[buffer], self.starts, self.ends)
        ends = np.flatnonzero(closes)  # last word of every sentence
        begins = np.concatenate([[0], ends[:-1] + 1]) if len(ends) else ends
        self.first = np.union1d(begins, self._cuts(begins, ends))  # first word of every piece
        self.last = np.append(self.first[1:], n)[: len(self.first)] - 1
        self.sentence = np.searchsorted(begins, self.first, "right") - 1
        self.heads = np.searchsorted(self.first, begins)  # first and last piece of every sentence
        self.tails = np.searchsorted(self.last, ends)
        self.firsts = np.searchsorted(self.first, firsts)  # first piece of every text

    def _cuts(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Words before which long sentences are cut: the last smallest hash of any ``PIECE`` words in a row."""
        n = len(self.each) - PIECE + 1
        if n <= 0:
            return begins[:0]
        long = np.repeat(ends - begins >= PIECE, ends - begins + 1)
        to = np.repeat(ends, ends - begins + 1)
        windows = np.flatnonzero(long[:n] & (np.arange(n) + PIECE - 1 <= to[:n]))
        least, at = self.each[windows], windows
        for k in range(1, PIECE):
            other = self.each[windows + k]
            lower = other <= least
            least, at = np.where(lower, other, least), np.where(lower, windows + k, at)
        return np.unique(at)

    def runs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First and last piece and the text of every run."""
        n = len(self.first)
        weight = np.concatenate([[0], np.cumsum(1 + (self.ends - self.starts) // 24)])
        begin, end = weight[self.first], weight[self.last + 1]
        text = np.repeat(np.arange(len(self.firsts) - 1), np.diff(self.firsts))
        low, high, at = self.firsts[text], self.firsts[text + 1] - 1, np.arange(n)
        ahead, back = np.searchsorted(end, begin + LONG), np.searchsorted(begin, end - LONG, "right") - 1
        # runs of whole sentences
        each = np.arange(len(self.heads))
        to = np.maximum(each + SENTENCES - 1, np.searchsorted(end[self.tails], begin[self.heads] + WORDS))
        ahead[self.heads] = np.minimum(ahead[self.heads], np.append(self.tails, n)[np.minimum(to, len(each))])
        since = np.minimum(each - SENTENCES + 1, np.searchsorted(begin[self.heads], end[self.tails] - WORDS, "right") - 1)
        back[self.tails] = np.maximum(back[self.tails], np.append(self.heads, -1)[np.maximum(since, -1)])
        fits, fits_back = ahead <= high, back >= low
        keys = np.unique(np.concatenate([at[fits] * n + ahead[fits], back[fits_back] * n + at[fits_back]])) if n else at
        return keys // max(n, 1), keys % max(n, 1), text

    def hashes(self, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Two independent hashes of every run, of 64 and 31 bits."""
        each = self.each
        borders = self.first[first], self.last[last] + 1
        other = words.span_hash(words.prefix(words.mix(each + np.uint64(0x632BE59BD9B4E019))), *borders)
        return words.span_hash(words.prefix(each), *borders), (other >> np.uint64(33)).astype(np.int32)

    def touched(self, text: int, removed: np.ndarray) -> np.ndarray:
        """The sentences of a text that lose pieces."""
        own = self.sentence[self.firsts[text] : self.firsts[text + 1]]
        gone = np.zeros(own[-1] - own[0] + 1 if len(own) else 0, bool)
        gone[own[removed] - own[0]] = True
        return gone

    def without(self, text: int, removed: np.ndarray) -> str:
        """A text without some of its pieces (true in ``removed``)."""
        a, b = self.firsts[text], self.firsts[text + 1]
        begins = np.append(self.starts[self.first[a:b]], self.offsets[text + 1])
        kept = [self.buffer[self.offsets[text] : begins[0]]]
        kept += [self.buffer[begins[k] : begins[k + 1]] for k in np.flatnonzero(~removed)]
        return b"".join(part.tobytes() for part in kept).decode()


def _hashes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for _, buffer, offsets in words.steps(batch.column(0)):
            step = Sentences(buffer, offsets)
            first, last, _ = step.runs()
            yield pa.RecordBatch.from_arrays([pa.array(step.hashes(first, last)[0].view(np.int64))], names=["h"])


def _places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, buffer, offsets in words.steps(batch.column(2)):
            step = Sentences(buffer, offsets)
            first, last, text = step.runs()
            text = text[first] if len(first) else first
            own = step.firsts[text]
            h, h2 = step.hashes(first, last)
            at = pa.array(text + rows.start)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(h.view(np.int64)),
                    pa.array(h2),
                    batch.column(0).take(at),
                    batch.column(1).take(at),
                    pa.array((first - own).astype(np.int32)),
                    pa.array((last - own).astype(np.int32)),
                ],
                names=["h", "h2", "doc_id", "text_key", "first", "last"],
            )


def _key() -> Column:
    return F.hash("text")


def later_occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, text_key, first, last, of: every occurrence of a repeated run but the first, which is in document ``of``."""
    repeated = docs.select("text").mapInArrow(_hashes, "h long").groupBy("h").agg(F.count("*").alias("n"))
    repeated = cut_lineage(repeated.where("n > 1").select("h"), "repeated-hashes")
    places = docs.select("doc_id", _key().alias("text_key"), "text")
    places = places.mapInArrow(_places, "h long, h2 int, doc_id long, text_key int, first int, last int")
    places = cut_lineage(places.join(repeated, "h"), "repeated-places")
    begin = F.struct("doc_id", "text_key", "first")
    firsts = cut_lineage(places.groupBy("h", "h2").agg(F.min(begin).alias("begin")), "first-places")
    later = places.join(firsts, ["h", "h2"]).where(~begin.eqNullSafe(F.col("begin")))
    return later.select("doc_id", "text_key", "first", "last", F.col("begin.doc_id").alias("of"))


def _join(docs: DataFrame, how: str) -> tuple[DataFrame, str, str]:
    """``docs`` with what each loses: names of the columns of sentence runs and of documents."""
    runs, of, d, k, key = (fresh_name(docs, x) for x in ("runs", "of", "d", "k", "key"))
    lost = later_occurrences(docs).groupBy("doc_id", "text_key")
    # at most the sentences of one document
    lost = lost.agg(F.collect_set(F.struct("first", "last")).alias(runs), F.sort_array(F.collect_set("of")).alias(of))
    lost = cut_lineage(lost.withColumnsRenamed({"doc_id": d, "text_key": k}), "lost-runs")
    keyed = docs.withColumn(key, _key())
    return keyed.join(lost, keyed["doc_id"].eqNullSafe(lost[d]) & (keyed[key] == lost[k]), how).drop(d, k, key), runs, of


def _removed(step: Sentences, text: int, runs: list[dict] | None) -> np.ndarray:
    gone = np.zeros(step.firsts[text + 1] - step.firsts[text], bool)
    for run in runs or ():
        gone[run["first"] : run["last"] + 1] = True
    return gone


_FOUND = "doc_id long, n_sentences long, n_removed long, removed array<struct<first:int,last:int>>, first_doc_ids array<long>, text string"


def find_repeats(docs: DataFrame) -> DataFrame:
    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, buffer, offsets in words.steps(batch.column(1)):
                step, found = Sentences(buffer, offsets), []
                part = batch.slice(rows.start, rows.stop - rows.start)
                for text, (doc, runs, of) in enumerate(zip(*(part.column(k).to_pylist() for k in (0, 2, 3)))):
                    pieces = _removed(step, text, runs)
                    gone = step.touched(text, pieces)
                    edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0, append=0))
                    stretches = [{"first": int(a), "last": int(b) - 1} for a, b in edges.reshape(-1, 2)]
                    found.append((doc, len(gone), int(gone.sum()), stretches, of, step.without(text, pieces)))
                stretch = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
                kinds = [pa.int64(), pa.int64(), pa.int64(), stretch, pa.list_(pa.int64()), pa.string()]
                names = ["doc_id", "n_sentences", "n_removed", "removed", "first_doc_ids", "text"]
                yield pa.RecordBatch.from_arrays([pa.array(c, kind) for c, kind in zip(zip(*found), kinds)], names=names)

    joined, runs, of = _join(docs.select("doc_id", "text"), "inner")
    return joined.select("doc_id", "text", runs, of).mapInArrow(clean, _FOUND)


def remove_repeats(docs: DataFrame) -> DataFrame:
    """``docs`` with the texts that are left, all rows and columns kept."""
    joined, runs, _ = _join(docs, "left")
    columns, at = docs.columns, docs.columns.index("text")

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for rows, buffer, offsets in words.steps(batch.column(at)):
                step = Sentences(buffer, offsets)
                lists = batch.column(len(columns)).slice(rows.start, rows.stop - rows.start).to_pylist()
                texts += [step.without(text, _removed(step, text, own)) if own else None for text, own in enumerate(lists)]
            old = batch.column(at).to_pylist()
            new = pa.array([o if n is None else n for o, n in zip(old, texts)], batch.column(at).type)
            yield pa.RecordBatch.from_arrays([new if k == at else batch.column(k) for k in range(len(columns))], names=columns)

    return joined.select(*[F.col(f"`{c}`") for c in columns], runs).mapInArrow(clean, docs.schema)
