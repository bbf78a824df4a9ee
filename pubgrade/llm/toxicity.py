"""Toxicity by a bidirectional recurrent network over word and character inputs.

A word enters as a vector of evidence: how much likelier the word itself, its
beginnings and its endings (of several lengths) are in toxic documents than in
others, as smoothed log odds over labelled documents. The network (see
``recurrent``) reads overlapping windows of words, and a document's score is that of
its highest window. Every window of every text is scored.

The model is fitted in one task from a bounded sample: at most ``sample`` toxic
documents and twice as many others, those with the smallest hashes of their ids, each
of at most ``longest`` characters. A training document's own share is taken out of
the evidence of its words. Toxic documents train with the window of most
evidence, others with that and one drawn window each. The logit's zero lies where
the training documents are parted best.

Rows (``score``): doc_id, held_out, score, predicted. Null, empty and wordless texts
score 0. Without labels of both classes every score is 0. Rows are independent:
repeated ids and rows score each, a null doc_id is not held out, other columns are
ignored by ``score`` and kept by ``drop_toxic``. Labels with a null id or class are
left out, and an id that is labelled both ways counts as toxic.
"""

import pickle
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.llm import words
from pubgrade.llm.recurrent import Network, sigmoid

SAMPLE, LONGEST = 1000, 20_000
LENGTH, STRIDE = 32, 24
STARTS, ENDINGS = (3, 4, 5, 6, 8), (3, 4, 5, 6)
#: Strength of the prior in the log odds, in documents; rarer features give no evidence.
PRIOR, RARE = 4.0, 3

#: Letters in lower case, digits and all bytes of longer characters are parts of words, all else separates.
_PART = words.LOWER.copy()
for _b in range(128):
    if not chr(_b).isalnum():
        _PART[_b] = 0x20
_SEPARATES = _PART == 0x20
INPUTS = 6


def held_out(doc_id: Column) -> Column:
    """Rows that never train: those whose checksum leaves no remainder by five."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 5 == 0, F.lit(False))


def _lower(buffer: np.ndarray) -> np.ndarray:
    text = _PART[buffer]
    # two-byte capitals of Latin-1 are 0x20 below their small letters
    second = np.flatnonzero(text[:-1] == 0xC3) + 1
    capital = second[(text[second] >= 0x80) & (text[second] <= 0x9E) & (text[second] != 0x97)]
    text[capital] += 0x20
    return text


class Words:
    """The words of a step: each word's place among the distinct ones, and the features of those."""

    def __init__(self, buffer: np.ndarray, offsets: np.ndarray):
        text = _lower(buffer)
        starts, ends, self.firsts = words.spans(text, offsets, _SEPARATES)
        hashes, where, self.inverse = np.unique(words.hash_spans(text, starts, ends), return_index=True, return_inverse=True)
        starts, ends = starts[where], ends[where]
        self.features = np.zeros((len(hashes), 1 + len(STARTS) + len(ENDINGS)), np.uint64)
        self.features[:, 0] = hashes
        for k, size in enumerate(STARTS + ENDINGS):
            long = np.flatnonzero(ends - starts > size)
            spans = (starts[long], starts[long] + size) if k < len(STARTS) else (ends[long] - size, ends[long])
            self.features[long, k + 1] = words.mix(words.hash_spans(text, *spans) + np.uint64(k + 1))


def _join(odds: np.ndarray) -> np.ndarray:
    """Word vectors from the log odds of the features."""
    start, end = odds[:, 1 : 1 + len(STARTS)], odds[:, 1 + len(STARTS) :]
    parts = [odds[:, 0], start.max(axis=1), start.mean(axis=1), end.max(axis=1), end.mean(axis=1), np.ones(len(odds))]
    return np.stack(parts, axis=1).astype(np.float32)


def windows(firsts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, sizes and documents of all windows; the last window of a document may be short."""
    sizes = np.diff(firsts)
    counts = np.where(sizes > 0, 1 + np.maximum(0, -(-(sizes - LENGTH) // STRIDE)), 0)
    docs = np.repeat(np.arange(len(sizes)), counts)
    nth = np.arange(len(docs)) - np.repeat(np.cumsum(counts) - counts, counts)
    starts = firsts[docs] + nth * STRIDE
    return starts, np.minimum(LENGTH, firsts[docs + 1] - starts), docs


class Model:
    """Evidence of features and the network, small enough to go to every task."""

    def __init__(self, keys: np.ndarray, odds: np.ndarray, network: Network, shift: float):
        self.keys, self.odds, self.network, self.shift = keys, odds, network, shift

    def scores(self, buffer: np.ndarray, offsets: np.ndarray) -> np.ndarray:
        """One score per text of a step."""
        found = np.full(len(offsets) - 1, -np.inf, np.float32)
        step = Words(buffer, offsets)
        if len(step.inverse) and len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, step.features), len(self.keys) - 1)
            odds = np.where(self.keys[at] == step.features, self.odds[at], 0)
            starts, sizes, docs = windows(step.firsts)
            np.maximum.at(found, docs, self.network.logits(_join(odds)[step.inverse], starts, sizes, LENGTH))
        return sigmoid(found.astype(np.float64) - self.shift)


def _log_odds(toxic: np.ndarray, clean: np.ndarray, share: float) -> np.ndarray:
    up, down = PRIOR * share, PRIOR * (1 - share)
    odds = np.log((toxic + up) / (clean + down)) - np.log(up / down)
    return np.where(toxic + clean >= RARE, odds, 0)


def _split_point(logits: np.ndarray, labels: np.ndarray) -> float:
    """The middle of the widest gap between sorted logits that leaves the fewest documents on the wrong side."""
    order = np.argsort(logits, kind="stable")
    logits, labels = logits[order].astype(np.float64), labels[order]
    wrong = np.cumsum(labels) - np.cumsum(1 - labels)
    best = np.flatnonzero(wrong[:-1] == wrong[:-1].min())
    gaps = logits[best + 1] - logits[best]
    k = best[gaps.argmax()]
    return float((logits[k] + logits[k + 1]) / 2)


def fit(texts: pa.Array, labels: np.ndarray) -> Model | None:
    """The model of labelled texts; None if a class is missing."""
    labels = labels.astype(np.int64)
    if len(set(labels.tolist())) < 2:
        return None
    steps, word, sizes = [], [], []
    for _, buffer, offsets in words.steps(texts):
        step = Words(buffer, offsets)
        steps.append(step.features)
        word.append(step.inverse)
        sizes.append(np.diff(step.firsts))
    # distinct words of all steps, and every word's place among them
    features = np.concatenate(steps)
    _, where, merged = np.unique(features[:, 0], return_index=True, return_inverse=True)
    features, begins = features[where], np.cumsum([0, *map(len, steps)])
    word = np.concatenate([merged[begin + w] for begin, w in zip(begins, word)])
    sizes = np.concatenate(sizes)
    if not len(word):
        return None
    docs, firsts = np.repeat(np.arange(len(sizes)), sizes), np.concatenate([[0], np.cumsum(sizes)])
    pairs = np.unique(docs * len(features) + word)  # a document's distinct words
    doc, own_word = pairs // len(features), pairs % len(features)
    keys, place = np.unique(features, return_inverse=True)
    place = place.reshape(features.shape).astype(np.int32)
    toxic, clean = np.zeros(len(keys), np.int32), np.zeros(len(keys), np.int32)
    for k in range(place.shape[1]):  # each kind of feature counts once a document
        seen = np.unique(doc * len(keys) + place[own_word, k])
        mark = labels[seen // len(keys)]
        toxic += np.bincount(seen[mark == 1] % len(keys), minlength=len(keys)).astype(np.int32)
        clean += np.bincount(seen[mark == 0] % len(keys), minlength=len(keys)).astype(np.int32)
    share = labels.mean()
    toxic[keys == 0] = clean[keys == 0] = 0
    # the word vectors as a document of either class sees them, without its own share
    own = [_join(_log_odds(np.maximum(toxic - y, 0), np.maximum(clean - (1 - y), 0), share).astype(np.float32)[place]) for y in (0, 1)]
    vectors, is_toxic = own[0][word], labels[docs] == 1
    vectors[is_toxic] = own[1][word[is_toxic]]

    starts, lengths, of = windows(firsts)
    strength = np.concatenate([[0], np.cumsum(np.maximum(vectors[:, :5], 0).sum(axis=1), dtype=np.float64)])
    strength = strength[starts + lengths] - strength[starts]
    order = np.lexsort((-strength, of))
    top = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
    drawn = np.random.default_rng(5).random(len(of))
    order = np.lexsort((drawn, of))
    other = order[np.flatnonzero(np.diff(of[order], prepend=-1))]
    chosen = np.concatenate([top, other[labels[of[other]] == 0]])
    time = np.arange(LENGTH)[:, None]
    x = vectors[np.minimum(starts[chosen] + time, len(vectors) - 1)]
    y = labels[of[chosen]]
    network = Network(INPUTS)
    network.train(x, time < lengths[chosen], y.astype(np.float32), np.where(y == 1, len(y) / y.sum(), len(y) / (1 - y).sum()).astype(np.float32))

    logits = np.full(len(labels), -np.inf, np.float32)
    for a in range(0, len(starts), 8192):  # windows follow each other, so a part of the vectors is enough
        some = slice(a, a + 8192)
        low, high = starts[some].min(), (starts[some] + lengths[some]).max()
        np.maximum.at(logits, of[some], network.logits(vectors[low:high], starts[some] - low, lengths[some], LENGTH))
    has = np.isfinite(logits)
    odds = _log_odds(toxic, clean, share).astype(np.float32)
    kept = odds != 0
    return Model(keys[kept], odds[kept], network, _split_point(logits[has], labels[has]))


def training_rows(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> DataFrame:
    """doc_id, toxic and text of the bounded sample."""
    known = labels.where("doc_id is not null and toxic in (0, 1)").where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    order = [F.xxhash64("doc_id"), F.col("doc_id")]
    chosen = known.where("toxic = 1").orderBy(*order).limit(sample).unionByName(known.where("toxic = 0").orderBy(*order).limit(sample * 2))
    # at most 3 * sample rows of two numbers go to every task
    text = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").where(F.char_length("text") <= longest)
    return text.groupBy("doc_id").agg(F.max("toxic").alias("toxic"), F.min("text").alias("text"))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE, longest: int = LONGEST) -> bytes | None:
    """The fitted model, pickled. The sample meets in one task, which needs more memory than the driver may have."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if found := list(batches):
            rows = pa.Table.from_batches(found).sort_by("doc_id")
            model = fit(rows.column("text").combine_chunks(), rows.column("toxic").to_numpy())
            if model is not None:
                yield pa.RecordBatch.from_pydict({"model": [pickle.dumps(model)]}, pa.schema([("model", pa.binary())]))

    rows = training_rows(docs, labels, sample, longest).repartition(1).mapInArrow(run, "model binary").collect()
    return bytes(rows[0].model) if rows else None


def _scorer(spark, model: bytes | None):
    shared = spark.sparkContext.broadcast(model)

    def load():
        """The scores of a batch of texts, with the model loaded once per task."""
        fitted = None if shared.value is None else pickle.loads(shared.value)

        def scores(texts: pa.Array) -> np.ndarray:
            if fitted is None:
                return np.zeros(len(texts))
            parts = [fitted.scores(buffer, offsets) for _, buffer, offsets in words.steps(texts)]
            return np.concatenate([*parts, np.zeros(0)])

        return scores

    return load


def score(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    load = _scorer(docs.sparkSession, train(docs, labels, sample))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = load()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(scores(batch.column(1)))], names=["doc_id", "score"])

    scored = docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def drop_toxic(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> DataFrame:
    """The rows that score below one half, all columns kept, without a shuffle."""
    load = _scorer(docs.sparkSession, train(docs, labels, sample))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores = load()
        for batch in batches:
            yield batch.filter(pa.array(scores(batch.column(at)) < 0.5))

    return docs.mapInArrow(run, docs.schema)
