"""The network's gradients, held-out accuracy, windows, edge rows."""

import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from pubgrade.llm import recurrent, toxicity, words

VOCABULARY = [a + b + c for a in "bcdfgl" for b in "aeiou" for c in ("n", "rt", "lling", "st", "ma")]


def text(rng, toxic):
    found = rng.choices(VOCABULARY, k=rng.randint(30, 200))
    for _ in range(rng.randint(2, 5) if toxic else 0):
        found.insert(rng.randint(0, len(found)), rng.choice(["Idiot,", "scum.", "zork" + rng.choice(VOCABULARY), "zork" + rng.choice(VOCABULARY)]))
    return " ".join(found)


@pytest.fixture(scope="module")
def labelled():
    rng = random.Random(8)
    return [(i, text(rng, i % 5 == 0), int(i % 5 == 0)) for i in range(900)]


def test_gradients_equal_differences():
    rng = np.random.default_rng(0)
    net = recurrent.Network(3)
    net.p = {k: v.astype(np.float64) for k, v in net.p.items()}
    x, mask = rng.standard_normal((5, 4, 3)), np.arange(5)[:, None] < np.array([5, 3, 1, 4])
    labels, weights = np.array([1.0, 0, 1, 0]), np.array([1.0, 2, 1, 3])

    def loss():
        logit = net.logits(x.transpose(1, 0, 2).reshape(-1, 3), np.arange(4) * 5, mask.sum(axis=0), 5).astype(np.float64)
        return float((weights * (np.logaddexp(0, logit) - labels * logit)).sum() / weights.sum())

    found = net.gradients(x, mask, labels, weights)
    for name, values in net.p.items():
        at = tuple(rng.integers(0, s) for s in values.shape)
        old = values[at]
        values[at] = old + 1e-2
        up = loss()
        values[at] = old - 1e-2
        down = loss()
        values[at] = old
        assert abs((up - down) / 2e-2 - found[name][at]) < 2e-3, name


def test_windows_cover_every_word():
    firsts = np.array([0, 0, 1, 33, 65, 200])
    starts, sizes, docs = toxicity.windows(firsts)
    covered = np.zeros(200, int)
    for a, n in zip(starts, sizes):
        covered[a : a + n] += 1
    assert covered.min() == 1 and covered.max() == 2 and set(docs) == {1, 2, 3, 4}
    assert all(firsts[d] <= a and a + n <= firsts[d + 1] for a, n, d in zip(starts, sizes, docs))


def test_held_out_accuracy(spark, docs, labelled, edge_rows):
    labels = spark.createDataFrame([(i, 1, y) for i, _, y in labelled] + [(None, 1, 1), (5, 1, None)], "doc_id long, quality int, toxic int")
    extra = [((d or 0) + 5000 if d else None, t) for d, t in edge_rows]
    df = docs(*[(i, t) for i, t, _ in labelled], *extra)
    found = toxicity.score(df, labels, sample=200).collect()
    assert len(found) == len(labelled) + len(extra)
    truth = {i: y for i, _, y in labelled}
    for r in found:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0)
        assert 0 <= r.score <= 1 and r.predicted == (r.score >= 0.5)
    held = [r for r in found if r.held_out and r.doc_id in truth]
    assert len(held) > 100 and sum(r.predicted == truth[r.doc_id] for r in held) >= 0.98 * len(held)
    empty = {r.doc_id: r.score for r in found if r.doc_id in (5001, 5002, 5003)}
    assert set(empty.values()) == {0.0}
    kept = toxicity.drop_toxic(df, labels, sample=200)
    assert kept.columns == df.columns and kept.count() == sum(not r.predicted for r in found)


def test_without_labels(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = docs((1, "a b c"), (2, None))
    assert [r.score for r in toxicity.score(df, none).collect()] == [0.0, 0.0]
    assert toxicity.drop_toxic(df, none).count() == 2 and toxicity.score(df.where("false"), none).count() == 0


def test_words_meet_in_lower_case():
    forms = ["ÉTÉ été Été.", "IDIOT idiot, idiot!"]
    for _, buffer, offsets in words.steps(pa.array(forms)):
        assert len(toxicity.Words(buffer, offsets).features) == 2
