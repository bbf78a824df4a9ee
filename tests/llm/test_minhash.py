"""Components against all pairs."""

import random
import re

import pytest

from pubgrade.llm import components, minhash


def brute(rows, size, percent):
    sets = {}
    for doc, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        runs = {tuple(w[i : i + size]) for i in range(max(len(w) - size + 1, 1))} if w else set()
        sets[doc] = runs
    parent = {d: d for d in sets}

    def root(d):
        while parent[d] != d:
            d = parent[d]
        return d

    for a in sets:
        for b in sets:
            if a < b and sets[a] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                x, y = sorted((root(a), root(b)))
                parent[y] = x
    return {d: (len(sets[d]), root(d)) for d in sets}


def family(rng, base, n, edits):
    """Copies of a text with some words replaced."""
    out = []
    for _ in range(n):
        w = list(base)
        for at in rng.sample(range(len(w)), edits):
            w[at] = f"new{rng.random()}"
        out.append(" ".join(w))
    return out


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    vocabulary = [f"w{i}" for i in range(400)]
    texts = [" ".join(rng.choices(vocabulary, k=rng.randint(1, 60))) for _ in range(60)]
    for edits in (0, 1, 2, 3):  # similarities from one to below 0.8
        texts += family(rng, rng.choices(vocabulary, k=120), 30, edits)
    texts += ["A b C d e", "a B c D e", "one", "ONE", "two", "", None, "two words", "two  words"]
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("small", [64, 2])
def test_links_equal_all_pairs(docs, rows, monkeypatch, small):
    monkeypatch.setattr(minhash, "SMALL", small)  # 2: larger bands go through blocks
    monkeypatch.setattr(minhash, "BLOCK", 2000)
    found = minhash.link_near_duplicates(docs(*rows), 4, 80).collect()
    expected = brute(rows, 4, 80)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == expected
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def test_edges_of_the_input(docs, edge_rows):
    df = docs(*edge_rows)
    found = minhash.link_near_duplicates(df).collect()
    assert len(found) == len(edge_rows)
    assert {(r.doc_id, r.component_id) for r in found} == {(d, d) for d, _ in edge_rows}
    kept = minhash.drop_near_duplicates(df)
    assert kept.columns == df.columns
    # repeated ids give one row, rows without id stay
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(["1", "2", "3", "4", "5", "6", "7", "None", "None"])
    assert minhash.link_near_duplicates(docs((1, "a")).where("false")).count() == 0


def test_components_of_chains_and_stars(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 40)] + [(2001, 2000), (7, 7)]
    found = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()}
    expected = {i: 0 for i in range(1, 61)} | {1000 + i: 1000 for i in range(1, 40)} | {2001: 2000}
    assert {k: v for k, v in found.items() if k != v} == expected


def test_row_that_stays_is_the_kept_one(docs):
    """Of two texts under one id the copy of a smaller id goes, whichever has the smaller hash."""
    a, b = (" ".join(f"{c}{i}" for i in range(30)) for c in "ab")
    for copy, clean in ((a, b), (b, a)):
        df = docs((3, copy), (7, clean), (7, copy), (7, clean))
        assert sorted((r.doc_id, r.text) for r in minhash.drop_near_duplicates(df).collect()) == [(3, copy), (7, clean)]
        assert {(r.doc_id, r.component_id) for r in minhash.link_near_duplicates(df).collect()} == {(3, 3), (7, 7), (7, 3)}
