"""The Merkle manifest against plain loops: several rounds, lone leaves, nulls, repeated rows, tampered leaves."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from pubgrade.llm import manifest
from pubgrade.llm.ranks import ranked


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(r, text):
    fields = ["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (r.doc_id, r.source, r.lang, r.n_chars, text)]
    return sha("".join(fields))


def climb(nodes):
    """Root and, for every node, its sibling segments from the leaves up."""
    paths, below = [[] for _ in nodes], [[i] for i in range(len(nodes))]
    while len(nodes) > 1:
        runs = [range(s, min(s + 16, len(nodes))) for s in range(0, len(nodes), 16)]
        for run in runs:
            for j in run:
                segments = "".join(nodes[k] for k in run if k < j), "".join(nodes[k] for k in run if k > j)
                for i in below[j]:
                    paths[i].append(segments)
        nodes, below = [sha("".join(nodes[k] for k in run)) for run in runs], [[i for k in run for i in below[k]] for run in runs]
    return nodes[0], paths


def brute_force(rows):
    sources = sorted({r.source for r in rows}, key=lambda s: (s is not None, (s or "").encode()))
    own = {s: sorted((r for r in rows if r.source == s), key=lambda r: (r.doc_id is not None, r.doc_id or 0, leaf(r, r.text))) for s in sources}
    trees = {s: climb([leaf(r, r.text) for r in own[s]]) for s in sources}
    root, upper = climb([trees[s][0] for s in sources])
    for s, above in zip(sources, upper):
        for r, path in zip(own[s], trees[s][1]):
            start = node = leaf(r, r.text)
            if r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 5 == 0 and r.text is not None:
                node = leaf(r, "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in r.text))
            for left, right in path + above:
                node = sha(left + node + right)
            yield (r.doc_id, start, trees[s][0], root, sha("".join(a + b for a, b in path + above)), node, node == root)


CASES = {
    "rounds": [(i, f"Text {i}" if i % 3 else f"text {i}", "en", "hot" if i % 4 else f"s{i % 80}") for i in range(700)],
    "edges": [(1, None, None, None), (2, "", "en", ""), (2, "", "en", ""), (2, "Other", "en", ""), (None, "A", "é", "ü"), (None, None, "x", "ü"), (5, "Ä B " * 50_000, "de", None)],
    "lone": [(1, "One", "en", "s")],
    "one source": [(i, "Same text", "en", "s") for i in range(17)],
    "one row many times": [(3, "Again", "en", "s")] * 300,
}


@pytest.mark.parametrize("case", CASES)
def test_manifest_equals_plain_loops(docs, case):
    df = docs(*CASES[case])
    got = [tuple(r) for r in manifest.prove(df).collect()]
    assert sorted(got, key=repr) == sorted(brute_force(df.collect()), key=repr)
    if case == "rounds":
        assert {True, False} == {r[-1] for r in got}


def test_empty_table(docs):
    assert manifest.prove(docs((1, "a")).where("false")).count() == 0


def test_ranks_of_a_hot_group(spark):
    rows = spark.range(5000).select(F.when(F.col("id") < 4000, "hot").otherwise("cold").alias("g"), (F.col("id") % 7).alias("v"))
    found = ranked(rows, "g", [F.col("v")], "ranks").collect()
    for group, n in (("hot", 4000), ("cold", 1000)):
        own = sorted((r.pos, r.v) for r in found if r.g == group)
        assert [p for p, _ in own] == list(range(n)) and [v for _, v in own] == sorted(v for _, v in own)
        assert {r.total for r in found if r.g == group} == {n}
