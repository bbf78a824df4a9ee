"""Measures, sketches and verdicts against plain Python."""

import random
import re
from collections import Counter

from pubgrade.llm import quality


def measure(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    counts, covered = Counter(windows), set()
    for i, w in enumerate(windows):
        covered |= set(range(i, i + 8)) if counts[w] > 1 else set()
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    n, chars, signs = len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or ""))
    dup = len(lines) - len(set(lines))
    failed = n < 20 or 100 * len(covered) > 30 * n
    shares = (signs * 10000 // max(chars, 1), dup * 10000 // max(len(lines), 1), len(covered) * 10000 // max(n, 1), 100 * chars // max(n, 1))
    return (n, chars, signs, dup, len(covered), failed), shares


def bucket(v):
    drop = max(v.bit_length() - 6, 0)
    return v >> drop << drop


def fences(rows):
    out = []
    for k, (below, above) in enumerate(quality.MARGINS.values()):
        values = sorted(bucket(r[k]) for r in rows)
        q25, q75 = (values[-(-len(values) * p // 4) - 1] for p in (1, 3))
        reach = 3 * (q75 - q25)
        out.append((None if below is None else q25 - reach - below, None if above is None else q75 + reach + above))
    return out


def make(rng):
    words = [f"w{rng.randint(0, 300)}" for _ in range(rng.choice([5, 30, 60, 200]))]
    if rng.random() < 0.2:
        words = [w + "###" for w in words]
    if rng.random() < 0.2:
        words += words[: len(words) // 2]
    text = ""
    for w in words:
        text += w + rng.choice([" ", " ", "\n", "\t "])
    return text + ("\nline of words\nline of words" if rng.random() < 0.3 else "")


def test_verdicts(docs, edge_rows):
    rng = random.Random(4)
    rows = [(i, make(rng), rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c"])) for i in range(400)]
    rows += [(1000 + i, t, "xx", "rare") for i, (_, t) in enumerate(edge_rows)]
    measured = {i: measure(t) for i, t, *_ in rows}
    groups = {}
    for i, _, lang, source in rows:
        if not measured[i][0][-1]:
            for key in ((lang or "", source), (lang or "",), ()):
                groups.setdefault(key, []).append(measured[i][1])
    expected = {}
    for i, _, lang, source in rows:
        base, shares = measured[i]
        keys = [k for k in ((lang or "", source), (lang or "",)) if len(groups.get(k, ())) >= 30] + [()]
        inside = all((lo is None or v >= lo) and (hi is None or v <= hi) for v, (lo, hi) in zip(shares, fences(groups[keys[0]])))
        expected[i] = (*base, not base[-1] and inside)
    found = {r[0]: tuple(r)[1:] for r in quality.judge_quality(docs(*rows), least=30).collect()}
    assert found == expected
    assert {v[-1] for v in found.values()} == {True, False}


def test_no_rows_and_repeated_rows(docs, edge_rows):
    df = docs(*edge_rows)
    assert quality.judge_quality(df).count() == len(edge_rows) and quality.judge_quality(df.where("false")).count() == 0


def test_sketches_merge(docs):
    rng = random.Random(1)
    rows = [(i, make(rng), "en", str(i % 3)) for i in range(60)]
    measured = quality.measures(docs(*rows))
    parts = quality.sketches(measured.where("doc_id < 20")).unionByName(quality.sketches(measured.where("doc_id >= 20")))

    def total(df):
        return sorted(map(tuple, df.groupBy("lang", "source", "measure", "bucket").sum("n").collect()))

    assert total(parts) == total(quality.sketches(measured))


def test_repeats_below_the_base_rule_are_judged_by_the_group(docs):
    """A quarter of repeated words passes the base rule and fails the fence of a group without any; a tenth stays."""
    rng = random.Random(4)

    def text(n, repeated):
        own = [f"w{rng.randint(0, 10**6)}" for _ in range(n - repeated)]
        return " ".join([*own[:repeated], *own])

    rows = [(i, text(100, 0), "en", "s") for i in range(80)] + [(100, text(200, 25), "en", "s"), (101, text(200, 9), "en", "s")]
    found = {r.doc_id: r for r in quality.judge_quality(docs(*rows)).collect()}
    assert found[100].n_repeat_words == 50 and not found[100].base_failed and not found[100].kept
    assert found[101].n_repeat_words == 18 and found[101].kept
    assert all(found[i].kept for i in range(80))
