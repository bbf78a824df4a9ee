"""Memberships and rates against plain Python, and what the targets get."""

import json
import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from pubgrade.llm import mixing


def table(rng, n):
    rows, labels = [], []
    for i in range(n):
        poor = rng.random() < 0.3
        words = [("x!!##" if poor and rng.random() < 0.8 else f"word{rng.randint(0, 900)}") for _ in range(rng.randint(5, 60))]
        rows.append((i, " ".join(words), rng.choice(["en", "de"]), "s"))
        if rng.random() < 0.5:
            labels.append((i, int(not poor), int(rng.random() < 0.1)))
    return rows, labels


def brute(features, halves, labels, targets, iterations):
    """Rates by document: words of one half, naive Bayes of the other, then projected gradient, in plain numbers."""
    domains, names = list(targets), (*mixing.SHAPES, "words")
    known = [(features[i], "toxic" if t else "good" if q else "poor", halves[i]) for i, q, t in labels if i in features]
    first = [(x, d) for x, d, half in known if half == 0]
    size, held = Counter(d for _, d in first), Counter((w, d) for x, d in first for w in x["held"])
    odds = {}
    for w in {w for w, _ in held}:
        n = [held[w, d] for d in domains]
        if sum(n) >= mixing.LEAST_HELD:
            inside = [(n[k] + 1) / (size[d] + 2) for k, d in enumerate(domains)]
            outside = [(sum(n) - n[k] + 1) / (sum(size.values()) - size[d] + 2) for k, d in enumerate(domains)]
            odds[w] = [v if abs(v := math.log(a / b)) >= mixing.CLEAR else 0.0 for a, b in zip(inside, outside)]
    odds = {w: o for w, o in odds.items() if any(o)}
    for x in features.values():
        clear = [odds[w] for w in x["held"] if w in odds]
        sums = [sum(o[k] for o in clear) for k in range(len(domains))]
        x["words"] = "/".join("".join(str(int(s > border)) for border in mixing.BORDERS) for s in sums) if clear else ""
    known = [(x, d) for x, d, half in known if half == 1]
    total = Counter(d for _, d in known)
    seen = {f: Counter() for f in names}
    values = {f: {x[f] for x, _ in known} for f in names}
    for x, d in known:
        for f in names:
            seen[f][x[f], d] += 1
    m = {}
    for i, x in features.items():
        logs = []
        for d in domains:
            s = math.log(total[d] + mixing.PRIOR)
            for f in names:
                if x[f] in values[f]:
                    s += math.log((seen[f][x[f], d] + mixing.PRIOR) / (total[d] + mixing.PRIOR * len(values[f])))
            logs.append(s)
        e = [math.exp(s - max(logs)) for s in logs]
        m[i] = [v / sum(e) for v in e]
    tokens = {i: x["n_tokens"] for i, x in features.items()}
    shares = [v / sum(targets.values()) for v in targets.values()]
    have = [sum(tokens[i] * m[i][k] for i in m) for k in range(len(domains))]
    wanted = min(h / s for h, s in zip(have, shares))
    rate, ahead = dict.fromkeys(m, 1.0), dict.fromkeys(m, 1.0)
    for turn in range(iterations):
        now = [sum(ahead[i] * tokens[i] * m[i][k] for i in m) for k in range(len(domains))]
        slopes = [(n - s * wanted) / sum(have) for n, s in zip(now, shares)]
        if max(map(abs, slopes)) < 1e-5:
            break
        for i in m:
            new = max(0.0, ahead[i] - sum(a * b for a, b in zip(slopes, m[i])))
            ahead[i], rate[i] = new + turn / (turn + 3) * (new - rate[i]), new
    return m, rate, [wanted * s for s in shares]


def test_rates(spark, docs, edge_rows):
    rows, labels = table(random.Random(6), 300)
    rows += [((d or 0) + 1000, t, None, None) for d, t in edge_rows if d not in (4, 6, None)]
    df, known = docs(*rows), spark.createDataFrame([*labels, (None, 1, 0), (7, None, 1)], "doc_id long, quality int, toxic int")
    found = {r.doc_id: r for r in mixing.fit_rates(df, known).collect()}
    features = {r.doc_id: r.asDict() for r in mixing.features(df).collect()}
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    halves = {r.doc_id: r.half for r in df.select("doc_id", half.alias("half")).collect()}
    m, rate, wanted = brute(features, halves, labels, mixing.TARGETS, mixing.ITERATIONS)
    assert found.keys() == m.keys()
    for i, r in found.items():
        assert [r.m_good, r.m_poor, r.m_toxic] == pytest.approx(m[i], abs=1e-9) and r.rate == pytest.approx(rate[i], abs=1e-9)
        assert abs(r.copies - r.rate) < 1
    # toxic is labelled at random here: no rate can move its share
    for k, domain in enumerate(["good", "poor"]):
        assert sum(r.rate * r.n_tokens * r[f"m_{domain}"] for r in found.values()) == pytest.approx(wanted[k], rel=0.08)


def test_labelled_shares_move_to_their_targets(spark):
    """Domains are recognised: the tokens of labelled documents, not only the expected ones, come near the targets."""
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{name}.parquet") for name in ("documents", "labels"))
    targets = {"good": 0.6, "poor": 0.1, "toxic": 0.3}
    rates = mixing.fit_rates(docs, labels, targets).join(labels.dropDuplicates(["doc_id"]), "doc_id").withColumn("domain", mixing.label_domain())
    rows = rates.groupBy("domain").agg(F.sum("n_tokens").alias("before"), F.sum(F.col("rate") * F.col("n_tokens")).alias("after")).collect()
    before, after = (sum(r[name] for r in rows) for name in ("before", "after"))
    toxic = next(r for r in rows if r.domain == "toxic")
    print({r.domain: (r.before / before, r.after / after) for r in rows})
    assert toxic.before / before < 0.15 and toxic.after / after > 0.25


def test_whole_domain_stays(spark, docs):
    rows, labels = table(random.Random(8), 300)
    df, known = docs(*rows), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    found = mixing.fit_rates(df, known, {"good": 0.5, "poor": 0.5}, mixing.quality_domain(), whole="good").collect()
    expected = [sum(f * r.n_tokens * r.m_good for r in found) for f in (1, 0)]
    assert sum(r.rate * r.n_tokens * r.m_good for r in found) == pytest.approx(expected[0], rel=0.05)
    assert sum(r.rate * r.n_tokens * r.m_poor for r in found) == pytest.approx(expected[0], rel=0.1)
    assert all(r.rate == 1 and r.copies == 1 for r in found if r.m_good >= r.m_poor)
    bounded = mixing.fit_rates(df, known, {"good": 0.5, "poor": 0.5}, mixing.quality_domain(), whole="good", most=1.0).collect()
    assert max(r.rate for r in bounded) == 1 and max(r.copies for r in bounded) == 1


def test_features(docs):
    row = mixing.features(docs((1, "One two, two!", None, None))).first()
    assert len(row.held) == 2
    assert (row.n_tokens, row["lang"], row["shape"], row["signs"], row["length"]) == (3, "", "2/10", "2", "4")


def test_mix_keeps_columns_and_copies(spark, docs, edge_rows):
    rows, labels = table(random.Random(7), 200)
    df = docs(*rows, *[((d or 0) + 1000 if d else None, t) for d, t in edge_rows])
    known = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    copies = {(r.doc_id, r.draw): r.copies for r in mixing.fit_rates(df, known).collect()}
    mixed = mixing.mix(df, known)
    assert mixed.columns == df.columns
    assert mixed.count() == sum(copies[r.doc_id, r.draw] for r in mixing.features(df).collect())
    upsampled = {r.doc_id: r.copies for r in mixing.fit_rates(df, known, budget=40_000).collect()}
    assert max(upsampled.values()) > 1


def test_without_labels_or_rows(spark, docs):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = docs((1, "a b"), (2, None))
    assert mixing.fit_rates(df, none).count() == 2 and mixing.mix(df.where("false"), none).count() == 0
    assert json.dumps(mixing.TARGETS)
