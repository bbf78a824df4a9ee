import random

import pytest
from pyspark.sql import functions as F

from checks.oracles import AS_OF_YEAR
from checks.queries import load
from pubgrade import rules
from pubgrade.functions.rounding import round3
from pubgrade.plans import metrics, monitor, report
from pubgrade.sources.scratch import scratch_path

from conftest import SF_DIR


@pytest.fixture(scope="module")
def entities(spark):
    return {name: df.cache() for name, df in load(spark, SF_DIR).items()}


def test_rounding_equals_python(spark):
    rng = random.Random(1)
    values = [n / 10000 for n in range(10001)] + [n / 2000 for n in range(-2000, 2001)] + [0.0625, 2.5, -0.0005, 1e6 + 0.0005]
    values += [rng.random() for _ in range(5000)] + [rng.uniform(-1, 1) for _ in range(5000)]
    df = spark.createDataFrame([(v, round(v, 3)) for v in values], "value double, expected double")
    assert not df.withColumn("ours", round3(F.col("value"))).where("ours <> expected").take(5)


def test_selection():
    names, dimensions = report.select_metrics(["complete"])
    assert dimensions == ["Completeness", "Consistency"]
    assert names["CorrectValue"] == ["Correctness"] and len(names) == 9
    assert report.select_metrics(["NotNull", "CorrectValue", "Correctness"]) == (
        {"NotNull": ["NotNull"], "CorrectValue": ["CorrectValue", "Correctness"]}, [],
    )
    # complete only counts in the first place
    assert report.select_metrics(["MinValue", "complete"]) == ({"MinValue": ["MinValue"]}, [])
    assert report.select_metrics(["Consistency"])[0].keys() == rules.DIMENSIONS["Consistency"].keys()


def test_report_equals_python_model(entities):
    raw = {}
    for r in metrics.indicators(entities, list(rules.WEIGHTS), AS_OF_YEAR).collect():
        raw.setdefault(r.metric, {})[r.indicator] = r.value
    expected = {}
    for metric, weights in rules.WEIGHTS.items():
        shown = "Correctness" if metric == "CorrectValue" else metric
        total = 0
        for indicator, weight in weights.items():
            total += raw[metric][indicator] * weight
            expected[f"{shown}.{indicator}"] = round(raw[metric][indicator], 3)
        expected[shown] = round(total / sum(weights.values()), 3)
    for dimension, weights in rules.DIMENSIONS.items():
        total = 0
        for metric, weight in weights.items():
            total += expected[metric] * weight
            expected[f"{dimension}.{metric}"] = expected[metric]
        expected[dimension] = round(total / sum(weights.values()), 3)
    found = {r.indicator: r.value for r in report.analyze(entities, as_of_year=AS_OF_YEAR).collect()}
    assert found == expected


def test_single_metric(entities):
    found = {r.indicator: r.value for r in report.analyze(entities, ["MinObject"], AS_OF_YEAR).collect()}
    assert set(found) == {"MinObject", "MinObject.works", "MinObject.persons"}


def test_measure_and_monitor(spark, entities):
    path = scratch_path(spark, "measurements")
    half = dict(entities, works=entities["works"].where("title is not null"))
    assert report.append_measurement(entities, path, "initial", ["MinObject"], AS_OF_YEAR) == 1
    assert report.append_measurement(half, path, "complete", ["MinObject"], AS_OF_YEAR) == 2
    once = report.read_measurements(spark, path)
    assert monitor.monitor(once, "MinObject").isEmpty()
    assert not any(r.enough for r in monitor.run_counts(once).collect())
    assert report.append_measurement(half, path, "initial", ["MinObject"], AS_OF_YEAR) == 3
    assert report.append_measurement(half, path, "complete", ["MinObject"], AS_OF_YEAR) == 4
    runs = report.read_measurements(spark, path)
    value = {(r.run_seq, r.indicator): r.value for r in runs.collect()}
    rows = {r.indicator: r for r in monitor.monitor(runs, "MinObject").collect()}
    assert set(rows) == {"MinObject", "MinObject.works", "MinObject.persons", "works", "persons", "affiliations", "orgUnits"}
    for name, row in rows.items():
        first, result1, last, result2 = (value[run, name] for run in (1, 2, 3, 4))
        before, after = round(first - result1, 3), round(last - result2, 3)
        assert row.base_change == round(last - first, 3)
        assert (row.improvement_before, row.improvement_last) == (before, after)
        assert row.improvement_change == round(before - after, 3)
    assert monitor.monitor(runs, "complete").isEmpty()
