import re

import pytest
from pyspark.sql import functions as F

from checks.oracles import AS_OF_YEAR
from checks.queries import load
from pubgrade.operators import correct, enrich, filters, sample
from pubgrade.plans import chain, metrics

from conftest import SF_DIR


@pytest.fixture(scope="module")
def entities(spark):
    return {name: df.cache() for name, df in load(spark, SF_DIR).items()}


def values(entities, metric):
    return {r.indicator: r.value for r in metrics.indicators(entities, [metric], AS_OF_YEAR).collect()}


@pytest.mark.parametrize(
    "step,metric,indicators",
    [
        ("CorrectMinLength", "MinLength", None),
        ("CorrectContradict", "NoContradict", ["works.isbnXORissn"]),
        ("FilterContradict", "NoContradict", ["persons.affiliations.startBeforeEnd"]),
        ("FilterObjects", "MinObject", None),
    ],
)
def test_steps_reach_their_metric(entities, step, metric, indicators):
    after = {**entities, **chain.transform(entities, step)}
    found = values(after, metric)
    assert {found[i] for i in indicators or found} == {1.0}


@pytest.mark.parametrize(
    "step",
    [
        lambda e: correct.null_short_values(e["works"], "works"),
        lambda e: correct.prefer_issn(e["works"]),
        lambda e: filters.drop_contradicting_years(e["persons"]),
        lambda e: filters.keep_minimal_works(e["works"]),
    ],
)
def test_idempotent(entities, step):
    once = step(entities)
    name = "persons" if "affiliations" in once.columns else "works"
    twice = step({**entities, name: once})
    assert twice.exceptAll(once).isEmpty() and once.exceptAll(twice).isEmpty()


def test_stacks(entities):
    assert chain.transform(entities, "Correct").keys() == {"orgUnits", "works", "persons"}
    assert chain.transform(entities, "Parse").keys() == {"works", "persons"}
    assert len(chain.FULL_CHAIN) == 14 and set(chain.FULL_CHAIN) == set(chain.STEPS)


def test_cuts_do_not_change_the_result(entities):
    cut, lazy = chain.transform(entities), chain.transform(entities, cut=chain.keep_lazy)
    for name in cut:
        assert cut[name].exceptAll(lazy[name]).isEmpty() and lazy[name].exceptAll(cut[name]).isEmpty()


def test_joins_without_broadcast(spark, entities):
    """Sort-merge joins, as with tables beyond any broadcast limit, give the same rows."""
    broadcast = {
        "works": enrich.enrich_works(entities["works"], entities["crossRef"]),
        "orgs": chain.transform(entities, "CorrectOrgs")["orgUnits"],
        "persons": chain.transform(entities, "Merge")["persons"],
    }
    expected = {name: sorted(map(repr, df.collect())) for name, df in broadcast.items()}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        merged = {
            "works": enrich.enrich_works(entities["works"], entities["crossRef"]),
            "orgs": chain.transform(entities, "CorrectOrgs")["orgUnits"],
            "persons": chain.transform(entities, "Merge")["persons"],
        }
        for name, df in merged.items():
            assert "SortMergeJoin" in df._jdf.queryExecution().executedPlan().toString()
            assert sorted(map(repr, df.collect())) == expected[name]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_works_without_doi_are_spread(spark, entities):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        works = entities["works"].withColumn("doi", F.expr("if(orcid_publication_id = '0', doi, null)"))
        joined = enrich.join_reference(works, entities["crossRef"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert re.search(r"hashpartitioning\(doi#\d+, _spread#", plan)
        assert joined.count() == works.join(entities["crossRef"].select("doi"), "doi", "left").count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_doi_fans_out_completely(frame):
    works = frame("works", *[{"doi": "d", "orcid_publication_id": str(i)} for i in range(50)], {"doi": "D"}, {})
    reference = frame(
        "crossRef",
        {"doi": "d", "title": "a", "authors": [("f", "1", "l")]},
        {"doi": "d", "title": "b", "authors": [("f", "2", "l"), (None, "3", None)]},
        {"doi": None, "title": "n"},
    )
    joined = enrich.join_reference(works, reference)
    assert joined.count() == 102
    assert joined.where("doi = 'D' or doi is null").select("title").distinct().collect()[0].title is None
    persons = enrich.add_reference_persons(frame("persons", {"id": "p"}), joined)
    assert persons.count() == 1 + 50 * 3


def test_samples(frame):
    works = frame("works", *[{"title": t} for t in ["b", None, "", "a", "b", "c"]])
    assert [r.title for r in sample.sample_extremes(works, "title", 3).collect()] == ["a", "b", "b"]
    assert [r.title for r in sample.sample_extremes(works, "title", 2, descending=True).collect()] == ["c", "b"]
    persons = frame("persons", {"affiliations": [(None, "o2", None, None), (None, "o1", None, None)]}, {"affiliations": None})
    assert [r.orgID for r in sample.sample_extremes(persons, "affiliations.orgID").collect()] == ["o1", "o2"]
