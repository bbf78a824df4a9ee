import random

import pytest
from pyspark.sql import functions as F

from checks.oracles import AS_OF_YEAR
from checks.queries import load
from pubgrade import rules, schemas
from pubgrade.operators import registry
from pubgrade.plans import metrics

from conftest import SF_DIR


@pytest.fixture(scope="module")
def entities(spark):
    return {name: df.cache() for name, df in load(spark, SF_DIR).items()}


def by_indicator(df):
    return {r.indicator: r for r in df.collect()}


def registries(spark, ror=(), lei=(), fundref=()):
    return {
        "ROR": spark.createDataFrame(list(ror), "id string, `external_ids.GRID.preferred` string, name string"),
        "lei": spark.createDataFrame(list(lei), "id string, name string"),
        "fundref": spark.createDataFrame(list(fundref), "uri string, primary_name_display string, replaced string"),
    }


def test_fused_equals_one_count_at_a_time(entities):
    found = by_indicator(metrics.indicators(entities, ["NotNull"], AS_OF_YEAR))
    for name in ("persons", "works", "orgUnits"):
        df = entities[name]
        for column in df.columns:
            assert found[f"{name}.{column}"].value == df.where(F.col(column).isNotNull()).count() / df.count()
    rows = by_indicator(metrics.indicators(entities, ["MinLength"], AS_OF_YEAR))
    for entity, fields in rules.MIN_LENGTHS.items():
        for field, length in fields.items():
            present = entities[entity].where(F.col(field).isNotNull())
            expected = present.where(F.length(field) >= length).count() / present.count()
            assert rows[f"{entity}.{field}"].value == expected


def test_no_rows_give_zero(spark):
    empty = {name: spark.createDataFrame([], schema) for name, schema in schemas.ENTITIES.items()}
    rows = metrics.indicators(empty, list(rules.WEIGHTS), AS_OF_YEAR).collect()
    assert len(rows) == sum(len(w) for w in rules.WEIGHTS.values())
    # the population counts what is missing, so nothing of the domain is there
    assert {r.value for r in rows} == {0.0}


def test_every_affiliation_counts_in_the_base(frame, spark):
    persons = frame("persons", {"affiliations": [(None, None, None, None), ("2001", None, None, "1899")]}, {"affiliations": None})
    rows = by_indicator(metrics.fused_ratios(persons, metrics.person_ratios(persons, "CorrectValue")))
    start, end = rows["persons.affiliations.startYear"], rows["persons.affiliations.endYear"]
    assert (start.hits, start.base) == (0, 2) and (end.hits, end.base) == (1, 2)


def test_contradictions(frame):
    works = frame(
        "works",
        {"isbn": "1", "issn": "1", "type": "book"},
        {"isbn": "1", "type": "edited-book"},
        {"isbn": "1", "type": "journal-article"},
        {"issn": "1"},
        {"isbn": "1"},
        {},
    )
    rows = by_indicator(metrics.fused_ratios(works, metrics.work_ratios(works, "NoContradict", AS_OF_YEAR)))
    assert rows["works.isbnXORissn"].value == 1 - 1 / 5
    assert rows["works.isbnOnlyBook"].value == 1 - 1 / 3


def test_population(frame):
    works = frame("works", {"date": "2000-01", "type": "book"}, {"date": "2026"}, {"date": "1999"}, {"type": "other"})
    rows = by_indicator(metrics.fused_ratios(works, metrics.work_ratios(works, "MinPopulation", 2026)))
    assert rows["works.date"].value == 1 - 25 / 27
    assert rows["works.type"].value == 1 - 8 / 9
    domain = metrics.population_years(2100)  # more values than bits in one word
    missing = works.agg(metrics._missing(domain, "substring(date, 1, 4)")).first()[0]
    assert missing == 101 - 2
    left = metrics.missing_values(works, F.substring("date", 1, 4), domain)
    assert left.count() == 99 and left.where("value in ('2000', '2026')").isEmpty()


def test_org_names(frame, spark):
    orgs = frame(
        "orgUnits",
        {"type": "LEI", "id": "1", "name": "A"},
        {"type": "LEI", "id": "1", "name": None},
        {"type": "ROR", "id": "1", "name": "A"},
        {"type": None, "id": "1", "name": "A"},
        {"type": "GRID", "id": None, "name": "A"},
    )
    entities = {"orgUnits": orgs, **registries(spark, ror=[("1", "g", "B"), (None, None, "C")], lei=[("1", "A"), ("1", "B"), ("1", None)])}
    counts = {r.type: (r.orgs, r.mismatches) for r in registry.count_name_mismatches(entities).collect() if r.orgs}
    # two registry rows of the LEI id differ in name; the base is counted before the pairs
    assert counts == {"LEI": (2, 1), "ROR": (1, 1), "GRID": (1, 0)}
    ratio = metrics.org_name_ratio(entities).collect()[0]
    assert ratio.value == (1 - 0 / 1 + 1 - 1 / 1 + 1 - 1 / 2 + 0) / 4
    names = sorted(str(r.name) for r in registry.correct_org_names(entities).where("type = 'LEI'").collect())
    # three registry rows each; a NULL name does not replace
    assert names == ["A", "A", "A", "B", "B", "None"]


def test_mismatches_equal_the_join(spark):
    rng = random.Random(3)
    orgs = [(rng.choice("12"), rng.choice(["A", "B", None]), rng.choice(["LEI", "ROR", None])) for _ in range(400)]
    lei = [(rng.choice("123"), rng.choice(["A", "B", None])) for _ in range(60)]
    ror = [(rng.choice("123"), None, rng.choice(["A", "B", None])) for _ in range(60)]
    entities = {"orgUnits": spark.createDataFrame(orgs, "id string, name string, type string"), **registries(spark, ror, lei)}
    expected = {
        t: sum(o[2] == t and o[0] == r[0] and None not in (o[1], r[-1]) and o[1] != r[-1] for o in orgs for r in rows)
        for t, rows in (("LEI", lei), ("ROR", ror))
    }
    found = {r.type: r.mismatches for r in registry.count_name_mismatches(entities).collect() if r.orgs}
    assert found == expected


def test_array_elements(frame):
    works = frame("works", {"authors": ["0000-0001-0000-0001", "x", None]}, {"authors": []}, {"authors": None})
    row = metrics.array_elements(works, "authors", rules.OWNER_ID).collect()[0]
    assert (row.hits, row.base) == (1, 3)


def test_entry_count(frame):
    entities = {
        "persons": frame("persons", {"affiliations": [(None, "o", None, None)] * 3}, {"id": "1"}),
        "works": frame("works", {"title": "x"}),
        "orgUnits": frame("orgUnits", {"id": "1"}),
    }
    assert {r.entity: r.rows for r in metrics.count_entries(entities).collect()} == {
        "persons": 2, "affiliations": 1, "works": 1, "orgUnits": 1,
    }
