import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pubgrade.operators import enrich, merge


def keys(frame, *works):
    rows = [{"orcid_publication_id": f"p{i}", **w} for i, w in enumerate(works)]
    return [r.key for r in merge.add_duplicate_key(frame("works", *rows)).orderBy("orcid_publication_id").collect()]


def test_key_counts_authors_only(frame):
    found = keys(
        frame,
        {"title": "Ab C", "date": "2020", "authors": ["1", "2"]},
        {"title": "AB c", "date": "2020", "authors": ["3", "4"]},
        {"title": "Ab C", "date": "2020", "authors": ["1"]},
    )
    assert found == ["ab c#2020##", "ab c#2020##", "ab c#2020#"]


def test_key_of_incomplete_works(frame):
    found = keys(
        frame,
        {"title": "", "date": "2020", "authors": ["1"]},
        {"title": "t", "date": None, "authors": ["1"]},
        {"title": "t", "date": "2020", "authors": []},
        {"title": "t", "date": "2020"},
    )
    assert found == [None, "p1", None, "p3"]


def test_null_keys(frame):
    rows = [{"title": "", "date": "2020", "authors": ["1"], "doi": d} for d in "abc"]
    assert merge.merge_works(frame("works", *rows)).count() == 1
    assert merge.merge_works(frame("works", *rows), null_key="keep").count() == 3


def test_merge_equals_brute_force(frame):
    rng = random.Random(5)
    rows = [
        {
            "orcid_publication_id": str(rng.randint(0, 30)),
            "title": rng.choice([None, "", "One", "one", "Two"]),
            "date": rng.choice([None, "2020"]),
            "authors": rng.choice([None, [], ["a"], ["b"], ["a", "c"]]),
            "doi": rng.choice([None, "x", "y", "z"]),
            "abstract": rng.choice([None, "p", "q"]),
        }
        for _ in range(300)
    ]
    groups = defaultdict(list)
    for row in rows:
        title, date, authors = row["title"], row["date"], row["authors"]
        if title is None or date is None or authors is None:
            key = row["orcid_publication_id"]
        elif not title or not date or not authors:
            key = None
        else:
            key = f"{title}#{date}{'#' * len(authors)}".lower()
        groups[key].append(row)
    expected = set()
    for group in groups.values():
        best = [max((r[c] for r in group if r[c] is not None), default=None) for c in rows[0]]
        expected.add(tuple(tuple(v) if isinstance(v, list) else v for v in best))
    merged = merge.merge_works(frame("works", *rows)).select(list(rows[0])).collect()
    found = [tuple(tuple(v) if isinstance(v, list) else v for v in row) for row in merged]
    assert len(found) == len(groups) and set(found) == expected


def test_merge_persons(frame):
    works = frame("works", {"authors": ["1", "2"]}, {"authors": ["1"]}, {"authors": None})
    persons = frame(
        "persons",
        {"id": "1", "country": "DE", "affiliations": [(None, "o", None, None)]},
        {"id": "1", "country": "FR", "affiliations": [("2001", None, None, None)]},
        {"id": "3", "country": "IT"},
        {"id": None, "country": "ES"},
    )
    rows = merge.merge_persons(persons, works).collect()
    assert [(r.id, r.country) for r in rows] == [("1", "FR")]
    # NULL fields sort lowest
    assert rows[0].affiliations[0].endYear == "2001"


def test_key_with_names(frame):
    works = frame(
        "works",
        {"orcid_publication_id": "p1", "title": "T", "date": "2020", "authors": ["1", "2", "3", "9"]},
        {"orcid_publication_id": "p2", "title": "T", "date": "2020", "authors": []},
        {"orcid_publication_id": "p3", "title": "T", "date": "2020"},
    )
    persons = frame(
        "persons",
        {"id": "1", "firstName": "Ann", "lastName": "Ash"},
        {"id": "1", "otherNames": "ignored"},
        {"id": "2", "otherNames": "Bob van Berg"},
        {"id": "3", "publishedName": "Coe , Cy"},
    )
    rows = merge.add_duplicate_key_with_names(works, persons).orderBy("orcid_publication_id").collect()
    assert [r.key for r in rows] == ["t#2020#ash. ann#berg. bob#coe. cy#", None, "p3"]


def test_hot_key_is_combined_before_the_shuffle(spark):
    works = spark.range(2000).select(
        *[F.lit("x").alias(c) for c in ("abstract", "bibtex", "date", "doi", "isbn", "issn", "journal_title", "orcid_id")],
        F.col("id").cast("string").alias("orcid_publication_id"),
        *[F.lit("x").alias(c) for c in ("subTitle", "type", "url")],
        F.expr("if(id < 0, 'y', 'x')").alias("title"),
        F.array(F.lit("a")).alias("authors"),
    )
    merged = merge.merge_works(works)
    assert merged.count() == 1
    plan = merged._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_max") > plan.index("Exchange hashpartitioning(key")


def test_frequent_author_list_is_split(spark):
    """A third of the works shares one author list, a third has none; the joins can split the hot side."""
    rows = [(f"p{i}", f"Title number {i}", "2020", ["1"] if i % 3 == 0 else None if i % 3 == 1 else [str(i)]) for i in range(30_000)]
    works = spark.createDataFrame(rows, "orcid_publication_id string, title string, date string, authors array<string>").repartition(6)
    people = [("1", "Ann", "A", None, None)] + [(str(i), "F", f"L{i}", None, None) for i in range(2, 3000)]
    persons = spark.createDataFrame(people, "id string, firstName string, lastName string, otherNames string, publishedName string")
    conf = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20k",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
    }
    before = {key: spark.conf.get(key, None) for key in conf}
    for key, value in conf.items():
        spark.conf.set(key, value)
    try:
        keyed = merge.add_duplicate_key_with_names(works, persons)
        found = {r.orcid_publication_id: r.key for r in keyed.collect()}
        plan = keyed._jdf.queryExecution().executedPlan().toString()
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    assert "SortMergeJoin(skew=true)" in plan
    assert found["p0"] == "title number 0#2020#a. ann" and found["p1"] == "p1" and found["p5"] == "title number 5#2020#l5. f"


def test_one_row_per_id_of_the_reference(frame):
    works = frame("works", {"doi": "d", "orcid_publication_id": "1"})
    reference = frame("crossRef", {"doi": "d", "title": "b"}, {"doi": "d", "title": "a"}, {"doi": None, "title": "n"})
    assert [r.title for r in enrich.enrich_works(works, reference, duplicates="first").collect()] == ["a"]
    assert sorted(r.title for r in enrich.enrich_works(works, reference).collect()) == ["a", "b"]
    with pytest.raises(ValueError):
        enrich.enrich_works(works, reference, duplicates="last")
