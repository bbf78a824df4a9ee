"""Large item files: items over block borders, signs inside strings, other fields, damaged items."""

import json

import pytest

from pubgrade.sources import records
from pubgrade.sources.scratch import scratch_path

ITEMS = [
    {"DOI": f"10.1/{i}", "title": [text], "author": [{"given": "A{", "family": "}B"}], "published": {"date-parts": [[2020, i % 12]]}, "URL": "u" * (i % 50)}
    for i, text in enumerate(['plain', 'a "quoted" }{ text', "back\\\\", 'end\\"', "{", "}", '"', "items\": [", "é ü", ""] * 30)
]


@pytest.fixture
def small_blocks(spark):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)


@pytest.mark.parametrize("indent", [None, 2])
def test_items_are_read_over_block_borders(spark, small_blocks, indent):
    path = scratch_path(spark, "items")
    whole = json.dumps({"status": "o{k", "items": ITEMS, "total": {"n": len(ITEMS)}}, indent=indent, ensure_ascii=False)
    spark.createDataFrame([(whole,)], "value string").coalesce(1).write.text(path)
    read = records.read_large_items(spark, path)
    assert spark.read.option("lineSep", "}").text(path).rdd.getNumPartitions() > 5
    found = {r.DOI: (r.title, r.author[0].given, r.published["date-parts"], r.URL) for r in read.collect()}
    assert len(found) == read.count() == len(ITEMS)
    assert found == {i["DOI"]: (i["title"], "A{", i["published"]["date-parts"], i["URL"]) for i in ITEMS}


def test_damaged_items_and_empty_files(spark):
    path = scratch_path(spark, "items")
    texts = ['{"items": [{"DOI": "a"}, {"DOI": b}, {"DOI": "c"}]}', '{"items": []}', "", '{"meta": {"n": 1}, "items": [{"DOI": "d"}]}', '{"items": [{"DOI": "e"}, {"DOI": ']
    for k, text in enumerate(texts):
        spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{path}/{k}")
    paths = [f"{path}/{k}" for k in range(len(texts))]
    assert sorted(r.DOI for r in records.read_large_items(spark, paths).collect()) == ["a", "c", "d", "e"]
    bad = {r.json for r in records.read_large_items(spark, paths, damaged="only").collect()}
    assert bad == {'{"DOI": b}', '{"DOI": \n}'}
