"""Incremental measurements: what is computed again, and that the result is that of a full one."""

from checks.queries import AS_OF_YEAR, load
from pubgrade.operators import correct
from pubgrade.plans import metrics, partials, report
from pubgrade.sources import states
from pubgrade.sources.scratch import scratch_path

from conftest import SF_DIR


def test_only_changed_entities_are_scanned(spark):
    root, names = scratch_path(spark, "states"), ["NotNull", "CorrectValue"]
    store = f"{root}/partials"
    entities = load(spark, SF_DIR, "works", "persons", "orgUnits", "ROR", "lei", "fundref")
    states.write_state(root, states.INITIAL, entities)
    assert partials.refresh(spark, root, states.INITIAL, store, names, AS_OF_YEAR) == ["works", "persons", "orgUnits", "registries"]
    assert partials.refresh(spark, root, states.INITIAL, store, names, AS_OF_YEAR) == []
    works = correct.prefer_issn(entities["works"])
    states.write_state(root, "CorrectContradict", {"works": works})
    assert partials.refresh(spark, root, "CorrectContradict", store, names, AS_OF_YEAR) == ["works"]
    found = {tuple(r) for r in partials.analyze(spark, root, "CorrectContradict", store, AS_OF_YEAR, names).collect()}
    assert found == {tuple(r) for r in report.analyze(entities | {"works": works}, names, AS_OF_YEAR).collect()}
    # a state that is written again has a new version
    states.write_state(root, states.INITIAL, {"orgUnits": entities["orgUnits"].where("name is not null")})
    assert partials.refresh(spark, root, states.INITIAL, store, names, AS_OF_YEAR) == ["orgUnits", "registries"]


def test_merged_sketches_estimate_within_their_error(spark):
    df = spark.range(200_000).selectExpr("cast(id % 60000 as string) as many", "cast(id % 5 as string) as few", "if(id % 2 = 0, null, 'x') as half", "cast(null as string) as none")
    columns = ["many", "few", "half", "none"]
    parts = metrics.distinct_sketches(df.where("many < '3'"), columns).unionByName(metrics.distinct_sketches(df.where("many >= '3'"), columns))
    found = {r.column: (r.hits, r.base) for r in metrics.estimate_distinct(metrics.merge_sketches(parts)).collect()}
    assert abs(found["many"][0] - 60_000) < 0.03 * 60_000 and found["many"][1] == 200_000
    assert found["few"] == (5, 200_000) and found["half"] == (1, 100_000) and found["none"] == (0, 0)
