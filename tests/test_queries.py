"""Every query against its SQL, and the driver contract."""

import __spark_entry__ as entry_point
import pytest

from checks.compare import compare
from checks.oracles import all_sql
from checks.queries import all_queries

from conftest import SF_DIR


def test_contract(spark):
    assert all_sql().keys() == all_queries().keys() <= entry_point.queries().keys()
    report = {r.indicator: r.value for r in entry_point.entry(spark).collect()}
    assert {"Completeness", "Correctness", "Consistency"} <= report.keys()


@pytest.mark.parametrize("name", all_queries())
def test_query_equals_sql(spark, duck, name):
    ok, note = compare(spark, duck, SF_DIR, name)
    assert ok, note
