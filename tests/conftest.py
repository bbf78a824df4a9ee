import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from checks.compare import connect, local_session  # noqa: E402
from pubgrade import schemas  # noqa: E402
from pubgrade.sources.scratch import remove, scratch_root, use_local_scratch  # noqa: E402

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("4")
    session.sparkContext.setLogLevel("ERROR")
    use_local_scratch(session)
    return session


@pytest.fixture(scope="module", autouse=True)
def freed():
    """After a module, the session gives back what its tests held: scratch tables, cached plans, shuffles of collected frames."""
    yield
    session = SparkSession.getActiveSession()
    if session:
        remove(session, scratch_root(session))
        session.catalog.clearCache()
        session.sparkContext._jvm.System.gc()


@pytest.fixture(scope="session")
def duck():
    return connect(SF_DIR)


@pytest.fixture
def frame(spark):
    """Rows of an entity from dicts; missing fields are NULL."""

    def build(entity, *rows):
        schema = schemas.ENTITIES[entity]
        return spark.createDataFrame([{name: row.get(name) for name in schema.names} for row in rows], schema)

    return build


@pytest.fixture
def apply(spark):
    """Values of an expression over a column of strings, in order."""

    def run(expression, values):
        from pyspark.sql import functions as F

        rows = list(enumerate(values))
        df = spark.createDataFrame(rows, "n int, value string").coalesce(1)
        return [row[0] for row in df.select("n", expression(F.col("value")).alias("out")).orderBy("n").select("out").collect()]

    return run
