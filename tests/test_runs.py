"""Numbered runs: numbers of concurrent writers, unfinished runs, missing tables."""

from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import types as T

from pubgrade.sources import runs
from pubgrade.sources.scratch import scratch_path

ROW = T.StructType([T.StructField("writer", T.IntegerType()), T.StructField("value", T.DoubleType())])


def test_concurrent_writers_get_numbers_of_their_own(spark):
    path = scratch_path(spark, "runs")
    assert runs.read_runs(spark, path, ROW).count() == 0

    def write(writer):
        return writer, runs.append_run(spark.createDataFrame([(writer, 0.5), (writer, 1.5)], ROW), path)

    with ThreadPoolExecutor(6) as pool:
        written = dict(pool.map(write, range(6)))
    assert sorted(written.values()) == list(range(1, 7)) == runs.run_numbers(spark, path)
    rows = runs.read_runs(spark, path, ROW)
    assert rows.columns == ["run_seq", "writer", "value"]
    assert sorted(map(tuple, rows.collect())) == sorted((n, w, v) for w, n in written.items() for v in (0.5, 1.5))


def test_a_number_that_is_taken_is_not_given_again(spark):
    path = scratch_path(spark, "runs")
    assert runs._create_if_absent(spark, f"{path}/numbers/{1:012d}", "other")
    assert not runs._create_if_absent(spark, f"{path}/numbers/{1:012d}", "mine")
    assert spark.read.text(f"{path}/numbers").first()[0] == "other"
    assert runs.append_run(spark.createDataFrame([(1, 2.0)], ROW), path) == 2


def test_unfinished_runs_are_not_read(spark):
    path = scratch_path(spark, "runs")
    one = spark.createDataFrame([(1, 2.0)], ROW)
    one.write.parquet(f"{path}/runs/unfinished")
    assert runs.read_runs(spark, path, ROW).count() == 0
    assert runs.append_run(one, path) == 1
    assert runs.read_runs(spark, path, ROW).count() == 1
