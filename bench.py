"""Times the headline queries and prints one JSON line.

Every query runs twice and the second run counts, so class loading and code
generation of the first are left out. Results are produced completely (noop
sink). The test tables are single files with one row group, which one task would read,
so they are copied into FILES files each before the clock starts. ``planning`` is the
part of a query's time that passes before its last job can start, the stored tables of a chain included. ``unfused_not_null`` is the same metric with one count per column and
``chain_without_cuts`` the chain without stored tables, for comparison; they are
not part of the total.
"""

import json
import os
import time

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from checks.compare import TABLES, local_session
from checks.queries import all_queries, load
from pubgrade.plans import chain
from pubgrade.sources.scratch import scratch_path, use_local_scratch

FILES = 16

HEADLINE = [
    "q_quality_report",
    "q_not_null",
    "q_correct_value",
    "q_unique_value",
    "q_unique_object",
    "q_parse_citation",
    "q_parse_values",
    "q_correct_values_works",
    "q_correct_affiliations",
    "q_correct_orgs",
    "q_correct_orgs_metric",
    "q_join_enrich",
    "q_duplicate_key",
    "q_merge_works",
    "q_merge_persons",
    "q_duplicate_key_names",
    "q_union_authors",
    "q_filter_contradict",
    "q_full_chain",
    "q_full_chain_persons",
    "q_extract_xml_works",
    "q_flatten_items",
    "q_sample_extremes",
    "q_monitor_improvement",
]


def produce(df: DataFrame) -> None:
    df.write.format("noop").mode("overwrite").save()


def unfused_not_null(spark, sf_dir: str) -> None:
    for df in load(spark, sf_dir, "works", "persons", "orgUnits").values():
        for column in df.columns:
            df.where(F.col(column).isNotNull()).count()
        df.count()


def chain_without_cuts(spark, sf_dir: str) -> None:
    """The works of the complete chain as one lazy plan, without stored tables in between."""
    produce(chain.transform(load(spark, sf_dir), cut=chain.keep_lazy)["works"])


def split_copy(spark, sf_dir: str) -> str:
    """A copy of the tables in FILES files each."""
    root = scratch_path(spark, "bench-tables")
    for name in TABLES:
        spark.read.parquet(f"{sf_dir}/{name}.parquet").repartition(FILES).write.parquet(f"{root}/{name}.parquet")
    return root


def planned(df: DataFrame) -> None:
    df._jdf.queryExecution().executedPlan()


def timed(run) -> float:
    start = time.time()
    run()
    return round(time.time() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    use_local_scratch(spark)
    queries, seconds, planning = all_queries(), {}, {}
    tables = split_copy(spark, sf_dir)
    for name in HEADLINE:
        for _ in range(2):
            seconds[name] = timed(lambda name=name: produce(queries[name](spark, tables)))
    for name in ("q_full_chain", "q_full_chain_persons", "q_quality_report"):
        planning[name] = timed(lambda name=name: planned(queries[name](spark, tables)))
    comparison = {
        "unfused_not_null": timed(lambda: unfused_not_null(spark, tables)),
        "chain_without_cuts": timed(lambda: chain_without_cuts(spark, tables)),
    }
    print(
        json.dumps(
            {
                "metric": "total wall time of the headline queries, second run each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
                "comparison": comparison,
                "planning": planning,
            }
        )
    )


if __name__ == "__main__":
    main()
