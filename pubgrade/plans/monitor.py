"""How indicators moved between the last two runs."""

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubgrade.functions.rounding import round3
from pubgrade.sources import runs


def run_counts(measurements: DataFrame) -> DataFrame:
    """Runs per state and metric selection; monitoring needs two of each state."""
    runs = measurements.groupBy("chain", "metrics", "run_seq").agg(F.count(F.lit(1)).alias("rows"))
    return (
        runs.groupBy("chain", "metrics")
        .agg(F.count(F.lit(1)).alias("runs"))
        .withColumn("enough", F.col("runs") >= 2)
    )


def latest_runs(measurements: DataFrame, metrics: str, base: str, result: str) -> DataFrame:
    """The two latest runs of both states: at most four rows (chain, run_seq, age).

    Empty unless both states were measured at least twice. The runs are reduced to
    one row each before the window, so its groups are as long as the history.
    """
    runs = (
        measurements.where((F.col("metrics") == metrics) & F.col("chain").isin(base, result))
        .groupBy("chain", "run_seq")
        .agg(F.count(F.lit(1)).alias("rows"))
    )
    by_age = Window.partitionBy("chain").orderBy(F.col("run_seq").desc())
    recent = runs.withColumn("age", F.row_number().over(by_age)).where("age <= 2").select("chain", "run_seq", "age")
    # at most four rows, gathered to judge them together
    gathered = recent.agg(F.collect_list(F.struct("chain", "run_seq", "age")).alias("runs"))
    return gathered.where(F.size("runs") == 2 * len({base, result})).select(F.inline("runs"))


def monitor(
    measurements: DataFrame, metrics: str = "complete", base: str = "initial", result: str = "complete"
) -> DataFrame:
    """Per count and indicator, all rounded to three places:

    ``base_change``         last base run minus the one before
    ``improvement_before``  base minus result of the previous runs, negative is better
    ``improvement_last``    base minus result of the last runs
    ``improvement_change``  improvement before minus improvement last

    The numbers of the four compared runs come along, and their times if measured.
    """
    runs = latest_runs(measurements, metrics, base, result)
    recent = measurements.where(F.col("metrics") == metrics).join(F.broadcast(runs), ["chain", "run_seq"])

    named = ["run_seq", "time"] if "time" in measurements.columns else ["run_seq"]
    ages = {"base_{}_last": (base, 1), "base_{}_before": (base, 2), "result_{}_last": (result, 1), "result_{}_before": (result, 2)}

    def of_run(column: str, chain: str, age: int) -> Column:
        return F.max(F.when((F.col("chain") == chain) & (F.col("age") == age), F.col(column)))

    compared = {form.format(c): of_run(c, *at) for c in named for form, at in ages.items()}
    values = recent.groupBy("kind", "indicator").agg(
        *[column.alias(name) for name, column in compared.items()],
        of_run("value", base, 1).alias("base_last"),
        of_run("value", base, 2).alias("base_before"),
        of_run("value", result, 1).alias("result_last"),
        of_run("value", result, 2).alias("result_before"),
    )
    return values.select(
        "kind",
        "indicator",
        *compared,
        round3(F.col("base_last") - F.col("base_before")).alias("base_change"),
        round3(F.col("base_before") - F.col("result_before")).alias("improvement_before"),
        round3(F.col("base_last") - F.col("result_last")).alias("improvement_last"),
    ).withColumn("improvement_change", round3(F.col("improvement_before") - F.col("improvement_last")))


_NAMES = "metrics base_chain result_chain kind indicator".split()
_TIMES = "base_time_last base_time_before result_time_last result_time_before".split()
_NUMBERS = "base_run_seq_last base_run_seq_before result_run_seq_last result_run_seq_before".split()
_CHANGES = "base_change improvement_before improvement_last improvement_change".split()
MONITORED = T.StructType(
    [T.StructField(name, T.StringType()) for name in _NAMES + _TIMES]
    + [T.StructField(name, T.LongType()) for name in _NUMBERS]
    + [T.StructField(name, T.DoubleType()) for name in _CHANGES]
)


def append_monitoring(
    measurements: DataFrame, path: str, metrics: str = "complete", base: str = "initial", result: str = "complete"
) -> int:
    """Appends what changed between the compared runs, with their chains, numbers and times, as a run; returns its number."""
    changes = monitor(measurements, metrics, base, result)
    named = changes.select(F.lit(metrics).alias("metrics"), F.lit(base).alias("base_chain"), F.lit(result).alias("result_chain"), "*")
    return runs.append_run(named.select([F.col(f.name).cast(f.dataType) for f in MONITORED]), path)


def read_monitoring(spark: SparkSession, path: str) -> DataFrame:
    """All monitoring runs with their number as run_seq."""
    return runs.read_runs(spark, path, MONITORED)
