"""Weighted scores of metrics and dimensions, and stored measurements."""

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubgrade import rules
from pubgrade.functions.rounding import round3
from pubgrade.plans import metrics as m
from pubgrade.sources import runs

# Correctness has a single metric, so it is that metric under another name
ALIASES = {"Correctness": "CorrectValue"}
ALL_DIMENSIONS = ["Completeness", "Correctness", "Consistency"]
ALL_METRICS = [*rules.WEIGHTS, *rules.DIMENSIONS, *ALIASES]

MEASUREMENT = T.StructType(
    [T.StructField(name, T.StringType()) for name in ("time", "metrics", "chain", "kind", "indicator")] + [T.StructField("value", T.DoubleType())]
)


def select_metrics(requested: list[str]) -> tuple[dict[str, list[str]], list[str]]:
    """Metrics to compute with the names they appear under, and dimensions to add.

    ``["complete"]`` stands for the three dimensions. Unknown names are ignored.
    """
    wanted = ALL_DIMENSIONS if requested[0] == "complete" else [name for name in ALL_METRICS if name in requested]
    dimensions = [name for name in wanted if name in rules.DIMENSIONS]
    names: dict[str, list[str]] = {}
    for metric in [metric for dimension in dimensions for metric in rules.DIMENSIONS[dimension]]:
        names.setdefault(metric, [metric])
    for name in wanted:
        if name not in rules.DIMENSIONS:
            shown_as = names.setdefault(ALIASES.get(name, name), [])
            if name not in shown_as:
                shown_as.append(name)
    return names, dimensions


def weighted_mean(items: Column) -> Column:
    """Mean of ``value`` by ``weight``, added up in the order of the array."""
    zero = F.lit(0.0)
    total = F.aggregate(items, zero, lambda acc, item: acc + item["value"] * item["weight"])
    return total / F.aggregate(items, zero, lambda acc, item: acc + item["weight"])


def metric_scores(indicators: DataFrame) -> DataFrame:
    """Score and ordered indicators per metric; the lists are as short as the rules."""
    items = F.sort_array(F.collect_list(F.struct("position", "indicator", "value", "weight")))
    return (
        indicators.groupBy("metric")
        .agg(items.alias("items"))
        .select("metric", weighted_mean(F.col("items")).alias("raw_score"), "items")
        .withColumn("score", round3(F.col("raw_score")))
    )


def _dimension_score(dimension: str) -> str:
    """SQL of the weighted mean of scores that are already rounded."""
    weights = rules.DIMENSIONS[dimension]
    total = " + ".join(f"scores['{metric}'] * {weight}D" for metric, weight in weights.items())
    return f"({total}) / {sum(weights.values())}D"


def scored_report(indicators: DataFrame, names: dict[str, list[str]], dimensions: list[str]) -> DataFrame:
    """(indicator, value): indicators, metric scores and dimension scores, rounded.

    All of it hangs on one grouping of the indicator rows, so nothing below is
    computed twice.
    """

    shown_as = ", ".join(f"'{metric}', array({', '.join(map(repr, aliases))})" for metric, aliases in names.items())
    dimension_rows = [
        f"array(struct('{dimension}' as indicator, {_dimension_score(dimension)} as value))" for dimension in dimensions
    ] + [
        f"array(struct('{dimension}.{metric}' as indicator, scores['{metric}'] as value))"
        for dimension in dimensions
        for metric in rules.DIMENSIONS[dimension]
    ]
    metric_rows = f"""
        flatten(transform(metrics, m -> flatten(transform(map({shown_as})[m.metric], name -> concat(
          array(struct(name as indicator, m.score as value)),
          transform(m.items, i -> struct(concat(name, '.', i.indicator) as indicator, i.value as value)))))))"""
    one_row = metric_scores(indicators).agg(F.collect_list(F.struct("metric", "score", "items")).alias("metrics"))
    return (
        one_row.withColumn("scores", F.expr("map_from_entries(transform(metrics, m -> struct(m.metric, m.score)))"))
        .select(F.expr(f"inline(concat({', '.join([metric_rows, *dimension_rows])}))"))
        .select("indicator", round3(F.col("value")).alias("value"))
    )


def analyze(
    entities: dict[str, DataFrame], requested: list[str] | None = None, as_of_year: int | None = None
) -> DataFrame:
    """Rounded report of the requested metrics or dimensions, by default of everything."""
    names, dimensions = select_metrics(requested or ["complete"])
    frame = m.indicators(entities, list(names), as_of_year or date.today().year)
    return scored_report(frame, names, dimensions)


def measurement_rows(
    entities: dict[str, DataFrame],
    chain: str,
    requested: list[str] | None = None,
    as_of_year: int | None = None,
    time: datetime | None = None,
) -> DataFrame:
    """One measurement in long form: entry counts and indicators."""
    requested = requested or ["complete"]
    counts = m.count_entries(entities).select(
        F.lit("count").alias("kind"), F.col("entity").alias("indicator"), F.col("rows").cast("double").alias("value")
    )
    report = analyze(entities, requested, as_of_year).select(F.lit("indicator").alias("kind"), "indicator", "value")
    return counts.unionByName(report).select(
        F.lit((time or datetime.now()).strftime("%d/%m/%Y %H:%M:%S")).alias("time"),
        F.lit(",".join(requested)).alias("metrics"),
        F.lit(chain).alias("chain"),
        "kind",
        "indicator",
        "value",
    )


def append_measurement(
    entities: dict[str, DataFrame],
    path: str,
    chain: str,
    requested: list[str] | None = None,
    as_of_year: int | None = None,
) -> int:
    """Appends a measurement as a run of its own to the table of all runs and returns its number."""
    return runs.append_run(measurement_rows(entities, chain, requested, as_of_year), path)


def read_measurements(spark: SparkSession, path: str) -> DataFrame:
    """All measurements with their number as run_seq; a missing table has none."""
    return runs.read_runs(spark, path, MEASUREMENT)
