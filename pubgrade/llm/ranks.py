"""Positions of rows in a global order, without one task that sees a whole group."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage

_INDEX_BITS = (1 << 33) - 1


def ranked(df: DataFrame, group: str, order: list[Column], name: str) -> DataFrame:
    """``df`` with ``pos`` (from 0, by ``order``) and ``total`` (rows) within each group; ``group`` has no nulls.

    The rows are dealt by ranges of (group, order) and numbered within their range;
    what a range adds to its groups is counted in a table of one row per range and
    group. Equal rows may stand in any order. A key that many rows share is split over
    ranges too, since the rows' own numbers come last in the order.
    """
    columns = df.columns
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    keys = [F.col(group), *order, F.col("_row")]
    spread = numbered.repartitionByRange(*keys).sortWithinPartitions(*keys)
    at = F.monotonically_increasing_id().bitwiseAND(F.lit(_INDEX_BITS))
    placed = cut_lineage(spread.select(*columns, F.spark_partition_id().alias("_part"), at.alias("_at")), name)
    runs = placed.groupBy(group, "_part").agg(F.min("_at").alias("_first"), F.count("*").alias("_n"))
    earlier = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    runs = runs.select(
        group,
        "_part",
        (F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")).alias("_shift"),
        F.sum("_n").over(Window.partitionBy(group)).alias("total"),
    )
    return placed.join(runs, [group, "_part"]).select(*columns, (F.col("_at") + F.col("_shift")).alias("pos"), "total")
