"""Samples of extreme values."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sample_extremes(df: DataFrame, attribute: str, n: int = 1000, descending: bool = False) -> DataFrame:
    """The first ``n`` non-empty values in the given order, with repetitions.

    A dotted attribute is a field of the entries of an array. Sorting with a limit
    keeps ``n`` rows per task and never sorts the whole table.
    """
    first, _, rest = attribute.partition(".")
    if rest:
        values = df.select(F.explode(first).alias("_entry")).select(F.col(f"_entry.{rest}").alias(attribute.split(".")[-1]))
    else:
        values = df.select(first)
    column = F.col(values.columns[0])
    return values.where(column != "").orderBy(column.desc() if descending else column.asc()).limit(n)
