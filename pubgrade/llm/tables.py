"""Intermediate tables and small frame helpers of the corpus operators."""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pubgrade.sources.scratch import cut_lineage, scratch_path

__all__ = ["cut_lineage", "fresh_name", "scratch_path", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fresh_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that the frame does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def own(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col(f"`{name}`")
