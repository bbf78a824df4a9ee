"""JSON and CSV sources into Parquet entities."""

import json

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pubgrade import schemas
from pubgrade.sources import states


DAMAGED = "_damaged"


def _split(df: DataFrame, schema: T.StructType, damaged: str) -> DataFrame:
    """Good rows, or with ``damaged="only"`` the text of the others as ``damaged``."""
    # Spark refuses to read nothing but the column of damaged records, so another one is always read too
    other = F.length(F.coalesce(F.col(f"`{df.columns[0]}`").cast("string"), F.lit(""))) >= 0
    if damaged == "only":
        return df.where(F.col(DAMAGED).isNotNull() & other).select(F.col(DAMAGED).alias("damaged"))
    return df.where(F.col(DAMAGED).isNull() & other).select([F.col(f"`{name}`") for name in schema.names])


def _with_damaged(reader: DataFrameReader, schema: T.StructType, damaged: str) -> DataFrameReader:
    if damaged not in ("drop", "only", "fail"):
        raise ValueError(f"damaged must be drop, only or fail, not {damaged}")
    reader = reader.schema(T.StructType([*schema, T.StructField(DAMAGED, T.StringType())]))
    return reader.option("columnNameOfCorruptRecord", DAMAGED).option("mode", "FAILFAST" if damaged == "fail" else "PERMISSIVE")


def read_json(spark: SparkSession, paths: str | list[str], schema: T.StructType, damaged: str = "drop") -> DataFrame:
    """JSON lines, plain or compressed; a list in a string field arrives as its JSON text.

    Lines that are no JSON objects are left out ("drop"), are all that is returned
    ("only") or raise ("fail").
    """
    return _split(_with_damaged(spark.read, schema, damaged).json(paths), schema, damaged)


def read_json_files(spark: SparkSession, paths: str | list[str], schema: T.StructType, damaged: str = "drop") -> DataFrame:
    """Like ``read_json`` for files that hold one document each."""
    return _split(_with_damaged(spark.read.option("multiLine", True), schema, damaged).json(paths), schema, damaged)


def read_csv(spark: SparkSession, paths: str | list[str], schema: T.StructType, damaged: str = "drop") -> DataFrame:
    """CSV with a header, all strings; columns are matched by their header names.

    Rows with fewer or more values than the header are damaged; see ``read_json``.
    """
    header = spark.read.option("header", True).csv(paths).schema
    reader = spark.read.option("header", True).option("columnPruning", False)  # else unread values are not counted
    df = _with_damaged(reader, header, damaged).csv(paths)
    return _split(df, schema, damaged)


def read_source(spark: SparkSession, paths: str | list[str], schema: T.StructType, damaged: str = "drop") -> DataFrame:
    first = paths if isinstance(paths, str) else paths[0]
    reader = read_csv if ".csv" in first else read_json
    return reader(spark, paths, schema, damaged)


def ingest(
    spark: SparkSession, sources: dict[str, str | list[str]], root: str, entity: str | None = None
) -> list[str]:
    """Writes every source, or only the given entity, to the initial state."""
    chosen = [name for name in sources if entity in (None, name)]
    for name in chosen:
        df = read_source(spark, sources[name], schemas.ENTITIES[name])
        save_schema(df, f"{root}/schemes/{name}")
        states.write_state(root, states.INITIAL, {name: df})
    return chosen


def save_schema(df: DataFrame, path: str) -> None:
    line = df.sparkSession.createDataFrame([(df.schema.json(),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(path)


def load_schema(spark: SparkSession, path: str) -> T.StructType:
    return T.StructType.fromJson(json.loads(spark.read.text(path).first()[0]))
