"""Intermediate tables in the shared folder of the cluster."""

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: dict[str, str] = {}


def use_local_scratch(spark: SparkSession) -> None:
    """Sets a folder of its own for a local session without one, as queries and tests run in.

    A no-op where ``spark.checkpoint.dir`` is set. Executors on other machines must
    see the folder, so a cluster without that setting is refused.
    """
    if not spark.conf.get("spark.checkpoint.dir", None) and spark.sparkContext.applicationId not in _own:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        _own[spark.sparkContext.applicationId] = tempfile.mkdtemp(prefix="pubgrade-")


def with_local_scratch(query):
    """A query (spark, sf_dir) that also runs in a local session without a shared folder."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        use_local_scratch(spark)
        return query(spark, sf_dir)

    return run


def scratch_root(spark: SparkSession) -> str:
    """The folder set as ``spark.checkpoint.dir``, or by ``use_local_scratch``."""
    configured = spark.conf.get("spark.checkpoint.dir", None) or _own.get(spark.sparkContext.applicationId)
    if not configured:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return configured.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def store(df: DataFrame, path: str) -> DataFrame:
    """Writes the table once and goes on from the copy.

    The copy survives lost executors, and later readers scan only the columns
    they need, unlike with a checkpoint of serialised rows.
    """
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame, name: str) -> DataFrame:
    """``store`` in the shared folder."""
    return store(df, scratch_path(df.sparkSession, name))


def remove(spark: SparkSession, path: str) -> None:
    """Deletes a stored table or folder wherever Spark can write one."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)
