"""Tables that grow by numbered runs, each of which is there whole or not at all.

A run is written to a folder of its own first. Then a file named by the next number is
created with the folder's name in it, which fails if another writer was faster and is
tried again with the number after. Readers see the folders that such a file names, so
half-written runs stay unseen and no two runs share a number.
"""

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_RUNS, _NUMBERS = "runs", "numbers"
RUN = "run_seq"


def file_system(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def _create_if_absent(spark: SparkSession, path: str, text: str) -> bool:
    """Creates a file with a short text unless there is one; of several writers one succeeds."""
    jvm = spark._jvm
    place, fs = file_system(spark, path)
    fs.mkdirs(place.getParent())
    try:
        if fs.getScheme() == "file":
            # Hadoop's local file system looks first and creates then; the operating system does both at once
            options = spark.sparkContext._gateway.new_array(jvm.java.nio.file.OpenOption, 2)
            options[0], options[1] = jvm.java.nio.file.StandardOpenOption.CREATE_NEW, jvm.java.nio.file.StandardOpenOption.WRITE
            jvm.java.nio.file.Files.write(jvm.java.nio.file.Path.of(fs.makeQualified(place).toUri()), bytearray(text, "utf-8"), options)
        else:
            out = fs.create(place, False)
            out.write(bytearray(text, "utf-8"))
            out.close()
    except Py4JJavaError as error:
        if "FileAlreadyExists" not in error.java_exception.getClass().getName():
            raise
        return False
    return True


def run_numbers(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the runs, ascending: one per append, from the names of files."""
    place, fs = file_system(spark, f"{path}/{_NUMBERS}")
    if not fs.exists(place):
        return []
    names = [status.getPath().getName() for status in fs.listStatus(place)]
    return sorted(int(name) for name in names if re.fullmatch("[0-9]+", name))


def append_run(rows: DataFrame, path: str) -> int:
    """Appends the rows (few, in one file) as a run and returns its number; numbers ascend, from 1."""
    spark, folder = rows.sparkSession, uuid.uuid4().hex
    rows.coalesce(1).write.parquet(f"{path}/{_RUNS}/{folder}")
    number = max(run_numbers(spark, path), default=0) + 1
    while not _create_if_absent(spark, f"{path}/{_NUMBERS}/{number:012d}", folder):
        number += 1
    return number


def read_runs(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The rows of all runs with their number as ``run_seq`` before the columns of ``schema``; a missing table has none."""
    if not run_numbers(spark, path):
        return spark.createDataFrame([], T.StructType([T.StructField(RUN, T.LongType()), *schema]))
    names = spark.read.text(f"{path}/{_NUMBERS}", wholetext=True)
    numbered = names.select(
        F.substring_index("_metadata.file_path", "/", -1).cast("long").alias(RUN), F.col("value").alias("_folder")
    )
    rows = spark.read.schema(schema).parquet(f"{path}/{_RUNS}/*")
    folder = F.element_at(F.split(F.col("_metadata.file_path"), "/"), -2)
    return rows.select("*", folder.alias("_folder")).join(numbered, "_folder").select(RUN, *schema.names)
