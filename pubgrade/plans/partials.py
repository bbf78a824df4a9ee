"""Measurements of states that read only what the last step changed.

The indicators of every part of a measurement (``metrics.PARTS``) are stored under the versions
of the entities that the part reads. A version is the state that holds the entity and the
time it was written. A state shares the versions of entities that its steps left alone with the
states before it, so of a new state only the changed entities are scanned.
"""

import hashlib
from functools import reduce

from pyspark.sql import DataFrame, SparkSession

from pubgrade.plans import metrics as m
from pubgrade.plans import report
from pubgrade.sources import states
from pubgrade.sources.runs import file_system


def _version(spark: SparkSession, root: str, chain: str, entity: str) -> str:
    found = states.stored_chain(spark, root, chain, entity)
    if found is None:
        raise ValueError(f"no {entity} in {root}")
    place, fs = file_system(spark, f"{root}/{found}/{entity}/_SUCCESS")
    return f"{entity}={found}@{fs.getFileStatus(place).getModificationTime()}"


def _path(spark: SparkSession, root: str, chain: str, store: str, part: str, names: list[str], as_of_year: int) -> str:
    versions = [_version(spark, root, chain, entity) for entity in m.PARTS[part]]
    key = "|".join([root, part, *versions, *sorted(names), str(as_of_year)])
    return f"{store}/{part}-{hashlib.sha256(key.encode()).hexdigest()}"


def refresh(spark: SparkSession, root: str, chain: str, store: str, names: list[str], as_of_year: int) -> list[str]:
    """Stores the parts of a state's measurement that are not stored yet, and returns their names."""
    entities, computed = states.read_entities(spark, root, chain), []
    for part in m.PARTS:
        path = _path(spark, root, chain, store, part, names, as_of_year)
        place, fs = file_system(spark, f"{path}/_SUCCESS")
        frame = None if fs.exists(place) else m.part_indicators(part, entities, names, as_of_year)
        if frame is not None:
            frame.coalesce(1).write.mode("overwrite").parquet(path)
            computed.append(part)
    return computed


def indicators(spark: SparkSession, root: str, chain: str, store: str, names: list[str], as_of_year: int) -> DataFrame:
    """``metrics.indicators`` of a state, from stored parts; those missing are computed and stored first."""
    refresh(spark, root, chain, store, names, as_of_year)
    frames = []
    for part in m.PARTS:
        path = _path(spark, root, chain, store, part, names, as_of_year)
        place, fs = file_system(spark, f"{path}/_SUCCESS")
        if fs.exists(place):
            frames.append(spark.read.parquet(path))
    return reduce(DataFrame.unionByName, frames)


def analyze(spark: SparkSession, root: str, chain: str, store: str, as_of_year: int, requested: list[str] | None = None) -> DataFrame:
    """``report.analyze`` of a state, from stored parts."""
    names, dimensions = report.select_metrics(requested or ["complete"])
    return report.scored_report(indicators(spark, root, chain, store, list(names), as_of_year), names, dimensions)
