"""Stored states of the entities: one folder per chain of transformations.

A chain is the dot-joined list of the steps applied so far, and a state holds
only the entities its last step changed. The others come from the longest prefix
of the chain that has them, at last from the initial state.

A small list of a state's entities is emptied before anything is written and
written last, so a state of which a part is missing is refused, not read.
"""

import json
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

from pubgrade import schemas

INITIAL = "initial"
_LIST = "entities.json"


def fallback_chains(chain: str) -> list[str]:
    steps = chain.split(".")
    prefixes = [".".join(steps[:n]) for n in range(len(steps), 0, -1)]
    return prefixes if INITIAL in prefixes else prefixes + [INITIAL]


def extend_chain(chain: str, step: str) -> str:
    return step if chain == INITIAL else f"{chain}.{step}"


def _read_or_none(read) -> DataFrame | None:
    try:
        return read()
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
    return None


def _write_list(spark: SparkSession, root: str, chain: str, names: list[str] | None) -> None:
    line = spark.createDataFrame([(json.dumps(names),)], "value string")
    line.coalesce(1).write.mode("overwrite").text(f"{root}/{chain}/{_LIST}")


def _read_list(spark: SparkSession, root: str, chain: str) -> tuple[bool, list[str]]:
    """Whether there is such a state, and its entities: none if it was not written completely."""
    lines = _read_or_none(lambda: spark.read.text(f"{root}/{chain}/{_LIST}"))
    return lines is not None, lines and json.loads(getattr(lines.first(), "value", "null")) or []


def stored_entities(spark: SparkSession, root: str, chain: str) -> list[str] | None:
    """Names of the entities of a state; None if there is no such state."""
    exists, names = _read_list(spark, root, chain)
    if exists and not names:
        raise ValueError(f"state {chain} in {root} was not written completely")
    return names or None


def write_state(root: str, chain: str, entities: dict[str, DataFrame]) -> None:
    """Writes a state, or adds entities to it or replaces them.

    All entities are written at the same time: small ones have few tasks, which
    would leave the cluster idle one after the other.
    """
    if not entities:
        raise ValueError("a state needs at least one entity")
    spark = next(iter(entities.values())).sparkSession
    _, names = _read_list(spark, root, chain)
    _write_list(spark, root, chain, None)

    def write(name: str) -> None:
        entities[name].write.mode("overwrite").parquet(f"{root}/{chain}/{name}")

    with ThreadPoolExecutor(len(entities)) as pool:
        list(pool.map(inheritable_thread_target(spark)(write), entities))
    _write_list(spark, root, chain, sorted({*names, *entities}))


def stored_chain(spark: SparkSession, root: str, chain: str, entity: str) -> str | None:
    """The state that holds the latest version of an entity; None if none does."""
    chains = fallback_chains(chain)
    stored = {candidate: stored_entities(spark, root, candidate) for candidate in chains}
    if chain != INITIAL and not any(stored[c] for c in chains if c != INITIAL):
        raise ValueError(f"no state of {chain} in {root}")
    return next((c for c in chains if entity in (stored[c] or [])), None)


def read_entity(spark: SparkSession, root: str, chain: str, entity: str) -> DataFrame | None:
    """The latest stored version of an entity.

    The schema is that of the files: the correction of affiliations changes the
    order of their fields, which later decides how two arrays compare.
    """
    found = stored_chain(spark, root, chain, entity)
    return None if found is None else spark.read.parquet(f"{root}/{found}/{entity}")


def read_entities(spark: SparkSession, root: str, chain: str = INITIAL) -> dict[str, DataFrame]:
    found = {name: read_entity(spark, root, chain, name) for name in schemas.ENTITIES}
    return {name: df for name, df in found.items() if df is not None}
