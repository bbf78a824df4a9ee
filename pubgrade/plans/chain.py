"""The transformations by name, and their complete chain."""

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from pubgrade.operators import correct, enrich, filters, merge, parse, registry
from pubgrade.sources import states
from pubgrade.sources.scratch import cut_lineage, remove, store

Entities = dict[str, DataFrame]
Cut = Callable[[DataFrame, str], DataFrame]

# fixed values: order of the complete chain
FULL_CHAIN = [
    "ParseBibtex",
    "ParseValues",
    "CorrectOrgs",
    "CorrectMinLength",
    "CorrectValues",
    "CorrectContradict",
    "JoinCrossRef",
    "ParseValues",
    "CorrectMinLength",
    "CorrectValues",
    "CorrectContradict",
    "Merge",
    "FilterContradict",
    "FilterObjects",
]

# fixed values: composed transformations
STACKS = {
    "Parse": ["ParseBibtex", "ParseValues"],
    "Correct": ["CorrectOrgs", "CorrectMinLength", "CorrectValues", "CorrectContradict"],
    "Filter": ["FilterContradict", "FilterObjects"],
    "complete": FULL_CHAIN,
}


def _parse_bibtex(e: Entities, cut: Cut) -> Entities:
    # both results need the citations: they are parsed once and read twice
    cited = cut(parse.read_citations(e["works"]), "citations")
    return {
        "persons": parse.add_persons(e["persons"], cited),
        "works": parse.fill_works(cited).select(e["works"].columns),
    }


def _join_reference(e: Entities, cut: Cut) -> Entities:
    # both results need the join: it runs once and is read twice
    joined = cut(enrich.join_reference(e["works"], e["crossRef"]), "reference-join")
    return {
        "persons": enrich.add_reference_persons(e["persons"], joined),
        "works": joined.select(e["works"].columns),
    }


def _merge(e: Entities, cut: Cut) -> Entities:
    # the persons only need the authors column of the merged works
    works = cut(merge.merge_works(e["works"]), "merged-works")
    return {"works": works, "persons": merge.merge_persons(e["persons"], works)}


STEPS: dict[str, Callable[[Entities, Cut], Entities]] = {
    "ParseBibtex": _parse_bibtex,
    "ParseValues": lambda e, cut: {"works": parse.fill_works_from_labels(e["works"])},
    "CorrectOrgs": lambda e, cut: {"orgUnits": registry.correct_org_names(e)},
    "CorrectMinLength": lambda e, cut: {
        name: correct.null_short_values(e[name], name) for name in ("persons", "works")
    },
    "CorrectValues": lambda e, cut: {
        "works": correct.correct_work_values(e["works"]),
        "persons": correct.correct_person_values(e["persons"]),
    },
    "CorrectContradict": lambda e, cut: {"works": correct.prefer_issn(e["works"])},
    "JoinCrossRef": _join_reference,
    "Merge": _merge,
    "FilterContradict": lambda e, cut: {"persons": filters.drop_contradicting_years(e["persons"])},
    "FilterObjects": lambda e, cut: {
        "works": filters.keep_minimal_works(e["works"]),
        "persons": filters.keep_minimal_persons(e["persons"]),
    },
}


def transform(entities: Entities, transformation: str = "complete", cut: Cut = cut_lineage) -> Entities:
    """Runs a transformation and returns the entities it changed.

    ``cut`` stores tables that several results need, by default in the scratch
    folder. Citations, join and merge cut; all other steps stay lazy.
    """
    current, changed = dict(entities), {}
    for step in STACKS.get(transformation, [transformation]):
        result = STEPS[step](current, cut)
        current.update(result)
        changed.update(result)
    return changed


def keep_lazy(df: DataFrame, name: str) -> DataFrame:
    """For ``cut``: no stored copy, every result computes its own lineage."""
    return df


def run_transformation(
    spark: SparkSession, root: str, transformation: str = "complete", chain: str = states.INITIAL
) -> str:
    """Reads a state, transforms it, stores the changed entities as the next state.

    Tables that several results need lie below the root until the state is written.
    """
    scratch = f"{root}/.cuts-{uuid.uuid4().hex}"
    target = states.extend_chain(chain, transformation)
    try:
        entities = states.read_entities(spark, root, chain)
        changed = transform(entities, transformation, lambda df, name: store(df, f"{scratch}/{name}"))
        states.write_state(root, target, changed)
    finally:
        remove(spark, scratch)
    return target
