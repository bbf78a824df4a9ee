"""Organisation names against the registries their ids come from."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubgrade import rules


def registry_names(entities: dict[str, DataFrame]) -> DataFrame:
    """All registries as one table (type, id, name); types never overlap."""
    parts = [
        entities[entity].select(
            F.lit(org_type).alias("type"), F.col(f"`{id_column}`").alias("id"), F.col(name).alias("name")
        )
        for org_type, (entity, id_column, name) in rules.REGISTRIES.items()
    ]
    return reduce(DataFrame.unionByName, parts).where("id is not null")


def correct_org_names(entities: dict[str, DataFrame], duplicates: str = "multiply") -> DataFrame:
    """Takes the registry name where the registry has one.

    One equi-join on (type, id) instead of one join per registry. Several rows
    of a registry with one id multiply the organisation, or count as their smallest
    name with ``duplicates="first"``. Spark picks broadcast
    or sort-merge from the actual size of the registries; the id in the join key
    spreads untyped organisations.
    """
    orgs = entities["orgUnits"]
    names = registry_names(entities).withColumnRenamed("name", "registry_name")
    if duplicates not in ("multiply", "first"):
        raise ValueError(f"duplicates must be multiply or first, not {duplicates}")
    if duplicates == "first":
        names = names.groupBy("type", "id").agg(F.min("registry_name").alias("registry_name"))
    return (
        orgs.join(names, ["type", "id"], "left")
        .withColumn("name", F.coalesce("registry_name", "name"))
        .select(orgs.columns)
    )


def count_name_mismatches(entities: dict[str, DataFrame]) -> DataFrame:
    """Per registry type: organisations and pairs (organisation, registry row) that differ in name.

    Counted without building the pairs: per id, all pairs of named rows are
    (named organisations) * (named registry rows), and the equal ones are the
    same product per name. Both are plain aggregations with map-side combining,
    so an id shared by a third of the rows costs no more than any other.
    """
    orgs = entities["orgUnits"].where(F.col("type").isin(*rules.REGISTRIES))
    rows = orgs.select("type", "id", "name", F.lit(1).alias("orgs"), F.lit(0).alias("names")).unionByName(
        registry_names(entities).select("type", "id", "name", F.lit(0).alias("orgs"), F.lit(1).alias("names"))
    )
    per_name = rows.groupBy("type", "id", "name").agg(F.sum("orgs").alias("orgs"), F.sum("names").alias("names"))
    comparable = F.col("id").isNotNull() & F.col("name").isNotNull()
    per_id = per_name.groupBy("type", "id").agg(
        F.sum("orgs").alias("orgs"),
        F.sum(F.when(comparable, F.col("orgs")).otherwise(0)).alias("named_orgs"),
        F.sum(F.when(comparable, F.col("names")).otherwise(0)).alias("named_rows"),
        F.sum(F.when(comparable, F.col("orgs") * F.col("names")).otherwise(0)).alias("equal_pairs"),
    )
    return per_id.groupBy("type").agg(
        F.sum("orgs").alias("orgs"),
        F.sum(F.col("named_orgs") * F.col("named_rows") - F.col("equal_pairs")).alias("mismatches"),
    )
