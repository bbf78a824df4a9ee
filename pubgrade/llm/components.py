"""Connected components of a graph given as edges, as Spark joins only."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage


#: Up to this many edges (a few megabytes) a graph is worked in one partition, which needs no shuffles.
ONE_PARTITION = 200_000


def _print_of(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, component): the smallest node reachable, for every node with an edge.

    ``edges`` has columns u and v. Large-star and small-star steps alternate until
    nothing changes: every node's edges are replaced by edges to its least
    neighbour, so the number of edges never grows and long chains halve in each
    round. Every step is written to the shared folder. Hot nodes arrive
    pre-aggregated at the minimum, and the join back is between two stored tables,
    whose hot side Spark can split.
    """
    edges = cut_lineage(edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    state = _print_of(edges)
    small = state[0] <= ONE_PARTITION

    def stored(df: DataFrame, name: str) -> DataFrame:
        df = cut_lineage(df, name)
        return df.coalesce(1) if small else df

    edges = edges.coalesce(1) if small else edges
    while True:
        both = stored(edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v"))), "both")
        least = stored(both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m")), "least")
        large = stored(both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        least = stored(large.groupBy("u").agg(F.min("v").alias("m")), "least")
        hung = large.join(least, "u")
        moved = hung.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(moved.unionByName(hung.select("u", F.col("m").alias("v"))).distinct(), "edges")
        before, state = state, _print_of(edges)
        if state == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("component"))
