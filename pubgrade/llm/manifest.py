"""A Merkle manifest of a table of documents: leaves, roots and a proof for every row.

A leaf is the SHA-256 of a row's fields. The leaves of a source, ascending by doc_id,
are hashed in runs of 16 until one node remains, its subroot; the subroots, ascending
by source (null first), likewise give the root. All digests are lower-case hex.

The nodes of a level are dealt to aligned blocks of 256. A block keeps its level as one
string of 64 signs a node; fixed-width substrings of it are the runs, whose hashes,
strung together, are the next level. After two levels a block is one node, and the
blocks' nodes are the level of the next round. Sibling segments are what stands left and
right of a node in its run. They are read downwards: a block's path to the root is
found once, in the round above, and only the rows of the result carry it further.
So no text and no path is shuffled, and no row holds more than 256 nodes.

Rows (``prove``): doc_id, leaf, subroot, root, proof_sha256 (of all sibling segments, leaf
level first), folded_root (what the ``tampered`` leaf, else the leaf, folds to with these
segments), verified (it equals the root). Null fields count as ``-``. Rows with equal
doc_ids stand in the order of their leaves; rows with a null doc_id come first and are never
tampered with. An empty table gives no rows. Other columns are ignored. Everything is
DataFrame expressions.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.llm.ranks import ranked
from pubgrade.llm.tables import cut_lineage

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
WIDTH = 16
#: Nodes of a block: two levels of runs.
BLOCK = WIDTH * WIDTH
HEX = 64
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _hash(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf(fields: list[Column]) -> Column:
    parts = [F.coalesce(F.concat(F.octet_length(f).cast("string"), F.lit(":"), f), F.lit("-")) for f in (f.cast("string") for f in fields)]
    return _hash(F.concat(*parts))


def leaves(docs: DataFrame) -> DataFrame:
    """doc_id, tree (the source as a key that is never null and sorts null first), digest, tampered (null: untouched)."""
    text = F.translate("text", UPPER, LOWER)
    changed = leaf([text if f == "text" else F.col(f) for f in FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    return docs.select(
        "doc_id",
        F.coalesce(F.concat(F.lit("+"), "source"), F.lit("")).alias("tree"),
        leaf([F.col(f) for f in FIELDS]).alias("digest"),
        F.when(chosen, changed).alias("tampered"),
    )


def _segment(level: Column, first: Column, nodes: Column) -> Column:
    """``nodes`` digests of a level from node ``first`` on."""
    return F.substr(level, first * HEX + 1, nodes * HEX)


def _parents(level: Column) -> Column:
    runs = F.ceil(F.length(level) / (WIDTH * HEX)).cast("int")
    return F.array_join(F.transform(F.sequence(F.lit(0), runs - 1), lambda r: _hash(_segment(level, r * WIDTH, F.lit(WIDTH)))), "")


def _blocks(nodes: DataFrame, *own: str) -> DataFrame:
    """tree, block, total, nodes, level_0, level_1, depth (levels that the block climbs), top (its node after them)."""
    placed = F.struct("pos", "digest", *own)
    blocks = nodes.groupBy("tree", F.expr(f"pos div {BLOCK}").alias("block")).agg(F.max("total").alias("total"), F.array_sort(F.collect_list(placed)).alias("nodes"))
    blocks = blocks.withColumn("level_0", F.array_join(F.transform("nodes", lambda n: n["digest"]), ""))
    blocks = blocks.withColumn("depth", F.when(F.col("total") == 1, 0).when(F.col("total") <= WIDTH, 1).otherwise(2))
    blocks = blocks.withColumn("level_1", F.when(F.col("depth") > 0, _parents(F.col("level_0"))))
    top = F.when(F.col("depth") == 0, F.col("level_0")).when(F.col("depth") == 1, F.col("level_1")).otherwise(_parents(F.col("level_1")))
    return blocks.withColumn("top", top)


def _climb(nodes: DataFrame, name: str, *own: str) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round, from the leaves up, and tree, top."""
    largest = nodes.agg(F.max("total")).first()[0] or 1
    rounds = [cut_lineage(_blocks(nodes, *own), f"{name}-blocks")]
    while largest > BLOCK:
        largest = -(-largest // BLOCK)
        below = rounds[-1].select("tree", F.col("block").alias("pos"), F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"), F.col("top").alias("digest"))
        rounds.append(cut_lineage(_blocks(below), f"{name}-blocks"))
    return rounds, rounds[-1].select("tree", "top")


def _step(level: str, at: Column) -> Column:
    """The sibling segments of node ``at`` in its run."""
    start = at - at % WIDTH
    return F.struct(
        _segment(F.col(level), start, at % WIDTH).alias("left"),
        _segment(F.col(level), at + 1, start + (WIDTH - 1) - at).alias("right"),
    )


def _descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """The nodes of the first round with their path; ``tops`` has tree, path and whatever else a tree's nodes get."""
    more = [c for c in tops.columns if c not in ("tree", "path")]
    paths = tops.withColumn("block", F.lit(0).cast("long"))
    for blocks in reversed(rounds):
        nodes = blocks.join(paths, ["tree", "block"]).select("*", F.posexplode("nodes").alias("i", "node"))
        first, second = _step("level_0", F.col("i")), _step("level_1", F.floor(F.col("i") / WIDTH).cast("int"))
        steps = F.when(F.col("depth") == 2, F.array(first, second)).when(F.col("depth") == 1, F.array(first)).otherwise(F.array_repeat(first, 0))
        found = nodes.select("tree", F.concat(steps, "path").alias("path"), *more, "node.*")
        paths = found.withColumnRenamed("pos", "block")
    return paths


def prove(docs: DataFrame) -> DataFrame:
    nodes = ranked(cut_lineage(leaves(docs), "manifest-leaves"), "tree", [F.col("doc_id"), F.col("digest")], "manifest-order")
    rounds, subroots = _climb(nodes, "manifest", "doc_id", "tampered")
    # the trees' tops are the leaves of one more tree
    upper = ranked(subroots.select(F.lit("").alias("tree"), F.col("tree").alias("of"), F.col("top").alias("digest")), "tree", [F.col("of")], "manifest-subroots")
    upper_rounds, root = _climb(upper, "manifest-roots", "of")
    no_path = F.expr("cast(array() as array<struct<left: string, right: string>>)")
    subroots = _descend(upper_rounds, root.select("tree", no_path.alias("path"), F.col("top").alias("root")))
    subroots = cut_lineage(subroots.select(F.col("of").alias("tree"), "path", F.col("digest").alias("subroot"), "root"), "manifest-tops")
    found = _descend(rounds, subroots)
    siblings = F.array_join(F.transform("path", lambda s: F.concat(s["left"], s["right"])), "")
    folded = F.aggregate("path", F.coalesce("tampered", "digest"), lambda node, s: _hash(F.concat(s["left"], node, s["right"])))
    rows = found.select("doc_id", F.col("digest").alias("leaf"), "subroot", "root", _hash(siblings).alias("proof_sha256"), folded.alias("folded_root"))
    return rows.withColumn("verified", F.col("folded_root") == F.col("root"))
