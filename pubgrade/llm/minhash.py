"""Near duplicates by min-max hashing with exact confirmation.

Every document's set of word shingles is hashed under a number of permutations,
and both the minimum and the maximum under each permutation are kept: each of
them agrees between two sets with a probability equal to their similarity, so
half the hash evaluations give a signature of the same length. The signature is
cut into bands; documents that share a band are candidates, and every candidate
is confirmed on the full sets.

Rows (``link_near_duplicates``): one per document with doc_id, n_shingles,
component_id (smallest doc_id reachable over links), kept. Null and blank texts
have an empty set and are linked with nothing. Rows that repeat a doc_id with another
text have the component of their own text. A null doc_id cannot be named in a link: its row comes back
with a null component_id and is kept. An empty table gives no rows; other columns
of the input are ignored here and kept by ``drop_near_duplicates``.
"""

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pubgrade.llm import words
from pubgrade.llm.components import connected_components
from pubgrade.llm.tables import cut_lineage, fresh_name

#: Two sets of similarity 0.8 share none of 24 bands of 4 values with a chance of 3 in a million.
BANDS, ROWS = 24, 4
#: Members of a band that are compared pair by pair; those of larger bands are compared in blocks.
SMALL = 64
#: Shingles and documents in a block, and the number of documents up to which a shingle is rare there.
BLOCK, MEMBERS, RARE = 250_000, 1000, 8

_SEEDS = np.random.default_rng(20240229).integers(1, 1 << 63, (2, BANDS * ROWS // 2), dtype=np.uint64)


def _bands(runs: np.ndarray, firsts: np.ndarray) -> np.ndarray:
    """Band keys (documents x bands) of the non-empty sets in ``runs`` that begin at ``firsts``."""
    keys = np.empty((len(firsts), BANDS), np.uint64)
    for pair in range(BANDS // 2):
        low = np.full(len(firsts), 2 * pair + 1, np.uint64)
        high = low + np.uint64(1)
        for k in range(pair * ROWS, (pair + 1) * ROWS):
            h = (runs ^ _SEEDS[0, k]) * (_SEEDS[1, k] | np.uint64(1))
            h ^= h >> np.uint64(31)
            low = words.mix(low + np.minimum.reduceat(h, firsts))
            high = words.mix(high + np.maximum.reduceat(h, firsts))
        keys[:, 2 * pair], keys[:, 2 * pair + 1] = low, high
    return keys


def _sets(texts: pa.Array, size: int) -> Iterator[tuple[slice, list[np.ndarray]]]:
    for rows, buffer, offsets in words.steps(texts):
        hashes, firsts = words.word_hashes(buffer, offsets)
        yield rows, [words.shingles(hashes[a:b], size) for a, b in zip(firsts[:-1], firsts[1:])]


def _signer(size: int):
    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _sets(batch.column(1), size):
                sizes = np.array([len(s) for s in sets])
                filled = np.flatnonzero(sizes)
                lists: list[np.ndarray] = [np.zeros(0, np.uint64)] * len(sets)
                if len(filled):
                    runs = np.concatenate([sets[i] for i in filled])
                    firsts = np.concatenate([[0], np.cumsum(sizes[filled])[:-1]])
                    for i, keys in zip(filled, _bands(runs, firsts)):
                        lists[i] = keys
                digests = [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(rows.start, len(sets)),
                        pa.array(sizes, pa.int64()),
                        pa.array(digests, pa.binary()),
                        words.flat_lists(lists, pa.int64()),
                        batch.column(2).slice(rows.start, len(sets)),
                    ],
                    names=["doc_id", "n_shingles", "digest", "bands", "text_key"],
                )

    return sign


def _setter(size: int):
    def write_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, sets in _sets(batch.column(1), size):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(rows.start, len(sets)), words.flat_lists(sets, pa.int64())], names=["rep", "runs"]
                )

    return write_sets


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Pairs whose sets have 100 * intersection >= percent * union, as edges."""
    left = sets.select(F.col("rep").alias("u"), F.col("runs").alias("u_runs"))
    right = sets.select(F.col("rep").alias("v"), F.col("runs").alias("v_runs"))
    shared = F.size(F.array_intersect("u_runs", "v_runs")).cast("long")
    union = F.size("u_runs") + F.size("v_runs") - F.col("shared")
    joined = pairs.select("u", "v").distinct().join(left, "u").join(right, "v")
    return joined.withColumn("shared", shared).where(100 * F.col("shared") >= percent * union).select("u", "v")


def _fits(a: str, b: str, percent: int):
    """Sizes that still allow the similarity."""
    return 100 * F.least(a, b) >= percent * F.greatest(a, b)


def _compare(percent: int):
    def compare(rows: pa.Table) -> pa.Table:
        """Edges that join the documents of one or two blocks as their links do, at most one per document."""
        reps, lists = rows.column("rep").to_numpy(), rows.column("runs").combine_chunks()
        sizes = np.diff(lists.offsets.to_numpy()).astype(np.int64)
        n, runs = len(reps), lists.flatten().to_numpy()
        docs = np.repeat(np.arange(n), sizes)
        order = np.argsort(runs, kind="stable")
        runs, docs = runs[order], docs[order]
        first = np.flatnonzero(np.diff(runs, prepend=runs[0] - 1))
        counts = np.diff(np.append(first, len(runs)))
        shared = np.zeros((n, n), np.float32)
        # rare shingles: neighbours in the sorted order; frequent ones: a product of 0/1 matrices
        column = np.repeat(np.arange(len(first)), counts)
        rare = np.repeat(counts <= RARE, counts)
        for k in range(1, RARE):
            both = np.flatnonzero((column[k:] == column[:-k]) & rare[k:])
            np.add.at(shared, (docs[both], docs[both + k]), 1)
        shared += shared.T
        often, held = np.flatnonzero(counts > RARE), None
        for part in (often[a : a + 1024] for a in range(0, len(often), 1024)):
            at = np.flatnonzero(np.isin(column, part))
            held = np.zeros((n, len(part)), np.float32)
            held[docs[at], np.searchsorted(part, column[at])] = 1
            shared += held @ held.T
        linked, some = np.empty((n, n), bool), [slice(a, a + 256) for a in range(0, n, 256)]
        for rows_ in some:  # in strips, so that only one matrix of numbers is held
            linked[rows_] = 100 * shared[rows_] >= percent * (sizes[rows_, None] + sizes[None, :] - shared[rows_])
        del shared, held
        np.fill_diagonal(linked, True)
        root, before = np.arange(n), None
        while before is None or (root != before).any():
            before = root
            root = np.concatenate([np.where(linked[rows_], root, n).min(axis=1) for rows_ in some])
            root = root[root]
        moved = np.flatnonzero(root != np.arange(n))
        return pa.table({"u": reps[moved], "v": reps[root[moved]]}, pa.schema([("u", pa.int64()), ("v", pa.int64())]))

    return compare


def _compare_families(big: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Edges among the members of large bands, compared exactly in blocks.

    Members that share large bands form a family, a family is dealt into blocks of
    bounded total size, and every two blocks are compared in one task by a matrix
    product. Only a forest of the links found leaves the task, no pairs.
    """
    centres = big.groupBy("band").agg(F.min("rep").alias("v"))
    families = connected_components(big.select("band", F.col("rep").alias("u")).join(centres, "band").select("u", "v"))
    members = families.unionByName(families.select(F.col("component").alias("node"), "component")).distinct()
    members = cut_lineage(members.select(F.col("node").alias("rep"), F.col("component").alias("family")), "families")
    held = members.join(sets, "rep").select("family", "rep", "runs")
    held = cut_lineage(held, "family-sets")
    blocks = held.groupBy("family").agg(
        F.greatest(F.ceil(F.sum(F.size("runs")) / BLOCK), F.ceil(F.count("*") / MEMBERS)).cast("long").alias("blocks")
    )
    dealt = held.join(blocks, "family").withColumn("own", F.pmod(F.xxhash64("rep"), F.col("blocks")))
    other = F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1))
    dealt = dealt.select("family", "rep", "runs", "own", other.alias("other"))
    dealt = dealt.withColumn("i", F.least("own", "other")).withColumn("j", F.greatest("own", "other"))
    return dealt.groupBy("family", "i", "j").applyInArrow(_compare(percent), "u long, v long")


def _links(active: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """(node, component) of the representatives that share bands.

    First every band's members are compared with its smallest one (a star, not all
    pairs), which settles groups of copies of any size. Bands whose members then lie
    in different components are open: in small ones the members are compared with
    each other, members of large ones in blocks. So every two members of a band are
    compared, or known to be connected.
    """
    centres = cut_lineage(active.groupBy("band").agg(F.min_by(F.struct("rep", "size"), "rep").alias("c")), "centres")
    stars = active.join(centres, "band").where("rep > c.rep").where(_fits("size", "c.size", percent))
    edges = cut_lineage(_confirmed(stars.select(F.col("c.rep").alias("u"), F.col("rep").alias("v")), sets, percent), "star-links")
    found = connected_components(edges).select(F.col("node").alias("rep"), "component")
    known = cut_lineage(active.join(found, "rep", "left").withColumn("component", F.coalesce("component", "rep")), "known")
    ends = known.groupBy("band").agg(F.count("*").alias("n"), F.min("component").alias("low"), F.max("component").alias("high"))
    open_ = cut_lineage(known.join(cut_lineage(ends.where("low < high").select("band", "n"), "open-bands"), "band"), "open")

    small = open_.where(F.col("n") <= SMALL)
    other = small.select("band", F.col("rep").alias("v"), F.col("size").alias("v_size"), F.col("component").alias("v_component"))
    pairs = small.join(other, "band").where("rep < v and component <> v_component").where(_fits("size", "v_size", percent))
    links = _confirmed(pairs.select(F.col("rep").alias("u"), "v"), sets, percent)
    big = open_.where(F.col("n") > SMALL)
    if not big.isEmpty():
        links = links.unionByName(_compare_families(big, sets, percent))
    more = cut_lineage(links, "more-links")
    if more.isEmpty():
        return found.withColumnRenamed("rep", "node")
    return connected_components(edges.unionByName(more))


def link_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """One row per document with its component; see the module's text."""
    return _linked(docs, shingle, percent).drop("text_key")


def _linked(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """The rows of ``link_near_duplicates`` with text_key, a hash of the text.

    Exact copies (of the set) are grouped by a digest first and only their
    representative goes on, so copies never meet in pairs. Sets are kept for
    candidates only. Joins on a digest, band or representative that many rows share
    are between stored tables, which lets Spark split the hot side.
    """
    text = docs.select("doc_id", "text")
    signed = text.withColumn("text_key", F.xxhash64("text"))
    signed = signed.mapInArrow(_signer(shingle), "doc_id long, n_shingles long, digest binary, bands array<long>, text_key long")
    signed = cut_lineage(signed, "signatures")
    real = signed.where("n_shingles > 0 and doc_id is not null")
    reps = cut_lineage(real.groupBy("digest").agg(F.min("doc_id").alias("rep")), "representatives")
    members = cut_lineage(real.drop("bands").join(reps, "digest").select("doc_id", "n_shingles", "rep", "text_key"), "members")

    firsts = real.select(F.col("doc_id").alias("rep"), "digest", F.col("n_shingles").alias("size"), "bands").join(reps, ["digest", "rep"], "left_semi")
    banded = firsts.select("rep", "size", F.explode("bands").alias("band"))
    shared = banded.groupBy("band").agg(F.min("rep").alias("low"), F.max("rep").alias("high")).where("low < high").select("band")
    active = cut_lineage(banded.join(cut_lineage(shared, "shared-bands"), "band").distinct(), "active")
    wanted = cut_lineage(active.select(F.col("rep").alias("doc_id")).distinct(), "wanted")
    once = Window.partitionBy("doc_id", F.xxhash64("text")).orderBy("doc_id")
    chosen = text.join(wanted, "doc_id").withColumn("turn", F.row_number().over(once)).where("turn = 1").drop("turn")
    found = _links(active, cut_lineage(chosen.mapInArrow(_setter(shingle), "rep long, runs array<long>"), "sets"), percent)

    linked = members.join(found.withColumnRenamed("node", "rep"), "rep", "left").withColumn("component", F.coalesce("component", "rep"))
    linked = linked.select("doc_id", "n_shingles", F.col("component").alias("component_id"), "text_key")
    alone = signed.where("n_shingles = 0 or doc_id is null").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), "text_key")
    return linked.unionByName(alone).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def drop_near_duplicates(docs: DataFrame, shingle: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` without near duplicates, all columns kept.

    Of each component the document with the smallest doc_id stays; of the kept rows that
    repeat that id the one with the smallest text hash. Rows without doc_id stay.
    """
    kept = _linked(docs, shingle, percent).where("kept and doc_id is not null")
    d, key, turn = (fresh_name(docs, x) for x in ("d", "key", "turn"))
    kept = cut_lineage(kept.groupBy(F.col("doc_id").alias(d)).agg(F.min("text_key").alias(key)), "kept")
    chosen = docs.join(kept, (F.col("doc_id") == F.col(d)) & (F.xxhash64("text") == F.col(key)))
    chosen = chosen.withColumn(turn, F.row_number().over(Window.partitionBy("doc_id").orderBy(key)))
    chosen = chosen.where(F.col(turn) == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
    return chosen.unionByName(docs.where("doc_id is null"))
