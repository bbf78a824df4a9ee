"""Phrases of two to four words whose words belong together, per language.

Texts are lower-cased (A-Z) and split into pieces and words. Words that occur at least
``least`` times get ids by falling frequency. A pair of neighbours is a cell of the square
of all ids, which is cut into tiles of 256 by 256 cells: a cell's code holds its tile above
its place in the tile. A tile with many cells is counted in an array that the place
addresses, with ``numpy.bincount``; the cells of all others are kept sorted, with their
counts (coordinate form). Frequent pairs get ids by frequency in turn, and neighbouring
pairs are three words, neighbouring triples four: the same step three times.

How it is dealt out. A task cuts its documents into chunks of one language and about
CHUNK_BYTES. A chunk keeps its words as a sequence of ids (-1 where a phrase cannot
go on) and its cells, counted; these are shuffled by buckets of tiles, which sum them up,
in a stream of rows sorted by bucket, so memory is bounded by one bucket.
A tile of frequent words gets a share of every chunk, so from an estimate of its size (by
Zipf's law) it is split by chunks over several buckets, whose sums are added afterwards. The ids of frequent pairs travel back the same way: bucket by
bucket to the cells of every chunk, then by chunk to the sequences. Nothing is
broadcast, no dictionary is held whole, and nothing is dropped.

Rows (``find_collocations``): lang, rank, phrase, a, l, r, n, score, the best ``top`` of each
language. Null texts are empty, null languages ``und``. Repeated rows count
each. An empty table gives no rows, other columns are ignored. A chunk is at least one text.
Ids of a level and language must stay below 2^31, else the query fails; a chunk knows its
words by 64-bit hashes, so two of its words are taken for one with a chance of about one in 10^9.
"""

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubgrade.llm import words
from pubgrade.llm.ranks import ranked
from pubgrade.llm.tables import cut_lineage

LEAST, TOP, WIDEST = 30, 2000, 4
#: Bytes of text of a chunk; a longer text is a chunk of its own.
CHUNK_BYTES = 8_000_000
#: Values in one row of a chunk, so that a batch of rows stays small.
PART = 4096
#: A tile has SIDE * SIDE cells.
SIDE, SIDE_BITS = 256, 8
TILE_BITS = 2 * SIDE_BITS
ID_BITS = 31
COLUMN_BITS = ID_BITS - SIDE_BITS
#: Cells from which a tile is counted in an array of all its cells.
DENSE = 16_384
#: Places that fill a bucket of many tiles, and cells of chunks that fill one with a single tile.
BUCKET_WORDS, BUCKET_CELLS = 2_000_000, 64_000_000
#: By how much a tile may be larger than the estimate of its size.
MARGIN = 8

#: Blanks between words, and signs that end a piece.
ENDS = np.zeros(256, dtype=bool)
ENDS[list(b".,;:!?\n\x0b\x0c\r")] = True
GAPS = ENDS.copy()
GAPS[list(b" \t")] = True


def tile_codes(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    a, b = a.astype(np.int64), b.astype(np.int64)
    return (((a >> SIDE_BITS) << COLUMN_BITS | b >> SIDE_BITS) << TILE_BITS) | (a & (SIDE - 1)) << SIDE_BITS | b & (SIDE - 1)


def _first(code: Column) -> Column:
    tile = F.shiftright(code, COLUMN_BITS + TILE_BITS)
    return F.shiftleft(tile, SIDE_BITS).bitwiseOR(F.shiftright(code, SIDE_BITS).bitwiseAND(F.lit(SIDE - 1)))


def _second(code: Column) -> Column:
    tile = F.shiftright(code, TILE_BITS).bitwiseAND(F.lit((1 << COLUMN_BITS) - 1))
    return F.shiftleft(tile, SIDE_BITS).bitwiseOR(code.bitwiseAND(F.lit(SIDE - 1)))


def count_cells(codes: np.ndarray, counts: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes, sorted, with the sums of their counts (one each by default): the coordinate form."""
    order = np.argsort(codes, kind="stable")
    codes = codes[order]
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]])) if len(codes) else np.zeros(0, np.int64)
    if counts is None:
        return codes[starts], np.diff(np.append(starts, len(codes)))
    return codes[starts], np.add.reduceat(counts[order], starts) if len(codes) else counts


class Tiles:
    """Counts of cells, added in runs of sorted codes: arrays for full tiles, sorted codes for the others."""

    def __init__(self) -> None:
        self.dense: dict[int, np.ndarray] = {}
        self.sparse: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, codes: np.ndarray, counts: np.ndarray) -> None:
        tiles = codes >> TILE_BITS
        borders = np.flatnonzero(np.concatenate([[True], tiles[1:] != tiles[:-1], [True]]))
        rest = np.ones(len(codes), bool)
        for i in np.flatnonzero(np.diff(borders) >= DENSE):
            own = slice(borders[i], borders[i + 1])
            self._fill(int(tiles[own.start]), codes[own], counts[own])
            rest[own] = False
        self.sparse.append((codes[rest], counts[rest]))
        self.pending += len(self.sparse[-1][0])
        if self.pending > BUCKET_WORDS:
            self._merge()

    def _fill(self, tile: int, codes: np.ndarray, counts: np.ndarray) -> None:
        cells = np.bincount(codes & (SIDE * SIDE - 1), counts, SIDE * SIDE).astype(np.int64)
        self.dense[tile] = self.dense[tile] + cells if tile in self.dense else cells

    def _merge(self) -> None:
        self.sparse = [count_cells(*(np.concatenate(x) for x in zip(*self.sparse)))]
        self.pending = 0

    def cells(self) -> tuple[np.ndarray, np.ndarray]:
        for tile, counts in self.dense.items():
            places = np.flatnonzero(counts)
            self.sparse.append(((tile << TILE_BITS) | places, counts[places]))
        self.dense.clear()
        self._merge()
        return self.sparse[0]


class Buckets:
    """Which bucket a cell of a chunk goes to."""

    def __init__(self, n_words: int, n_chunks: int, at_least: int, cells: int):
        self.words, self.chunks, self.cells = n_words, n_chunks, cells
        self.number = max(at_least, -(-n_words // BUCKET_WORDS))

    def parts(self, tiles: np.ndarray) -> np.ndarray:
        """Buckets over which a tile is split, from its estimated size; a wrong estimate costs time only."""

        def share(strip: np.ndarray) -> np.ndarray:
            # words of rank r take about 1 / (r ln V) of all places, V of some hundred thousand
            return np.where(strip > 0, 1 / np.maximum(strip, 1), 6) / 12

        most = MARGIN * self.words * share(tiles >> COLUMN_BITS) * share(tiles & ((1 << COLUMN_BITS) - 1))
        most = np.minimum(np.minimum(most, self.words), self.chunks * SIDE * SIDE)
        return np.maximum(np.ceil(most / self.cells), 1).astype(np.int64)

    def of(self, codes: np.ndarray, chunk: int) -> np.ndarray:
        tiles = codes >> TILE_BITS
        return (tiles % 2147483647 * 1_000_003 + chunk % self.parts(tiles)) % 2147483647 % self.number


# what tasks return: rows with null in the columns that they do not fill
_CHUNK = "chunk long, lang string, no int, seq binary, words array<string>, counts array<long>"
_STEP = "chunk long, lang string, no int, seq binary, bucket long, codes binary, counts binary"
_SUM = "bucket long, lang string, codes array<long>, counts array<long>"
_BACK = "chunk long, codes array<long>, ids array<long>"


def _rows(columns: dict[str, tuple[list, pa.DataType]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in columns.values()], names=list(columns))


def _chunks(size: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Chunks of a task's documents: sequences of the chunk's own word ids, and its words with their counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[pa.Array]] = {}
        sizes: dict[str, int] = {}
        number = TaskContext.get().partitionId() << 32
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            for k, lang in enumerate(langs.dictionary.to_pylist()):
                for texts in _pieces(batch.column(1).filter(pc.equal(langs.indices, k)).cast(pa.large_binary()), size):
                    held.setdefault(lang, []).append(texts)
                    sizes[lang] = sizes.get(lang, 0) + texts.nbytes
                    if sizes[lang] >= size:
                        yield from _chunk(number, lang, pa.concat_arrays(held.pop(lang)))
                        sizes[lang], number = 0, number + 1
        for lang, texts in held.items():
            yield from _chunk(number, lang, pa.concat_arrays(texts))
            number += 1

    return run


def _pieces(texts: pa.Array, size: int) -> Iterator[pa.Array]:
    """Slices of about ``size`` bytes."""
    for rows, *_ in words.steps(texts, size):
        yield pa.concat_arrays([texts.slice(rows.start, rows.stop - rows.start)])


def _chunk(number: int, lang: str, texts: pa.Array) -> Iterator[pa.RecordBatch]:
    parts, dictionary, size = [], {}, 0
    hashes, buffers = [], []
    for _, buffer, offsets in words.steps(texts):
        low = words.LOWER[buffer]
        starts, ends, firsts = words.spans(buffer, offsets, GAPS)
        pieces = np.cumsum(ENDS[buffer], dtype=np.int32)[starts] if len(starts) else np.zeros(0, np.int32)
        fresh = np.ones(len(starts), bool)
        fresh[1:] = pieces[1:] != pieces[:-1]
        fresh[firsts[:-1][firsts[:-1] < len(starts)]] = True
        own = words.hash_spans(low, starts, ends)
        known, where = np.unique(own, return_index=True)
        for h, i in zip(known.tolist(), where.tolist()):
            if h not in dictionary:
                dictionary[h] = low[starts[i] : ends[i]].tobytes()
        hashes.append(own)
        parts.append(fresh)
    if not dictionary:
        return
    every, places, counts = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
    order = np.argsort(-counts, kind="stable")
    ids = np.empty(len(every), np.int32)
    ids[order] = np.arange(len(every), dtype=np.int32)
    fresh = np.concatenate(parts)
    seq = np.full(len(fresh) + int(fresh.sum()), -1, np.int32)
    seq[np.arange(len(fresh)) + np.cumsum(fresh)] = ids[places]
    values = [dictionary[h].decode("utf-8", "replace") for h in every[order].tolist()]
    yield from _sequence_rows(number, lang, seq, {"words": pa.list_(pa.string()), "counts": pa.list_(pa.int64())})
    cuts = range(0, len(values), PART)
    yield _rows({
        "chunk": ([number] * len(cuts), pa.int64()),
        "lang": ([lang] * len(cuts), pa.string()),
        "no": ([k // PART for k in cuts], pa.int32()),
        "seq": ([None] * len(cuts), pa.binary()),
        "words": ([values[k : k + PART] for k in cuts], pa.list_(pa.string())),
        "counts": ([counts[order[k : k + PART]] for k in cuts], pa.list_(pa.int64())),
    })


def _sequence_rows(chunk: int, lang: str, seq: np.ndarray, empty: dict[str, pa.DataType]) -> Iterator[pa.RecordBatch]:
    parts = [seq[k : k + PART].tobytes() for k in range(0, len(seq), PART)]
    n = len(parts)
    columns = {"chunk": ([chunk] * n, pa.int64()), "lang": ([lang] * n, pa.string()), "no": (list(range(n)), pa.int32()), "seq": (parts, pa.binary())}
    yield _rows(columns | {name: ([None] * n, kind) for name, kind in empty.items()})


def _runs(batches: Iterator[pa.RecordBatch], *keys: str) -> Iterator[tuple[tuple, Iterator[pa.RecordBatch]]]:
    """Slices of sorted batches with one value of the keys each, as (key, slice); a key's slices follow one another."""
    for batch in batches:
        if not batch.num_rows:
            continue
        changed = np.zeros(batch.num_rows, bool)
        changed[0] = True
        for key in keys:
            values = batch.column(key).dictionary_encode().indices.to_numpy(zero_copy_only=False)
            changed[1:] |= values[1:] != values[:-1]
        starts = np.append(np.flatnonzero(changed), batch.num_rows)
        for start, end in zip(starts[:-1].tolist(), starts[1:].tolist()):
            part = batch.slice(start, end - start)
            yield tuple(part.column(key)[0].as_py() for key in keys), part


def _numbers(values: pa.Array, kind: type = np.int64) -> np.ndarray:
    """The numbers of a column of lists or of binary values, strung together; nulls have none."""
    if pa.types.is_binary(values.type):
        return np.frombuffer(b"".join(v for v in values.to_pylist() if v is not None), kind)
    return values.flatten().to_numpy(zero_copy_only=False).astype(kind, copy=False)


def _advance(buckets: Buckets, level: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """From the ids of a level (rows of codes and ids, then the sequence, chunk by chunk) to the next sequence and its cells."""

    def finish(chunk: int, lang: str, codes: list, ids: list, seq: list) -> Iterator[pa.RecordBatch]:
        codes, ids, seq = np.concatenate(codes), np.concatenate(ids), np.concatenate(seq)
        if len(seq) < 2:
            return
        if level == 1:
            known = np.full(int(seq.max()) + 1, -1, np.int64)
            known[codes] = ids
            new = np.where(seq >= 0, known[seq], -1)
        else:
            order = np.argsort(codes)
            new = np.full(len(seq) - 1, -1, np.int64)
            pairs = np.flatnonzero((seq[:-1] >= 0) & (seq[1:] >= 0))
            if len(codes) and len(pairs):
                wanted = tile_codes(seq[pairs], seq[pairs + 1])
                at = np.minimum(np.searchsorted(codes, wanted, sorter=order), len(codes) - 1)
                new[pairs] = np.where(codes[order[at]] == wanted, ids[order[at]], -1)
        gap = new < 0
        new = new[~(gap & np.concatenate([[True], gap[:-1]]))]
        if not len(new):
            return
        if level < WIDEST - 1:
            yield from _sequence_rows(chunk, lang, new.astype(np.int32), {"bucket": pa.int64(), "codes": pa.binary(), "counts": pa.binary()})
        pairs = np.flatnonzero((new[:-1] >= 0) & (new[1:] >= 0))
        cells, counts = count_cells(tile_codes(new[pairs], new[pairs + 1]))
        of = buckets.of(cells, chunk)
        order = np.argsort(of, kind="stable")
        cells, counts, of = cells[order], counts[order].astype(np.int32), of[order]
        starts = np.flatnonzero(np.concatenate([[True], of[1:] != of[:-1], [True]])) if len(of) else np.zeros(1, np.int64)
        spans = list(zip(starts[:-1].tolist(), starts[1:].tolist()))
        n = len(spans)
        yield _rows({
            "chunk": ([chunk] * n, pa.int64()),
            "lang": ([lang] * n, pa.string()),
            "no": ([None] * n, pa.int32()),
            "seq": ([None] * n, pa.binary()),
            "bucket": ([of[s] for s, _ in spans], pa.int64()),
            "codes": ([cells[s:e].tobytes() for s, e in spans], pa.binary()),
            "counts": ([counts[s:e].tobytes() for s, e in spans], pa.binary()),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, lang, codes, ids, seq = None, "", [], [], []
        for (chunk,), part in _runs(batches, "chunk"):
            if chunk != current:
                if seq:
                    yield from finish(current, lang, codes, ids, seq)
                current, codes, ids, seq = chunk, [], [], []
            codes.append(_numbers(part.column("codes")))
            ids.append(_numbers(part.column("ids")))
            own = part.filter(pc.is_valid(part.column("seq")))
            if own.num_rows:
                lang = own.column("lang")[0].as_py()
                seq.append(_numbers(own.column("seq"), np.int32))
        if seq:
            yield from finish(current, lang, codes, ids, seq)

    return run


def _sum_up(buckets: Buckets, least: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Counts of the cells of every bucket; those of tiles in one bucket only if frequent."""

    def finish(key: tuple[int, str], tiles: Tiles) -> pa.RecordBatch:
        codes, counts = tiles.cells()
        kept = (counts >= least) | (buckets.parts(codes >> TILE_BITS) > 1)
        codes, counts = codes[kept], counts[kept]
        cuts = range(0, len(codes), PART)
        return _rows({
            "bucket": ([key[0]] * len(cuts), pa.int64()),
            "lang": ([key[1]] * len(cuts), pa.string()),
            "codes": ([codes[k : k + PART] for k in cuts], pa.list_(pa.int64())),
            "counts": ([counts[k : k + PART] for k in cuts], pa.list_(pa.int64())),
        })

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current, tiles = None, Tiles()
        for key, part in _runs(batches, "bucket", "lang"):
            if key != current:
                if current:
                    yield finish(current, tiles)
                current, tiles = key, Tiles()
            for codes, counts in zip(part.column("codes").to_pylist(), part.column("counts").to_pylist()):
                tiles.add(np.frombuffer(codes, np.int64), np.frombuffer(counts, np.int32).astype(np.int64))
        if current:
            yield finish(current, tiles)

    return run


def _bring_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The ids of every chunk's frequent cells; of a bucket, the rows of frequent cells (chunk null) come first."""
    current, frequent, ids, known = None, [], [], None
    for key, part in _runs(batches, "bucket", "lang"):
        if key != current:
            current, frequent, ids, known = key, [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], None
        of_all = pc.is_null(part.column("chunk"))
        frequent.append(_numbers(part.filter(of_all).column("frequent")))
        ids.append(_numbers(part.filter(of_all).column("ids")))
        own = part.filter(pc.invert(of_all))
        if not own.num_rows:
            continue
        if known is None:
            known, numbers = np.concatenate(frequent), np.concatenate(ids)
            order = np.argsort(known)
            known, numbers = known[order], numbers[order]
        chunks, found, of = [], [], []
        for chunk, cells in zip(own.column("chunk").to_pylist(), own.column("codes").to_pylist()) if len(known) else ():
            cells = np.frombuffer(cells, np.int64)
            at = np.minimum(np.searchsorted(known, cells), len(known) - 1)
            hit = known[at] == cells
            if hit.any():
                chunks.append(chunk)
                found.append(cells[hit])
                of.append(numbers[at[hit]])
        if chunks:
            yield _rows({"chunk": (chunks, pa.int64()), "codes": (found, pa.list_(pa.int64())), "ids": (of, pa.list_(pa.int64()))})


def _with_ids(counted: DataFrame, order: Column, name: str) -> DataFrame:
    """``counted`` with ids by falling n, then ``order``, within each language."""
    placed = ranked(cut_lineage(counted, name), "lang", [F.desc("n"), order], f"{name}-order")
    held = F.when(F.col("pos") < 1 << ID_BITS, F.col("pos")).otherwise(F.raise_error(F.lit("more frequent phrases than ids")))
    return cut_lineage(placed.withColumn("id", held).drop("pos", "total"), f"{name}-ids")


def _next(back: DataFrame, sequences: DataFrame, buckets: Buckets, level: int) -> DataFrame:
    rows = back.unionByName(sequences, allowMissingColumns=True).repartition("chunk")
    return cut_lineage(rows.sortWithinPartitions("chunk", F.asc_nulls_first("no")).mapInArrow(_advance(buckets, level), _STEP), "phrase-steps")


def _frequent(cells: DataFrame, buckets: Buckets, least: int) -> DataFrame:
    """lang, code, n, buckets, id of the frequent cells."""
    sums = cells.select("bucket", "lang", "codes", "counts").repartition("bucket").sortWithinPartitions("bucket", "lang")
    sums = sums.mapInArrow(_sum_up(buckets, least), _SUM).select("bucket", "lang", F.explode(F.arrays_zip("codes", "counts")).alias("cell"))
    whole = sums.groupBy("lang", F.col("cell.codes").alias("code")).agg(F.sum("cell.counts").alias("n"), F.collect_set("bucket").alias("buckets"))
    return _with_ids(whole.where(F.col("n") >= least), F.col("code"), "phrase-cells")


def _back_to_chunks(cells: DataFrame, frequent: DataFrame) -> DataFrame:
    known = frequent.select(F.explode("buckets").alias("bucket"), "lang", F.array("code").alias("frequent"), F.array("id").alias("ids"))
    rows = known.unionByName(cells.select("bucket", "lang", "chunk", "codes"), allowMissingColumns=True).repartition("bucket")
    return rows.sortWithinPartitions("bucket", "lang", F.asc_nulls_first("chunk")).mapInArrow(_bring_back, _BACK)


def _joined(cells: DataFrame, parts: DataFrame) -> DataFrame:
    """The cells with their two parts as structs x and y."""
    cells = cells.select("lang", "id", "n", _first(F.col("code")).alias("first"), _second(F.col("code")).alias("second"))
    x = parts.select(F.col("lang").alias("_l"), F.col("id").alias("_i"), F.struct(*[c for c in parts.columns if c not in ("lang", "id")]).alias("x"))
    y = x.withColumnRenamed("x", "y")
    found = cells.join(x, (F.col("lang") == F.col("_l")) & (F.col("first") == F.col("_i"))).drop("_l", "_i")
    return found.join(y, (F.col("lang") == F.col("_l")) & (F.col("second") == F.col("_i"))).drop("_l", "_i")


def _phrases(tables: list[DataFrame]) -> list[DataFrame]:
    """Of two, three and four words: lang, id, n, phrase, last (word), heads and tails (counts of the first and last words up to the whole), first, second (ids of the parts)."""
    spelled = tables[0].select("lang", "id", "n", F.col("word").alias("phrase"), F.col("word").alias("last"), F.array("n").alias("heads"), F.array("n").alias("tails"))
    found = []
    for cells in tables[1:]:
        both = _joined(cells, spelled)
        whole = both.select(
            "lang",
            "id",
            "n",
            F.concat("x.phrase", F.lit(" "), "y.last").alias("phrase"),
            F.col("y.last").alias("last"),
            F.concat("x.heads", F.array("n")).alias("heads"),
            F.concat("y.tails", F.array("n")).alias("tails"),
            "first",
            "second",
        )
        found.append(cut_lineage(whole, "phrases"))
        spelled = found[-1].drop("first", "second")
    return found


def _scored(phrases: DataFrame, width: int, longer: DataFrame | None) -> DataFrame:
    """lang, phrase, a, l, r, score of the phrases that no longer one covers."""

    def cut(k: int) -> Column:
        left, right = F.get("heads", F.lit(k - 1)), F.get("tails", F.lit(width - k - 1))
        score = F.expr(f"cast(2000000 as decimal(18, 0)) * cast(n as decimal(20, 0)) div (heads[{k - 1}] + tails[{width - k - 1}])")
        return F.struct(score.alias("score"), F.lit(k).alias("k"), left.alias("l"), right.alias("r"))

    if longer is not None:
        parts = longer.select("lang", "n", F.explode(F.array("first", "second")).alias("id"))
        most = parts.groupBy("lang", "id").agg(F.max("n").alias("most"))
        phrases = phrases.join(most, ["lang", "id"], "left").where(F.coalesce(100 * F.col("most") < 80 * F.col("n"), F.lit(True)))
    cuts = F.array(*[cut(k) for k in range(1, width)])
    return phrases.withColumn("cut", F.array_min(cuts)).select("lang", "phrase", F.col("n").alias("a"), "cut.l", "cut.r", "cut.score")


def find_collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, chunk_bytes: int = CHUNK_BYTES, bucket_cells: int = BUCKET_CELLS) -> DataFrame:
    own = docs.select(F.coalesce("lang", F.lit("und")).alias("lang"), F.coalesce("text", F.lit("")).alias("text"))
    chunks = cut_lineage(own.mapInArrow(_chunks(chunk_bytes), _CHUNK), "phrase-chunks")
    listed = chunks.where("words is not null").select("chunk", "lang", "no", F.posexplode(F.arrays_zip("words", "counts")).alias("i", "w"))
    listed = listed.select("chunk", "lang", (F.col("no").cast("long") * PART + F.col("i")).alias("code"), F.col("w.words").alias("word"), F.col("w.counts").alias("n"))
    totals = listed.groupBy("lang").agg(F.sum("n").alias("n"))
    # two numbers
    n_words = totals.agg(F.sum("n")).first()[0] or 0
    n_chunks = chunks.where("words is not null and no = 0").count()
    buckets = Buckets(n_words, n_chunks, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), bucket_cells)
    spelled = _with_ids(listed.groupBy("lang", "word").agg(F.sum("n").alias("n")).where(F.col("n") >= least), F.col("word"), "phrase-words")
    pairs = listed.select("chunk", "lang", "code", "word").join(spelled.select("lang", "word", "id"), ["lang", "word"])
    packed = pairs.groupBy("chunk", F.expr(f"code div {PART}").alias("part")).agg(F.collect_list(F.struct("code", "id")).alias("pairs"))
    back = packed.select("chunk", F.col("pairs.code").alias("codes"), F.col("pairs.id").alias("ids"))
    tables, sequences = [spelled], chunks.where("seq is not null").select("chunk", "lang", "no", "seq")
    for level in range(1, WIDEST):
        step = _next(back, sequences, buckets, level)
        cells = step.where("bucket is not null")
        tables.append(_frequent(cells, buckets, least))
        if level < WIDEST - 1:
            back, sequences = _back_to_chunks(cells, tables[-1]), step.where("seq is not null").select("chunk", "lang", "no", "seq")
    phrases = _phrases(tables)
    scored = [_scored(p, k + 2, phrases[k + 1] if k + 1 < len(phrases) else None) for k, p in enumerate(phrases)]
    candidates = scored[0].unionByName(scored[1]).unionByName(scored[2])
    best = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranks = candidates.withColumn("rank", F.row_number().over(best).cast("long")).where(F.col("rank") <= top)
    return ranks.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")
