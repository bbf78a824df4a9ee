"""Documents that hold benchmark questions, also with other numbers, names or units.

Texts become templates: numbers, names (capitalised words inside a sentence) and
units after a number turn into typed placeholders, letters into lower case, and
closing punctuation goes. A template has exactly one word for each word of its text.
Windows of eight template words are hash-joined with those of the benchmark. Matches
of one document and item on one diagonal (equal distance of positions) belong
together; a document is contaminated by an item if one diagonal holds at least
``least`` windows, or half the windows of a short item, and if the slots agree: every
value of the item stands for one value in the document throughout.

What this template misses is searched for under two wider ones, by the same rules.
Both make one word of a number in digit groups (1 250) or in words (twenty five) and
know units in any case. ``folded`` has all other words in lower case, so it finds
items in other letter case; ``named`` takes every capitalised word for a name, the
first of a sentence too. A name that is changed in a text without capitals is not
recognised, and number words are English.

Items without any window under the plain template are searched for word by word, in
any case and without closing punctuation: those of fewer than eight words as a whole,
however short, the others by their windows. An item of a single word must be alone
on its line, since the word itself stands in many texts.

Most documents hold none of it, so templates are built for candidates only. Every
window searched for has a run of literal words, which a match must hold as they are: the
longest run of four, else two, else one of them is its anchor. A document is a candidate if
it holds an anchor, by a Bloom filter of all anchors first and by a join afterwards, with the
other literal words of the window at their places; nothing is lost by that. Only where a window
has no plain word at all, or the benchmark has more anchors than can be broadcast, are all
documents candidates.

Rows (``find_leaks``): doc_id, item_id, n_windows (of the best diagonal; under the
wider templates only where the plain one finds nothing), exact (all slot values
equal), one per pair. Null and empty texts have no windows. In a template, windows with
fewer than four words that are no placeholders are not searched for. Rows that repeat
an id are judged by their own text and reported once. Empty tables give no rows, other
columns are ignored here and kept by ``drop_leaks``. Everything is DataFrame expressions.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage, fresh_name

WINDOW, LITERALS = 8, 4
#: Windows that make a leak: thirteen words in a row.
LEAST = 6
#: A benchmark with more windows than this (16 bytes each) is joined by a shuffle instead of a broadcast.
BROADCAST_WINDOWS = 1_000_000

UNITS = (
    "km kilometers? kilometres? m meters? metres? cm mm miles? feet foot ft inch(?:es)? kg kilograms? g grams? mg lbs? pounds? ounces? oz "
    "l liters? litres? ml seconds? s minutes? min hours? h days? weeks? months? years? dollars? cents? euros? percent degrees?"
).split()

_BLANK = r"[\x20\x09-\x0D]+"
#: Patterns in the order in which they apply; names need two rounds, since a match takes the end of the word before it.
STEPS = [
    (r"[0-9]+(?:[.,:/][0-9]+)*", "<num>"),
    (r"[$€£¥]<num>", "<unit><num>"),
    (r"(<num> ?)(?:%|(?:" + "|".join(UNITS) + r")\b)", "$1<unit>"),
    (r"([\p{Ll}\p{N},;>] )\p{Lu}[\p{L}'-]*", "$1<name>"),
    (r"([\p{Ll}\p{N},;>] )\p{Lu}[\p{L}'-]*", "$1<name>"),
    (r"([\p{L}\p{N}>])[.,;:!?)]+([\x20\x09-\x0D]|$)", "$1$2"),
]

NUMBER_WORDS = (
    "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen "
    "twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million billion"
).split()
_NUMBER = r"\b(?:" + "|".join(NUMBER_WORDS) + r")\b"
#: Signs of number, unit and name in the wider templates, for private use; a text's own are taken for blanks.
NUM, UNIT, NAME = "\ue000", "\ue001", "\ue002"
SIGNS = NUM + UNIT + NAME
#: Makes one word of each number.
JOINS = [
    (r"(?<![0-9.,:/])([0-9]{1,3})[\x20\x{A0}\x{202F}](?=[0-9]{3}(?![0-9]))", "$1"),
    (rf"(?i)({_NUMBER}){_BLANK}(?:and{_BLANK})?(?={_NUMBER})", "$1-"),
]
_VALUES = [
    (rf"(?i)[0-9]+(?:[.,:/][0-9]+)*|{_NUMBER}(?:-{_NUMBER})*", NUM),
    (rf"[$€£¥]{NUM}", UNIT + NUM),
    (rf"(?i)({NUM} ?)(?:%|(?:" + "|".join(UNITS) + r")\b)", "$1" + UNIT),
]
_CLOSING = (rf"([\p{{L}}\p{{N}}{SIGNS}])[.,;:!?)]+(?=[\x20\x09-\x0D]|$)", "$1")
WIDER = {
    "folded": [*_VALUES, _CLOSING],
    "named": [*_VALUES, (r"(?<![\p{L}\p{N}'-])\p{Lu}[\p{L}'-]*", NAME), _CLOSING],
}


def _words(text: Column) -> Column:
    return F.filter(F.split(text, _BLANK), lambda w: w != "")


def template(text: Column) -> Column:
    return F.lower(_replaced(text, STEPS))


def _replaced(text: Column, steps: list[tuple[str, str]]) -> Column:
    for pattern, by in steps:
        text = F.regexp_replace(text, pattern, by)
    return text


def _windows(words: str) -> Column:
    n = F.size(words)
    hashes = F.transform(F.sequence(F.lit(1), n - WINDOW + 1), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    return F.when(n >= WINDOW, hashes).otherwise(F.array().cast("array<bigint>"))


def benchmark_windows(items: DataFrame) -> DataFrame:
    """hash, item_id, at, slotted (it has a placeholder), n (windows of the item searched for); a repeated window counts at its first place."""
    words = items.where("item_id is not null").select("item_id", _words(template(F.col("text"))).alias("words"))
    placed = words.select("item_id", "words", F.posexplode(_windows("words")).alias("at", "hash"))
    literals = F.size(F.filter(F.slice("words", F.col("at") + 1, WINDOW), lambda w: ~F.contains(w, F.lit("<"))))
    counted = placed.withColumn("literals", literals).where(F.col("literals") >= LITERALS)
    firsts = counted.groupBy("hash", "item_id").agg(F.min("at").alias("at"), F.max(F.col("literals") < WINDOW).alias("slotted"))
    counts = firsts.groupBy("item_id").agg(F.count("*").alias("n"))
    return firsts.join(counts, "item_id")


def _is_plain_slot(word: Column) -> Column:
    return F.contains(word, F.lit("<"))


def _agreeing(joined: DataFrame, is_slot: Callable[[Column], Column]) -> DataFrame:
    """Candidates with ``exact``, without those whose slots disagree; ``joined`` has their raw, words, i_raw and i_words."""
    # positions of the item, the same word of the document is ``diagonal`` further
    places = F.filter(
        F.sequence(F.col("low"), F.col("high") + WINDOW - 1),
        lambda p: is_slot(F.get("i_words", p)) & F.get("i_words", p).eqNullSafe(F.get("words", p + F.col("diagonal"))),
    )

    def value(word: Column) -> Column:
        return F.lower(F.regexp_replace(word, r"[.,;:!?)]+$", ""))

    slots = F.transform(
        places, lambda p: F.struct(value(F.get("i_raw", p)).alias("i"), value(F.get("raw", p + F.col("diagonal"))).alias("d"))
    )
    joined = joined.withColumn("slots", F.array_distinct(slots))
    values = F.array_distinct(F.transform("slots", lambda s: s["i"]))
    agreeing = joined.where(F.size(values) == F.size("slots"))
    return agreeing.select("doc_id", "key", "item_id", "n_windows", F.forall("slots", lambda s: s["i"].eqNullSafe(s["d"])).alias("exact"))


def _with_texts(candidates: DataFrame, docs: DataFrame) -> DataFrame:
    """``docs`` joined with its candidates."""
    own = candidates.withColumnsRenamed({"doc_id": "d", "key": "k"})
    return docs.join(own, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k"))).drop("d", "k")


def _lines(matches: DataFrame, least: int) -> DataFrame:
    """The diagonals with enough windows."""
    lines = matches.groupBy("doc_id", "key", "item_id", "kind", "n", "diagonal").agg(
        F.count("*").alias("n_windows"), F.min("at").alias("low"), F.max("at").alias("high"), F.max("slotted").alias("slotted")
    )
    return lines.where(F.col("n_windows") >= _needed(F.col("n"), least))


def _matches(placed: DataFrame, index: DataFrame, broadcast_windows: int) -> DataFrame:
    if index.count() <= broadcast_windows:
        index = F.broadcast(index)
    diagonal = (F.col("place") - F.col("at")).alias("diagonal")
    return placed.join(index, "hash").select("doc_id", "key", "item_id", "kind", "n", "at", "slotted", diagonal).distinct()


def _best(found: DataFrame) -> DataFrame:
    return found.groupBy("doc_id", "key", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("exact").alias("exact"))


#: Signs that keep a word out of anchors: there its form may depend on the template.
_ODD = rf"[.,;:!?)<>{SIGNS}]"
_ANCHOR_SIZES = (4, 2, 1)
#: Bits of the filter of anchors: half a megabyte, whatever the benchmark's size.
FILTER_BITS = 1 << 22


def _anchor(words: Column) -> Column:
    """Hash, size and place of the longest run of anchor size in an array of (w, plain, breaks), NULL without a plain word."""

    def runs(size: int) -> Column:
        starts = F.when(F.size(words) >= size, F.sequence(F.lit(0), F.size(words) - size)).otherwise(F.array().cast("array<int>"))
        whole = F.filter(starts, lambda i: F.forall(F.slice(words, i + 1, size), lambda w: w["plain"]))
        return F.transform(whole, lambda i: F.struct(F.length(F.array_join(F.transform(F.slice(words, i + 1, size), lambda w: w["w"]), "")).alias("n"), (-i).alias("at")))

    def hashed(size: int) -> Column:
        def of(best: Column) -> Column:
            words_of = [F.xxhash64(F.get(words, k - best["at"])["w"]) for k in range(size)]
            return F.when(best.isNotNull(), F.struct(_run_hash(words_of).alias("hash"), F.lit(size).alias("size"), (-best["at"]).alias("at"), best["n"].alias("n")))

        return _bound(F.array_max(runs(size)), of)

    return F.coalesce(*[hashed(size) for size in _ANCHOR_SIZES])


def _run_hash(hashes: list[Column]) -> Column:
    return hashes[0] if len(hashes) == 1 else F.xxhash64(_run_hash(hashes[: len(hashes) // 2]), _run_hash(hashes[len(hashes) // 2 :]))


def _anchored(windows: DataFrame, slot: Callable[[Column], Column], breaks: Callable[[Column], Column], least: int) -> DataFrame:
    """hash and size of the anchors of windows (item_id, ws), and others: distance and hash of the plain words that stand as far from the anchor in a text too.

    Words that ``breaks`` holds for may be several words of a text. As a leak has several of an item's
    windows, those with the poorest anchors are left out: as many as any leak must exceed.
    """
    words = F.transform("ws", lambda w: F.struct(w.alias("w"), (~slot(w) & ~F.rlike(w, F.lit(_ODD))).alias("plain"), breaks(w).alias("breaks")))
    found = cut_lineage(windows.distinct().select("item_id", words.alias("ws")).withColumn("a", _anchor(F.col("ws"))), "leak-runs")
    best = Window.partitionBy("item_id").orderBy(F.desc_nulls_last("a.size"), F.desc("a.n"), "a.hash")
    n = F.count("*").over(Window.partitionBy("item_id"))
    found = found.withColumn("n", n).withColumn("no", F.row_number().over(best)).where(F.col("no") <= F.col("n") - _needed(F.col("n"), least) + 1)

    def other(w: Column, i: Column) -> Column:
        low, high = F.least(i, F.col("a.at")), F.greatest(i, F.col("a.at"))
        joined = ~F.exists(F.slice("ws", low + 1, high - low + 1), lambda v: v["breaks"])
        return F.when(w["plain"] & joined, F.struct((i - F.col("a.at")).alias("off"), F.xxhash64(w["w"]).alias("h")))

    others = F.filter(F.transform("ws", other), lambda o: o.isNotNull())
    return found.select("a.hash", "a.size", F.when(F.col("a").isNotNull(), others).alias("others"))


def _needed(n: Column, least: int) -> Column:
    """Windows that make a leak of an item with ``n`` of them; a passage may lose a window at either end to the text around it."""
    return F.least(F.ceil(n / 2), F.lit(least))


def _slices(words: str, size: int | Column) -> Column:
    """All runs of ``size`` words."""
    n = F.size(words)
    starts = F.when(n >= size, F.sequence(F.lit(1), n - size + 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(starts, lambda i: F.slice(words, i, size))


def _anchors(items: DataFrame, least: int) -> DataFrame:
    """The anchors of the windows searched for; NULLs if one has none."""
    own = items.where("item_id is not null").select("item_id", "text")

    def never(w: Column) -> Column:
        return F.lit(False)

    def of_windows(words: DataFrame, kind: str, slot: Callable[[Column], Column], breaks: Callable[[Column], Column]) -> DataFrame:
        windows = words.select("item_id", F.explode(_slices(kind, WINDOW)).alias("ws"))
        return _anchored(windows.where(F.size(F.filter("ws", lambda w: ~slot(w))) >= LITERALS), slot, breaks, least)

    found = of_windows(own.select("item_id", _words(template(F.col("text"))).alias("plain")), "plain", _is_plain_slot, never)
    wider = _wider_words(own)
    for kind in WIDER:
        found = found.unionByName(of_windows(wider, kind, _is_slot, lambda w: F.contains(w, F.lit(NUM))))
    raw = _left_out(own).select("item_id", F.explode(_slices("raw", F.col("size"))).alias("ws"))
    return found.unionByName(_anchored(raw, never, never, least)).distinct()


def _filter_bits(hash_: Column) -> list[Column]:
    """The two bits of a hash in the filter."""
    return [F.pmod(hash_, F.lit(FILTER_BITS)), F.pmod(F.shiftright(hash_, 24), F.lit(FILTER_BITS))]


def _filter(anchors: DataFrame) -> Column:
    """A Bloom filter of the anchors as an array, 64 bits a number, that Spark looks up once.

    A scalar subquery on a stored row: a constant would stand in every plan, its text and each task
    as boxed numbers, once for every place that uses it.
    """
    bits = anchors.select(F.explode(F.array(*_filter_bits(F.col("hash")))).alias("bit"))
    own = bits.select(F.expr("bit div 64").alias("at"), F.expr("shiftleft(1L, cast(bit % 64 as int))").alias("bits"))
    none = anchors.sparkSession.range(FILTER_BITS // 64).select(F.col("id").alias("at"), F.lit(0).cast("long").alias("bits"))
    numbers = own.unionByName(none).groupBy("at").agg(F.bit_or("bits").alias("bits"))
    row = numbers.agg(F.transform(F.sort_array(F.collect_list(F.struct("at", "bits"))), lambda x: x["bits"]).alias("bits"))
    return cut_lineage(row, "leak-filter").scalar()


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _candidates(docs: DataFrame, items: DataFrame, least: int, broadcast_windows: int) -> DataFrame:
    """doc_id, key, text of the documents that hold an anchor with the plain words around it.

    A scan with the filter keeps the places of possible anchors with the words around
    them; only these are joined with the anchors themselves.
    """
    keyed = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    anchors = cut_lineage(_anchors(items, least), "leak-anchors")
    sizes = {row["size"]: row["n"] for row in anchors.groupBy("size").agg(F.count("*").alias("n")).collect()}
    if None in sizes or sum(sizes.values()) > broadcast_windows:
        return keyed
    if not sizes:
        return keyed.where("false")
    core = F.transform(_raw_words(F.translate("text", SIGNS, " " * len(SIGNS))), lambda w: F.xxhash64(w))

    def known(hash_: Column, bits: Column) -> Column:
        first, second = [F.getbit(F.get(bits, F.shiftright(bit, 6).cast("int")), bit.bitwiseAND(F.lit(63)).cast("int")) == 1 for bit in _filter_bits(hash_)]
        return first & second

    def pairs(h1: Column) -> Column:
        return F.zip_with(h1, F.slice(h1, 2, F.size(h1)), lambda x, y: F.xxhash64(x, y))

    def fours(h2: Column) -> Column:
        return F.zip_with(h2, F.slice(h2, 3, F.size(h2)), lambda x, y: F.xxhash64(x, y))

    def hits(h1: Column, runs: Column, size: int, bits: Column) -> Column:
        places = F.filter(F.transform(runs, lambda h, i: F.when(known(h, bits), i)), lambda i: i.isNotNull())

        def around(i: Column) -> Column:
            near = F.transform(F.sequence(F.lit(1 - WINDOW), F.lit(WINDOW - 1)), lambda d: F.get(h1, i + d))
            return F.struct(F.lit(size).alias("size"), F.get(runs, i).alias("hash"), near.alias("near"))

        return F.transform(places, around)

    def all_hits(h1: Column, bits: Column) -> Column:
        own = [] if 1 not in sizes else [hits(h1, h1, 1, bits)]
        if not {2, 4} & set(sizes):
            return F.concat(*own)

        def of_pairs(h2: Column) -> Column:
            more = [] if 2 not in sizes else [hits(h1, h2, 2, bits)]
            last = [] if 4 not in sizes else [_bound(fours(h2), lambda h4: hits(h1, h4, 4, bits))]
            return F.concat(*own, *more, *last)

        return _bound(pairs(h1), of_pairs)

    # one expression that computes each step once, and twice for the few documents that are kept
    hit = _bound(core, lambda h1: _bound(F.col("bits"), lambda bits: all_hits(h1, bits)))
    held = keyed.withColumn("bits", _filter(anchors)).withColumn("hits", hit).drop("bits").where(F.size("hits") > 0)
    held = cut_lineage(held, "leak-texts")
    placed = held.select("doc_id", "key", F.explode("hits").alias("hit")).select("doc_id", "key", "hit.*")
    found = placed.join(F.broadcast(anchors), ["hash", "size"])
    found = found.where(F.forall("others", lambda o: F.get("near", o["off"] + (WINDOW - 1)).eqNullSafe(o["h"])))
    found = cut_lineage(found.select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct(), "leak-hits")
    texts = held.select("doc_id", "key", "text")
    return cut_lineage(texts.join(found, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")), "left_semi"), "leak-candidates")


def _plain_leaks(docs: DataFrame, items: DataFrame, least: int, broadcast_windows: int) -> DataFrame:
    index = cut_lineage(benchmark_windows(items).withColumn("kind", F.lit("plain")), "benchmark-windows")
    words = docs.select("doc_id", "key", _words(template(F.col("text"))).alias("words"))
    placed = words.select("doc_id", "key", F.posexplode(_windows("words")).alias("place", "hash"))
    candidates = cut_lineage(_lines(_matches(placed, index, broadcast_windows), least), "leak-candidates")
    plain = candidates.where("not slotted").select("doc_id", "key", "item_id", "n_windows", F.lit(True).alias("exact"))
    texts = _with_texts(candidates.where("slotted"), docs.select("doc_id", "key", "text"))
    texts = texts.withColumns({"raw": _words(F.col("text")), "words": _words(template(F.col("text")))}).drop("text")
    item = items.select("item_id", _words(F.col("text")).alias("i_raw"), _words(template(F.col("text"))).alias("i_words"))
    return _best(plain.unionByName(_agreeing(texts.join(item, "item_id"), _is_plain_slot)))


def _wider_words(table: DataFrame) -> DataFrame:
    """``table`` with the words of its text (raw) and of the wider templates, the same number of each, instead of the text."""
    joined = table.withColumn("text", _replaced(F.translate("text", SIGNS, " " * len(SIGNS)), JOINS))
    wider = {kind: _words(F.lower(_replaced(F.col("text"), steps))) for kind, steps in WIDER.items()}
    return joined.withColumns({"raw": _words(F.col("text")), **wider}).drop("text")


def _is_slot(word: Column) -> Column:
    return F.rlike(word, F.lit(f"[{SIGNS}]"))


def _wider_windows(words: DataFrame, *keys: str) -> DataFrame:
    """keys, kind, place and hash of all windows under the wider templates."""

    def windows(kind: str) -> Column:
        hashed = F.transform(_slices(kind, WINDOW), lambda ws, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), F.xxhash64(F.lit(kind), ws).alias("hash")))
        return hashed

    hashed = words.select(*keys, *[F.transform(k, lambda w: F.xxhash64(w)).alias(k) for k in WIDER])
    return hashed.select(*keys, F.explode(F.concat(*[windows(k) for k in WIDER])).alias("w")).select(*keys, "w.*")


def _slot_counts(words: DataFrame) -> DataFrame:
    """item_id, kind, place and n_slots of the same windows."""

    def windows(kind: str) -> Column:
        return F.transform(_slices(kind, WINDOW), lambda ws, i: F.struct(F.lit(kind).alias("kind"), i.alias("place"), F.size(F.filter(ws, _is_slot)).alias("n_slots")))

    return words.select("item_id", F.explode(F.concat(*[windows(k) for k in WIDER])).alias("w")).select("item_id", "w.*")


def _wider_leaks(docs: DataFrame, items: DataFrame, known: DataFrame, least: int, broadcast_windows: int) -> DataFrame:
    """Leaks under the wider templates, without the pairs in ``known``."""
    item = _wider_words(items.where("item_id is not null").select("item_id", "text"))
    windows = _wider_windows(item, "item_id").join(_slot_counts(item), ["item_id", "kind", "place"]).where(F.col("n_slots") <= WINDOW - LITERALS)
    firsts = windows.groupBy("hash", "item_id", "kind").agg(F.min("place").alias("at"), F.max(F.col("n_slots") > 0).alias("slotted"))
    index = cut_lineage(firsts.join(firsts.groupBy("item_id", "kind").agg(F.count("*").alias("n")), ["item_id", "kind"]), "wider-windows")
    keyed = docs.select("doc_id", "key", "text")
    placed = _wider_windows(_wider_words(keyed), "doc_id", "key").select("doc_id", "key", "place", "hash")
    lines = _lines(_matches(placed, index, broadcast_windows), least)
    same = known.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("item_id").alias("i"))
    new = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("key") == F.col("k")) & (F.col("item_id") == F.col("i"))
    candidates = cut_lineage(lines.join(same, new, "left_anti"), "wider-candidates")
    plain = candidates.where("not slotted").select("doc_id", "key", "item_id", "n_windows", F.lit(True).alias("exact"))
    texts = _wider_words(_with_texts(candidates.where("slotted"), keyed))
    texts = texts.join(item.select("item_id", F.col("raw").alias("i_raw"), *[F.col(k).alias(f"i_{k}") for k in WIDER]), "item_id")
    for kind in WIDER:
        own = texts.where(F.col("kind") == kind).withColumns({"words": F.col(kind), "i_words": F.col(f"i_{kind}")})
        plain = plain.unionByName(_agreeing(own, _is_slot))
    return _best(plain)


def _raw_words(text: Column) -> Column:
    return _words(F.lower(_replaced(text, [_CLOSING])))


def _left_out(items: DataFrame) -> DataFrame:
    """item_id, raw (words), size (of a window) of the items that have no window under the plain template."""
    words = items.where("item_id is not null").select("item_id", _words(template(F.col("text"))).alias("words"), _raw_words(F.col("text")).alias("raw"))
    searched = F.exists(_slices("words", WINDOW), lambda ws: F.size(F.filter(ws, lambda w: ~_is_plain_slot(w))) >= LITERALS)
    return words.where((F.size("raw") > 0) & ~searched).select("item_id", "raw", F.least(F.size("raw"), F.lit(WINDOW)).alias("size"))


def _raw_windows(words: str, size: int) -> Column:
    return F.transform(_slices(words, size), lambda ws, i: F.struct(i.alias("place"), F.xxhash64(F.lit(size), ws).alias("hash")))


def _lone_words(text: Column) -> Column:
    """Windows of one word, for the lines that have one word only."""
    lines = F.transform(F.split(text, "\n"), _raw_words)
    lone = F.filter(lines, lambda ws: F.size(ws) == 1)
    return F.transform(lone, lambda ws: F.struct(F.lit(0).alias("place"), F.xxhash64(F.lit(1), ws).alias("hash")))


def _raw_leaks(docs: DataFrame, items: DataFrame, least: int, broadcast_windows: int) -> DataFrame | None:
    """Leaks of the items that have no window under the plain template, None without such items."""
    left_out = cut_lineage(_left_out(items), "unsearched-items")
    # at most one number per size comes to the driver
    sizes = sorted(row["size"] for row in left_out.select("size").distinct().collect())
    if not sizes:
        return None
    each = F.coalesce(*[F.when(F.col("size") == n, _raw_windows("raw", n)) for n in sizes])
    firsts = left_out.select("item_id", "size", F.explode(each).alias("w")).groupBy("w.hash", "item_id", "size").agg(F.min("w.place").alias("at"))
    counts = firsts.groupBy("item_id", "size").agg(F.when(F.col("size") < WINDOW, 1).otherwise(F.count("*")).cast("long").alias("n"))
    index = firsts.join(counts, ["item_id", "size"]).select("hash", "item_id", "at", "n", F.lit("raw").alias("kind"), F.lit(False).alias("slotted"))
    own = docs.select("doc_id", "key", "text", _raw_words(F.col("text")).alias("raw"))
    windows = F.concat(*[_lone_words(F.col("text")) if n == 1 else _raw_windows("raw", n) for n in sizes])
    placed = own.select("doc_id", "key", F.explode(windows).alias("w")).select("doc_id", "key", "w.*")
    lines = _lines(_matches(placed, cut_lineage(index, "raw-windows"), broadcast_windows), least)
    return lines.select("doc_id", "key", "item_id", "n_windows", F.lit(True).alias("exact"))


def _leaks(docs: DataFrame, items: DataFrame, least: int, broadcast_windows: int) -> DataFrame:
    """doc_id, key (hash of the text), item_id, n_windows, exact."""
    docs = _candidates(docs, items, least, broadcast_windows)
    plain = cut_lineage(_plain_leaks(docs, items, least, broadcast_windows), "plain-leaks")
    more = _wider_leaks(docs, items, plain, least, broadcast_windows)
    raw = _raw_leaks(docs, items, least, broadcast_windows)
    return plain.unionByName(more if raw is None else _best(more.unionByName(raw)))


def find_leaks(docs: DataFrame, items: DataFrame, least: int = LEAST, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    found = _leaks(docs, items, least, broadcast_windows)
    return found.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("exact").alias("exact"))


def drop_leaks(docs: DataFrame, items: DataFrame, least: int = LEAST, broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """The rows without any leak, all columns kept."""
    found = _leaks(docs, items, least, broadcast_windows).select(F.col("doc_id").alias("d"), F.col("key").alias("k")).distinct()
    key, d, k = (fresh_name(docs, name) for name in ("key", "d", "k"))
    found = cut_lineage(found.withColumnsRenamed({"d": d, "k": k}), "leaks")
    keyed = docs.withColumn(key, F.xxhash64("text"))
    return keyed.join(found, keyed["doc_id"].eqNullSafe(found[d]) & (keyed[key] == found[k]), "left_anti").drop(key)
