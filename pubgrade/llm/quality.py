"""Quality rules with thresholds that follow the data.

Every document's measures go into a quantile sketch of its language and source. A
sketch is a table of counts per bucket: values below 64 have buckets of their own,
larger ones 32 buckets for each power of two (an error of at most 1/32). Sketches
merge by adding counts, so they are built map-side, do not depend on the order of
rows, and the sketches of a language or of everything are sums of the finer ones.
A document is rejected if a measure lies outside the fences
q25 - 3 (q75 - q25) - margin and q75 + 3 (q75 - q25) + margin of its group.

Rows (``judge_quality``): one per document; see the columns at ``measures``. Null and
empty texts have no words and fail the base rules. Null languages or sources form
a group together with empty ones. Groups with fewer than ``least`` documents that
pass the base rules use the thresholds of their language, then those of all.
Repeated ids or rows count each, other columns are ignored, an empty table gives no
rows. Everything is DataFrame expressions.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage

#: Measure: (margin below, margin above) in ten-thousandths; None: no fence on that side. Where the quartiles
#: of lines and repeats are zero, one repeated line of a short good document is a tenth of it and must pass.
MARGINS = {"symbols": (None, 100), "lines": (None, 2000), "repeats": (None, 2000), "length": (100, 100)}
#: Smallest group with thresholds of its own.
LEAST = 50
#: Rows of one language and source are dealt over so many tasks when thresholds come to them.
SPREAD = 32

_WINDOW = 8
_BLANK = r"[\x20\x09-\x0D]+"


def _windows(words: str) -> Column:
    """Hashes of all windows of eight words."""
    n = F.size(words)
    starts = F.sequence(F.lit(1), n - _WINDOW + 1)
    return F.when(n >= _WINDOW, F.transform(starts, lambda i: F.xxhash64(F.slice(words, i, _WINDOW)))).otherwise(F.array().cast("array<bigint>"))


def _covered(windows: str) -> tuple[Column, Column]:
    """The sorted windows, to be named pairs, and the words that repeated ones cover.

    Each repeated start adds the words that the one before has not covered.
    """
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    last = F.size(windows) - 1

    def twin(pair: Column, k: Column) -> Column:
        before = (k > 0) & (F.get("pairs", k - 1)["h"] == pair["h"])
        return before | ((k < last) & (F.get("pairs", k + 1)["h"] == pair["h"]))

    starts = F.array_sort(F.transform(F.filter("pairs", twin), lambda p: p["i"]))
    first = F.struct(F.lit(0).alias("end"), F.lit(0).alias("words"))

    def add(done: Column, i: Column) -> Column:
        end = i + _WINDOW
        return F.struct(end.alias("end"), (done["words"] + end - F.greatest(i, done["end"])).alias("words"))

    return pairs, F.aggregate(starts, first, add, lambda done: done["words"])


def measures(docs: DataFrame) -> DataFrame:
    """doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed and the sketched measures.

    symbols, lines and repeats are shares of the word characters, lines and words in
    ten thousandths; length is the mean word length in hundredths. Windows are
    compared by their 64-bit hashes, and only texts that hold a repeated one sort them.
    """
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split("text", "\n"), lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]")))
    words = F.filter(F.split("text", _BLANK), lambda w: w != "")
    df = docs.select("doc_id", F.coalesce("lang", F.lit("")).alias("lang"), F.coalesce("source", F.lit("")).alias("source"), text.alias("text"))
    df = df.select("doc_id", "lang", "source", "text", words.alias("words"), lines.alias("lines"))
    df = df.select(
        "doc_id",
        "lang",
        "source",
        F.size("words").cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.size("lines").cast("long").alias("n_lines"),
        F.size(F.array_distinct("lines")).cast("long").alias("n_lines_once"),
        _windows("words").alias("windows"),
    )
    pairs, covered = _covered("windows")
    repeated = F.size(F.array_distinct("windows")) < F.size("windows")
    df = df.withColumn("pairs", F.when(repeated, pairs)).withColumn("n_repeat_words", F.coalesce(covered.cast("long"), F.lit(0).cast("long")))

    def share(part: str, whole: str) -> Column:
        return F.expr(f"{part} * 10000 div greatest({whole}, 1)")

    df = df.withColumn("n_dup_lines", F.col("n_lines") - F.col("n_lines_once"))
    return df.select(
        "doc_id", "lang", "source", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        ((F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words"))).alias("base_failed"),
        share("n_symbols", "word_chars").alias("symbols"),
        share("n_dup_lines", "n_lines").alias("lines"),
        share("n_repeat_words", "n_words").alias("repeats"),
        F.expr("100 * word_chars div greatest(n_words, 1)").alias("length"),
    )


def bucket(value: Column) -> Column:
    """The smallest value of the value's bucket: its six leading bits."""
    drop = F.greatest(F.char_length(F.bin(value)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", value, drop), drop)


def sketches(measured: DataFrame) -> DataFrame:
    """lang, source, measure, bucket, n: over the documents that pass the base rules."""
    values = F.explode(F.array(*[F.struct(F.lit(m).alias("measure"), bucket(F.col(m)).alias("bucket")) for m in MARGINS])).alias("m")
    passed = measured.where("not base_failed").select("lang", "source", values)
    return passed.groupBy("lang", "source", "m.measure", "m.bucket").agg(F.count("*").alias("n"))


def _fences(sketch: DataFrame, *group: str) -> DataFrame:
    """group, docs, fences (a column low_ and high_ per measure)."""
    merged = sketch.groupBy(*group, "measure", "bucket").agg(F.sum("n").alias("n"))
    part = Window.partitionBy(*group, "measure")
    ranked = merged.withColumn("upto", F.sum("n").over(part.orderBy("bucket"))).withColumn("docs", F.sum("n").over(part))
    q25, q75 = (F.min(F.when(F.col("upto") * 4 >= F.col("docs") * k, F.col("bucket"))) for k in (1, 3))
    quartiles = ranked.groupBy(*group, "measure").agg(F.max("docs").alias("docs"), q25.alias("q25"), q75.alias("q75"))
    reach = 3 * (F.col("q75") - F.col("q25"))
    columns = [F.max("docs").alias("docs")]
    for m, (below, above) in MARGINS.items():
        own = F.col("measure") == m
        low = F.lit(None).cast("long") if below is None else F.max(F.when(own, F.col("q25") - reach - below))
        high = F.lit(None).cast("long") if above is None else F.max(F.when(own, F.col("q75") + reach + above))
        columns += [low.alias(f"low_{m}"), high.alias(f"high_{m}")]
    return quartiles.groupBy(*group).agg(*columns)


def thresholds(sketch: DataFrame, least: int = LEAST) -> DataFrame:
    """lang, source and the fences that hold for them."""
    names = [f"{side}_{m}" for m in MARGINS for side in ("low", "high")]
    own = _fences(sketch, "lang", "source")
    by_lang = _fences(sketch, "lang").select("lang", F.col("docs").alias("lang_docs"), F.struct(*names).alias("by_lang"))
    of_all = _fences(sketch.withColumn("every", F.lit(1)), "every").select("every", F.struct(*names).alias("of_all"))
    joined = own.join(by_lang, "lang").withColumn("every", F.lit(1)).join(of_all, "every")
    chosen = F.when(F.col("docs") >= least, F.struct(*names)).when(F.col("lang_docs") >= least, F.col("by_lang")).otherwise(F.col("of_all"))
    return joined.select("lang", "source", chosen.alias("fences"))


def judge_quality(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """Measures, ``base_failed`` and ``kept``. The text is read once; the measures are stored.

    Thresholds come to the documents by a join on language, source and a number drawn
    from the id, so a source with a third of all rows is dealt over many tasks.
    """
    measured = cut_lineage(measures(docs), "measures")
    limits = cut_lineage(thresholds(sketches(measured), least), "thresholds")
    limits = limits.withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))))
    salted = measured.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SPREAD)))
    joined = salted.join(limits, ["lang", "source", "salt"], "left")
    inside = F.lit(True)
    for m in MARGINS:
        low, high = F.col(f"fences.low_{m}"), F.col(f"fences.high_{m}")
        inside &= F.coalesce(F.col(m) >= low, F.lit(True)) & F.coalesce(F.col(m) <= high, F.lit(True))
    kept = ~F.col("base_failed") & inside
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"))
