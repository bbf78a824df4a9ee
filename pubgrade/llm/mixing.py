"""Document rates with which the corpus meets target token shares of its domains.

A naive Bayes classifier over a few binned features of the text, fitted on the
labelled documents, gives every document a soft membership in the domains of the
labels. Some features are shape, the others are words: in one half of the labelled documents
every hashed word gets a log odds for each domain, by the documents that hold it; a document's
sums of those that are clear are binned, and what the bins mean is learned from the other half. Nonnegative rates are then fitted so that the expected tokens of each domain
(rate times tokens times membership, summed) come to the targets: least squares by
projected gradient with momentum, from rate one on. A document's steps depend on its
memberships alone, so documents with equal features form a cell; every iteration is
one Spark aggregation over the cells, and only one number per domain comes back.

By default the total is the largest for which no domain needs repetition; with ``whole`` it
is the one for which that domain stays as it is, and cells that most likely belong to it have
the rate one, so that none of its documents is lost to a draw or repeated. ``most`` bounds the rates: with one nothing
is repeated, and a domain with too few tokens stays below its target. A document is copied floor(rate) times and
once more with the chance of the rest, drawn by a hash of its id and text.

Rows (``fit_rates``): doc_id, n_tokens (words), one membership column per domain
(m_<domain>), rate, copies. Null and empty texts have no tokens and get the rate of
their cell. Labels with null fields are left out; an id labelled more than once counts
each time, as do repeated rows. Domains without a labelled document get the
membership of their prior alone, documents without a clear word share one bin; without any label or token all rates are one. Null
languages count as empty. Other columns are ignored here and kept by ``mix``. All
of it is DataFrame expressions.
"""

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage, fresh_name

ITERATIONS, SPREAD = 30, 32
#: Pseudo-documents behind every feature value.
PRIOR = 1.0
SHAPES = ("lang", "shape", "signs", "length")
#: Buckets of hashed words, so the table of their log odds is bounded (some MB).
WORD_BUCKETS = 1 << 18
#: A word counts if so many labelled documents hold it and its log odds is so far from zero.
LEAST_HELD, CLEAR = 5, 1.0
#: Borders of the bins of a document's sum of log odds.
BORDERS = (-6.0, -2.0, 2.0, 6.0)

#: Token shares of the domains of the labels.
TARGETS = {"good": 0.86, "poor": 0.05, "toxic": 0.09}


def label_domain() -> Column:
    return F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 1, "good").otherwise("poor")


def quality_domain() -> Column:
    return F.when(F.col("quality") == 1, "good").otherwise("poor")


def _draw() -> Column:
    """From 0 to 1, the same for rows of equal id and text."""
    return F.pmod(F.xxhash64("doc_id", "text", F.lit("mix")), F.lit(1 << 30)) / F.lit(float(1 << 30))


def features(docs: DataFrame) -> DataFrame:
    """row (a number of its own), doc_id, draw, n_tokens, the shape features as strings and held, the buckets of its distinct words."""
    text = F.coalesce("text", F.lit(""))
    words = F.filter(F.split(text, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    df = docs.select("doc_id", _draw().alias("draw"), F.coalesce("lang", F.lit("")).alias("lang"), text.alias("text"), words.alias("words"))
    bare = F.transform("words", lambda w: F.lower(F.rtrim(w, F.lit(".,;:!?"))))
    df = df.select(
        F.monotonically_increasing_id().alias("row"), "doc_id", "draw", "lang",
        F.size("words").cast("long").alias("n_tokens"),
        F.size(F.array_distinct("words")).alias("distinct"),
        F.char_length("text").alias("chars"),
        F.regexp_count("text", F.lit(r"[^\p{L}\p{N}\s]")).alias("marks"),
        F.array_distinct(F.transform(bare, lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_BUCKETS)).cast("int"))).alias("held"),
    )
    n = "greatest(n_tokens, 1)"
    return df.select(
        "row", "doc_id", "draw", "n_tokens", "held", "lang",
        F.expr(f"concat(least(length(bin(n_tokens)), 16), '/', 10 * distinct div {n})").alias("shape"),
        F.expr(f"cast(least(4 * marks div {n}, 16) as string)").alias("signs"),
        F.expr(f"cast(least(chars div {n}, 20) as string)").alias("length"),
    )


def word_features(own: DataFrame, labelled: DataFrame, domains: list[str]) -> DataFrame:
    """row and words, a text of one bin for each domain, of all documents; ``labelled`` has row, held and ``domain``."""
    counts = [F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(f"n{k}") for k, d in enumerate(domains)]
    # one number per domain comes to the driver
    total = [x or 0.0 for x in labelled.agg(*counts).first()]

    def odds(k: int) -> Column:
        others = sum((F.col(f"n{j}") for j in range(len(domains)) if j != k), F.lit(0.0))
        inside, outside = (F.col(f"n{k}") + 1) / (total[k] + 2), (others + 1) / (sum(total) - total[k] + 2)
        value = F.log(inside / outside)
        return F.when(F.abs(value) >= CLEAR, value).otherwise(0.0)

    by_word = labelled.select("domain", F.explode("held").alias("word")).groupBy("word").agg(*counts)
    held = sum((F.col(f"n{k}") for k in range(len(domains))), F.lit(0.0))
    known = by_word.where(held >= LEAST_HELD).select("word", F.array(*[odds(k) for k in range(len(domains))]).alias("odds"))
    known = cut_lineage(known.where(F.exists("odds", lambda x: x != 0)), "mix-words")
    found = own.select("row", F.explode("held").alias("word")).join(F.broadcast(known), "word")
    sums = found.groupBy("row").agg(*[F.sum(F.col("odds")[k]).alias(f"s{k}") for k in range(len(domains))])
    bins = [F.concat(*[(F.col(f"s{k}") > border).cast("int").cast("string") for border in BORDERS]) for k in range(len(domains))]
    return sums.select("row", F.concat_ws("/", *bins).alias("words"))


def memberships(cells: DataFrame, labelled: DataFrame, domains: list[str], names: tuple[str, ...] = SHAPES) -> DataFrame:
    """``cells`` with m, an array of one membership per domain; ``labelled`` has the features ``names`` and ``domain``."""
    known = labelled.where(F.col("domain").isin(domains))
    pairs = F.explode(F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).alias("value")) for f in names]))
    counts = [F.count(F.when(F.col("domain") == d, 1)).cast("double").alias(d) for d in domains]
    # one number per domain comes to the driver
    total = [row or 0.0 for row in known.agg(*counts).first()]
    by_value = known.select("domain", pairs.alias("p")).groupBy("p.feature", "p.value").agg(F.array(*counts).alias("n"))
    # a value's log likelihood under each domain, a prior document of its own spread over the values
    values = by_value.groupBy("feature").agg(F.count("*").alias("values"))
    likelihoods = [F.log((F.col("n")[k] + PRIOR) / (total[k] + PRIOR * F.col("values"))) for k in range(len(domains))]
    weighed = by_value.join(values, "feature").select("feature", "value", F.array(*likelihoods).alias("l"))
    held = cells.select("cell", pairs.alias("p")).select("cell", "p.feature", "p.value").join(weighed, ["feature", "value"])
    sums = held.groupBy("cell").agg(*[F.sum(F.col("l")[k]).alias(f"l{k}") for k in range(len(domains))])
    logs = F.array(*[F.coalesce(F.col(f"l{k}"), F.lit(0.0)) + math.log(total[k] + PRIOR) for k in range(len(domains))])
    joined = cells.join(sums, "cell", "left").withColumn("logs", logs)
    powers = joined.withColumn("logs", F.transform("logs", lambda x: F.exp(x - F.array_max("logs"))))
    whole = F.aggregate("logs", F.lit(0.0), lambda s, x: s + x)
    return powers.select(*cells.columns, F.transform("logs", lambda x: x / whole).alias("m"))


def _rate(steps: list[list[float]], domains: int, fixed: Column, most: float) -> Column:
    """The rate of a cell after the gradient steps so far, up to ``most``, and the point from which the next step goes; one for ``fixed`` cells."""
    start = F.struct(F.lit(1.0).alias("rate"), F.lit(1.0).alias("ahead"))
    if not steps:
        return start

    def move(state: Column, step: Column) -> Column:
        slope = sum((F.get("m", F.lit(k)) * F.get(step, F.lit(k)) for k in range(domains)), F.lit(0.0))
        rate = F.least(F.greatest(state["ahead"] - slope, F.lit(0.0)), F.lit(most))
        return F.struct(rate.alias("rate"), (rate + F.get(step, F.lit(domains)) * (rate - state["rate"])).alias("ahead"))

    return F.when(fixed, start).otherwise(F.aggregate(F.lit(steps), start, move))


def _fit(
    cells: DataFrame, targets: dict[str, float], whole: str | None, fixed: Column, budget: float | None, iterations: int, most: float
) -> list[list[float]]:
    """The gradient steps: one slope per domain and the momentum."""
    shares = [share / sum(targets.values()) for share in targets.values()]
    k = len(shares)

    def totals(rate: Column) -> list[float]:
        row = cells.withColumn("r", rate).agg(*[F.sum(F.col("r") * F.col("tokens") * F.get("m", F.lit(i))) for i in range(k)]).first()
        return [x or 0.0 for x in row]

    have = totals(F.lit(1.0))
    total = sum(have)
    if not total:
        return []
    able = {d: h / s for d, h, s in zip(targets, have, shares) if s > 0}
    wanted = budget if budget is not None else able.get(whole) or min(able.values(), default=total)
    steps: list[list[float]] = []
    for turn in range(iterations):
        now = totals(_rate(steps, k, fixed, most)["ahead"])
        # tokens are the metric of the rates, in which the Lipschitz constant is at most one
        slopes = [(n - s * wanted) / total for n, s in zip(now, shares)]
        if max(map(abs, slopes)) < 1e-5:
            break
        steps.append([*slopes, turn / (turn + 3)])
    return steps


def fit_rates(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: Column | None = None, whole: str | None = None,
    budget: float | None = None, iterations: int = ITERATIONS, most: float = math.inf,
) -> DataFrame:
    """One row per document; see the module's text. ``budget`` is the wanted number of tokens."""
    targets = targets or TARGETS
    domains, names = list(targets), (*SHAPES, "words")
    own = cut_lineage(features(docs), "mix-features")
    known = labels.where("doc_id is not null and quality is not null and toxic is not null")
    known = known.select("doc_id", (label_domain() if domain is None else domain).alias("domain")).where(F.col("domain").isin(domains))
    # both halves have documents of all kinds: the last bit of a hash of the id
    half = F.pmod(F.xxhash64("doc_id", F.lit("half")), F.lit(2))
    binned = word_features(own, own.join(known, "doc_id").where(half == 0), domains)
    own = own.drop("held").join(binned, "row", "left").withColumn("words", F.coalesce("words", F.lit("")))
    own = cut_lineage(own.withColumn("cell", F.to_json(F.array(*names))), "mix-documents")
    labelled = own.join(known, "doc_id")
    cells = own.groupBy("cell", *names).agg(F.sum("n_tokens").alias("tokens"))
    cells = memberships(cells, labelled.where(half == 1), domains, names)
    cells = cut_lineage(cells.select("cell", "tokens", "m"), "mix-cells")
    fixed = F.lit(False) if whole is None else F.get("m", F.lit(domains.index(whole))) >= F.array_max("m")
    rate = _rate(_fit(cells, targets, whole, fixed, budget, iterations, most), len(domains), fixed, most)["rate"]
    fitted = cells.select("cell", "m", rate.alias("rate"), F.explode(F.sequence(F.lit(0).cast("long"), F.lit(SPREAD - 1).cast("long"))).alias("salt"))
    salted = own.withColumn("salt", F.floor(F.col("draw") * SPREAD))
    joined = salted.join(cut_lineage(fitted, "mix-rates"), ["cell", "salt"])
    copies = F.floor("rate") + (F.col("draw") < F.col("rate") - F.floor("rate")).cast("long")
    return joined.select("doc_id", "n_tokens", *[F.col("m")[k].alias(f"m_{d}") for k, d in enumerate(domains)], "rate", copies.alias("copies"), "draw")


def mix(
    docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None, domain: Column | None = None, whole: str | None = None,
    most: float = math.inf,
) -> DataFrame:
    """``docs`` with each row as often as its copies say, all columns kept."""
    d, copies, draw, key = (fresh_name(docs, x) for x in ("d", "copies", "draw", "key"))
    rates = fit_rates(docs, labels, targets, domain, whole, most=most)
    # equal ids and texts have equal draws, so one of equal rows decides for all
    rates = rates.select(F.col("doc_id").alias(d), F.col("draw").alias(draw), F.col("copies").alias(copies)).distinct()
    drawn = docs.withColumn(key, _draw())
    joined = drawn.join(rates, drawn["doc_id"].eqNullSafe(rates[d]) & (drawn[key] == rates[draw])).where(F.col(copies) > 0)
    return joined.withColumn(copies, F.explode(F.sequence(F.lit(1).cast("long"), F.col(copies)))).select(*[F.col(f"`{c}`") for c in docs.columns])
