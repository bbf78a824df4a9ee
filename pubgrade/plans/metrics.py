"""Quality indicators, compiled to one aggregation per entity.

Every indicator is a ratio of two aggregates. All ratios of an entity run in one
pass over its table; only distinct counts and the registry comparison need jobs
of their own. Each pass returns one row, which is turned into long form:
``(metric, position, indicator, weight, hits, base, value)``.
"""

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade import rules
from pubgrade.functions import affiliations, identifiers, text
from pubgrade.operators import filters, merge, registry


class Ratio(NamedTuple):
    metric: str
    indicator: str
    hits: Column
    base: Column
    inverse: bool = False  # 1 - hits / base


def _sum(value: Column) -> Column:
    return F.coalesce(F.sum(value), F.lit(0))


def _missing(domain: list[str], value: str) -> Column:
    """How many values of the domain do not occur.

    Every row contributes the bit of its value, so the whole domain is covered by
    a bitwise OR per 60 values and no distinct values are shuffled.
    """
    seen = []
    for chunk in (domain[i : i + 60] for i in range(0, len(domain), 60)):
        values = ", ".join(f"'{v}'" for v in chunk)
        position = f"cast(array_position(array({values}), {value}) as int)"
        seen.append(f"coalesce(bit_count(bit_or(if({position} > 0, shiftleft(1L, {position} - 1), 0L))), 0)")
    return F.expr(f"{len(domain)} - ({' + '.join(seen)})")


def _min_length(entity: str) -> list[Ratio]:
    return [
        Ratio("MinLength", f"{entity}.{field}", F.count_if(F.length(field) >= length), F.count(field))
        for field, length in rules.MIN_LENGTHS[entity].items()
    ]


def _not_null(entity: str, df: DataFrame) -> list[Ratio]:
    return [
        Ratio("NotNull", f"{entity}.{column}", F.count(F.col(f"`{column}`")), F.count(F.lit(1)))
        for column in df.columns
    ]


def _population(indicator: str, domain: list[str], value: str) -> Ratio:
    return Ratio("MinPopulation", indicator, _missing(domain, value), F.lit(len(domain)), inverse=True)


def _correct(indicator: str, value: Column, condition: Column) -> Ratio:
    return Ratio("CorrectValue", indicator, F.count_if(condition), F.count(value))


def _clean_text(value: Column) -> Column:
    return ~(
        value.rlike(rules.LINE_BREAKS) | text.has_foreign_alphabet(value) | text.has_noise(value)
    )


def _clean_name(value: Column) -> Column:
    return ~(value.rlike(rules.NAME_NOISE) | text.has_foreign_alphabet(value))


def population_years(as_of_year: int) -> list[str]:
    return [str(year) for year in range(rules.FIRST_POPULATION_YEAR, as_of_year + 1)]


def work_ratios(works: DataFrame, metric: str, as_of_year: int) -> list[Ratio]:
    """Ratios of one metric over works; empty for metrics that need other jobs."""
    match metric:
        case "MinLength":
            return _min_length("works")
        case "MinValue":
            full = F.length("date") == rules.FULL_DATE_LENGTH
            return [Ratio(metric, "works.date", F.count_if(full), F.count("date"))]
        case "NotNull":
            return _not_null("works", works)
        case "MinPopulation":
            return [
                _population("works.date", population_years(as_of_year), "substring(date, 1, 4)"),
                _population("works.type", rules.WORK_TYPES, "type"),
            ]
        case "MinObject":
            return [Ratio(metric, "works", F.count_if(filters.is_minimal_work()), F.count(F.lit(1)))]
        case "CorrectValue":
            return _correct_work_values(as_of_year)
        case "NoContradict":
            both, either = F.expr("isbn is not null and issn is not null"), F.expr("isbn is not null or issn is not null")
            other_type, typed = F.expr("isbn is not null and not contains(type, 'book')"), F.expr("isbn is not null and type is not null")
            return [
                Ratio(metric, "works.isbnXORissn", F.count_if(both), F.count_if(either), inverse=True),
                Ratio(metric, "works.isbnOnlyBook", F.count_if(other_type), F.count_if(typed), inverse=True),
            ]
    return []


def _correct_work_values(as_of_year: int) -> list[Ratio]:
    c = F.col
    patterns = {
        "bibtex": rules.BIBTEX,
        "orcid_id": rules.OWNER_ID,
        "orcid_publication_id": rules.PUBLICATION_ID,
        "doi": rules.DOI,
        "issn": rules.ISSN,
        "isbn": rules.ISBN,
    }
    abstract = c("abstract")
    clean_abstract = abstract.rlike(rules.FIVE_WORDS) & ~(
        abstract.rlike(rules.ABSTRACT_LABEL) | text.has_foreign_alphabet(abstract) | text.has_noise(abstract)
    )
    return [
        *[_correct(f"works.{field}", c(field), c(field).rlike(p)) for field, p in patterns.items()],
        _correct("works.date", c("date"), identifiers.is_date(c("date"), as_of_year)),
        _correct("works.url", c("url"), identifiers.is_url(c("url"))),
        _correct("works.abstract", abstract, clean_abstract),
        _correct("works.title", c("title"), _clean_text(c("title"))),
        _correct("works.subTitle", c("subTitle"), _clean_text(c("subTitle"))),
    ]


def person_ratios(persons: DataFrame, metric: str) -> list[Ratio]:
    """Ratios of one metric over persons."""
    entries = F.col("affiliations")
    match metric:
        case "MinLength":
            return _min_length("persons")
        case "NotNull":
            return _not_null("persons", persons)
        case "MinPopulation":
            return [_population("works.country", rules.COUNTRIES, "country")]
        case "MinObject":
            return [Ratio(metric, "persons", F.count_if(filters.is_minimal_person()), F.count(F.lit(1)))]
        case "CorrectValue":
            return _correct_person_values(entries)
        case "NoContradict":
            both = affiliations.count_entries(entries, lambda a: a["startYear"].isNotNull() & a["endYear"].isNotNull())
            in_order = affiliations.count_entries(entries, lambda a: a["startYear"] <= a["endYear"])
            return [Ratio(metric, "persons.affiliations.startBeforeEnd", _sum(in_order), _sum(both))]
    return []


def _correct_person_values(entries: Column) -> list[Ratio]:
    c = F.col

    def valid_year(field: str) -> Ratio:
        # every entry counts in the base, also without a year
        hits = affiliations.count_entries(entries, lambda a: a[field].rlike(rules.AFFILIATION_YEAR))
        return Ratio("CorrectValue", f"persons.affiliations.{field}", _sum(hits), _sum(affiliations.count_entries(entries)))

    return [
        _correct("persons.id", c("id"), c("id").rlike(rules.PERSON_ID)),
        _correct("persons.country", c("country"), c("country").rlike(rules.COUNTRY_CODE)),
        valid_year("startYear"),
        valid_year("endYear"),
        *[
            _correct(f"persons.{name}", c(name), _clean_name(c(name)))
            for name in ("firstName", "lastName", "publishedName", "otherNames")
        ],
    ]


def org_ratios(orgs: DataFrame, metric: str) -> list[Ratio]:
    return _not_null("orgUnits", orgs) if metric == "NotNull" else []


def fused_ratios(df: DataFrame, ratios: list[Ratio]) -> DataFrame:
    """All ratios of one table in one pass, in long form."""
    aggregates = [
        column.cast("bigint").alias(f"{kind}_{i}")
        for i, ratio in enumerate(ratios)
        for kind, column in (("hits", ratio.hits), ("base", ratio.base))
    ]
    entries = [_entry(r.metric, r.indicator, f"hits_{i}", f"base_{i}", r.inverse) for i, r in enumerate(ratios)]
    return df.agg(*aggregates).select(F.expr(f"inline(array({', '.join(entries)}))"))


def _entry(
    metric: str, indicator: str, hits: str = "hits", base: str = "base", inverse: bool = False, value: str | None = None
) -> str:
    """SQL of one row of the long form; a ratio without a base is 0."""
    weights = rules.WEIGHTS[metric]
    if indicator not in weights:
        raise ValueError(f"{metric} has no weight for {indicator}; known are {', '.join(weights)}")
    share = f"{hits} / nullif({base}, 0)"
    value = value or f"coalesce({'1 - ' if inverse else ''}{share}, 0D)"
    return (
        f"struct('{metric}' as metric, {list(weights).index(indicator)} as position, '{indicator}' as indicator,"
        f" {float(weights[indicator])}D as weight, {hits} as hits, {base} as base, {value} as value)"
    )


def _one_entry(one_row: DataFrame, metric: str, indicator: str, value: str | None = None) -> DataFrame:
    return one_row.select(F.expr(f"inline(array({_entry(metric, indicator, value=value)}))"))


def count_distinct(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, hits, base): distinct values and rows with a value, exactly.

    All columns go through one grouping of (column, value) pairs, so the table is
    read once and equal values are combined before the shuffle. A value goes by its
    SHA-256 digest, so long texts are not moved.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.sha2(c, 256).alias("value")) for c in columns]))
    groups = (
        df.select(pairs.alias("pair"))
        .select("pair.*")
        .where("value is not null")
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    return groups.groupBy("column").agg(F.count(F.lit(1)).alias("hits"), F.sum("n").alias("base"))


def unique_value_ratios(df: DataFrame, entity: str) -> DataFrame:
    indicators = [i for i in rules.WEIGHTS["UniqueValue"] if i.split(".")[0] == entity]
    counts = count_distinct(df, [i.split(".")[1] for i in indicators])
    # one row with a column pair per indicator, also where no value occurs at all
    picked = [
        _sum(F.when(F.col("column") == indicator.split(".")[1], F.col(kind))).alias(f"{kind}_{i}")
        for i, indicator in enumerate(indicators)
        for kind in ("hits", "base")
    ]
    entries = [_entry("UniqueValue", indicator, f"hits_{i}", f"base_{i}") for i, indicator in enumerate(indicators)]
    return counts.agg(*picked).select(F.expr(f"inline(array({', '.join(entries)}))"))


def array_elements(df: DataFrame, column: str, pattern: str) -> DataFrame:
    """Elements of an array column that match, and all elements, without exploding."""
    values = F.col(column)
    hits = F.size(F.filter(values, lambda value: value.rlike(pattern)))
    return df.where(values.isNotNull()).agg(
        _sum(hits).cast("bigint").alias("hits"), _sum(F.size(values)).cast("bigint").alias("base")
    )


def count_objects(works: DataFrame) -> DataFrame:
    """Distinct duplicate keys, the NULL key being one of them, and rows."""
    groups = merge.add_duplicate_key(works).groupBy(F.sha2("key", 256).alias("key")).agg(F.count(F.lit(1)).alias("n"))
    return groups.agg(F.count(F.lit(1)).alias("hits"), _sum(F.col("n")).alias("base"))


def org_name_ratio(entities: dict[str, DataFrame]) -> DataFrame:
    """Mean share of organisations whose name agrees with their registry, over all registries."""
    per_type = registry.count_name_mismatches(entities)
    shares = [
        F.coalesce(F.max(F.when(F.col("type") == t, 1 - F.col("mismatches") / F.col("orgs"))), F.lit(0.0))
        for t in rules.REGISTRIES
    ]
    total = reduce(lambda a, b: a + b, shares)
    one_row = per_type.where("orgs > 0").agg(
        _sum(F.col("mismatches")).alias("hits"),
        _sum(F.col("orgs")).alias("base"),
        (total / len(shares)).alias("share"),
    )
    return _one_entry(one_row, "CorrectValue", "orgUnits.name", value="share")


#: What a measurement consists of, and the entities that each part reads.
PARTS = {
    "works": ("works",),
    "persons": ("persons",),
    "orgUnits": ("orgUnits",),
    "registries": ("orgUnits", "ROR", "lei", "fundref"),
}


def part_indicators(part: str, entities: dict[str, DataFrame], metrics: list[str], as_of_year: int) -> DataFrame | None:
    """Indicators of one part in long form, not rounded; None if the metrics have none there."""
    if part == "registries":
        return org_name_ratio(entities) if "CorrectValue" in metrics else None
    df = entities[part]
    ratios_of = {"works": lambda df, metric: work_ratios(df, metric, as_of_year), "persons": person_ratios, "orgUnits": org_ratios}[part]
    ratios = [ratio for metric in metrics for ratio in ratios_of(df, metric)]
    frames = [fused_ratios(df, ratios)] if ratios else []
    if "UniqueValue" in metrics:
        frames.append(unique_value_ratios(df, part))
    if "UniqueObject" in metrics and part == "works":
        frames.append(_one_entry(count_objects(df), "UniqueObject", "works"))
    return reduce(DataFrame.unionByName, frames) if frames else None


def indicators(entities: dict[str, DataFrame], metrics: list[str], as_of_year: int) -> DataFrame:
    """Indicators of the given metrics in long form, not rounded."""
    frames = [part_indicators(part, entities, metrics, as_of_year) for part in PARTS]
    return reduce(DataFrame.unionByName, [frame for frame in frames if frame is not None])


#: Size of a distinct-count sketch as the logarithm of its buckets: some kilobytes, an error of about 1 %.
SKETCH_SIZE = 14


def distinct_sketches(df: DataFrame, columns: list[str]) -> DataFrame:
    """(column, sketch, base): what is needed to estimate distinct values, in one pass without a shuffle of values.

    Sketches of several tables, or of what was added to one, merge with ``merge_sketches``.
    """
    sketches = [F.struct(F.lit(c).alias("column"), F.hll_sketch_agg(c, SKETCH_SIZE).alias("sketch"), F.count(c).alias("base")) for c in columns]
    return df.agg(F.array(*sketches).alias("all")).select(F.inline("all"))


def merge_sketches(sketches: DataFrame) -> DataFrame:
    return sketches.groupBy("column").agg(F.hll_union_agg("sketch").alias("sketch"), F.sum("base").alias("base"))


def estimate_distinct(sketches: DataFrame) -> DataFrame:
    """(column, hits, base) as in ``count_distinct``, hits estimated."""
    return sketches.select("column", F.least(F.hll_sketch_estimate("sketch"), F.col("base")).alias("hits"), "base")


def missing_values(df: DataFrame, value: Column, domain: list[str]) -> DataFrame:
    """Values of the domain that do not occur.

    The big table is reduced to the domain before the anti join, so its right side
    never has more rows than the domain.
    """
    spark = df.sparkSession
    wanted = spark.createDataFrame([(v,) for v in domain], "value string")
    present = df.select(value.alias("value")).where(F.col("value").isin(domain)).distinct()
    return wanted.join(F.broadcast(present), "value", "left_anti")


def count_entries(entities: dict[str, DataFrame]) -> DataFrame:
    """Rows per entity; affiliations are the persons that have any."""
    persons = entities["persons"].agg(F.count(F.lit(1)).alias("persons"), F.count("affiliations").alias("affiliations"))
    frames = [
        persons.select(F.inline(F.array(*[F.struct(F.lit(n).alias("entity"), F.col(n).alias("rows")) for n in ("persons", "affiliations")])))
    ]
    for name in ("works", "orgUnits"):
        frames.append(entities[name].agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("entity"), "rows"))
    return reduce(DataFrame.unionByName, frames)
