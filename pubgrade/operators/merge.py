"""Duplicate keys of works, and merging of duplicate works and persons."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.functions import text
from pubgrade.sources.scratch import cut_lineage


def add_duplicate_key(works: DataFrame, author_part: Column | None = None) -> DataFrame:
    """Adds ``key``: normalised title, date and author part, else the publication id.

    By default the author part is one ``#`` per author, so the number of authors
    counts and their ids do not. Where title, date and authors are all set but one
    of them is empty, the key is NULL.
    """
    title, date, authors = F.col("title"), F.col("date"), F.col("authors")
    if author_part is None:
        author_part = F.repeat(F.lit("#"), F.size(authors))
    complete = title.isNotNull() & date.isNotNull() & authors.isNotNull()
    usable = (title != "") & (date != "") & (F.size(authors) > 0)
    raw = F.when(complete & usable, F.concat(title, F.lit("#"), date, author_part))
    normalised = text.normalise(works.withColumn("key", raw), "key")
    return normalised.withColumn("key", F.when(complete, F.col("key")).otherwise(F.col("orcid_publication_id")))


def display_name(person: Column) -> Column:
    """``last, first`` from first and last name, else from other or published names."""

    def from_parts(name: Column) -> Column:
        parts = F.split(name, ",")
        words = F.split(name, " ")
        by_comma = F.concat(F.trim(F.get(parts, F.lit(0))), F.lit(", "), F.trim(F.element_at(parts, -1)))
        by_blank = F.concat(F.trim(F.element_at(words, -1)), F.lit(", "), F.trim(F.get(words, F.lit(0))))
        return F.when(F.size(parts) > 1, by_comma).otherwise(by_blank)

    both = F.when(
        person["firstName"].isNotNull() & person["lastName"].isNotNull(),
        F.concat(person["lastName"], F.lit(", "), person["firstName"]),
    )
    return F.coalesce(
        from_parts(F.coalesce(both, person["otherNames"], person["publishedName"])), F.lit("")
    )


def add_duplicate_key_with_names(works: DataFrame, persons: DataFrame, cut: Callable[[DataFrame, str], DataFrame] = cut_lineage) -> DataFrame:
    """Like ``add_duplicate_key``, but with the names of the authors in the key.

    Names are looked up once per distinct author list. The list is put together
    again per list, so one group never holds more than the authors of one work.
    Works without authors take no part in the join. The right sides of both joins are
    stored tables (``cut``) and not groupings, so the adaptive skew join can split
    a frequent author or author list.
    """
    names = merge_by_id(persons).select(
        F.col("id").alias("_author"),
        display_name(F.struct("firstName", "lastName", "otherNames", "publishedName")).alias("_name"),
    )
    names = cut(names.where("_author is not null"), "author-names")
    with_authors = F.coalesce(F.size("authors") > 0, F.lit(False))
    lists = works.select("authors").where(with_authors).distinct()
    parts = (
        lists.select("authors", F.posexplode("authors").alias("_position", "_author"))
        .join(names, "_author", "left")
        .groupBy("authors")
        .agg(F.sort_array(F.collect_list(F.struct("_position", F.coalesce("_name", F.lit("")).alias("_name")))).alias("_names"))
        .select("authors", F.concat(F.lit("#"), F.array_join("_names._name", "#")).alias("_part"))
    )
    joined = works.where(with_authors).join(cut(parts, "author-parts"), "authors", "left").select(*works.columns, "_part")
    alone = works.where(~with_authors).withColumn("_part", F.lit(None).cast("string"))
    return add_duplicate_key(joined.unionByName(alone), F.coalesce("_part", F.lit(""))).drop("_part")


def merge_works(works: DataFrame, null_key: str = "merge") -> DataFrame:
    """One row per key; every column takes its own maximum.

    The maxima are combined before the shuffle, so even a key shared by a third of
    all works arrives as one row per task. Works with a NULL key form one group,
    or stay as they are with ``null_key="keep"``. Groups go by the digest of the key,
    so titles are neither sorted nor moved for it.
    """
    keyed = add_duplicate_key(works).withColumn("key", F.sha2("key", 256))
    if null_key == "keep":
        merged = _max_per(keyed.where("key is not null"), "key", works.columns)
        return merged.unionByName(keyed.where("key is null").select(works.columns))
    return _max_per(keyed, "key", works.columns)


def merge_by_id(persons: DataFrame) -> DataFrame:
    rest = [column for column in persons.columns if column != "id"]
    return persons.groupBy("id").agg(*[F.max(column).alias(column) for column in rest]).select(persons.columns)


def merge_persons(persons: DataFrame, works: DataFrame) -> DataFrame:
    """One row per id, for persons that occur as author of a work.

    Grouping comes first: it combines before the shuffle, and its partitioning by
    id serves the join, so the persons move only once. The cited ids are distinct,
    which makes the inner join a semi join; written as a semi join, the optimizer
    would move it below the grouping and shuffle every single row of a frequent id.
    """
    cited = works.select(F.explode("authors").alias("id")).distinct()
    return merge_by_id(persons).join(cited, "id").select(persons.columns)


def _max_per(df: DataFrame, key: str, columns: list[str]) -> DataFrame:
    return df.groupBy(key).agg(*[F.max(column).alias(column) for column in columns]).select(columns)
