"""Flat works, persons and organisations from nested records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade import rules
from pubgrade.sources.records import owner_id, publication_id


def publication_date(date: Column) -> Column:
    """``year[-month[-day]]``: no date without a year, no day without a month."""
    day = F.when(date["month"].isNotNull(), date["day"])
    return F.when(date["year"].isNotNull(), F.concat_ws("-", date["year"], date["month"], day))


def citation_text(source: Column) -> Column:
    """Text of a citation in BibTeX notation or of unknown notation."""
    return F.when(source["type"].isNull() | (source["type"] == "bibtex"), source["value"])


def author_contributors(contributors: Column) -> Column:
    """Contributors with a name whose role is open or makes them authors."""
    return F.filter(
        contributors,
        lambda c: c["credit_name"].isNotNull() & (c["role"].isNull() | c["role"].isin(rules.AUTHOR_ROLES)),
    )


def external_id(ids: Column, id_type: str) -> Column:
    """The last id of a type, normalised where possible."""
    of_type = F.filter(ids, lambda i: (i["type"] == id_type) & i["value"].isNotNull())
    last = F.try_element_at(of_type, F.lit(-1))
    return F.coalesce(last["normalized"], last["value"])


def authors_with_ids(contributors: Column, work_id: Column) -> Column:
    """Array of (id, otherNames); authors without an id get the work id and their position."""

    def author(c: Column, position: Column) -> Column:
        own_id = F.concat(work_id, F.lit("_"), position.cast("string"))
        return F.struct(F.coalesce(c["orcid"], own_id).alias("id"), c["credit_name"].alias("otherNames"))

    authors = F.transform(author_contributors(contributors), author)
    return F.when(F.size(authors) > 0, authors)


def flatten_works(records: DataFrame) -> DataFrame:
    """Nested works -> works plus ``_authors`` (id, otherNames)."""
    with_ids = records.withColumn("orcid_publication_id", publication_id(F.col("path")))
    flat = with_ids.select(
        "abstract",
        citation_text(F.col("citation")).alias("bibtex"),
        publication_date(F.col("publication_date")).alias("date"),
        *[external_id(F.col("external_ids"), t).alias(t) for t in ("doi", "isbn", "issn")],
        "journal_title",
        owner_id(F.col("path")).alias("orcid_id"),
        "orcid_publication_id",
        "subTitle",
        "title",
        "type",
        "url",
        authors_with_ids(F.col("contributors"), F.col("orcid_publication_id")).alias("_authors"),
    )
    return flat.withColumn("authors", F.col("_authors.id"))


def work_authors(flat_works: DataFrame) -> DataFrame:
    """Persons named in works."""
    return flat_works.select(F.inline("_authors"))


def person_affiliations(persons: DataFrame) -> DataFrame:
    """Affiliations reduced to years, role and organisation id."""
    fields = [f for f in persons.schema["affiliations"].dataType.elementType.names if f not in ("orgName", "orgIDType")]
    return persons.withColumn(
        "affiliations", F.transform("affiliations", lambda a: F.struct(*[a[f].alias(f) for f in fields]))
    )


def isolate_organisations(persons: DataFrame) -> DataFrame:
    """One organisation per id; the id is the name where no id is known.

    Of several descriptions of an id the smallest (name, type) is taken, which
    does not depend on the order of the input.
    """
    found = persons.select(F.inline("affiliations")).select(
        F.coalesce("orgID", "orgName").alias("id"), F.struct(F.col("orgName").alias("name"), F.col("orgIDType").alias("type")).alias("org")
    )
    return found.where("id is not null").groupBy("id").agg(F.min("org").alias("org")).select("id", "org.name", "org.type")
