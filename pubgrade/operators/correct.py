"""Correction of single values; what cannot be corrected becomes NULL."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade import rules
from pubgrade.functions import affiliations, identifiers, text

PERSON_NAMES = ["firstName", "lastName", "otherNames", "publishedName"]


def null_short_values(df: DataFrame, entity: str) -> DataFrame:
    """Values below the minimum length of their field become NULL."""
    return df.withColumns(
        {
            field: F.when(F.length(field) >= length, F.col(field))
            for field, length in rules.MIN_LENGTHS[entity].items()
        }
    )


def correct_work_values(works: DataFrame) -> DataFrame:
    """Strips labels and noise first, then keeps what fits the pattern of its field.

    One projection per step, so every cleaned value is computed once and tested after.
    """

    def without_foreign(column: str) -> Column:
        return F.when(~text.has_foreign_alphabet(F.col(column)), F.col(column))

    stripped = works.withColumns(
        {
            "issn": identifiers.strip_issn(F.col("issn")),
            "isbn": identifiers.strip_isbn(F.col("isbn")),
            "url": identifiers.strip_url(F.col("url")),
            "doi": identifiers.strip_doi(F.col("doi")),
            "abstract": F.when(F.col("abstract").rlike(rules.FIVE_WORDS), F.col("abstract")),
            "title": without_foreign("title"),
            "subTitle": without_foreign("subTitle"),
        }
    )
    stripped = text.strip_noise(stripped, ["title", "subTitle"], ["abstract"])
    return stripped.withColumns(
        {
            "issn": F.when(F.col("issn").rlike(rules.ISSN), F.col("issn")),
            "isbn": F.when(F.col("isbn").rlike(rules.ISBN), F.col("isbn")),
            "url": F.when(identifiers.is_url(F.col("url")), F.col("url")),
            "doi": F.when(F.col("doi").rlike(rules.DOI), F.col("doi")),
            "abstract": without_foreign("abstract"),
            "title": F.when(F.col("title") != "", F.col("title")),
            "subTitle": F.when(F.col("subTitle") != "", F.col("subTitle")),
        }
    )


def correct_person_values(persons: DataFrame) -> DataFrame:
    stripped = persons.withColumns(
        {
            name: text.strip_name_remarks(F.when(~text.has_foreign_alphabet(F.col(name)), F.col(name)))
            for name in PERSON_NAMES
        }
    )
    return stripped.withColumns(
        {name: F.when(~F.col(name).rlike(rules.NAME_NOISE), F.col(name)) for name in PERSON_NAMES}
        | {"affiliations": affiliations.keep_valid_years(F.col("affiliations"))}
    )


def prefer_issn(works: DataFrame) -> DataFrame:
    """A work with an ISSN has no ISBN."""
    return works.withColumn("isbn", F.when(F.col("issn").isNull(), F.col("isbn")))
