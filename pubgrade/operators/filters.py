"""Contradictions and incomplete records."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade.functions import affiliations


def is_minimal_work() -> Column:
    """A title and an address, URL or DOI."""
    return F.col("title").isNotNull() & (F.col("url").isNotNull() | F.col("doi").isNotNull())


def is_minimal_person() -> Column:
    """An id and any usable name."""
    full_name = F.col("firstName").isNotNull() & F.col("lastName").isNotNull()
    other_name = F.col("publishedName").isNotNull() | F.col("otherNames").isNotNull()
    return F.col("id").isNotNull() & (full_name | other_name)


def drop_contradicting_years(persons: DataFrame) -> DataFrame:
    """Affiliations that start after they end lose both years."""
    return persons.withColumn(
        "affiliations", affiliations.drop_contradicting_years(F.col("affiliations"))
    )


def keep_minimal_works(works: DataFrame) -> DataFrame:
    return works.where(is_minimal_work())


def keep_minimal_persons(persons: DataFrame) -> DataFrame:
    return persons.where(is_minimal_person())
