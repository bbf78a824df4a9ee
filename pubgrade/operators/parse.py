"""Fill gaps of works from their citation text and from neighbouring fields."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pubgrade import rules
from pubgrade.functions import citation, identifiers

# work column -> names of the citation fields that can fill it
CITATION_FIELDS = {
    "doi": ["doi"],
    "date": ["date", "year"],
    "journal_title": ["journal_title", "journal"],
    "abstract": ["abstract"],
    "issn": ["issn"],
    "isbn": ["isbn"],
    "url": ["url"],
    "subTitle": ["subtitle"],
    "title": ["title"],
}
# only names that are work columns as they stand
STRICT_CITATION_FIELDS = {
    column: [column] for column in CITATION_FIELDS if column != "subTitle"
}


AUTHOR_FIELDS = ["orcid-numbers", "author"]


def cited_authors(works: DataFrame, names: list[str] | None = None) -> DataFrame:
    """Works plus ``_fields`` (pairs of the citation) and ``_authors`` (id, otherNames).

    ``names`` are further citation fields to read.
    """
    fields = citation.citation_fields(F.col("bibtex"), AUTHOR_FIELDS + (names or []))
    authors = citation.split_authors(
        citation.field_value("_fields", *AUTHOR_FIELDS), F.col("orcid_publication_id")
    )
    return works.withColumn("_fields", fields).withColumn("_authors", authors)


def read_citations(works: DataFrame, strict_fields: bool = False) -> DataFrame:
    """Works with all that their citations hold, for both functions below: parsed once."""
    sources = STRICT_CITATION_FIELDS if strict_fields else CITATION_FIELDS
    return cited_authors(works, [name for names in sources.values() for name in names])


def fill_works_from_citations(works: DataFrame, strict_fields: bool = False) -> DataFrame:
    return fill_works(read_citations(works, strict_fields), strict_fields).select(works.columns)


def fill_works(cited: DataFrame, strict_fields: bool = False) -> DataFrame:
    """Works from ``read_citations`` with their gaps filled."""
    sources = STRICT_CITATION_FIELDS if strict_fields else CITATION_FIELDS
    filled = {
        column: F.coalesce(F.col(column), citation.field_value("_fields", *names))
        for column, names in sources.items()
    }
    filled["authors"] = F.coalesce(F.col("authors"), F.col("_authors.id"))
    return cited.withColumns(filled).drop("_fields", "_authors")


def add_cited_persons(persons: DataFrame, works: DataFrame) -> DataFrame:
    """Appends the authors of every readable citation."""
    return add_persons(persons, cited_authors(works))


def add_persons(persons: DataFrame, cited: DataFrame) -> DataFrame:
    authors = cited.select(F.inline("_authors"))
    return persons.unionByName(authors, allowMissingColumns=True)


def fill_works_from_labels(works: DataFrame) -> DataFrame:
    """ISSN, then ISBN, then DOI from labelled numbers in the other fields.

    Each number is searched only where its column is NULL or empty, and a number
    found in one step is itself searched in the next.
    """
    filled = works
    for field in rules.LABELLED_NUMBERS:
        others = [F.col(name) for name in rules.SEARCHED_FIELDS if name != field]
        missing = F.col(field).isNull() | (F.col(field) == "")
        found = identifiers.labelled_number(field, others)
        filled = filled.withColumn(
            field, F.when(missing, F.coalesce(found, F.col(field))).otherwise(F.col(field))
        )
    return filled.select(works.columns)
