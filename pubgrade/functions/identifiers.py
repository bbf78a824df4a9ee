"""Numbers and addresses of publications: clean, check, find in other fields."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubgrade import rules

# every character the URL pattern can consume
_URL_ALPHABET = r"^[\w.\-+~%/()#?=&;@:,]*$"


def strip_issn(value: Column) -> Column:
    return _dashes(F.regexp_replace(value, rules.ISSN_LABEL, ""))


def strip_isbn(value: Column) -> Column:
    return _dashes(F.regexp_replace(value, rules.ISBN_LABEL, ""))


def strip_url(value: Column) -> Column:
    return F.regexp_replace(value, rules.URL_NOISE, "")


def strip_doi(value: Column) -> Column:
    return F.regexp_replace(value, rules.DOI_LABEL, "")


def _dashes(value: Column) -> Column:
    return F.translate(value, rules.NUMBER_SEPARATORS, "-" * len(rules.NUMBER_SEPARATORS))


def is_url(value: Column) -> Column:
    """The alphabet test is implied by the pattern and spares its backtracking on odd values."""
    return value.rlike(_URL_ALPHABET) & value.rlike(rules.URL)


def is_date(value: Column, as_of_year: int) -> Column:
    year = F.substring(value, 1, 4)
    return value.rlike(rules.DATE_SHAPE) & year.between(str(rules.FIRST_VALID_YEAR), str(as_of_year))


def labelled_number(field: str, sources: list[Column]) -> Column:
    """First labelled ISSN, ISBN or DOI found in the sources, in their order.

    The patterns look behind at every position of a text, so only texts that
    contain the label at all are searched.
    """
    pattern = rules.LABELLED_NUMBERS[field]

    def found(source: Column) -> Column:
        return F.when(source.rlike(f"(?i){field}"), F.regexp_extract(source, pattern, 0))

    return F.get(F.filter(F.array(*[found(source) for source in sources]), lambda number: number != ""), F.lit(0))
