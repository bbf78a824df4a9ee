"""Arrays of affiliations, rewritten in place without exploding them."""

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubgrade import rules


def _non_empty(value: Column) -> Column:
    return F.when(value != "", value)


def _rebuild(affiliations: Column, years: Callable[[Column], tuple[Column, Column]]) -> Column:
    """Fields in the order role, orgID, startYear, endYear; empty entries and arrays vanish."""

    def entry(affiliation: Column) -> Column:
        start, end = years(affiliation)
        return F.struct(
            _non_empty(affiliation["role"]).alias("role"),
            _non_empty(affiliation["orgID"]).alias("orgID"),
            start.alias("startYear"),
            end.alias("endYear"),
        )

    def has_content(entry: Column) -> Column:
        return F.coalesce(entry["role"], entry["orgID"], entry["startYear"], entry["endYear"]).isNotNull()

    kept = F.filter(F.transform(affiliations, entry), has_content)
    return F.when(F.size(kept) > 0, kept)


def keep_valid_years(affiliations: Column) -> Column:
    def year(value: Column) -> Column:
        return F.when(value.rlike(rules.AFFILIATION_YEAR), value)

    return _rebuild(affiliations, lambda a: (year(a["startYear"]), year(a["endYear"])))


def drop_contradicting_years(affiliations: Column) -> Column:
    """Years are compared as text, so partial dates keep their natural order."""

    def years(affiliation: Column) -> tuple[Column, Column]:
        start, end = _non_empty(affiliation["startYear"]), _non_empty(affiliation["endYear"])
        in_order = start.isNull() | end.isNull() | (start <= end)
        return F.when(in_order, start), F.when(in_order, end)

    return _rebuild(affiliations, years)


def count_entries(affiliations: Column, condition: Callable[[Column], Column] | None = None) -> Column:
    """Entries of one row that meet the condition; 0 where there is no array."""
    counted = F.filter(affiliations, condition) if condition else affiliations
    return F.when(affiliations.isNull(), 0).otherwise(F.size(counted))
