"""Cleaning and normalising of free text.

Regular expressions over long texts dominate the cost of the whole pipeline, so
the functions first ask cheap questions (byte counts, first and last character,
plain substrings) and run a pattern only where it can match. The answers are the
same as those of the patterns in the rules alone.

Cleaning works on a column of a table, one small step per projection. Each step
reads its input several times; as one nested expression, every level would
compute the levels below again, because Spark shares no subexpressions inside
the branches of a condition.
"""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pubgrade import rules

_FROM_CYRILLIC = "[\u0410-\uffff]"
#: TEXT_NOISE, where a letter or digit costs one test: only NOT_AVAILABLE begins with one.
_GUARDED_NOISE = (
    rf"(?=[^a-zA-Z0-9])(?:{rules.TAG}|{rules.LEADING_NOISE}|{rules.TRAILING_NOISE}|{rules.DOUBLE_BLANK})|{rules.NOT_AVAILABLE}"
)
_REVERSED_TRAILING = "^" + rules.TRAILING_NOISE.removesuffix("$")


def is_ascii(text: Column) -> Column:
    """Compares byte and character counts, which is far cheaper than any regex."""
    return F.octet_length(text) == F.char_length(text)


def has_foreign_alphabet(text: Column) -> Column:
    """CJK or Cyrillic letters occur.

    ASCII text never reaches a regex, and text below the Cyrillic letters only the
    first one, whose single range is much faster than the union of all ranges.
    """
    return ~is_ascii(text) & text.rlike(_FROM_CYRILLIC) & text.rlike(rules.FOREIGN_ALPHABET)


def _first(text: Column) -> Column:
    return F.substring(text, 1, 1)


def _last(text: Column) -> Column:
    return F.substring(text, -1, 1)


def _is_not_available(text: Column) -> Column:
    # at most four characters and a line end
    return (F.length(text) <= 6) & text.rlike(rules.NOT_AVAILABLE)


def has_noise(text: Column) -> Column:
    """``rlike(TEXT_NOISE)``, alternative by alternative."""
    return (
        _first(text).rlike(rules.LEADING_NOISE)
        | _last(text).rlike(rules.TRAILING_NOISE)
        | text.contains("  ")
        | (text.contains("<") & text.rlike(rules.TAG))
        | _is_not_available(text)
    )


def _step(df: DataFrame, columns: list[str], change: Callable[[Column], Column]) -> DataFrame:
    return df.withColumns({name: change(F.col(name)) for name in columns})


def _squeeze(df: DataFrame, columns: list[str]) -> DataFrame:
    """Several blanks become one; one blank on either side goes, also before a line end."""

    def single(text: Column) -> Column:
        return F.when(text.contains("  "), F.regexp_replace(text, rules.BLANKS, " ")).otherwise(text)

    def trimmed(text: Column) -> Column:
        touched = text.startswith(" ") | _last(text).rlike("[ \n\r\u0085\u2028\u2029]")
        return F.when(touched, F.regexp_replace(text, rules.EDGE_BLANK, "")).otherwise(text)

    return _step(_step(df, columns, single), columns, trimmed)


def strip_noise(df: DataFrame, titles: list[str], abstracts: list[str]) -> DataFrame:
    """Removes noise from columns, the same step of all columns in one projection.

    Titles lose TEXT_NOISE and line breaks, abstracts their label and TEXT_NOISE; all
    lose surplus blanks. In text without ``<`` the alternatives of the pattern cannot
    overlap: noise at the start, noise at the end, and the substrings to remove
    between them. What follows a label is no longer the start of the text, so noise
    there stays.
    """
    patterns = {c: f"{_GUARDED_NOISE}|{rules.LINE_BREAKS}" for c in titles}
    patterns |= {c: f"{rules.ABSTRACT_LABEL}|{_GUARDED_NOISE}" for c in abstracts}
    removed = {c: [rules.DOUBLE_BLANK, "\n", "\r", "\t"] for c in titles} | {c: [rules.DOUBLE_BLANK] for c in abstracts}

    def step(change: Callable[[str, Column, Column], Column]) -> None:
        nonlocal df
        df = df.withColumns({c: change(c, F.col(c), F.col(f"_kind_{c}")) for c in patterns})

    def kind(column: str) -> Column:
        value = F.col(column)
        mixed = value.contains("<") | _is_not_available(value)
        kinds = F.when(mixed, "mixed")
        if column in abstracts:
            kinds = kinds.when(value.rlike(rules.ABSTRACT_LABEL), "labelled")
        return kinds.otherwise("plain")

    def whole(column: str, value: Column, kind: Column) -> Column:
        changed = F.when(kind == "mixed", F.regexp_replace(value, patterns[column], ""))
        if column in abstracts:
            changed = changed.when(kind == "labelled", F.regexp_replace(value, rules.ABSTRACT_LABEL, ""))
        return changed.otherwise(value)

    def leading(column: str, value: Column, kind: Column) -> Column:
        noisy = (kind == "plain") & _first(value).rlike(rules.LEADING_NOISE)
        return F.when(noisy, F.regexp_replace(value, rules.LEADING_NOISE, "")).otherwise(value)

    def trailing(column: str, value: Column, kind: Column) -> Column:
        noisy = (kind != "mixed") & _last(value).rlike(rules.TRAILING_NOISE)
        # from the end, where one try is enough; from the start the pattern tries every run of signs
        stripped = F.reverse(F.regexp_replace(F.reverse(value), _REVERSED_TRAILING, ""))
        return F.when(noisy, stripped).otherwise(value)

    def inner(column: str, value: Column, kind: Column) -> Column:
        changed = value
        for part in removed[column]:
            changed = F.replace(changed, F.lit(part), F.lit(""))
        return F.when(kind != "mixed", changed).otherwise(value)

    df = df.withColumns({f"_kind_{c}": kind(c) for c in patterns})
    for change in (whole, leading, trailing, inner):
        step(change)
    return _squeeze(df.drop(*[f"_kind_{c}" for c in patterns]), list(patterns))


def strip_name_remarks(name: Column) -> Column:
    """Drops everything in parentheses and one blank on either side."""
    return F.regexp_replace(F.regexp_replace(name, rules.PARENTHESES, ""), rules.EDGE_BLANK, "")


def fold_characters(df: DataFrame, column: str) -> DataFrame:
    """Maps accented letters and typographic signs to ASCII.

    One pass maps single characters. Those with several letters as output need one
    replacement each, letters before the rarer signs; text that is ASCII by then
    is done.
    """
    single = {char: to for char, to in rules.FOLDED.items() if len(to) == 1}
    several = [char for char, to in rules.FOLDED.items() if len(to) > 1]

    def fold_single(text: Column) -> Column:
        folded = F.translate(text, "".join(single), "".join(single.values()))
        return F.when(is_ascii(text), text).otherwise(folded)

    def fold_several(chars: list[str]) -> Callable[[Column], Column]:
        def fold(text: Column) -> Column:
            folded = text
            for char in chars:
                folded = F.replace(folded, F.lit(char), F.lit(rules.FOLDED[char]))
            return F.when(is_ascii(text), text).otherwise(folded)

        return fold

    df = _step(df, [column], fold_single)
    df = _step(df, [column], fold_several([char for char in several if char.isalpha()]))
    return _step(df, [column], fold_several([char for char in several if not char.isalpha()]))


def normalise(df: DataFrame, column: str) -> DataFrame:
    """Lower case, one kind of separator, single blanks, no edge blanks, no quotes, folded."""

    def separated(text: Column) -> Column:
        return F.regexp_replace(F.lower(text), rules.KEY_SEPARATORS, ".")

    def single_blanks(text: Column) -> Column:
        return F.when(text.contains("  "), F.regexp_replace(text, rules.KEY_BLANKS, " ")).otherwise(text)

    def trimmed(text: Column) -> Column:
        edges = text.startswith(" ") | text.endswith(" ") | text.endswith(" \n")
        return F.when(edges, F.regexp_replace(text, r"^ | (?=\n?\z)", "")).otherwise(text)

    def unquoted(text: Column) -> Column:
        return F.regexp_replace(text, rules.KEY_QUOTES, "")

    for change in (separated, single_blanks, trimmed, unquoted):
        df = _step(df, [column], change)
    return fold_characters(df, column)
