"""The fixed values, written out a second time."""

import re

from pubgrade import rules


def test_weights():
    sums = {metric: sum(weights.values()) for metric, weights in rules.WEIGHTS.items()}
    assert sums == {
        "MinLength": 64, "MinValue": 1, "NotNull": 615, "MinPopulation": 9, "MinObject": 4, "CorrectValue": 375, "UniqueValue": 26,
        "NoContradict": 9, "UniqueObject": 1,
    }
    assert rules.DIMENSIONS == {
        "Completeness": {"MinLength": 5, "MinValue": 2, "NotNull": 7, "MinPopulation": 2, "MinObject": 9},
        "Consistency": {"UniqueValue": 5, "NoContradict": 1, "UniqueObject": 3},
    }


def test_noise():
    assert rules.TEXT_NOISE == r"""(<[a-zA-Z/]+>)|(^[^a-zA-Z0-9]+)|([^a-zA-Z0-9.!?"'\)]+$)|(^[nk][\./]?[na][\./]?$)|(  )"""
    assert (rules.NAME_NOISE, rules.LINE_BREAKS) == (r"[\(\)/\t0-9]+", r"[\n\r\t]")
    assert rules.ABSTRACT_LABEL == r"^[Aa][Bb][Ss][Tt][Rr][Aa][Cc][Tt]"


def test_numbers():
    assert re.search(rules.ISSN, "1234-567X") and not re.search(rules.ISSN, "1234-56")
    assert re.search(rules.ISBN, "978-3161484100") and not re.search(rules.ISBN, "12345")
    assert re.search(rules.OWNER_ID, "0000-0001-2345-678X") and not re.search(rules.OWNER_ID, "0000-0001-2345")
    assert re.search(rules.DOI, "10.1234/a.b") and not re.search(rules.DOI, "10.12/a")


def test_tables():
    assert len(rules.COUNTRIES) == 41 and rules.COUNTRIES[:4] == ["BE", "BG", "DK", "DE"] and rules.COUNTRIES[-1] == "BY"
    assert len(rules.FOLDING) == 165 and rules.FOLDING[228] == "ae" and rules.FOLDING[8230] == "..." and rules.FOLDING[236] == "e"
    assert rules.REFERENCE_FIELDS == ["abstract", "date", "doi", "isbn", "issn", "subTitle", "title", "type", "url"]
    assert rules.MIN_LENGTHS["works"] == {"title": 6, "journal_title": 6, "abstract": 12, "subTitle": 6}
