from pyspark.sql import functions as F

from pubgrade import rules
from pubgrade.functions import identifiers
from pubgrade.operators import correct, parse


def corrected(frame, field, values):
    works = frame("works", *[{field: v, "orcid_publication_id": f"{i:02}"} for i, v in enumerate(values)])
    rows = correct.correct_work_values(works).orderBy("orcid_publication_id").collect()
    return [row[field] for row in rows]


def test_issn(frame):
    assert corrected(frame, "issn", ["ISSN 2049-3630", "12", "1234.567X", None]) == ["2049-3630", None, "1234-567X", None]


def test_isbn(frame):
    assert corrected(frame, "isbn", ["ISBN-13:9783161484100", "3_16_148410_0", "x"]) == ["9783161484100", "3-16-148410-0", None]


def test_doi(frame):
    assert corrected(frame, "doi", ["https://doi.org/10.1234/x", "dx.doi.org/10.1234/y", "doi 10.99"]) == ["10.1234/x", "10.1234/y", None]


def test_url(frame):
    assert corrected(frame, "url", ["http://example.org/a b", "http://e.org/?q=1&r=2#s", 'http://e.org/"']) == [
        "http://example.org/ab", "http://e.org/?q=1&r=2#s", None,
    ]


def test_url_check_equals_the_pattern(apply):
    urls = ["http://a.b/c", "a.b", "a.b/c?d=1", "a.b/c??", "http://a b", "a|b", "a.b/ü", "a.b/%20#x", "", "a.b/c#d#e", "https://x"]
    assert apply(identifiers.is_url, urls) == apply(lambda u: u.rlike(rules.URL), urls)


def test_dates(apply):
    dates = ["2020", "1799", "1800-01", "2026-12-31", "2027", "2020-3", "20201", "2020-01-1", None]
    assert apply(lambda d: identifiers.is_date(d, 2026), dates) == [True, False, True, True, False, False, False, False, None]


def labels(frame, **fields):
    row = parse.fill_works_from_labels(frame("works", fields)).collect()[0]
    return row.issn, row.isbn, row.doi


def test_labelled_numbers(frame):
    assert labels(frame, title="Book ISBN 3161484100") == (None, "3161484100", None)
    assert labels(frame, title="x ISSN 1111-2222", issn="") == ("1111-2222", None, None)
    assert labels(frame, url="doi:10.5555/u.1", title="doi:10.1/late") == (None, None, "10.5555/u.1")
    # a set value stays, also an incorrect one
    assert labels(frame, title="ISBN 3161484100", isbn="bad") == (None, "bad", None)
    # an empty value without a find stays empty
    assert labels(frame, title="nothing", isbn="") == (None, "", None)
    # the shortest label wins, so the 10 belongs to the number
    assert labels(frame, title="ISBN 1034567890123") == (None, "1034567890", None)


def test_found_number_is_searched_in_turn(frame):
    # the ISSN found first is itself a source of the later steps
    row = frame("works", {"title": "ISSN 1111-2222", "journal_title": "ISBN-13 9783161484100"})
    result = parse.fill_works_from_labels(row).select("issn", "isbn").collect()[0]
    assert tuple(result) == ("1111-2222", "9783161484100")


def test_correct_contradict(frame):
    works = frame("works", {"issn": "a", "isbn": "b"}, {"isbn": "b"}, {"issn": "a"})
    rows = correct.prefer_issn(works).select("issn", "isbn").collect()
    assert [tuple(r) for r in rows] == [("a", None), (None, "b"), ("a", None)]


def test_min_length_keeps_the_threshold(frame):
    works = frame("works", {"title": "12345", "abstract": "123456789012"}, {"title": "123456", "abstract": "12345678901"})
    rows = correct.null_short_values(works, "works").select("title", "abstract").collect()
    assert [tuple(r) for r in rows] == [(None, "123456789012"), ("123456", None)]
    twice = correct.null_short_values(correct.null_short_values(works, "works"), "works")
    assert twice.exceptAll(correct.null_short_values(works, "works")).isEmpty()


def test_no_lookup_for_null(apply):
    assert apply(lambda v: identifiers.labelled_number("issn", [v, F.lit(None).cast("string")]), [None, "ISSN 1234-5678"]) == [None, "1234-5678"]
