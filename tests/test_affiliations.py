from pubgrade.operators import correct, filters

FIELDS = ("endYear", "orgID", "role", "startYear")


def entry(**fields):
    return tuple(fields.get(f) for f in FIELDS)


def changed(frame, step, affiliations):
    row = step(frame("persons", {"affiliations": affiliations})).collect()[0]
    found = row.affiliations
    return found and [{k: v for k, v in a.asDict().items() if v is not None} for a in found]


def test_invalid_years_and_empty_strings(frame):
    step = correct.correct_person_values
    assert changed(frame, step, [entry(startYear="now")]) is None
    assert changed(frame, step, [entry(startYear="1999", endYear="")]) == [{"startYear": "1999"}]
    assert changed(frame, step, [entry(startYear="1899", role="r", orgID="")]) == [{"role": "r"}]
    assert changed(frame, step, []) is None
    assert changed(frame, step, None) is None


def test_contradicting_years(frame):
    step = filters.drop_contradicting_years
    assert changed(frame, step, [entry(startYear="2005", endYear="2001", orgID="o")]) == [{"orgID": "o"}]
    assert changed(frame, step, [entry(startYear="2005", endYear="2001")]) is None
    assert changed(frame, step, [entry(startYear="2001", endYear="2001")]) == [{"startYear": "2001", "endYear": "2001"}]
    # years that are no years are compared as text and kept
    assert changed(frame, step, [entry(startYear="now")]) == [{"startYear": "now"}]


def test_field_order_after_correction(frame):
    persons = correct.correct_person_values(frame("persons", {"affiliations": [entry(role="r")]}))
    assert persons.schema["affiliations"].dataType.elementType.names == ["role", "orgID", "startYear", "endYear"]
