from pubgrade.operators import parse


def parsed(frame, bibtex, strict=False, **fields):
    works = frame("works", {"bibtex": bibtex, "orcid_publication_id": "7", **fields})
    return parse.fill_works_from_citations(works, strict).collect()[0]


def test_one_entry_with_nested_braces_and_quotes(frame):
    row = parsed(frame, '@article{k, title={A {Big} Study}, year=2020, doi="10.1000/x=y", journal = "J. {of} X"}')
    assert (row.title, row.date, row.doi, row.journal_title) == ("A Big Study", "2020", "10.1000/x=y", "J. of X")


def test_several_or_no_entries(frame):
    for bibtex in ("@article{a, title={x}} @book{b, title={y}}", "free text", "", "@article{a, title={open", None):
        row = parsed(frame, bibtex)
        assert row.title is None and row.authors is None


def test_other_entry_types_do_not_count(frame):
    assert parsed(frame, "@online{a, title={x}}").title is None
    assert parsed(frame, "@online{a, title={x}} @Book{b, title={y}}").title == "y"


def test_set_values_stay(frame):
    row = parsed(frame, "@misc{a, title={x}, url={u}}", title="own")
    assert (row.title, row.url) == ("own", "u")


def test_strict_fields(frame):
    bibtex = "@misc{a, year=2020, journal={J}, subtitle={S}, title={T}}"
    loose, strict = parsed(frame, bibtex), parsed(frame, bibtex, strict=True)
    assert (loose.date, loose.journal_title, loose.subTitle, loose.title) == ("2020", "J", "S", "T")
    assert (strict.date, strict.journal_title, strict.subTitle, strict.title) == (None, None, None, "T")


def test_last_of_repeated_fields(frame):
    assert parsed(frame, "@misc{a, title={first}, Title={second}}").title == "second"


def test_values_with_an_equals_sign_do_not_start_fields(frame):
    row = parsed(frame, "@misc{a, abstract={we set title={no}, ok}, title={yes}}")
    assert (row.title, row.abstract) == ("yes", "we set title=no, ok")


def test_latex(frame):
    row = parsed(frame, r'@misc{a, title={K{\"o}ln \& \v{S}koda --- stra\ss e, \c c, \"{\i}, \o re, \emph{it} 5\% a~b}}')
    assert row.title == "Köln & Škoda — straße, ç, ï, øre, it 5% a b"


def test_authors(frame):
    row = parsed(frame, "@misc{a, author={Ann A/0000-0002 and Bob B and C/x/y}}")
    assert row.authors == ["0000-0002", "7_1", "7_2"]
    assert parsed(frame, "@misc{a, author={Ann}}", authors=["z"]).authors == ["z"]
    numbers = parsed(frame, "@misc{a, orcid-numbers={Ann/1 and Bob/2}, author={Eve}}")
    assert numbers.authors == ["1", "2"]


def test_null_publication_id(frame):
    assert parsed(frame, "@misc{a, author={Ann}}", orcid_publication_id=None).authors == [None]


def test_persons_are_appended_even_if_authors_are_set(frame):
    works = frame("works", {"bibtex": "@misc{a, author={Ann A/1 and Bob}}", "orcid_publication_id": "7", "authors": ["z"]})
    persons = frame("persons", {"id": "p", "affiliations": [("2001", "o", "r", "1999")]})
    rows = parse.add_cited_persons(persons, works).select("id", "otherNames", "affiliations").orderBy("id").collect()
    assert [(r.id, r.otherNames) for r in rows] == [("1", "Ann A"), ("7_1", "Bob"), ("p", None)]
    assert rows[2].affiliations[0].startYear == "1999"


def test_long_citation_does_not_exhaust_the_stack(frame):
    many = " ".join("{w}" for _ in range(30000))
    row = parsed(frame, "@misc{a, abstract={" + many + "}, title={t}, " + ", ".join(f"f{i}={{v}}" for i in range(5000)) + "}")
    assert row.title == "t" and row.abstract.startswith("w w w")


def test_any_depth_of_braces(frame):
    for levels in (6, 20, 1000):
        deep = "{" * levels + "Deep" + "}" * levels
        row = parsed(frame, "@misc{a, title=" + deep + ", doi={10.1/x}, year=2020}")
        assert (row.title, row.doi, row.date) == ("Deep", "10.1/x", "2020")


def test_concatenation_and_strings(frame):
    row = parsed(frame, '@string{j = "Journal of " # {X}} @misc{a, title = "one" # " two", journal = j, date = 3 # "~" # mar}')
    assert (row.title, row.journal_title, row.date) == ("one two", "Journal of X", "3 March")
    assert parsed(frame, "@misc{a, title={x}, journal=unknown}").title is None


def test_entries_in_parentheses(frame):
    row = parsed(frame, '@misc(a, title={x) y}, url="u)v", year=2020)')
    assert (row.title, row.url, row.date) == ("x) y", "u)v", "2020")


def test_unknown_commands_stay(frame):
    row = parsed(frame, r"@misc{a, title={The $\alpha$ and \foo of \emph{x}}}")
    assert row.title == r"The α and \foo of x"


def test_signs_inside_values(frame):
    row = parsed(frame, '@misc{a, title={a @book{b, "c" = d # e}, f}, url={x#y=z}}')
    assert (row.title, row.url) == ('a @bookb, "c" = d # e, f', "x#y=z")
