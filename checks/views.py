"""Dirty entity views over the test tables, in two SQL dialects.

The raw tables hold no NULLs and no publication metadata. The views derive both
from them, row by row and over whole tables and whole texts. One id stands for
many rows on purpose: a third of the organisations share an id, and a third of
the works share an author.
"""


class SparkDialect:
    def __init__(self, sf_dir: str):
        self.sf_dir = sf_dir

    def table(self, name: str) -> str:
        return f"parquet.`{self.sf_dir}/{name}.parquet`"

    def arr(self, *items: str) -> str:
        return f"array({', '.join(items)})"

    def st(self, **fields: str) -> str:
        return f"named_struct({', '.join(f'{chr(39)}{k}{chr(39)}, {v}' for k, v in fields.items())})"

    def date_parts(self, parts: str) -> str:
        return f"named_struct('date-parts', {parts})"

    def quoted(self, name: str) -> str:
        return f"`{name}`"


class DuckDialect:
    def table(self, name: str) -> str:
        return name

    def arr(self, *items: str) -> str:
        return f"[{', '.join(items)}]"

    def st(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def date_parts(self, parts: str) -> str:
        return "{'date-parts': " + parts + "}"

    def quoted(self, name: str) -> str:
        return f'"{name}"'


def _text(value: str) -> str:
    return f"cast({value} as string)"


def _person_id(number: str) -> str:
    padded = f"lpad({_text(number)}, 12, '0')"
    return f"'0000-' || substr({padded}, 1, 4) || '-' || substr({padded}, 5, 4) || '-' || substr({padded}, 9, 4)"


_NO_TEXT = "cast(null as string)"


def works(d) -> str:
    doc = _text("doc_id")
    author = _person_id("case when doc_id % 3 = 1 then 0 else doc_id - doc_id % 3 end")
    umlaut = "chr(92) || '\"o'"
    return f"""
select {doc} as orcid_publication_id,
 case when doc_id % 31 = 0 then 'bad-id' else {_person_id("doc_id - doc_id % 3")} end as orcid_id,
 case when n_chars % 17 = 0 then null when n_chars % 19 = 0 then '<b>' || text when n_chars % 23 = 0 then 'n/a'
      when n_chars % 29 = 0 then '日本語' when n_chars % 13 = 0 then 'abc'
      when n_chars % 2 = 0 then replace(text, chr(10), ' ') else text end as title,
 case when doc_id % 3 = 0 then source || '  ' || lang when doc_id % 3 = 1 then 'x' end as {d.quoted("subTitle")},
 case when doc_id % 7 = 0 then 'Abstract ' || text when doc_id % 11 = 0 then 'short' when doc_id % 5 = 0 then null else text end as abstract,
 case n_chars % 6 when 0 then '2019' when 1 then '2020-3' when 2 then '2021-04-07' when 4 then '1750-01-01' when 5 then '2015-11' end as {d.quoted("date")},
 case doc_id % 5 when 0 then '10.1234/d.' || {doc} when 1 then 'https://doi.org/10.1234/d.' || {doc} when 2 then 'doi 10.99' end as doi,
 case doc_id % 8 when 0 then '1234-567X' when 1 then 'ISSN 2049-3630' when 2 then '12' end as issn,
 case doc_id % 9 when 0 then '978-3-16-148410-0' when 1 then 'ISBN-13:9783161484100' when 4 then '3_16_148410_0' end as isbn,
 case doc_id % 4 when 0 then 'http://example.org/p/' || {doc} when 1 then 'http://example.org/a b' when 2 then 'doi:10.5555/u.' || {doc} end as url,
 case doc_id % 10 when 0 then 'J' when 1 then 'Journal ISSN 1111-2222' when 2 then 'Book ISBN 3161484100' else 'Journal of ' || lang end as journal_title,
 case doc_id % 4 when 0 then 'journal-article' when 1 then 'book' when 2 then 'book-chapter' end as type,
 case doc_id % 12
   when 0 then '@article{{k1, title={{A {{Big}} Study}}, date={{2018}}, author={{Ann A/0000-0002-0000-0001 and Bob B}}, doi={{10.7777/b.' || {doc} || '}}}}'
   when 1 then '@Book{{b' || {doc} || ',' || chr(10) || ' title = {{K{{' || {umlaut} || '}}ln ' || chr(92) || '& G{{' || {umlaut} || '}}teborg ' || {doc} || '}},' || chr(10) || ' Year = 2015,' || chr(10) || ' journal = "J. {{' || lang || '}}", subtitle = {{Vol. ' || {doc} || '}}' || chr(10) || '}}'
   when 2 then '@online{{o, title={{Skipped}}}}'
   when 3 then '@misc{{m, orcid-numbers={{Carl C/' || {author} || '}}, author={{Ignored}}, url={{http://example.org/m?x=' || {doc} || '}}, issn={{1234-5679}}}}'
   when 6 then '@article{{a, title={{x}}}} @book{{b, title={{y}}}}'
   when 7 then 'not bibtex' end as bibtex,
 case when n_chars % 4 = 3 then null when n_chars % 4 = 2 then {d.arr(author)} else {d.arr(author, f"{doc} || '_1'")} end as authors
from {d.table("documents")}"""


def persons(d) -> str:
    affiliation = d.st(
        endYear="case when c_custkey % 5 = 0 then 'now' when c_custkey % 5 = 1 then '2001' end",
        orgID=f"'org' || {_text('c_nationkey')}",
        role="case when c_custkey % 2 = 0 then 'prof' end",
        startYear="case c_custkey % 3 when 0 then '2005' when 1 then '1999' end",
    )
    second = d.st(
        endYear="case when c_custkey % 7 = 0 then '1995' end",
        orgID="case when c_custkey % 9 = 0 then '' end",
        role=_NO_TEXT,
        startYear="case when c_custkey % 7 < 2 then '1990' end",
    )
    return f"""
select {_person_id("c_custkey - c_custkey % 3")} as id,
 case when c_custkey % 7 = 0 then null when c_custkey % 11 = 0 then 'A1' else 'First' || c_mktsegment end as {d.quoted("firstName")},
 case when c_custkey % 5 = 0 then null else 'L' || substr(c_mktsegment, 1, cast(c_custkey % 4 as int)) end as {d.quoted("lastName")},
 case when c_custkey % 13 = 0 then 'Other (Name)' when c_custkey % 13 = 1 then 'Иван' when c_custkey % 13 = 2 then 'Doe, Jo' end as {d.quoted("otherNames")},
 case when c_custkey % 17 = 0 then 'Pub Name' end as {d.quoted("publishedName")},
 case when c_custkey % 3 = 0 then 'DE' when c_custkey % 3 = 1 then 'fr' when c_custkey % 8 = 0 then 'PT' end as country,
 case when c_custkey % 4 = 0 then null when c_custkey % 4 = 1 then {d.arr(affiliation, second)} else {d.arr(affiliation)} end as affiliations
from {d.table("customer")}"""


def org_units(d) -> str:
    key = _text("case when o_orderkey % 3 = 0 then 7 else o_custkey end")
    return f"""
select case o_orderkey % 5 when 0 then 'grid.' || {key} when 1 then 'https://ror.org/' || {key} when 2 then 'LEI' || {key}
   when 3 then 'http://dx.doi.org/10.13039/' || {key} else 'Org ' || {_text("o_orderkey")} end as id,
 case o_orderkey % 5 when 0 then 'GRID' when 1 then 'ROR' when 2 then 'LEI' when 3 then 'FUNDREF' end as type,
 case o_orderkey % 4 when 0 then 'Organisation ' || {key} when 1 then 'Customer#' || lpad({key}, 9, '0') when 2 then 'Org ' || o_orderpriority end as name
from {d.table("orders")}"""


def ror(d) -> str:
    return f"""
select 'https://ror.org/' || {_text("c_custkey")} as id,
 case when c_custkey % 5 <> 4 then 'grid.' || {_text("c_custkey")} end as {d.quoted("external_ids.GRID.preferred")},
 case when c_custkey % 6 > 0 then c_name end as name from {d.table("customer")}"""


def lei(d) -> str:
    # every fifth id has two rows with different names
    return f"""
select 'LEI' || {_text("case when c_custkey % 10 = 1 then c_custkey - 1 else c_custkey end")} as id, c_name as name
from {d.table("customer")}"""


def fundref(d) -> str:
    return f"""
select 'http://dx.doi.org/10.13039/' || {_text("c_custkey")} as uri, c_name as primary_name_display, {_NO_TEXT} as replaced
from {d.table("customer")}"""


def cross_ref(d) -> str:
    # every seventh DOI has two rows
    author = d.st(firstName="'First'", id=_person_id("p_partkey % 89"), lastName="p_brand")
    second = d.st(firstName=_NO_TEXT, id=f"'10.1234/d.' || {_text('p_partkey')} || '_1'", lastName="p_type")
    return f"""
select '10.1234/d.' || {_text("case when p_partkey % 7 = 1 then p_partkey - 1 else p_partkey end")} as doi, p_name as title,
 'About ' || p_name || ' in five words or more' as abstract, '2020-' || {_text("1 + p_partkey % 12")} as {d.quoted("date")},
 'journal-article' as type, case when p_partkey % 4 = 0 then p_type end as {d.quoted("subTitle")},
 case when p_partkey % 3 = 0 then '1234-5678' end as issn, case when p_partkey % 5 = 0 then '3161484100' end as isbn,
 case when p_partkey % 2 = 0 then 'http://dx.doi.org/10.1234/d.' || {_text("p_partkey")} end as url,
 case when p_partkey % 2 = 0 then {d.arr(author)} when p_partkey % 5 = 0 then {d.arr(author, second)} end as authors
from {d.table("part")}"""


def raw_works(d) -> str:
    key = _text("o_orderkey")
    first = d.st(
        credit_name="case when o_orderkey % 6 > 0 then 'A. One' end",
        role="case o_orderkey % 3 when 0 then 'author' when 1 then 'editor' end",
        orcid="case when o_orderkey % 2 = 0 then '0000-0001-0000-0001' end",
    )
    second = d.st(credit_name="'B. Two'", role=_NO_TEXT, orcid=_NO_TEXT)
    doi = d.st(
        type="'doi'", value=f"'DOI:10.1/' || {key}", normalized=f"case when o_orderkey % 2 = 0 then '10.1/' || {key} end"
    )
    other = d.st(type="case when o_orderkey % 4 = 0 then 'issn' else 'doi' end", value="'1234-5678'", normalized=_NO_TEXT)
    date = d.st(
        year=f"case when o_orderkey % 7 = 0 then null else {_text('1995 + o_orderkey % 30')} end",
        month=f"case when o_orderkey % 3 = 0 then null else lpad({_text('1 + o_orderkey % 12')}, 2, '0') end",
        day="case when o_orderkey % 2 = 0 then '15' end",
    )
    source = d.st(
        type="case o_orderkey % 4 when 0 then 'bibtex' when 1 then 'ris' end",
        value=f"case when o_orderkey % 5 > 0 then '@misc{{k, doi={{10.1000/' || {key} || '}}}}' end",
    )
    return f"""
select {key} as pub_id, {date} as publication_date, {source} as citation, {d.arr(first, second)} as contributors,
 {d.arr(doi, other)} as external_ids,
 'x/' || {_person_id("o_custkey")} || '_works_' || {key} || '.xml' as path,
 'Order & ' || o_orderpriority as title, case when o_orderkey % 3 = 0 then 'Sub <' || o_orderstatus || '>' end as {d.quoted("subTitle")},
 case when o_orderkey % 4 = 0 then 'Journal' end as journal_title, ' two  blanks ' || {key} as abstract,
 'journal-article' as type, case when o_orderkey % 5 = 0 then 'http://example.org/?a=1&b=' || {key} end as url
from {d.table("orders")}"""


def raw_items(d) -> str:
    key = _text("p_partkey")
    first = d.st(given="'G'", family="p_brand", ORCID="case when p_partkey % 3 = 0 then 'http://orcid.org/0000-0003-0000-0001' end")
    second = d.st(given=_NO_TEXT, family="'Group'", ORCID=_NO_TEXT)
    parts = d.arr(d.arr("cast(2000 + p_partkey % 20 as int)", "cast(1 + p_partkey % 12 as int)"))
    item = d.st(
        DOI=f"'10.1234/d.' || {key}",
        type="'journal-article'",
        title=d.arr("p_name", "p_type"),
        subtitle=f"case when p_partkey % 2 = 0 then {d.arr('p_brand')} end",
        abstract="case when p_partkey % 4 = 0 then 'About ' || p_name end",
        ISBN=f"case when p_partkey % 5 = 0 then {d.arr(_text('p_size'), key)} end",
        ISSN=f"case when p_partkey % 7 = 0 then {d.arr(key)} end",
        URL=f"'http://dx.doi.org/10.1234/d.' || {key}",
        author=f"case when p_partkey % 9 > 0 then {d.arr(first, second)} end",
        published=f"case when p_partkey % 5 > 0 then {d.date_parts(parts)} end",
    )
    return f"select p_size as file_no, {d.arr(item)} as items from {d.table('part')}"


def raw_persons(d) -> str:
    own = d.st(
        startYear="'2001'",
        endYear=_NO_TEXT,
        role="'R&D'",
        orgName="c_name",
        orgID=f"case when c_custkey % 3 > 0 then 'grid.' || {_text('c_nationkey')} end",
        orgIDType="case when c_custkey % 3 > 0 then 'GRID' end",
    )
    shared = d.st(startYear=_NO_TEXT, endYear=_NO_TEXT, role=_NO_TEXT, orgName="'Shared Org'", orgID=_NO_TEXT, orgIDType=_NO_TEXT)
    return f"""
select {_person_id("c_custkey")} as id, 'First ' || c_mktsegment as {d.quoted("firstName")},
 case when c_custkey % 4 > 0 then 'Last' end as {d.quoted("lastName")},
 case when c_custkey % 5 = 0 then 'DE' end as country,
 {d.arr(own, shared)} as affiliations from {d.table("customer")}"""


def measurements(d) -> str:
    # one run per order year; the result state has a laxer threshold
    def state(chain: str, threshold: int, kind: str, value: str) -> str:
        return f"""
select cast(year(o_orderdate) as bigint) as run_seq, 'complete' as metrics, '{chain}' as chain, '{kind}' as kind,
 'orders.' || o_orderpriority as indicator, {value.format(threshold)} as value
from {d.table("orders")} group by year(o_orderdate), o_orderpriority"""

    share = "cast(sum(case when o_totalprice > {} then 1 else 0 end) as double) / count(*)"
    rows = "cast(sum(case when o_totalprice > {} then 1 else 0 end) as double)"
    return "\nunion all".join(
        state(chain, threshold, kind, value)
        for kind, value in (("indicator", share), ("count", rows))
        for chain, threshold in (("initial", 250000), ("complete", 100000))
    )


VIEWS = {
    "v_works": works,
    "v_persons": persons,
    "v_orgUnits": org_units,
    "v_ROR": ror,
    "v_lei": lei,
    "v_fundref": fundref,
    "v_crossRef": cross_ref,
    "v_raw_works": raw_works,
    "v_raw_items": raw_items,
    "v_raw_persons": raw_persons,
    "v_measurements": measurements,
}


def spark_view(spark, sf_dir: str, name: str):
    return spark.sql(VIEWS[name](SparkDialect(sf_dir)))


def duck_ctes(*names: str) -> str:
    return ", ".join(f"{name} as ({VIEWS[name](DuckDialect())})" for name in names)
