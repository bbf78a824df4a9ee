"""The same results in the SQL of DuckDB, written independently of the Spark code.

Every step is a function from the name of a table to a select over it, so single
steps and the complete chain are checked with the same text. Fixed values
(patterns, thresholds, weights) come from the rules; everything else is restated.
"""

from checks.views import duck_ctes
from pubgrade import rules

AS_OF_YEAR = 2026

WORK_COLUMNS = (
    'abstract authors bibtex "date" doi isbn issn journal_title orcid_id orcid_publication_id "subTitle" title type url'
).split()
WORK_TEXTS = [c for c in WORK_COLUMNS if c != "authors"]
PERSON_TEXTS = ["country", '"firstName"', "id", '"lastName"', '"otherNames"', '"publishedName"']
WORKS_OUT = ", ".join(WORK_TEXTS) + ", array_to_string(authors, '|') as authors"
AFFILIATIONS_OUT = (
    "array_to_string(list_transform(affiliations, lambda a: coalesce(a.role, '~') || '|' || coalesce(a.\"orgID\", '~')"
    " || '|' || coalesce(a.\"startYear\", '~') || '|' || coalesce(a.\"endYear\", '~')), ';') as affiliations"
)
PERSONS_OUT = ", ".join(PERSON_TEXTS) + ", " + AFFILIATIONS_OUT


def text(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


def matches(value: str, pattern: str) -> str:
    return f"regexp_matches({value}, {text(pattern)})"


def cleaned(value: str, pattern: str, replacement: str = "") -> str:
    return f"regexp_replace({value}, {text(pattern)}, {text(replacement)}, 'g')"


def with_views(names: str, select: str, /, **steps: str) -> str:
    ctes = [duck_ctes(*names.split())] + [f"{name} as ({step})" for name, step in steps.items()]
    return f"with {', '.join(ctes)} {select}"


# --- rounding ------------------------------------------------------------------


def round3(value: str) -> str:
    p = f"(({value}) * 2000::double)"
    high = f"(({value}) * 134217729::double - (({value}) * 134217729::double - ({value})))"
    error = f"(({high} * 2000::double - {p}) + (({value}) - {high}) * 2000::double)"
    below = f"floor(({p} - 1) / 2)"
    return (
        f"(case when not ({p} = floor({p}) and abs({p} % 2) = 1) then floor(({p} + 1) / 2)"
        f" when {error} > 0 then {below} + 1 when {error} < 0 then {below}"
        f" when {below} % 2 = 0 then {below} else {below} + 1 end / 1000::double)"
    )


# --- transformations -------------------------------------------------------------

_B0 = r"\{[^{}]*\}"
_B1 = rf"\{{(?:[^{{}}]|{_B0})*\}}"
_B2 = rf"\{{(?:[^{{}}]|{_B1})*\}}"
_B3 = rf"\{{(?:[^{{}}]|{_B2})*\}}"
_ENTRY = rf"@(?i:{'|'.join(rules.CITATION_TYPES)})\s*\{{[^,{{}}]*,((?:[^{{}}]|{_B3})*)\}}"


def citation_body(w: str) -> str:
    return f"""
select *, case when len(entries) = 1 then entries[1] end as body
from (select *, regexp_extract_all(bibtex, {text(_ENTRY)}, 1) as entries from {w})"""


def citation_value(*names: str) -> str:
    found = []
    for name in names:
        pattern = rf"""(?:^|[,\s])(?i:{name})\s*=\s*({_B3}|"(?:[^"{{}}]|{_B3})*"|[^\s,{{}}"#]+)"""
        raw = f"regexp_extract(body, {text(pattern)}, 1)"
        inner = f"(case when {raw} like '{{%' or {raw} like '\"%' then substr({raw}, 2, length({raw}) - 2) else {raw} end)"
        found.append(f"nullif({inner}, '')")
    value = f"coalesce({', '.join(found)})"
    for old, new in (("'{'", "''"), ("'}'", "''"), ("chr(92) || '\"o'", "'ö'"), ("chr(92) || '&'", "'&'")):
        value = f"replace({value}, {old}, {new})"
    return value


def cited_authors(w: str) -> str:
    return f"""
select *, list_transform(string_split(names, ' and '), lambda x, i:
  {{'id': case when len(string_split(x, '/')) = 2 then string_split(x, '/')[2] else orcid_publication_id || '_' || cast(i - 1 as string) end,
    'otherNames': string_split(x, '/')[1]}}) as cited
from (select *, {citation_value('orcid-numbers', 'author')} as names from ({citation_body(w)}))"""


def fill_from_citations(w: str) -> str:
    fields = {
        "doi": ["doi"], '"date"': ["date", "year"], "journal_title": ["journal_title", "journal"], "abstract": ["abstract"],
        "issn": ["issn"], "isbn": ["isbn"], "url": ["url"], '"subTitle"': ["subtitle"], "title": ["title"],
    }
    filled = {c: f"coalesce({c}, {citation_value(*names)})" for c, names in fields.items()}
    filled["authors"] = "coalesce(authors, list_transform(cited, lambda c: c.id))"
    return "select " + ", ".join(f"{filled.get(c, c)} as {c}" for c in WORK_COLUMNS) + f" from ({cited_authors(w)})"


def add_cited_persons(p: str, w: str) -> str:
    return f"""
select {', '.join(PERSON_TEXTS)}, affiliations from {p}
union all
select null, null, c.id, null, c."otherNames", null, null from (select unnest(cited) as c from ({cited_authors(w)}))"""


# the label is consumed instead of looked behind at; its shortest form comes first
_LABELLED = {
    "issn": (r"[iI][sS][sS][nN][^a-z^A-Z](977-\d{3}-\d{4}-\d{2}-\d|\d{4}-\d{3}[0-9xX])", 1),
    "isbn": (
        r"[iI][sS][bB][nN](?:[ :\-.]|[ :\-.]?(?:10|13)[ :\-.]??)((?:97[89][\-]?)?(?:[0-9][-]?){8}[0-9](?:[-]?[0-9xX]))", 1,
    ),
    "doi": (r"""[dD][oO][iI][ :\-.](10[.][0-9]{4,}[^\s"\/<>]*\/[^\s"<>]+)""", 1),
}


def fill_from_labels(w: str) -> str:
    current = w
    for field, (pattern, group) in _LABELLED.items():
        sources = [s for s in ("doi", "url", "isbn", "issn", '"subTitle"', "journal_title", "title") if s != field]
        found = ", ".join(f"nullif(regexp_extract({s}, {text(pattern)}, {group}), '')" for s in sources)
        current = (
            f"(select * replace (case when {field} is null or {field} = '' then coalesce({found}, {field})"
            f" else {field} end as {field}) from {current})"
        )
    return f"select * from {current}"


def registry_rows() -> str:
    return """
select 'GRID' as type, "external_ids.GRID.preferred" as id, name from v_ROR
union all select 'ROR', id, name from v_ROR
union all select 'LEI', id, name from v_lei
union all select 'FUNDREF', uri, primary_name_display from v_fundref"""


def correct_orgs(o: str) -> str:
    # one join per registry
    current = o
    for org_type, registry, key, name in (
        ("GRID", "v_ROR", '"external_ids.GRID.preferred"', "name"), ("ROR", "v_ROR", "id", "name"),
        ("LEI", "v_lei", "id", "name"), ("FUNDREF", "v_fundref", "uri", "primary_name_display"),
    ):
        current = (
            f"(select o.id, o.type, coalesce(r.{name}, o.name) as name from {current} o"
            f" left join {registry} r on o.type = '{org_type}' and o.id = r.{key})"
        )
    return f"select * from {current}"


MIN_LENGTHS = {
    "works": {"title": 6, "journal_title": 6, "abstract": 12, '"subTitle"': 6},
    "persons": {'"firstName"': 2, '"lastName"': 2, '"otherNames"': 5, '"publishedName"': 5},
}


def null_short(t: str, entity: str) -> str:
    changed = ", ".join(
        f"case when length({c}) < {n} then null else {c} end as {c}" for c, n in MIN_LENGTHS[entity].items()
    )
    return f"select * replace ({changed}) from {t}"


def squeezed(value: str) -> str:
    return cleaned(cleaned(value, "[ ]{2,}", " "), "^[ ]|[ ]$")


def correct_works(w: str) -> str:
    issn = cleaned(cleaned("issn", rules.ISSN_LABEL), "[./_]", "-")
    isbn = cleaned(cleaned("isbn", rules.ISBN_LABEL), "[./_]", "-")
    url = cleaned("url", rules.URL_NOISE)
    doi = cleaned("doi", rules.DOI_LABEL)
    abstract = squeezed(cleaned("abstract", f"{rules.ABSTRACT_LABEL}|{rules.TEXT_NOISE}"))
    titles = []
    for c in ("title", '"subTitle"'):
        value = squeezed(cleaned(c, rules.TEXT_NOISE + r"|[\n\r\t]"))
        titles.append(f"case when {matches(c, rules.FOREIGN_ALPHABET)} then null else nullif({value}, '') end as {c}")
    return f"""
select * replace (
 case when {matches(issn, rules.ISSN)} then {issn} end as issn,
 case when {matches(isbn, rules.ISBN)} then {isbn} end as isbn,
 case when {matches(url, rules.URL)} then {url} end as url,
 case when {matches(doi, rules.DOI)} then {doi} end as doi,
 case when {matches('abstract', '([^ \\t\\n\\r\\f]+ ){4}[^ \\t\\n\\r\\f]+')} and not {matches(abstract, rules.FOREIGN_ALPHABET)} then {abstract} end as abstract,
 {', '.join(titles)}) from {w}"""


def rebuilt_affiliations(entry: str) -> str:
    kept = (
        f"list_filter(list_transform(affiliations, lambda a: {entry}), "
        "lambda e: coalesce(e.role, e.\"orgID\", e.\"startYear\", e.\"endYear\") is not null)"
    )
    return f"case when len({kept}) > 0 then {kept} end"


def correct_persons(p: str) -> str:
    names = []
    for c in ('"firstName"', '"lastName"', '"otherNames"', '"publishedName"'):
        value = cleaned(cleaned(c, r"\(.*\)"), "^[ ]|[ ]$")
        names.append(
            f"case when {matches(c, rules.FOREIGN_ALPHABET)} or {matches(value, rules.NAME_NOISE)} then null else {value} end as {c}"
        )

    def year(f: str) -> str:
        return f"case when {matches(f, rules.AFFILIATION_YEAR)} then {f} end"

    entry = (
        "{'role': nullif(a.role, ''), 'orgID': nullif(a.\"orgID\", ''), "
        f"'startYear': {year('a.\"startYear\"')}, 'endYear': {year('a.\"endYear\"')}}}"
    )
    return f"select * replace ({', '.join(names)}, {rebuilt_affiliations(entry)} as affiliations) from {p}"


def prefer_issn(w: str) -> str:
    return f"select * replace (case when issn is not null then null else isbn end as isbn) from {w}"


REFERENCE_FIELDS = ["abstract", '"date"', "doi", "isbn", "issn", '"subTitle"', "title", "type", "url"]


def enrich_works(w: str) -> str:
    changed = ", ".join(f"coalesce(w.{c}, r.{c}) as {c}" for c in REFERENCE_FIELDS)
    kept = ", ".join(f"w.{c}" for c in WORK_COLUMNS if c not in REFERENCE_FIELDS + ["authors"])
    return f"""
select {changed}, {kept}, coalesce(w.authors, list_transform(r.authors, lambda a: a.id)) as authors
from {w} w left join v_crossRef r on w.doi = r.doi"""


def add_reference_persons(p: str, w: str) -> str:
    return f"""
select {', '.join(PERSON_TEXTS)}, affiliations from {p}
union all
select null, a."firstName", a.id, a."lastName", null, null, null
from (select unnest(r.authors) as a from {w} w join v_crossRef r on w.doi = r.doi)"""


def normalised(value: str) -> str:
    value = cleaned(cleaned(cleaned(f"lower({value})", "[,;:]", "."), "[ ]+", " "), "^ | $|['\"´`]")
    for char, to in rules.FOLDED.items():
        if len(to) > 1:
            value = f"replace({value}, {text(char)}, {text(to)})"
    single = {char: to for char, to in rules.FOLDED.items() if len(to) == 1}
    return f"translate({value}, {text(''.join(single))}, {text(''.join(single.values()))})"


def keyed(w: str) -> str:
    raw = "title || '#' || \"date\" || repeat('#', len(authors))"
    return f"""
select *, case when title is not null and "date" is not null and authors is not null
 then case when title <> '' and "date" <> '' and len(authors) > 0 then {normalised(raw)} end
 else orcid_publication_id end as key from {w}"""


def merge_works(w: str) -> str:
    return f"select {', '.join(f'max({c}) as {c}' for c in WORK_COLUMNS)} from ({keyed(w)}) group by key"


def merge_persons(p: str, w: str, affiliation_order: list[str]) -> str:
    # NULL fields sort lowest: '0' for NULL, '1' in front of a value
    parts = ", ".join(f"coalesce('1' || a.\"{f}\", '0')" for f in affiliation_order)
    texts = ", ".join(f"max({c}) as {c}" for c in PERSON_TEXTS if c != "id")
    return f"""
select id, {texts}, arg_max(affiliations, list_transform(affiliations, lambda a: [{parts}])) as affiliations
from {p} where id in (select unnest(authors) from {w}) group by id"""


def filter_contradict(p: str) -> str:
    def field(f: str) -> str:
        return f"nullif(a.\"{f}\", '')"

    wrong = f"coalesce({field('startYear')} > {field('endYear')}, false)"
    entry = (
        f"{{'role': {field('role')}, 'orgID': {field('orgID')}, "
        f"'startYear': case when not {wrong} then {field('startYear')} end, "
        f"'endYear': case when not {wrong} then {field('endYear')} end}}"
    )
    return f"select * replace ({rebuilt_affiliations(entry)} as affiliations) from {p}"


MINIMAL_WORK = "title is not null and (url is not null or doi is not null)"
MINIMAL_PERSON = (
    'id is not null and (("firstName" is not null and "lastName" is not null)'
    ' or "publishedName" is not null or "otherNames" is not null)'
)

CHAIN_VIEWS = "v_works v_persons v_orgUnits v_ROR v_lei v_fundref v_crossRef"
CORRECTED_ORDER = ["role", "orgID", "startYear", "endYear"]


def chain_steps() -> dict[str, str]:
    steps = {
        "w01": fill_from_citations("v_works"),
        "p01": add_cited_persons("v_persons", "v_works"),
        "w02": fill_from_labels("w01"),
        "w04": null_short("w02", "works"),
        "p04": null_short("p01", "persons"),
        "w05": correct_works("w04"),
        "p05": correct_persons("p04"),
        "w06": prefer_issn("w05"),
        "w07": enrich_works("w06"),
        "p07": add_reference_persons("p05", "w06"),
        "w08": fill_from_labels("w07"),
        "w09": null_short("w08", "works"),
        "p09": null_short("p07", "persons"),
        "w10": correct_works("w09"),
        "p10": correct_persons("p09"),
        "w11": prefer_issn("w10"),
        "w12": merge_works("w11"),
        "p12": merge_persons("p10", "w12", CORRECTED_ORDER),
        "p13": filter_contradict("p12"),
    }
    return {name: f"select * from ({sql})" for name, sql in steps.items()}


# --- indicators --------------------------------------------------------------------


def indicator_selects(works: str = "v_works", persons: str = "v_persons", orgs: str = "v_orgUnits") -> list[str]:
    rows: list[tuple[str, str, str, str, str, bool]] = []

    def count(condition: str) -> str:
        return f"count(*) filter (where {condition})"

    def add(metric, indicator, table, hits, base, inverse=False):
        rows.append((metric, indicator, table, hits, base, inverse))

    tables = {"works": works, "persons": persons, "orgUnits": orgs}
    for entity, fields in MIN_LENGTHS.items():
        for c, n in fields.items():
            add("MinLength", f"{entity}.{c}", tables[entity], count(f"length({c}) >= {n}"), f"count({c})")
    add("MinValue", "works.date", works, count('length("date") = 10'), 'count("date")')
    for indicator in rules.WEIGHTS["NotNull"]:
        entity, c = indicator.split(".")
        add("NotNull", indicator, tables[entity], f'count("{c}")', "count(*)")
    add("MinObject", "works", works, count(MINIMAL_WORK), "count(*)")
    add("MinObject", "persons", persons, count(MINIMAL_PERSON), "count(*)")

    years = [str(y) for y in range(2000, AS_OF_YEAR + 1)]
    for indicator, table, value, domain in (
        ("works.date", works, 'substr("date", 1, 4)', years),
        ("works.type", works, "type", rules.WORK_TYPES),
        ("works.country", persons, "country", rules.COUNTRIES),
    ):
        inside = ", ".join(text(v) for v in domain)
        seen = f"count(distinct case when {value} in ({inside}) then {value} end)"
        add("MinPopulation", indicator, table, f"{len(domain)} - {seen}", f"{len(domain)}", True)

    patterns = {
        "bibtex": rules.BIBTEX, "orcid_id": rules.OWNER_ID, "orcid_publication_id": rules.PUBLICATION_ID,
        "url": rules.URL, "doi": rules.DOI, "issn": rules.ISSN, "isbn": rules.ISBN,
        # the years 1800 to 2026, spelled out
        "date": r"^(((1[8-9][0-9]{2})|(20)(([0-1][0-9])|(2[0-6])))(-[0-9]{2}(-[0-9]{2})?)?)$",
    }
    for c, pattern in patterns.items():
        add("CorrectValue", f"works.{c}", works, count(matches(f'"{c}"', pattern)), f'count("{c}")')

    def without(c: str, *antipatterns: str) -> str:
        return " and ".join(f"not {matches(c, a)}" for a in antipatterns)

    five = matches("abstract", "([^ \\t\\n\\r\\f]+ ){4}[^ \\t\\n\\r\\f]+")
    noise = without("abstract", rules.ABSTRACT_LABEL, rules.FOREIGN_ALPHABET, rules.TEXT_NOISE)
    add("CorrectValue", "works.abstract", works, count(f"{five} and {noise}"), "count(abstract)")
    for c in ("title", "subTitle"):
        clean = without(f'"{c}"', r"[\n\r\t]", rules.FOREIGN_ALPHABET, rules.TEXT_NOISE)
        add("CorrectValue", f"works.{c}", works, count(clean), f'count("{c}")')
    add("CorrectValue", "persons.id", persons, count(matches("id", rules.PERSON_ID)), "count(id)")
    add("CorrectValue", "persons.country", persons, count(matches("country", rules.COUNTRY_CODE)), "count(country)")
    for c in ("firstName", "lastName", "publishedName", "otherNames"):
        clean = without(f'"{c}"', rules.NAME_NOISE, rules.FOREIGN_ALPHABET)
        add("CorrectValue", f"persons.{c}", persons, count(clean), f'count("{c}")')
    entries = f"(select unnest(affiliations) as a from {persons})"
    for c in ("startYear", "endYear"):
        add("CorrectValue", f"persons.affiliations.{c}", entries, count(matches(f'a."{c}"', rules.AFFILIATION_YEAR)), "count(*)")

    both = 'a."startYear" is not null and a."endYear" is not null'
    add("NoContradict", "persons.affiliations.startBeforeEnd", entries, count('a."startYear" <= a."endYear"'), count(both))
    add("NoContradict", "works.isbnXORissn", works, count("isbn is not null and issn is not null"),
        count("isbn is not null or issn is not null"), True)
    add("NoContradict", "works.isbnOnlyBook", works, count("isbn is not null and type not like '%book%'"),
        count("isbn is not null and type is not null"), True)
    for indicator in rules.WEIGHTS["UniqueValue"]:
        entity, c = indicator.split(".")
        add("UniqueValue", indicator, tables[entity], f"count(distinct {c})", f"count({c})")
    add("UniqueObject", "works", f"(select distinct key from ({keyed(works)}))", "count(*)", f"(select count(*) from {works})")

    selects = []
    for metric, indicator, table, hits, base, inverse in rows:
        indicator = indicator.replace('"', "")
        weights = rules.WEIGHTS[metric]
        share = f"case when ({base}) <> 0 then {'1 - ' if inverse else ''}({hits}) / cast(({base}) as double) else 0 end"
        selects.append(
            f"select '{metric}' as metric, cast({list(weights).index(indicator)} as int) as position, '{indicator}' as indicator,"
            f" cast({weights[indicator]} as double) as weight, cast({hits} as bigint) as hits, cast({base} as bigint) as base,"
            f" cast({share} as double) as value from {table}"
        )
    return selects


def org_mismatches(o: str = "v_orgUnits") -> str:
    # the pairs of the join, counted
    return f"""
select t.type, cast(t.n as bigint) as orgs, cast(coalesce(m.n, 0) as bigint) as mismatches
from (select type, count(*) as n from {o} where type in ('GRID', 'ROR', 'LEI', 'FUNDREF') group by type) t
left join (select o.type, count(*) as n from {o} o join ({registry_rows()}) r
  on o.type = r.type and o.id = r.id and o.name <> r.name group by o.type) m on t.type = m.type"""


def org_indicator(o: str = "v_orgUnits") -> str:
    position = list(rules.WEIGHTS["CorrectValue"]).index("orgUnits.name")
    shares = " + ".join(
        f"coalesce(max(case when type = '{t}' then 1 - mismatches / cast(orgs as double) end), 0)" for t in rules.REGISTRIES
    )
    return f"""
select 'CorrectValue' as metric, cast({position} as int) as position, 'orgUnits.name' as indicator, cast(8 as double) as weight,
 cast(sum(mismatches) as bigint) as hits, cast(sum(orgs) as bigint) as base, cast(({shares}) / 4 as double) as value
from ({org_mismatches(o)})"""


def indicators(*metrics: str) -> str:
    selects = [s for s in indicator_selects() if not metrics or s.split("'")[1] in metrics]
    if not metrics or "CorrectValue" in metrics:
        selects.append(org_indicator())
    return " union all ".join(selects)


INDICATOR_VIEWS = "v_works v_persons v_orgUnits v_ROR v_lei v_fundref"


def metric_scores() -> str:
    return """
select metric, list_sum(list(value * weight order by position)) / list_sum(list(weight order by position)) as raw_score
from ind group by metric"""


def report_steps() -> dict[str, str]:
    steps = {"ind": indicators(), "raw": metric_scores(), "scores": f"select metric, {round3('raw_score')} as score from raw"}
    selects = []
    for metric in rules.WEIGHTS:
        shown = "Correctness" if metric == "CorrectValue" else metric
        selects.append(f"select '{shown}' as indicator, score as value from scores where metric = '{metric}'")
        selects.append(f"select '{shown}.' || indicator, {round3('value')} from ind where metric = '{metric}'")
    for dimension, weights in rules.DIMENSIONS.items():
        terms = " + ".join(f"(select score from scores where metric = '{m}') * {w}::double" for m, w in weights.items())
        steps[dimension] = f"select ({terms}) / {sum(weights.values())}::double as value"
        selects.append(f"select '{dimension}', {round3('value')} from {dimension}")
        for metric in weights:
            selects.append(f"select '{dimension}.{metric}', score from scores where metric = '{metric}'")
    steps["report"] = " union all ".join(selects)
    return steps


# --- extraction from nested records ---------------------------------------------------

PUB_ID = "string_split(string_split(string_split(path, '/')[-1], '.')[1], '_works_')[-1]"
OWNER_ID = "string_split(string_split(path, '/')[-1], '_')[1]"
PUBLICATION_DATE = (
    "publication_date.year || coalesce('-' || publication_date.month || coalesce('-' || publication_date.day, ''), '')"
)
CITATION = "case when citation.type is null or citation.type = 'bibtex' then citation.value end"
NAMED_AUTHORS = (
    "list_filter(contributors, lambda c: c.credit_name is not null and (c.role is null or c.role in "
    "('author', 'http://credit.niso.org/contributor-roles/writing-original-draft/')))"
)


def external_id(id_type: str) -> str:
    last = f"list_filter(external_ids, lambda i: i.type = '{id_type}' and i.value is not null)[-1]"
    return f"coalesce({last}.normalized, {last}.value)"


AUTHORS = (
    f"list_transform({NAMED_AUTHORS}, lambda c, i: {{'id': coalesce(c.orcid, {PUB_ID} || '_' || cast(i - 1 as string)),"
    " 'otherNames': c.credit_name})"
)


def isolated_orgs(p: str = "v_raw_persons") -> str:
    return f"""
select id, name, type from (select id, name, type, row_number() over (partition by id order by name nulls first, type nulls first) as n
 from (select coalesce(a."orgID", a."orgName") as id, a."orgName" as name, a."orgIDType" as type
  from (select unnest(affiliations) as a from {p})) where id is not null) where n = 1"""


ITEM_AUTHORS = (
    "list_transform(author, lambda a, i: {'firstName': a.given, 'id': coalesce(string_split(a.\"ORCID\", '/')[-1], "
    "\"DOI\" || '_' || cast(i - 1 as string)), 'lastName': a.family})"
)

# --- monitoring --------------------------------------------------------------------------


def monitor(columns: str) -> str:
    values = """
select kind, indicator,
 max(case when chain = 'initial' and age = 1 then value end) as b1, max(case when chain = 'initial' and age = 2 then value end) as b2,
 max(case when chain = 'complete' and age = 1 then value end) as r1, max(case when chain = 'complete' and age = 2 then value end) as r2
from (select *, dense_rank() over (partition by chain, metrics order by run_seq desc) as age from v_measurements where metrics = 'complete')
group by kind, indicator"""
    rounded = f"""
select kind, indicator, {round3('b1 - b2')} as base_change, {round3('b2 - r2')} as improvement_before,
 {round3('b1 - r1')} as improvement_last from vals"""
    change = f"select *, {round3('improvement_before - improvement_last')} as improvement_change from rounded"
    return with_views("v_measurements", f"select {columns} from changes", vals=values, rounded=rounded, changes=change)


# --- all queries ----------------------------------------------------------------------------


def all_sql() -> dict[str, str]:
    def indicator_query(*metrics: str) -> str:
        return with_views(INDICATOR_VIEWS, "select metric, indicator, hits, base, value from ind", ind=indicators(*metrics))

    def chain_query(select: str) -> str:
        return with_views(CHAIN_VIEWS, select, **chain_steps())

    sql = {}
    # sources and states
    sql["q_ingest_json"] = with_views("v_works", f"select {WORKS_OUT} from v_works")
    sql["q_ingest_csv"] = with_views(
        "v_ROR v_lei v_fundref",
        "select 'ROR' as entity, id, name, \"external_ids.GRID.preferred\" as grid from v_ROR"
        " union all select 'lei', id, name, null from v_lei union all select 'fundref', uri, primary_name_display, null from v_fundref",
    )
    cut = "cast(orcid_publication_id as bigint) % 5 = 0"
    sql["q_ingest_damaged"] = with_views(
        "v_works",
        f"select 'good' as kind, orcid_publication_id as value from v_works where not ({cut})"
        f" union all select 'damaged', cast(count(*) as string) from v_works where {cut}",
    )
    sql["q_ingest_one_entity"] = with_views("v_orgUnits", "select 'orgUnits' as entity, id from v_orgUnits")
    sql["q_schema_roundtrip"] = with_views("v_persons", f"select {PERSONS_OUT} from v_persons")
    sql["q_stack_parse"] = with_views(
        "v_works", f"select {WORKS_OUT} from w2", w1=fill_from_citations("v_works"), w2=fill_from_labels("w1")
    )
    sql["q_stack_correct"] = with_views(
        "v_works", f"select {WORKS_OUT} from ({prefer_issn('w2')})", w1=null_short("v_works", "works"), w2=correct_works("w1")
    )
    sql["q_stack_filter"] = with_views("v_persons", f"select {PERSONS_OUT} from ({filter_contradict('v_persons')}) where {MINIMAL_PERSON}")
    sql["q_extract_xml_damaged"] = with_views(
        "v_raw_persons", "select case when country is null then 'good' else 'damaged' end as kind, id from v_raw_persons"
    )
    sql["q_state_roundtrip"] = with_views("v_works", f"select {WORKS_OUT} from ({prefer_issn('v_works')})")
    sql["q_state_fallback"] = with_views(
        "v_works v_persons v_orgUnits",
        f"select 'works' as entity, orcid_publication_id as id, isbn from ({prefer_issn('v_works')}) where {MINIMAL_WORK}"
        f" union all select 'persons', id, null from v_persons where {MINIMAL_PERSON}"
        " union all select 'orgUnits', id, null from v_orgUnits",
    )
    record = f"{PUB_ID} as orcid_publication_id, {OWNER_ID} as orcid_id"
    sql["q_extract_xml_persons"] = with_views(
        "v_raw_persons",
        'select id, "firstName", "lastName", country, a."startYear", a.role, a."orgName", a."orgID", a."orgIDType"'
        " from (select * exclude (affiliations), unnest(affiliations) as a from v_raw_persons)",
    )
    sql["q_extract_xml_works"] = with_views(
        "v_raw_works",
        f"select {record}, title, \"subTitle\", journal_title, abstract, type, url, {PUBLICATION_DATE} as \"date\", {CITATION} as bibtex,"
        f" {external_id('doi')} as doi, {external_id('issn')} as issn, {external_id('isbn')} as isbn,"
        f" array_to_string(list_transform({AUTHORS}, lambda a: a.id), '|') as authors from v_raw_works",
    )
    sql["q_extract_xml_registry"] = with_views("v_lei", "select id, name from v_lei")
    # extraction rules
    sql["q_extract_date_parts"] = with_views("v_raw_works", f"select pub_id, {PUBLICATION_DATE} as \"date\" from v_raw_works")
    sql["q_extract_citation"] = with_views("v_raw_works", f"select pub_id, {CITATION} as bibtex from v_raw_works")
    sql["q_extract_authors"] = with_views(
        "v_raw_works",
        "select pub_id, c.credit_name, c.role, c.orcid from (select pub_id, unnest(" + NAMED_AUTHORS + ") as c from v_raw_works)",
    )
    sql["q_extract_external_ids"] = with_views(
        "v_raw_works",
        f"select pub_id, {external_id('doi')} as doi, {external_id('issn')} as issn, {external_id('isbn')} as isbn from v_raw_works",
    )
    sql["q_author_ids"] = with_views(
        "v_raw_works",
        f"select pub_id, a.id as author_id, a.\"otherNames\" from (select pub_id, unnest({AUTHORS}) as a from v_raw_works)",
    )
    sql["q_ids_from_path"] = with_views("v_raw_works", f"select path, {record} from v_raw_works")
    sql["q_isolate_orgs"] = with_views("v_raw_persons", f"select id, name, type from ({isolated_orgs()})")
    items = "select unnest(items, recursive := false) as i from v_raw_items"
    sql["q_flatten_items"] = with_views(
        "v_raw_items",
        'select "DOI" as doi, type, title[1] as title, subtitle[1] as "subTitle", abstract, "ISBN"[1] as isbn, "ISSN"[1] as issn, "URL" as url,'
        " array_to_string(published.\"date-parts\"[1], '-') as \"date\" from items",
        items=f"select i.* from ({items})",
    )
    sql["q_read_items"] = sql["q_flatten_items"]
    sql["q_flatten_authors"] = with_views(
        "v_raw_items",
        f'select "DOI" as doi, a."firstName", a.id, a."lastName" from (select "DOI", unnest({ITEM_AUTHORS}) as a from items)',
        items=f"select i.* from ({items})",
    )
    # indicators
    for name, metric in {
        "q_not_null": "NotNull", "q_min_length": "MinLength", "q_min_value": "MinValue", "q_min_population": "MinPopulation",
        "q_min_object": "MinObject", "q_correct_value": "CorrectValue", "q_unique_value": "UniqueValue",
        "q_no_contradict": "NoContradict", "q_unique_object": "UniqueObject",
    }.items():
        sql[name] = indicator_query(metric)
    sql["q_correct_nested"] = with_views(
        INDICATOR_VIEWS, "select indicator, hits, base, value from ind where indicator like 'persons.affiliations.%'", ind=indicators("CorrectValue")
    )
    sql["q_correct_array_elements"] = with_views(
        "v_works",
        f"select 'works.authors' as indicator, count(*) filter (where {matches('a', rules.OWNER_ID)}) as hits, count(*) as base"
        " from (select unnest(authors) as a from v_works)",
    )
    years = ", ".join(f"('{y}')" for y in range(2000, AS_OF_YEAR + 1))
    types = ", ".join(f"({text(t)})" for t in rules.WORK_TYPES)
    countries = ", ".join(f"({text(c)})" for c in rules.COUNTRIES)
    sql["q_missing_values"] = with_views(
        "v_works v_persons",
        f"""select 'date' as domain, v as value from (values {years}) d(v) where v not in (select substr("date", 1, 4) from v_works where "date" is not null)
union all select 'type', v from (values {types}) d(v) where v not in (select type from v_works where type is not null)
union all select 'country', v from (values {countries}) d(v) where v not in (select country from v_persons where country is not null)""",
    )
    sql["q_correct_orgs_metric"] = with_views(
        "v_orgUnits v_ROR v_lei v_fundref",
        "select type, orgs, mismatches, 1 - mismatches / cast(orgs as double) as value from mm",
        mm=org_mismatches(),
    )
    sql["q_weighted_score"] = with_views(
        INDICATOR_VIEWS, f"select metric, {round3('raw_score')} as score from raw", ind=indicators(), raw=metric_scores()
    )
    report = report_steps()
    sql["q_quality_report"] = with_views(INDICATOR_VIEWS, "select indicator, value from report", **report)
    sql["q_dimension_scores"] = with_views(
        INDICATOR_VIEWS,
        "select indicator, value from report where indicator in ('Completeness', 'Correctness', 'Consistency')",
        **report,
    )
    sql["q_entry_count"] = with_views(
        "v_works v_persons v_orgUnits",
        "select 'persons' as entity, count(*) as rows from v_persons union all select 'affiliations', count(affiliations) from v_persons"
        " union all select 'works', count(*) from v_works union all select 'orgUnits', count(*) from v_orgUnits",
    )
    # transformations
    sql["q_parse_citation"] = with_views("v_works", f"select {WORKS_OUT} from ({fill_from_citations('v_works')})")
    sql["q_parse_citation_authors"] = with_views(
        "v_works",
        f"select orcid_publication_id, a.id, a.\"otherNames\" from (select orcid_publication_id, unnest(cited) as a from ({cited_authors('v_works')}))",
    )
    sql["q_parse_values"] = with_views("v_works", f"select orcid_publication_id, issn, isbn, doi from ({fill_from_labels('v_works')})")
    sql["q_correct_orgs"] = with_views("v_orgUnits v_ROR v_lei v_fundref", f"select id, type, name from ({correct_orgs('v_orgUnits')})")
    sql["q_correct_min_length"] = with_views(
        "v_works v_persons",
        'select \'works\' as entity, orcid_publication_id as id, title as a, journal_title as b, abstract as c, "subTitle" as d'
        f" from ({null_short('v_works', 'works')}) union all"
        f' select \'persons\', id, "firstName", "lastName", "otherNames", "publishedName" from ({null_short("v_persons", "persons")})',
    )
    corrected = correct_works("v_works")
    sql["q_correct_values_ids"] = with_views("v_works", f"select orcid_publication_id, issn, isbn, url, doi from ({corrected})")
    sql["q_correct_values_works"] = with_views("v_works", f'select orcid_publication_id, abstract, title, "subTitle" from ({corrected})')
    sql["q_correct_values_persons"] = with_views("v_persons", f"select {', '.join(PERSON_TEXTS)} from ({correct_persons('v_persons')})")
    sql["q_correct_affiliations"] = with_views("v_persons", f"select id, {AFFILIATIONS_OUT} from ({correct_persons('v_persons')})")
    sql["q_correct_contradict"] = with_views("v_works", f"select orcid_publication_id, issn, isbn from ({prefer_issn('v_works')})")
    sql["q_join_enrich"] = with_views("v_works v_crossRef", f"select {WORKS_OUT} from ({enrich_works('v_works')})")
    sql["q_union_authors"] = with_views(
        "v_works v_persons v_crossRef",
        f"select {PERSONS_OUT} from p2",
        p1=add_cited_persons("v_persons", "v_works"),
        p2=add_reference_persons("p1", "v_works"),
    )
    sql["q_normalise_text"] = with_views("v_works", f"select orcid_publication_id, {normalised('title')} as normalised from v_works")
    sql["q_duplicate_key"] = with_views("v_works", f"select orcid_publication_id, key from ({keyed('v_works')})")
    by_comma = "trim(string_split(n, ',')[1]) || ', ' || trim(string_split(n, ',')[-1])"
    by_blank = "trim(string_split(n, ' ')[-1]) || ', ' || trim(string_split(n, ' ')[1])"
    named = "title || '#' || \"date\" || '#' || part"
    sql["q_duplicate_key_names"] = with_views(
        "v_works v_persons",
        f"""select w.orcid_publication_id, case when title is not null and "date" is not null and authors is not null
 then case when title <> '' and "date" <> '' and len(authors) > 0 then {normalised(named)} end else w.orcid_publication_id end as key
from v_works w left join parts p on w.orcid_publication_id = p.orcid_publication_id""",
        one="select id, max(\"firstName\") as f, max(\"lastName\") as l, max(\"otherNames\") as o, max(\"publishedName\") as p from v_persons group by id",
        names=f"select id, case when contains(n, ',') then {by_comma} else {by_blank} end as name"
        " from (select id, coalesce(l || ', ' || f, o, p) as n from one)",
        parts="select w.orcid_publication_id, string_agg(coalesce(name, ''), '#' order by i) as part"
        " from (select orcid_publication_id, unnest(authors) as a, generate_subscripts(authors, 1) as i from v_works) w"
        " left join names on names.id = w.a group by w.orcid_publication_id",
    )
    sql["q_merge_works"] = with_views("v_works", f"select {WORKS_OUT} from ({merge_works('v_works')})")
    sql["q_merge_persons"] = with_views(
        "v_works v_persons",
        f"select {PERSONS_OUT} from ({merge_persons('v_persons', 'merged', ['endYear', 'orgID', 'role', 'startYear'])})",
        merged=merge_works("v_works"),
    )
    sql["q_filter_contradict"] = with_views("v_persons", f"select id, {AFFILIATIONS_OUT} from ({filter_contradict('v_persons')})")
    sql["q_filter_objects"] = with_views(
        "v_works v_persons",
        f"select 'works' as entity, orcid_publication_id as id from v_works where {MINIMAL_WORK}"
        f" union all select 'persons', id from v_persons where {MINIMAL_PERSON}",
    )
    sql["q_full_chain"] = chain_query(f"select {WORKS_OUT} from w12 where {MINIMAL_WORK}")
    sql["q_full_chain_orgs"] = with_views("v_orgUnits v_ROR v_lei v_fundref", f"select id, type, name from ({correct_orgs('v_orgUnits')})")
    sql["q_selected_metrics"] = with_views(
        INDICATOR_VIEWS,
        "select indicator, value from report where indicator in ('NotNull', 'UniqueObject') or indicator like 'NotNull.%' or indicator like 'UniqueObject.%'",
        **report,
    )
    sql["q_full_chain_persons"] = chain_query(f"select {PERSONS_OUT} from p13 where {MINIMAL_PERSON}")
    # samples
    sql["q_sample_extremes"] = with_views("v_works", "select title from v_works where title <> '' order by title desc limit 1000")
    sql["q_sample_nested"] = with_views(
        "v_persons",
        "select a.\"startYear\" as \"startYear\" from (select unnest(affiliations) as a from v_persons) where a.\"startYear\" <> ''"
        " order by a.\"startYear\" limit 500",
    )
    # monitoring
    sql["q_incremental_report"] = sql["q_quality_report"]
    sql["q_unique_value_approximate"] = with_views(
        "v_works",
        " union all ".join(
            f"select '{c}' as \"column\", count({c}) as base, count(distinct {c}) > 0 as near from v_works" for c in ("bibtex", "orcid_publication_id", "doi")
        ),
    )
    counts = " union all ".join(
        f"select '{chain_name}' as chain, 'count' as kind, '{entity}' as indicator, ({counted})::double as value"
        for chain_name, person, work in (("initial", "true", "true"), ("FilterObjects", MINIMAL_PERSON, MINIMAL_WORK))
        for entity, counted in (
            ("persons", f"select count(*) from v_persons where {person}"),
            ("affiliations", f"select count(affiliations) from v_persons where {person}"),
            ("works", f"select count(*) from v_works where {work}"),
            ("orgUnits", "select count(*) from v_orgUnits"),
        )
    )
    measured = (
        f"{counts} union all select 'initial', 'indicator', indicator, value from report where indicator = 'MinObject' or indicator like 'MinObject.%'"
        " union all select 'FilterObjects', 'indicator', indicator, 1.0 from report where indicator = 'MinObject' or indicator like 'MinObject.%'"
    )
    sql["q_append_measurements"] = with_views(
        INDICATOR_VIEWS,
        "select case when chain = 'initial' then n else n + 1 end::bigint as run_seq, 'MinObject' as metrics, chain, kind, indicator, value"
        " from measured, (values (1), (3)) as t(n)",
        **report,
        measured=measured,
    )
    sql["q_append_monitoring"] = with_views(
        INDICATOR_VIEWS,
        "select 1::bigint as run_seq, 'initial' as base_chain, 'FilterObjects' as result_chain, kind, indicator,"
        " 3::bigint as base_run_seq_last, 1::bigint as base_run_seq_before, 4::bigint as result_run_seq_last, 2::bigint as result_run_seq_before,"
        f" 0.0::double as base_change, {round3('b.value - r.value')} as improvement_last, 0.0::double as improvement_change"
        " from measured b join measured r using (kind, indicator) where b.chain = 'initial' and r.chain = 'FilterObjects'",
        **report,
        measured=measured,
    )
    sql["q_monitor_base"] = monitor("kind, indicator, base_change")
    sql["q_monitor_improvement"] = monitor("kind, indicator, improvement_before, improvement_last, improvement_change")
    sql["q_monitor_guard"] = with_views(
        "v_measurements",
        "select chain, metrics, count(distinct run_seq) as runs, count(distinct run_seq) >= 2 as enough from v_measurements group by chain, metrics",
    )
    return sql
