"""SQL for the corpus queries that SQL can express, written apart from the operators."""

_WORDS = r"list_filter(regexp_split_to_array(coalesce({0}, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '')"
_LOWERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

URL_RULES = """
with cut as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) else '' end as rest from pages),
parsed as (
  select page_id, regexp_extract(rest, '^[^/?#]*') as raw, rest from cut),
target as (
  select page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') as path from parsed),
site(rule, domain, prefix, verdict) as (values
  ('com/', 'com', '/', 'allow'), ('example.com/en/', 'example.com', '/en/', 'block'),
  ('www.example.com/en/', 'www.example.com', '/en/', 'allow'), ('net/es/', 'net', '/es/', 'block'), ('net/fr/', 'net', '/fr/', 'block')),
hits as (
  select page_id, arg_max(rule, length(rule)) as rule, arg_max(s.verdict, length(rule)) as verdict
  from target, site s
  where (host = domain or ends_with(host, '.' || domain)) and starts_with(path, prefix)
  group by page_id)
select t.page_id, t.host, t.path, h.rule, coalesce(h.verdict, case when regexp_matches(t.host || t.path,
  '(?:[^A-Za-z0-9]|^)(?:adserver|adult|bets|betting|casino|escort|malware|phishing|pills|poker|porn|track|viagra|xxx)(?:[^A-Za-z0-9]|$)')
  then 'block' else 'allow' end) as verdict
from target t left join hits h using (page_id)
"""

QUALITY = f"""
with cut as (
  select doc_id, coalesce(lang, '') as lang, coalesce(source, '') as source, coalesce(text, '') as text,
    {_WORDS.format("text")} as words,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\\x20\\x09-\\x0D]')) as lines
  from documents),
windows as (
  select doc_id, i, array_to_string(words[i:i + 7], ' ') as w from cut, unnest(range(1, len(words) - 6)) as t(i)),
starts as (
  select doc_id, i from windows qualify count(*) over (partition by doc_id, w) > 1),
covered as (
  select doc_id, count(distinct i + k) as n from starts, range(8) as r(k) group by doc_id),
counted as (
  select doc_id, lang, source, len(words)::bigint as n_words, length(array_to_string(words, ''))::bigint as word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::bigint as n_symbols, len(lines)::bigint as n_lines,
    (len(lines) - len(list_distinct(lines)))::bigint as n_dup_lines, coalesce(n, 0)::bigint as n_repeat_words
  from cut left join covered using (doc_id)),
measured as (
  select *, n_words < 20 or 100 * n_repeat_words > 30 * n_words as base_failed,
    n_symbols * 10000 // greatest(word_chars, 1) as symbols, n_dup_lines * 10000 // greatest(n_lines, 1) as lines,
    n_repeat_words * 10000 // greatest(n_words, 1) as repeats, 100 * word_chars // greatest(n_words, 1) as length
  from counted),
long as (
  select lang, source, measure, (value >> greatest(length(bin(value)) - 6, 0)) << greatest(length(bin(value)) - 6, 0) as bucket
  from (unpivot (select * from measured where not base_failed) on symbols, lines, repeats, length into name measure value value)),
margins(measure, below, above) as (values ('symbols', null, 100), ('lines', null, 2000), ('repeats', null, 2000), ('length', 100, 100)),
quartiles as (
  select lang, source, measure, count(*) as docs, quantile_disc(bucket, 0.25) as q25, quantile_disc(bucket, 0.75) as q75
  from long group by grouping sets ((lang, source, measure), (lang, measure), (measure))),
fences as (
  select lang, source, measure, docs, q25 - 3 * (q75 - q25) - below as low, q75 + 3 * (q75 - q25) + above as high
  from quartiles join margins using (measure)),
judged as (
  select m.doc_id, bool_and(coalesce(v.value >= f.low, true) and coalesce(v.value <= f.high, true)) as inside
  from measured m
  join (unpivot (select doc_id, symbols, lines, repeats, length from measured) on symbols, lines, repeats, length
    into name measure value value) v on v.doc_id = m.doc_id
  join fences own on own.lang = m.lang and own.source = m.source and own.measure = v.measure
  join fences by_lang on by_lang.lang = m.lang and by_lang.source is null and by_lang.measure = v.measure
  join fences of_all on of_all.lang is null and of_all.source is null and of_all.measure = v.measure
  join fences f on f.measure = v.measure and f.lang is not distinct from case when own.docs >= 50 or by_lang.docs >= 50 then m.lang end
    and f.source is not distinct from case when own.docs >= 50 then m.source end
  group by m.doc_id)
select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  not base_failed and coalesce(inside, true) as kept
from measured left join judged using (doc_id)
"""

NEAR_DUPLICATES = f"""
with recursive cut as (
  select doc_id, {_WORDS.format(_LOWERED)} as w from documents),
sets as (
  select distinct doc_id, array_to_string(w[i:i + 3], ' ') as s from cut, unnest(range(1, greatest(len(w) - 2, 2))) as t(i) where len(w) > 0),
sizes as (
  select doc_id, count(s) as n from documents left join sets using (doc_id) group by doc_id),
common as (
  select a.doc_id as u, b.doc_id as v, count(*) as c from sets a join sets b on a.s = b.s and a.doc_id < b.doc_id group by all),
links as (
  select u, v from common join sizes x on x.doc_id = u join sizes y on y.doc_id = v where 100 * c >= 80 * (x.n + y.n - c)),
both_ways as (
  select u, v from links union all select v, u from links),
reach(doc_id, r) as (
  select doc_id, doc_id from documents union select reach.doc_id, v from reach join both_ways on u = r)
select doc_id, n as n_shingles, min(r) as component_id, doc_id = min(r) as kept
from reach join sizes using (doc_id) group by doc_id, n
"""

WARC = """
with heads as (
  select page_id, octet_length(encode(coalesce(html, '')))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages),
firsts as (
  select payload_digest, min(page_id) as page from heads where payload_bytes >= 100 group by payload_digest)
select page_id, payload_bytes, payload_digest, case when page <> page_id then 'revisit' else 'response' end as record_type,
  case when page <> page_id then page end as refers_to
from heads left join firsts using (payload_digest)
"""

_UNITS = (
    "km|kilometers?|kilometres?|m|meters?|metres?|cm|mm|miles?|feet|foot|ft|inch(?:es)?|kg|kilograms?|g|grams?|mg|lbs?|pounds?|ounces?|oz|"
    "l|liters?|litres?|ml|seconds?|s|minutes?|min|hours?|h|days?|weeks?|months?|years?|dollars?|cents?|euros?|percent|degrees?"
)


def _template(column: str) -> str:
    name = r"([\p{Ll}\p{N},;>] )\p{Lu}[\p{L}''-]*"
    steps = [
        (r"[0-9]+(?:[.,:/][0-9]+)*", "<num>"),
        (r"[$€£¥]<num>", "<unit><num>"),
        (rf"(<num> ?)(?:%|(?:{_UNITS})\b)", r"\1<unit>"),
        (name, r"\1<name>"),
        (name, r"\1<name>"),
        (r"([\p{L}\p{N}>])[.,;:!?)]+([\x20\x09-\x0D]|$)", r"\1\2"),
    ]
    for pattern, by in steps:
        column = f"regexp_replace({column}, '{pattern}', '{by}', 'g')"
    return f"lower({column})"


def _cut(table: str, key: str) -> str:
    return f"select {key}, {_WORDS.format('text')} as raw, {_WORDS.format(_template('text'))} as words from {table}"


def _grams(table: str, key: str) -> str:
    return f"select {key}, i - 1 as pos, words[i:i + 7] as ws from {table}, unnest(range(1, len(words) - 6)) as t(i)"


_VALUE = "lower(regexp_replace({0}, '[.,;:!?)]+$', ''))"

LEAKS = f"""
with items as ({_cut("benchmark", "item_id")}),
docs as ({_cut("documents", "doc_id")}),
item_grams as ({_grams("items", "item_id")}),
doc_grams as ({_grams("docs", "doc_id")}),
firsts as (
  select item_id, ws, min(pos) as pos from item_grams where len(list_filter(ws, lambda x: not contains(x, '<'))) >= 4 group by item_id, ws),
counts as (
  select item_id, count(*) as n from firsts group by item_id),
matches as (
  select distinct doc_id, item_id, f.pos, d.pos - f.pos as diagonal from doc_grams d join firsts f on d.ws = f.ws),
candidates as (
  select doc_id, item_id, diagonal, count(*) as n_windows, min(pos) as low, max(pos) as high
  from matches join counts using (item_id) group by doc_id, item_id, diagonal, n having count(*) >= least(6, ceil(n / 2))),
slots as (
  select distinct doc_id, item_id, diagonal, {_VALUE.format("i.raw[p + 1]")} as iv, {_VALUE.format("d.raw[p + 1 + diagonal]")} as dv
  from candidates c join items i using (item_id) join docs d using (doc_id), unnest(range(low, high + 8)) as r(p)
  where contains(i.words[p + 1], '<') and i.words[p + 1] = d.words[p + 1 + diagonal]),
lines as (
  select doc_id, item_id, diagonal, count(*) <> count(distinct iv) as clash, bool_or(iv is distinct from dv) as other
  from slots group by doc_id, item_id, diagonal)
select doc_id, item_id, max(n_windows) as n_windows, bool_or(not coalesce(other, false)) as exact
from candidates left join lines using (doc_id, item_id, diagonal)
where not coalesce(clash, false) group by doc_id, item_id
"""

_FIELD = "coalesce(octet_length(encode(cast({0} as varchar))) || ':' || {0}, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_FIELD.format(f) for f in ("doc_id", "source", "lang", "n_chars", text)) + ")"


def _levels(name: str, count: int) -> str:
    """Tables ``name``0 (tree, pos, node, total) to ``name``count: all levels of all trees, and ``name``r0 to ...: their runs."""
    parts = []
    for k in range(count):
        parts.append(
            f"{name}r{k} as (select tree, pos // 16 as up, string_agg(node, '' order by pos) as run, any_value(total) as total from {name}{k} group by all),\n"
            f"{name}{k + 1} as (select tree, up as pos, case when total = 1 then run else sha256(run) end as node, (total + 15) // 16 as total from {name}r{k})"
        )
    return ",\n".join(parts)


def _folds(name: str, count: int, start: str, columns: str) -> str:
    """Tables ``name``f0 (as ``start``) to ``name``fcount: node and siblings of every row, folded level by level."""
    parts = [f"{name}f0 as ({start})"]
    for k in range(count):
        left, right = "substr(run, 1, 64 * (pos % 16))", "substr(run, 64 * (pos % 16) + 65)"
        parts.append(
            f"{name}f{k + 1} as (select {columns}, tree, pos // 16 as pos, siblings || {left} || {right} as siblings,\n"
            f"  case when r.total = 1 then node else sha256({left} || node || {right}) end as node\n"
            f"  from {name}f{k} join {name}r{k} r using (tree) where r.up = pos // 16)"
        )
    return ",\n".join(parts)


_TAMPERED = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_BITS = "[-1, -1, -1, -1, -1, -1, -1, -1]"
#: Bit by bit: a byte (0 to 255) is taken in, -1 is one shift.
_CRC = (
    f"xor(list_reduce(flatten(list_transform(string_split(cast(doc_id as varchar), ''), lambda c: list_prepend(ascii(c), {_BITS}))),"
    " lambda c, x: case when x >= 0 then xor(c, x) else xor(c >> 1, 3988292384 * (c & 1)) end, 4294967295::bigint), 4294967295)"
)

#: Eight levels a tree: sources of up to 4 thousand million documents.
MANIFEST = f"""
with leaves as (
  select doc_id, coalesce('+' || source, '') as tree, {_leaf("text")} as leaf,
    case when {_CRC} % 5 = 0 then {_leaf(_TAMPERED)} end as tampered from documents),
placed as (
  select *, row_number() over (partition by tree order by doc_id nulls first, leaf) - 1 as pos, count(*) over (partition by tree) as total from leaves),
d0 as (select tree, pos, leaf as node, total from placed),
{_levels("d", 8)},
s0 as (
  select '' as tree, tree as source, row_number() over (order by tree) - 1 as pos, node, count(*) over () as total from d8),
{_levels("s", 8)},
{_folds("d", 8, "select doc_id, leaf, tree as source, tree, pos, '' as siblings, coalesce(tampered, leaf) as node from placed", "doc_id, leaf, source")},
{_folds("s", 8, "select doc_id, leaf, s0.node as subroot, '' as tree, s0.pos, siblings, df8.node from df8 join s0 using (source)", "doc_id, leaf, subroot")}
select doc_id, leaf, subroot, root.node as root, sha256(siblings) as proof_sha256, f.node as folded_root, f.node = root.node as verified
from sf8 f, s8 root
"""

def _cuts(width: int) -> str:
    values = [
        f"select phrase, lang, {k} as k, (select f from counted c where c.lang = g.lang and c.size = {k} and c.words = g.words[1:{k}]) as l,\n"
        f"  (select f from counted c where c.lang = g.lang and c.size = {width - k} and c.words = g.words[{k + 1}:{width}]) as r from frequent g where size = {width}"
        for k in range(1, width)
    ]
    return "\nunion all ".join(values)


COLLOCATIONS = rf"""
with pieces as (
  select doc_id, coalesce(lang, 'und') as lang, unnest(regexp_split_to_array({_LOWERED}, '[.,;:!?\x0A-\x0D]')) as piece from documents),
cut as (
  select lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') as w from pieces),
counted as (
  select lang, size, w[i:i + size - 1] as words, count(*) as f
  from cut, unnest([1, 2, 3, 4]) as s(size), unnest(range(1, len(w) - size + 2)) as t(i) group by all),
totals as (
  select lang, sum(f)::bigint as n from counted where size = 1 group by lang),
frequent as (
  select *, array_to_string(words, ' ') as phrase from counted where f >= 30 and size > 1),
cuts as ({_cuts(2)}
union all {_cuts(3)}
union all {_cuts(4)}),
best as (
  select lang, phrase, min((2000000::hugeint * f // (l + r))) as score, arg_min(l, ((2000000::hugeint * f // (l + r)) * 4 + k)) as l,
    arg_min(r, ((2000000::hugeint * f // (l + r)) * 4 + k)) as r
  from cuts join frequent using (lang, phrase) group by lang, phrase),
longest as (
  select lang, part, max(f) as f from (
    select lang, f, unnest([array_to_string(words[1:size - 1], ' '), array_to_string(words[2:size], ' ')]) as part from frequent where size > 2)
  group by lang, part),
kept as (
  select b.*, g.f from best b join frequent g using (lang, phrase) left join longest o on o.lang = b.lang and o.part = b.phrase
  where coalesce(100 * o.f < 80 * g.f, true))
select lang, row_number() over (partition by lang order by score desc, f desc, phrase) as rank, phrase, f as a, l, r, n, score::bigint as score
from kept join totals using (lang) qualify rank <= 2000
"""


def llm_sql() -> dict[str, str]:
    return {
        "op4_url_rules": URL_RULES,
        "op5_adaptive_quality": QUALITY,
        "op6_minmax_near_duplicates": NEAR_DUPLICATES,
        "op9_template_leaks": LEAKS,
        "op10_warc_revisits": WARC,
        "op11_tiled_collocations": COLLOCATIONS,
        "op13_merkle_manifest": MANIFEST,
    }
