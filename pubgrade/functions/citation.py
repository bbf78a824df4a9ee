"""Values of a citation in BibTeX notation, as native expressions.

The text is cut into tokens, and a fold over them carries the depth of braces: what
stands at depth one (commas, equals and number signs, closing signs) cuts an entry
into names and operands. So braces nest to any depth. A fold copies its state at every step, so
the tokens are folded in blocks: the states between blocks first, then the cuts of every block from its
own state. Segments are joined from the tokens between two cuts, never cut out of the whole
text by character. So the time grows with the length of the text (and with definitions times
bare words). Operands are joined at number signs; a bare word must be a number, a month or a ``@string`` of
the same text, else the whole citation is unreadable (NULL) rather than wrong.
LaTeX commands that the letter table does not know stay as they are.
"""

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from pubgrade import rules

_PART = r"""(?s)@\s*+[a-zA-Z]++\s*+[{(]|[{}()",=#]|\\.|[^@{}()",=#\\]++|."""

_SPECIAL = r"""[\\{}~$%]|--|``|''"""
_COMMAND = (
    r"""\\(?:["'`^~=.]\s*(?:\{\\?[a-zA-Z]\}|\\?[a-zA-Z])"""
    r"""|[uvHckrbd](?:\{\\?[a-zA-Z]\}|\s+\\?[a-zA-Z])|[a-zA-Z]+\s*|[^a-zA-Z])"""
)
_TOKEN = rf"{_COMMAND}|[^\\]++|\\"

_ACCENTS = {
    '"': "\u0308", "'": "\u0301", "`": "\u0300", "^": "\u0302", "~": "\u0303", "=": "\u0304",
    ".": "\u0307", "u": "\u0306", "v": "\u030c", "H": "\u030b", "c": "\u0327", "k": "\u0328",
    "r": "\u030a", "b": "\u0331", "d": "\u0323",
}
_SYMBOLS = {
    "ss": "ß", "ae": "æ", "AE": "Æ", "oe": "œ", "OE": "Œ", "o": "ø", "O": "Ø", "aa": "å", "AA": "Å",
    "l": "ł", "L": "Ł", "i": "ı", "j": "ȷ", "&": "&", "%": "%", "$": "$", "#": "#", "_": "_",
    "{": "{", "}": "}", " ": " ", "textendash": "–", "textemdash": "—",
}
_GREEK = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon phi chi psi omega".split()
# commands that only change the look of their argument
_LOOKS = (
    "emph textbf textit textrm textsc textsf textsl texttt textup textmd underline mathbf mathit mathrm mathsf mathcal text mbox "
    "bf it rm sc sf sl tt em bfseries itshape rmfamily small large protect relax url"
).split()


def _letters() -> dict[str, str]:
    """Accent command plus letter -> composed letter, wherever Unicode has one."""
    composed = {}
    for command, mark in _ACCENTS.items():
        for letter in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ":
            char = unicodedata.normalize("NFC", letter + mark)
            if len(char) == 1:
                composed[command + letter] = char
    for name in _GREEK:
        full = name.upper().replace("LAMBDA", "LAMDA")
        composed[name] = unicodedata.lookup(f"GREEK SMALL LETTER {full}")
        composed[name.capitalize()] = unicodedata.lookup(f"GREEK CAPITAL LETTER {full}")
    return composed | _SYMBOLS | dict.fromkeys(_LOOKS, "")


def decode_latex(text: Column) -> Column:
    """Plain text of a LaTeX string; text without special signs is passed through."""
    # folds to one literal, where a map of 200 literals would bloat every plan
    pairs = "\n".join(f"{command}\t{char}" for command, char in _letters().items())
    table = F.str_to_map(F.lit(pairs), F.lit("\n"), F.lit("\t"))

    def plain(token: Column) -> Column:
        for pattern, replacement in (("%[^\n]*", ""), (r"[{}$]", "")):
            token = F.regexp_replace(token, pattern, replacement)
        for sign, replacement in (("~", " "), ("---", "—"), ("--", "–"), ("``", "“"), ("''", "”")):
            token = F.replace(token, F.lit(sign), F.lit(replacement))
        return token

    def decode(token: Column) -> Column:
        command = F.regexp_replace(F.substring(token, 2, 2147483647), r"(?<=.)[{}\\\s]", "")
        return F.when(
            token.startswith("\\"), F.coalesce(F.try_element_at(table, command), token)
        ).otherwise(plain(token))

    tokens = F.regexp_extract_all(text, F.lit(_TOKEN), F.lit(0))
    return F.when(text.rlike(_SPECIAL), F.array_join(F.transform(tokens, decode), "")).otherwise(text)


#: Tokens of a block; a fold copies its state at every step, so what one fold collects must stay small.
_BLOCK = 200
_STATE = "struct<depth: int, opener: string, quoted: boolean, at: int, type: string>"


def _bound(value: Column, use) -> Column:
    """``use`` of a value that is computed once, where every use of an expression would compute it anew."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _blocks(values: Column) -> Column:
    n = F.size(values)
    starts = F.sequence(F.lit(0), F.greatest(n - 1, F.lit(0)), F.lit(_BLOCK))
    return F.transform(starts, lambda s: F.slice(values, s + 1, F.lit(_BLOCK)))


def _moved(state: Column, token: Column, kind: Column) -> Column:
    """The state after a token."""
    depth, following = state["depth"], state["at"] + 1
    begins, ends = kind == "@", kind == "$"
    opens = (depth > 0) & ((token == "{") | (token.startswith("@") & token.endswith("{")))
    closes = (depth > 1) & (token == "}")
    changed = F.struct(
        F.when(begins | opens, depth + 1).when(ends | closes, depth - 1).otherwise(depth).alias("depth"),
        F.when(begins, F.substring(token, -1, 1)).otherwise(state["opener"]).alias("opener"),
        F.when(begins | ends, False).when((depth == 1) & (token == '"'), ~state["quoted"]).otherwise(state["quoted"]).alias("quoted"),
        following.alias("at"),
        F.when(begins, F.lower(F.regexp_extract(token, r"[a-zA-Z]+", 0))).when(~ends, state["type"]).alias("type"),
    )
    # most tokens only move on: text, and inside of values all but braces
    brace = token.endswith("{") | (token == "}")
    sign = (depth <= 1) & (token.startswith("@") | token.isin(")", '"'))
    return F.when(brace | sign, changed).otherwise(state.withField("at", following))


def _kind(state: Column, token: Column) -> Column:
    """What the token cuts: @ and $ for the begin and end of an entry, or a comma, equals or number sign at the first level; '' for nothing."""
    depth, opener = state["depth"], state["opener"]
    begins = (depth == 0) & token.startswith("@") & (F.char_length(token) > 1)
    ends = (depth == 1) & (((token == "}") & (opener == "{")) | ((token == ")") & (opener == "(") & ~state["quoted"]))
    divides = (depth == 1) & ~state["quoted"] & token.isin(",", "=", "#")
    return F.when(begins, "@").when(ends, "$").when(divides, token).otherwise("")


def _cuts(tokens: Column) -> Column:
    """kind, at (position of the token) and type (of the entry) of all cuts: first the states between blocks, then each block's cuts."""
    start = F.struct(F.lit(0).alias("depth"), F.lit("").alias("opener"), F.lit(False).alias("quoted"), F.lit(0).alias("at"), F.lit(None).cast("string").alias("type"))
    collected = "array<struct<kind: string, at: int, type: string>>"

    def passed(both: Column, block: Column) -> Column:
        end = F.aggregate(block, both["state"], lambda state, token: _moved(state, token, _kind(state, token)))
        return F.struct(end.alias("state"), F.array_append(both["starts"], both["state"]).alias("starts"))

    def starts(blocks: Column) -> Column:
        none = F.struct(start.alias("state"), F.array().cast(f"array<{_STATE}>").alias("starts"))
        return F.when(F.size(blocks) == 1, F.array(start)).otherwise(F.aggregate(blocks, none, passed, lambda both: both["starts"]))

    def step(both: Column, token: Column) -> Column:
        state = both["state"]

        def go_on(kind: Column) -> Column:
            moved = _moved(state, token, kind)
            cut = F.struct(kind.alias("kind"), state["at"].alias("at"), F.coalesce(moved["type"], state["type"]).alias("type"))
            return F.struct(moved.alias("state"), F.when(kind != "", F.array_append(both["cuts"], cut)).otherwise(both["cuts"]).alias("cuts"))

        return _bound(_kind(state, token), go_on)

    def of_block(block: Column, state: Column) -> Column:
        return F.aggregate(block, F.struct(state.alias("state"), F.array().cast(collected).alias("cuts")), step, lambda both: both["cuts"])

    def of_all(blocks: Column) -> Column:
        return _bound(starts(blocks), lambda states: F.flatten(F.zip_with(blocks, states, of_block)))

    return _bound(_blocks(tokens), of_all)


def _groups(tokens: Column, cuts: Column) -> Column:
    """What stands between two of the cuts @ , $: kind, type, name, closed (another one follows) and the parts (kind, text) after = and #."""

    def segment(cut: Column, i: Column) -> Column:
        following = F.coalesce(F.get(cuts, i + 1)["at"], F.size(tokens))
        text = F.array_join(F.slice(tokens, cut["at"] + 2, following - cut["at"] - 1), "")
        return F.struct(cut["kind"].alias("kind"), cut["type"].alias("type"), F.regexp_replace(text, r"^\s+|\s+$", "").alias("text"))

    def grouped(segments: Column) -> Column:
        def group(border: Column, i: Column, borders: Column) -> Column:
            first, following = F.get(segments, border), F.get(borders, i + 1)
            parts = F.slice(segments, border + 2, F.coalesce(following, F.size(segments)) - border - 1)
            return F.struct(
                first["kind"].alias("kind"), first["type"].alias("type"), F.lower(first["text"]).alias("name"), following.isNotNull().alias("closed"), parts.alias("parts")
            )

        places = F.transform(segments, lambda s, i: F.when(s["kind"].isin("@", ",", "$"), i))
        borders = F.filter(places, lambda p: p.isNotNull())
        return _bound(borders, lambda found: F.transform(found, lambda border, i: group(border, i, found)))

    return _bound(F.transform(cuts, segment), grouped)


def _operand(text: Column, words: Column, place: Column) -> Column:
    """Value of an operand: enclosed text, a number or a word that is defined before ``place``; NULL if it is none of these."""
    enclosed = text.rlike(r'^[{"]') & (F.char_length(text) > 1)
    word = F.get(F.filter(words, lambda w: (w["name"] == F.lower(text)) & (w["place"] < place)), F.lit(0))["value"]
    inner = F.substring(text, F.lit(2), F.char_length(text) - 2)
    return F.when(enclosed, inner).when(text.rlike(r"^[0-9]+$"), text).when(text != "", word).otherwise("")


def _value(parts: Column, words: Column, place: Column) -> Column:
    """The operands from the last equals sign on, joined; NULL without one or if one of them is NULL."""

    def joined(value: Column, part: Column) -> Column:
        operand = _operand(part["text"], words, place)
        return F.when(part["kind"] == "=", operand).otherwise(F.concat(value, operand))

    only = F.get(parts, F.lit(0))
    alone = (F.size(parts) == 1) & (only["kind"] == "=")
    return F.when(alone, _operand(only["text"], words, place)).when(F.size(parts) > 0, F.aggregate(parts, F.lit(None).cast("string"), joined))


def _read(groups: Column) -> Column:
    """Struct of the number of entries, whether an operand was unreadable, and the pairs in order."""
    months = F.array(*[F.struct(F.lit(m[:3].lower()).alias("name"), F.lit(m).alias("value"), F.lit(-1).alias("place")) for m in rules.MONTHS])
    placed = F.transform(groups, lambda g, i: g.withField("place", i))
    defined = F.filter(placed, lambda g: (g["type"] == "string") & (F.size(g["parts"]) > 0) & g["closed"])

    def define(words: Column, g: Column) -> Column:
        value = _value(g["parts"], words, g["place"])
        word = F.struct(g["name"].alias("name"), value.alias("value"), g["place"].alias("place"))
        return F.when(value.isNotNull(), F.array_append(words, word)).otherwise(words)

    def read(words: Column) -> Column:
        def unreadable(g: Column, i: Column) -> Column:
            parts = g["parts"]
            twice = g["type"].isin(rules.CITATION_TYPES) & (F.size(parts) > 1) & (F.size(F.filter(parts, lambda p: p["kind"] == "=")) > 1)
            return (g["type"].isin(rules.CITATION_TYPES) | (g["type"] == "string")) & (twice | F.exists(parts, lambda p: _operand(p["text"], words, i).isNull()))

        fields = F.transform(
            groups,
            lambda g, i: F.when(
                g["closed"] & g["type"].isin(rules.CITATION_TYPES), F.struct(g["name"].alias("name"), _value(g["parts"], words, i).alias("value"))
            ),
        )
        return F.struct(
            F.size(F.filter(groups, lambda g: (g["kind"] == "$") & g["type"].isin(rules.CITATION_TYPES))).alias("entries"),
            F.exists(F.transform(groups, unreadable), lambda b: F.coalesce(b, F.lit(False))).alias("bad"),
            F.filter(fields, lambda f: f["value"].isNotNull()).alias("pairs"),
        )

    return _bound(F.aggregate(defined, months, define), read)


def citation_fields(citation: Column, names: list[str]) -> Column:
    """Array of (name, value) of the only entry; NULL for none, several or unreadable entries.

    Holds the given names with a non-empty value, decoded. The last of several
    fields with one name counts, so the array is reversed. Entries of other types do
    not count.
    """

    def pairs(found: Column) -> Column:
        trimmed = F.transform(
            found["pairs"], lambda f: F.struct(f["name"].alias("name"), F.regexp_replace(f["value"], "\n[ \t]+", "\n").alias("value"))
        )
        wanted = F.filter(trimmed, lambda f: f["name"].isin(names) & (f["value"] != ""))
        decoded = F.transform(wanted, lambda f: F.struct(f["name"].alias("name"), decode_latex(f["value"]).alias("value")))
        return F.when((found["entries"] == 1) & ~found["bad"], F.reverse(F.filter(decoded, lambda f: f["value"] != "")))

    tokens = F.regexp_extract_all(citation, F.lit(_PART), F.lit(0))
    groups = _bound(tokens, lambda parts: _bound(_cuts(parts), lambda cuts: _groups(parts, cuts)))
    return F.when(citation.contains("@"), _bound(_bound(groups, _read), pairs))


def field_value(fields: str, *names: str) -> Column:
    """Value of the first of the names that has one; ``fields`` is the column of the pairs."""
    values = [f"get(filter({fields}, f -> f.name = '{name}'), 0).value" for name in names]
    return F.expr(f"coalesce({', '.join(values)})")


def split_authors(authors: Column, publication_id: Column) -> Column:
    """``name/id and name and ...`` -> array of (id, otherNames).

    Authors without an id get the publication id and their position.
    """

    def author(text: Column, position: Column) -> Column:
        parts = F.split(text, "/")
        own_id = F.concat(publication_id, F.lit("_"), position.cast("string"))
        return F.struct(
            F.when(F.size(parts) == 2, F.get(parts, F.lit(1))).otherwise(own_id).alias("id"),
            F.get(parts, F.lit(0)).alias("otherNames"),
        )

    return F.transform(F.split(authors, " and "), author)
