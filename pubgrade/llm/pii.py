"""Personal data in texts, also in disguise, with places in the source text.

Base: email addresses, IP addresses, card and phone numbers by their patterns, leftmost
and non-overlapping for each kind; a match that fails its check (parts up to 255, the Luhn
sum, the number of digits) is dropped without a second try.

Disguises are undone by transducers, each of which rewrites a text and keeps, for every
sign it writes, the source signs it stands for:

* signs: look-alike letters of other scripts, digits of any script, wide and mathematical
  forms, dashes, dots and blanks become ASCII; invisible signs go;
* digits: runs of at least three spelled digits (English, German, French, Spanish; mixed
  with figures) become figures, "dot" or "point" between them a full stop, "plus" before them +;
  the letters O, o, l and I between figures become 0 and 1;
* addresses: "at" and "dot" in brackets, "name @ host . com", character references, and
  bare "name at host dot com" where both words are spelled out in one of the four languages
  and the host ends as hosts do.

The patterns then run on the rewritten text. A match counts if it holds a rewritten sign
and, mapped back, overlaps no base span of its kind; an address must also end in
letters. Spans are code points of the source text, end exclusive.

Rows (``find_spans``): doc_id, spans (kind, start, end, base), sorted by start, then kind. Null and empty texts
have no spans; repeated ids or rows count each; other columns are ignored; an empty
table gives no rows. ``redact`` keeps all columns and writes the kind over every span.
All scans are linear in the text, whatever it holds.
"""

import re
import unicodedata
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KINDS = ("email", "ip", "card", "phone")

Span = tuple[int, int]

#: The signs of an address, and the patterns of the contract. Runs are possessive and start where a run starts, so no text takes more than linear time.
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_HOST = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
_IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
_IP_LIKE = re.compile(r"\.[0-9]++\.[0-9]++\.[0-9]")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_NO_DIGIT = re.compile(r"[^0-9]+")


def emails(text: str) -> Iterator[Span]:
    done = 0
    at = text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in _LOCAL:
            start -= 1
        host = _HOST.match(text, at + 1) if start < at else None
        if host:
            yield start, host.end()
        done = host.end() if host else at + 1
        at = text.find("@", done)


def ips(text: str) -> Iterator[Span]:
    for m in _IP.finditer(text) if _IP_LIKE.search(text) else ():
        if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m.groups()):
            yield m.span()


def luhn(digits: str) -> bool:
    doubled = sum(sum(divmod(2 * int(d), 10)) for d in digits[-2::-2])
    return (doubled + sum(map(int, digits[::-2]))) % 10 == 0


def cards(text: str) -> Iterator[Span]:
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 14:
            digits = _NO_DIGIT.sub("", m[0])
            if 14 <= len(digits) <= 19 and luhn(digits):
                yield m.span()


def phones(text: str) -> Iterator[Span]:
    if "+" in text:
        for m in _PHONE.finditer(text):
            if 10 <= len(_NO_DIGIT.sub("", m[0])) <= 15:
                yield m.span()


FINDERS: dict[str, Callable[[str], Iterator[Span]]] = {"email": emails, "ip": ips, "card": cards, "phone": phones}


class Tape:
    """A rewritten text: for every sign the source signs [start, end) it stands for, and whether it was rewritten."""

    def __init__(self, text: str):
        self.text = text
        self.starts = np.arange(len(text), dtype=np.int64)
        self.ends = self.starts + 1
        self.new = np.zeros(len(text), bool)

    def rewrite(self, changes: list[tuple[int, int, str]]) -> None:
        """Replaces ascending [start, end) of the text; every new sign stands for the whole of its change."""
        if not changes:
            return
        texts, starts, ends, new, done = [], [], [], [], 0
        for start, end, by in changes:
            source = (int(self.starts[start]), int(self.ends[end - 1]))
            texts += [self.text[done:start], by]
            starts += [self.starts[done:start], np.full(len(by), source[0])]
            ends += [self.ends[done:start], np.full(len(by), source[1])]
            new += [self.new[done:start], np.ones(len(by), bool)]
            done = end
        self.text = "".join([*texts, self.text[done:]])
        self.starts, self.ends = np.concatenate([*starts, self.starts[done:]]), np.concatenate([*ends, self.ends[done:]])
        self.new = np.concatenate([*new, self.new[done:]])

    def source(self, span: Span) -> Span | None:
        """The span in the source text, None if it holds no rewritten sign."""
        start, end = span
        return (int(self.starts[start]), int(self.ends[end - 1])) if self.new[start:end].any() else None


#: Letters of other scripts that look like Latin ones.
LOOKALIKES = {
    "АаВСсЕеНІіЈјКМОоРрЅѕТХхУуԛԝһӏ": "AaBCcEeHIiJjKMOoPpSsTXxYyqwhl",
    "ΑΒΕΖΗΙΚΜΝΟοΡΤΥΧνκι": "ABEZHIKMNOoPTYXvki",
    "աօոսցհ": "wonugh",
    "ıȷɑɡɩ": "ijagi",
    "。．․‧∙•·﹒": "........",
    "﹫": "@",
    "‐‑‒–—―−﹣⁃": "---------",
    "﹢": "+",
}
_GONE = 0xFFFFFFFF
#: Code points with an entry in the table of signs.
_TABLE_SIZE = 0x20000


def _sign_table() -> np.ndarray:
    """By code point: the ASCII sign that it stands for, _GONE for invisible signs, else itself."""
    table = np.arange(_TABLE_SIZE, dtype=np.uint32)
    for code in range(0x80, _TABLE_SIZE):
        char = chr(code)
        kind = unicodedata.category(char)
        if kind == "Cf":
            table[code] = _GONE
        elif kind == "Zs":
            table[code] = 32
        elif kind == "Nd":
            table[code] = 48 + unicodedata.decimal(char)
        elif kind != "Cs" and (code >= 0x2100) and len(plain := unicodedata.normalize("NFKC", char)) == 1 and plain.isascii():
            table[code] = ord(plain)
    for signs, plain in LOOKALIKES.items():
        table[[ord(c) for c in signs]] = [ord(c) for c in plain]
    return table


_SIGNS = _sign_table()


def undo_signs(tape: Tape) -> None:
    if tape.text.isascii():
        return
    codes = np.frombuffer(tape.text.encode("utf-32-le", "surrogatepass"), "<u4")
    plain = np.where(codes < _TABLE_SIZE, _SIGNS[np.minimum(codes, _TABLE_SIZE - 1)], codes)
    changed = plain != codes
    if changed.any():
        kept = plain != _GONE
        tape.text = plain[kept].astype("<u4").tobytes().decode("utf-32-le", "surrogatepass")
        tape.starts, tape.ends = tape.starts[kept], tape.ends[kept]
        # next to an invisible sign counts as rewritten
        gone = ~kept
        tape.new = (changed | np.append(gone[1:], False) | np.insert(gone[:-1], 0, False))[kept]


#: Spelled digits.
DIGIT_WORDS = {
    "en": "zero one two three four five six seven eight nine",
    "de": "null eins zwei drei vier fünf sechs sieben acht neun",
    "fr": "zéro un deux trois quatre cinq six sept huit neuf",
    "es": "cero uno dos tres cuatro cinco seis siete ocho nueve",
}
_DIGITS = {word: str(k) for words in DIGIT_WORDS.values() for k, word in enumerate(words.split())} | {"oh": "0"}
_POINTS = {"dot": ".", "point": ".", "punkt": ".", "punto": ".", "dash": "-", "hyphen": "-", "plus": "+"}
#: A run has at least one of these, so texts without any are not searched.
_TELLING = [w for w in _DIGITS if w not in ("one", "un", "uno", "oh", "eins")]
_NUMBER = "|".join(sorted(_DIGITS, key=len, reverse=True))
_GAP = r"[\x20\t\n,-]{1,3}"
_SPELLED = re.compile(
    rf"(?i)(?<![^\W_])(?:plus{_GAP})?(?:{_NUMBER})(?![^\W_])(?:[\x20\t\n,.-]{{1,3}}(?:{_NUMBER}|{'|'.join(_POINTS)}|[0-9]+)(?![^\W_]))++"
)
_TOKEN = re.compile(r"[^\W_]+")
_MIXED = re.compile(r"(?<![^\W_])[+]?(?=[^\W_]*[0-9])[0-9OolI][0-9OolI.\x20-]*[0-9OolI](?![^\W_])")
_LETTER_IN_NUMBER = re.compile(r"[0-9][OolI]|[OolI][0-9]")
_POINTED = re.compile(r"(?i)(?<=[0-9])\x20(?:dot|punto|point|punkt)\x20(?=[0-9])")
_LETTERS = {"O": "0", "o": "0", "l": "1", "I": "1"}


def _has_word(text: str, word: str) -> bool:
    at = text.find(word)
    while at >= 0:
        if not text[at - 1 : at].isalnum() and not text[at + len(word) : at + len(word) + 1].isalnum():
            return True
        at = text.find(word, at + 1)
    return False


def undo_digits(tape: Tape) -> None:
    low = tape.text.lower()
    if any(_has_word(low, word) for word in _TELLING):
        changes: list[tuple[int, int, str]] = []
        for run in _SPELLED.finditer(tape.text):
            tokens = [(m.start(), m.end(), m[0].lower()) for m in _TOKEN.finditer(tape.text, *run.span())]
            while tokens and tokens[-1][2] in _POINTS:
                tokens.pop()
            if sum(word in _DIGITS for *_, word in tokens) < 3:
                continue
            for k, (start, end, word) in enumerate(tokens):
                # blanks after a spelled sign go with it
                last = k + 1 == len(tokens)
                spelled = word in _DIGITS or word in _POINTS
                joined = not last and (spelled or tokens[k + 1][2] in _POINTS or tokens[k + 1][2] in _DIGITS) and not tape.text[end : tokens[k + 1][0]].strip(" \t\n")
                if spelled:
                    changes.append((start, tokens[k + 1][0] if joined else end, _DIGITS.get(word) or _POINTS[word]))
                elif joined:
                    changes.append((end, tokens[k + 1][0], ""))
        tape.rewrite(changes)
    if " dot " in low or " punto " in low or " point " in low or " punkt " in low:
        tape.rewrite([(*m.span(), ".") for m in _POINTED.finditer(tape.text)])
    if _LETTER_IN_NUMBER.search(tape.text):
        changes = []
        for run in _MIXED.finditer(tape.text):
            letters = [m.start() for m in re.finditer(r"[OolI]", run[0])]
            if letters and len(letters) <= sum(map(run[0].count, "0123456789")):
                changes += [(run.start() + k, run.start() + k + 1, _LETTERS[run[0][k]]) for k in letters]
        tape.rewrite(changes)


#: Spelled signs of addresses; a bare one belongs to its own language.
AT_DOT = {"at": ("dot", "punkt"), "arroba": ("punto",), "arobase": ("point",), "klammeraffe": ("punkt",), "@": ("dot", "punkt", "punto", "point")}
_JOINTS = {"dash": "-", "hyphen": "-", "underscore": "_"}
#: Endings of a host with bare signs; those that are English words are left out.
ENDINGS = frozenset("com org net edu gov mil int info biz io co uk de fr es eu ch ca au jp cn ru nl se pl br mx ar cl example test".split())
_DOT_WORDS = "dot|punto|point|punkt"
_SPELLED_DOTS = [f" {word} " for word in _DOT_WORDS.split("|")]
_OPEN, _CLOSE = r"[\[({<]", r"[\])}>]"
_BRACKET_AT = re.compile(rf"(?i){_OPEN}\x20?(?:at|arroba|arobase|klammeraffe|ät|a|@)\x20?{_CLOSE}[\x20\t]{{0,2}}")
_BRACKET_DOT = re.compile(rf"(?i){_OPEN}\x20?(?:{_DOT_WORDS}|\.)\x20?{_CLOSE}[\x20\t]{{0,2}}")
_REFERENCE_AT = re.compile(r"(?i)&(?:#0*64|#x0*40|commat);")
_REFERENCE_DOT = re.compile(r"(?i)&(?:#0*46|#x0*2e|period);")
_BARE_AT = re.compile(r"(?i)(?<=[A-Za-z0-9_%+-])(?:\x20(at|arroba|arobase|klammeraffe|@)\x20|(@))(?=[A-Za-z0-9])")
#: One label of a host and the sign after it; labels of more than 63 signs are none.
_LABEL = re.compile(rf"(?i)([A-Za-z0-9-]{{1,63}})(?:\x20({_DOT_WORDS}|\.)\x20|(\.))?(?=([A-Za-z0-9])?)")
_BEFORE = re.compile(r"(?i)\x20(dot|punto|point|punkt|dash|hyphen|underscore)\x20[A-Za-z0-9]{1,63}$")
#: Signs before a bare "at" in which a word of its name and the sign before it stand.
_NAME_SIGNS = 80


def undo_addresses(tape: Tape) -> None:
    text = tape.text
    if "[" in text or "(" in text or "{" in text or "<" in text:
        for pattern, by in ((_BRACKET_AT, "@"), (_BRACKET_DOT, ".")):
            # blanks before it go with it
            found = [(len(tape.text[max(m.start() - 2, 0) : m.start()].rstrip(" \t")) + max(m.start() - 2, 0), m.end(), by) for m in pattern.finditer(tape.text)]
            tape.rewrite([c for k, c in enumerate(found) if not k or c[0] >= found[k - 1][1]])
    if "&" in text:
        tape.rewrite([(*m.span(), "@") for m in _REFERENCE_AT.finditer(tape.text)])
        tape.rewrite([(*m.span(), ".") for m in _REFERENCE_DOT.finditer(tape.text)])
    low = tape.text.lower()
    if not (" @ " in low or any(word in low for word in _SPELLED_DOTS)):
        return
    changes: list[tuple[int, int, str]] = []
    for at in _BARE_AT.finditer(tape.text):
        host = _bare_host(tape.text, at)
        if host is not None:
            here = [*_bare_name(tape.text, at.start(), changes[-1][1] if changes else 0), (*at.span(), "@"), *host]
            if not changes or here[0][0] >= changes[-1][1]:
                changes += here
    tape.rewrite(changes)


def _bare_host(text: str, at: re.Match) -> list[tuple[int, int, str]] | None:
    """The spelled dots of the host after an at that is spelled or stands apart, None if there is no such host."""
    word = (at[1] or at[2]).lower()
    place, signs, ending = at.end(), [], None
    while m := _LABEL.match(text, place):
        sign = (m[2] or m[3] or "").lower()
        ending = len(signs) if m[1].lower() in ENDINGS else ending
        if not sign or not m[4] or sign != "." and sign not in AT_DOT[word]:
            break
        signs.append((m.end(1), m.end(), "."))
        place = m.end()
    if not ending:
        return None
    host = [s for s in signs[:ending] if s[1] - s[0] > 1]
    # a bare word needs a spelled dot, a lone @ something that is not written as in an address
    return host if host or at[1] == "@" else None


def _bare_name(text: str, end: int, done: int) -> list[tuple[int, int, str]]:
    """The spelled signs inside the name that ends at ``end``."""
    found: list[tuple[int, int, str]] = []
    while m := _BEFORE.search(text, max(end - _NAME_SIGNS, done), end):
        found.append((m.start(), m.end(1) + 1, _JOINTS.get(m[1].lower(), ".")))
        end = m.start()
    return found[::-1]


TRANSDUCERS = (undo_signs, undo_digits, undo_addresses)


def find(text: str) -> list[tuple[str, int, int, bool]]:
    """All spans of a text: kind, start, end, whether a base pattern found it."""
    base = {kind: list(finder(text)) for kind, finder in FINDERS.items()}
    found = [(kind, *span, True) for kind, spans in base.items() for span in spans]
    tape = Tape(text)
    for undo in TRANSDUCERS:
        undo(tape)
    if tape.new.any():
        for kind, finder in FINDERS.items():
            for span in finder(tape.text):
                source = tape.source(span)
                if source is None or kind == "email" and not re.search(r"\.[A-Za-z]{2,}$", tape.text[span[0] : span[1]]):
                    continue
                if not any(s < source[1] and source[0] < e for s, e in base[kind]):
                    found.append((kind, *source, False))
    return sorted(found, key=lambda f: (f[1], KINDS.index(f[0]), f[2]))


SPANS = "array<struct<kind: string, start: long, end: long, base: boolean>>"
_SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_())]))


def _spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = [[dict(zip(("kind", "start", "end", "base"), s)) for s in find(t or "")] for t in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, _SPAN_TYPE)], names=["doc_id", "spans"])


def find_spans(docs: DataFrame) -> DataFrame:
    own = docs.select("doc_id", "text")
    return own.mapInArrow(_spans, f"doc_id {own.schema['doc_id'].dataType.simpleString()}, spans {SPANS}")


def _redacted(text: str | None) -> str | None:
    if not text:
        return text
    parts, done = [], 0
    for kind, start, end, _ in find(text):
        if end > done:
            parts += [text[done:start], f"<{kind}>"] if start >= done else []
            done = end
    return "".join([*parts, text[done:]])


def redact(docs: DataFrame) -> DataFrame:
    """The table with ``<kind>`` in place of every span; of spans that overlap, the first is named."""
    place = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = pa.array([_redacted(t) for t in batch.column(place).to_pylist()], pa.string())
            yield batch.set_column(place, "text", texts)

    return docs.mapInArrow(run, docs.schema)


def report(found: DataFrame) -> DataFrame:
    """Counts and digest of the base spans, and all spans as kind:start:end."""

    def joined(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base, counts = F.filter("spans", lambda s: s["base"]), [count(kind) for kind in KINDS]
    added = F.size(F.filter("spans", lambda s: ~s["base"])).cast("long").alias("n_added")
    return found.select("doc_id", *counts, F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), added)
