"""Personal data: base spans against the plain patterns, disguises with known places, clean texts, linear time."""

import hashlib
import random
import re
import time

import pytest

from pubgrade.llm import pii


def plain_spans(text):
    """The base rules word for word."""

    def digits(m):
        return re.sub("[^0-9]", "", m[0])

    def sums_up(number):
        values = [int(d) * (1 + k % 2) for k, d in enumerate(reversed(number))]
        return sum(v - 9 * (v > 9) for v in values) % 10 == 0

    rules = [
        ("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
        ("ip", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m[0].split("."))),
        ("card", r"[0-9]([\x20-]?[0-9])+", lambda m: 14 <= len(digits(m)) <= 19 and sums_up(digits(m))),
        ("phone", r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 10 <= len(digits(m)) <= 15),
    ]
    found = [(m.start(), k, kind, m.end()) for k, (kind, pattern, holds) in enumerate(rules) for m in re.finditer(pattern, text) if holds(m)]
    return [(kind, start, end) for start, _, kind, end in sorted(found)]


def base_spans(text):
    return [s[:3] for s in pii.find(text) if s[3]]


def test_base_spans_equal_the_plain_patterns():
    rng = random.Random(1)
    parts = ["a@b.c", "@", ".", "x+y", "10.0.0.1", "1.2.3.4.5.6.7.8", "256.1.1.1", "0001.2.3.004", "4111 1111 1111 1111", "4111-1111", "1111", "+1 (988) 555-2485", "+", "(", ")", "-", "--", " ", " ", "é", "\n", "b..c", "5"]
    for _ in range(4000):
        text = "".join(rng.choices(parts, k=rng.randint(1, 12)))
        assert base_spans(text) == plain_spans(text), text
    alphabet = "a@.1+- (5"
    for _ in range(4000):
        text = "".join(rng.choices(alphabet, k=rng.randint(1, 40)))
        assert base_spans(text) == plain_spans(text), text


DISGUISED = [
    ("email", "john.doe (at) example [dot] com"),
    ("email", "john.doe[at]mail.example.com"),
    ("email", "john dot doe at mail dot example dot com"),
    ("email", "john_doe AT example DOT org"),
    ("email", "john underscore doe at example dot co dot uk"),
    ("email", "juan arroba correo punto es"),
    ("email", "max klammeraffe beispiel punkt de"),
    ("email", "jean arobase exemple point fr"),
    ("email", "joe @ example . com"),
    ("email", "joe&#64;example&period;com"),
    ("email", "ｊｏｅ＠ｅｘａｍｐｌｅ．ｃｏｍ"),
    ("email", "jоhn@exаmple.cоm"),  # Cyrillic letters
    ("email", "jo​hn@exa­mple.com"),
    ("ip", "10[.]20(dot)0.1"),
    ("ip", "192 dot 168 dot 1 dot 1"),
    ("ip", "one nine two dot one six eight dot one dot one"),
    ("ip", "١٩٢.168.0.1"),
    ("ip", "l92.l68.O.l"),
    ("card", "４１１１ １１１１ １１１１ １１１１"),
    ("card", "4111–1111–1111–1111"),
    ("card", "41ll 1111 1I11 1111"),
    ("card", "four one one one one one one one one one one one one one one one"),
    ("phone", "+1 (988) five five five 2485"),
    ("phone", "plus four nine eins zwei drei vier fünf sechs sieben acht neun"),
    ("phone", "+33 un deux trois quatre cinq six sept huit"),
    ("phone", "＋1‐988‐555‐2485"),
]


@pytest.mark.parametrize("kind,text", DISGUISED)
def test_disguises_are_found_at_their_place(kind, text):
    for before, after in (("", ""), ("Ünï и слово — see: ", "; thanks."), ("to a@b.co or\n", "\n" + "more words " * 20)):
        whole = before + text + after
        added = [s[:3] for s in pii.find(whole) if not s[3]]
        assert added == [(kind, len(before), len(before) + len(text))]
        assert base_spans(whole) == plain_spans(whole)


CLEAN = [
    "Meet me at noon, look at the dot on the map. Three apples at 2.50 each, at example.com we sell more.",
    "One two three, one of two, six of seven; point to the dot at the end. Version 1.2.3 (at least) is out.",
    "Sie machte acht Punkte, drei at home. Au point de vue de la rue, un deux. A las dos y cuatro, punto final.",
    "Слово и дело: три точки. Ñandú é ê – “quotes” … 10–20 items, 2010–2015, 4O winks, size XL10.",
    "f(at) = x [at] y; if (a) then {b} <a> c. @home @ work @ 5.",
    "Order 1234 5678 9012 3456 has 16 digits and no valid sum. Call 555-1234.",
]


@pytest.mark.parametrize("text", CLEAN)
def test_clean_texts_stay_clean(text):
    assert pii.find(text) == []


@pytest.mark.parametrize(
    "part", ["a", "1", "1.", "1 ", "+1 ", "a@", "@a", "a@b.", "one ", "one dot ", " dot a", "a at b dot ", "(at) ", "O1", ".1", "a at ", "​1", "([", " ", "- ", "+(", "l.", "+1(" ]
)
def test_linear_time(part):
    start = time.time()
    pii.find(part * (300_000 // len(part)))
    assert time.time() - start < 20


def test_report_and_redaction(docs, edge_rows):
    text = "Write to joe@a.b or +1 (988) 555-2485, or to é jim (at) a [dot] org. 4111 1111 1111 1111"
    df = docs(*edge_rows, (50, text), (50, text))
    rows = pii.report(pii.find_spans(df)).collect()
    assert len(rows) == len(edge_rows) + 2
    for r in rows:
        if r.doc_id == 50:
            base = ",".join(f"{k}:{s}:{e}" for k, s, e in plain_spans(text))
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.n_added) == (1, 0, 1, 1, 1)
            assert r.base_sha256 == hashlib.sha256(base.encode()).hexdigest()
            assert r.spans == base.replace(",card", f",email:{text.index('jim')}:{text.index('org') + 3},card")
        else:
            assert (r.spans, r.n_email, r.base_sha256) == ("", 0, hashlib.sha256(b"").hexdigest())
    hidden = pii.redact(df)
    assert hidden.schema == df.schema
    texts = {(r.doc_id, r.text) for r in hidden.collect()}
    assert (50, "Write to <email> or <phone>, or to é <email>. <card>") in texts
    assert texts - {(50, "Write to <email> or <phone>, or to é <email>. <card>")} == set(edge_rows)
    assert pii.report(pii.find_spans(df.where("false"))).count() == 0
