"""Repeated passages: planted ones, and all runs against plain Python."""

import random
import re

import pyarrow as pa
import pytest

from pubgrade.llm import repeats, words


def sentences(text):
    """(begin, end) of the words of each sentence."""
    found, begin = [], None
    spans = [m.span() for m in re.finditer(r"[^\x20\x09-\x0D]+", text)]
    for i, (a, b) in enumerate(spans):
        begin = a if begin is None else begin
        closed = re.search(r"[.!?][^\w]{0,3}$", text[a:b], re.ASCII)
        if closed or i + 1 == len(spans) or "\n" in text[b : spans[i + 1][0]]:
            found.append((begin, b))
            begin = None
    return found


def brute(rows):
    """Sentences removed from each (doc, text)."""
    runs, places = {}, {}
    for doc, text in set(rows):
        each = [tuple(text[a:b].lower().split()) for a, b in sentences(text or "")]
        sizes = [sum(1 + len(w.encode()) // 24 for w in s) for s in each]

        def big(i, j):
            n = sum(sizes[i : j + 1])
            return n >= repeats.LONG or (j - i + 1 >= repeats.SENTENCES and n >= repeats.WORDS)

        own = set()
        for i in range(len(each)):
            own |= {(i, next(j for j in range(i, len(each)) if big(i, j)))} if big(i, len(each) - 1) else set()
            own |= {(next(k for k in range(i, -1, -1) if big(k, i)), i)} if big(0, i) else set()
        for i, j in own:
            runs.setdefault(sum(each[i : j + 1], ()), []).append((doc, text, i, j))
    for found in runs.values():
        first = min(found, key=lambda r: (r[0], r[2]))
        for doc, text, i, j in found:
            if (doc, text, i) != first[:3]:
                places.setdefault((doc, text), set()).update(range(i, j + 1))
    return places


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(9)

    def sentence():
        return " ".join(f"w{rng.randint(0, 5000)}" for _ in range(rng.randint(1, 14))).capitalize() + rng.choice([".", "!", "?", ".)", "\n"])

    passages = [" ".join(sentence() for _ in range(9)) for _ in range(4)]
    out = []
    for doc in range(60):
        parts = [sentence() for _ in range(rng.randint(1, 12))]
        if doc % 3 == 0:
            parts.insert(rng.randint(0, len(parts)), rng.choice(passages))
        if doc % 10 == 0:
            parts += ["All rights reserved."]
        out.append((doc, " ".join(parts)))
    return [*out, (70, out[1][1]), (71, ""), (72, None)]


def test_removed_sentences(docs, rows):
    found = {r.doc_id: r for r in repeats.find_repeats(docs(*rows)).collect()}
    expected = {d: gone for (d, _), gone in brute([(d, t or "") for d, t in rows]).items()}
    assert {d: {i for s in r.removed for i in range(s["first"], s["last"] + 1)} for d, r in found.items()} == expected
    texts = dict(rows)
    for doc, r in found.items():
        kept = [texts[doc][a:b] for k, (a, b) in enumerate(sentences(texts[doc])) if k not in expected[doc]]
        assert r.text.split() == " ".join(kept).split() and r.n_removed == len(expected[doc]) and min(r.first_doc_ids) <= doc
    assert 70 in found and 1 not in found


def test_rows_and_columns_stay(docs, edge_rows, rows):
    df = docs(*edge_rows, *[(d + 100, t) for d, t in rows])
    cleaned = repeats.remove_repeats(df)
    assert cleaned.columns == df.columns and cleaned.count() == df.count()
    assert dict(cleaned.where("doc_id = 1 or doc_id = 2").select("doc_id", "text").collect()) == {1: None, 2: ""}
    assert repeats.find_repeats(df.where("false")).count() == 0


def test_equal_rows_are_one_document(docs):
    body = "One sentence that is here. Another sentence of some words follows it. " * 1 + "And a third one closes the text with many more words."
    assert repeats.find_repeats(docs((1, body), (1, body))).count() == 0
    found = repeats.find_repeats(docs((1, body), (1, body), (None, body))).collect()
    assert [(r.doc_id, r.first_doc_ids) for r in found] == [(1, []), (1, [])] or {r.doc_id for r in found} == {1}


def test_long_words_count_more():
    text = "漢" * 300
    for _, buffer, offsets in words.steps(pa.array([text])):
        first, last, _ = repeats.Sentences(buffer, offsets).runs()
        assert len(first) == 1


@pytest.mark.parametrize("length", [0, 11, 13, 14, 17])
def test_passages_cut_into_mid_sentence(docs, length):
    """Every passage of 50 words is found, wherever it breaks sentences off, and but for ten words at either end."""
    rng = random.Random(length)
    rows, passages = [], {}
    for shift in range(12):
        w = [f"p{length}x{shift}x{k}" for k in range(50)]
        if length:
            w = [x + "." * ((k + shift) % length == length - 1) for k, x in enumerate(w)]
        passages[100 + shift] = w
        for base in (0, 100):
            around = [[f"o{rng.randint(0, 10**9)}" for _ in range(rng.randint(3, 30))] for _ in range(2)]
            rows.append((base + shift, " ".join(around[0] + w + around[1])))
    texts = dict(rows)
    found = {r.doc_id: r for r in repeats.find_repeats(docs(*rows)).collect()}
    assert found.keys() == passages.keys()
    for doc, r in found.items():
        left = set(r.text.split())
        assert not left & set(passages[doc][10:40])
        assert left >= set(texts[doc].split()) - set(passages[doc])


def test_full_stops_of_other_scripts(docs):
    stops = {"。": "", "।": " ", "؟": " ", "۔": " "}
    rows, left = [], {}
    for k, (stop, blank) in enumerate(stops.items()):
        shared = blank.join(f"{c * 90}{blank}{c * 90}{stop}" for c in ("日本語" if not blank else "कखग" if stop == "।" else "ابت"))
        rows += [(k, f"eins{stop}{blank}{shared}"), (10 + k, f"zwei{stop}{blank}{shared}{blank}drei{stop}")]
        left[10 + k] = [f"zwei{stop}", f"drei{stop}"]
    found = {r.doc_id: r.text for r in repeats.find_repeats(docs(*rows)).collect()}
    assert {d: re.findall(r"(?:zwei|drei).", t) for d, t in found.items()} == left
    assert all(len(t) < 20 for t in found.values())
