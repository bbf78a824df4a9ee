"""URL rules and archives."""

import gzip
import hashlib
import re

import pytest
from pyarrow import fs

from pubgrade.llm import url_rules, warc
from pubgrade.llm.tables import scratch_path

URLS = [
    "http://a.com/x", "http://com/", "http://com", "https://example.com/en/1?q", "https://www.example.com/en/1", "http://b.www.EXAMPLE.com/en/",
    "http://x.net/es/1", "http://x.net/fr", "http://x.net/FR/", "http://notexample.com/en/", "http://casino.org/", "http://a.org/casino-win", "http://a.org/casinos",
    "ftp://u@h.com:80/p#f", "no url", "", None, "http://", "http:///en/", "a://b://com/", "http://a.net/es/?x", "http://TRACK.org", "x\n://a.com/\n/b?c",
]


def plain(url):
    host, path = "", ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        raw = re.match(r"[^/?#]*", rest)[0]
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in raw)
        path = re.match(r"[^?#]*", rest[len(raw) :])[0]
    best = None
    for rule, verdict in (("com/", "allow"), ("example.com/en/", "block"), ("www.example.com/en/", "allow"), ("net/es/", "block"), ("net/fr/", "block")):
        domain, _, prefix = rule.partition("/")
        if (host == domain or host.endswith("." + domain)) and path.startswith("/" + prefix) and len(rule) > len((best or ("",))[0]):
            best = (rule, verdict)
    if best:
        return host, path, *best
    words = re.split(r"[^A-Za-z0-9]+", host + path)
    return host, path, None, "block" if set(words) & set(url_rules.BLOCKED_WORDS) else "allow"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "x", "y") for r in rows], "page_id long, url string, html string, rule string, host string").repartition(3)


def test_verdicts(spark):
    df = pages(spark, [*((i, u, "") for i, u in enumerate(URLS)), (None, URLS[0], ""), (0, URLS[0], "")])
    found = url_rules.judge(df, url_rules.SITE_RULES + url_rules.WORD_RULES).collect()
    expected = [(i, *plain(u)) for i, u in enumerate(URLS)] + [(None, *plain(URLS[0])), (0, *plain(URLS[0]))]
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    assert url_rules.judge(df.where("false"), url_rules.SITE_RULES).count() == 0


def test_patterns(spark):
    rules = [url_rules.Rule("||site.org/*/print^", "block", name="print"), url_rules.Rule("^ad^*banner*", "block", name="ad")]
    urls = {"http://site.org/a/print": "print", "http://site.org/a/printer": None, "http://b.org/ad/x/mybanners": "ad", "http://b.org/bad/banner": None}
    found = url_rules.judge(pages(spark, [(i, u, "") for i, u in enumerate(urls)]), rules).collect()
    assert {list(urls)[r.page_id]: r.rule for r in found} == urls
    with pytest.raises(ValueError):
        url_rules.judge(pages(spark, [(1, "", "")]), [url_rules.Rule("*x*", "block")])


def test_literal_tokens():
    assert url_rules.literal_tokens("||www.example.com/en/") == ["www", "example", "com", "en"]
    assert url_rules.literal_tokens("^ad^*banner*") == ["ad"] and url_rules.literal_tokens("abc/de/") == ["de"]


BIG, SMALL = "<p>é body</p>" * 20, "tiny"
PAGES = [(5, "http://a/ b", BIG), (3, "http://c", BIG), (3, "http://c", BIG), (9, None, BIG), (1, "u", SMALL), (2, "u", SMALL), (4, "u", None), (None, "u", BIG), (None, "v", "z" * 200)]


def test_archives(spark):
    folder = scratch_path(spark, "warc")
    files = warc.write_archives(pages(spark, PAGES), folder)
    expected = []
    for page, _, html in PAGES:
        raw = (html or "").encode()
        first = 3 if html == BIG else None
        revisit = first is not None and page != first
        expected.append((page, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if revisit else "response", first if revisit else None))
    found = warc.read_archives(files).collect()
    assert sorted(map(tuple, found), key=str) == sorted(expected, key=str)
    raw = b""
    for row in files.collect():
        store, place = fs.FileSystem.from_uri(row.path)
        with store.open_input_stream(place, compression=None) as stream:
            raw += gzip.decompress(stream.read())
    assert raw.count(b"WARC/1.1\r\n") == len(PAGES) and raw.count(BIG.encode()) == 2 and raw.count(b"WARC-Type: revisit") == 3
    assert warc.read_archives(warc.write_archives(pages(spark, PAGES).where("false"), folder)).count() == 0


def test_cut_off_archive():
    import io

    record = {"page_id": 1, "url": "u", "digest": "d", "refers_to": None, "copy": False, "payload": b"x" * 5000}
    member = warc.record(record, "2026-01-01T00:00:00Z")
    assert len(list(warc.members(io.BytesIO(member * 3)))) == 3
    with pytest.raises(ValueError):
        list(warc.members(io.BytesIO(member + member[:-30])))
