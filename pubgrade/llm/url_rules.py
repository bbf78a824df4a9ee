"""Pattern rules on URLs, found by their rarest literal token.

A rule's pattern may use ``||`` at its start (the host or any of its subdomains,
then what follows), ``*`` (anything) and ``^`` (a character that is no letter or
digit, or an end). Its literal tokens are the runs of letters and digits that any
matching URL must hold as a whole token. Each rule is filed under the token that is
rarest among the URLs; a URL's tokens fetch its candidate rules, and only those run
their regular expression. Of the rules that match, the one of highest ``level``
wins, then the longest, then the smallest pattern.

Rows: page_id, host, path, rule, verdict, one per input row. A null url or one
without "://" has an empty host and path, which no rule with a token can match; it
gets the default verdict. Verdicts are worked out once per distinct host and path,
so repeated rows and hot hosts cost nothing more. An empty table gives no rows and
other columns are ignored.
"""

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pubgrade.llm.tables import cut_lineage


@dataclass(frozen=True)
class Rule:
    pattern: str
    verdict: str
    level: int = 0
    #: what the result shows; None: nothing
    name: str | None = None


#: Rules on host and path.
SITE_RULES = [
    Rule("||com/", "allow", 1, "com/"),
    Rule("||example.com/en/", "block", 1, "example.com/en/"),
    Rule("||www.example.com/en/", "allow", 1, "www.example.com/en/"),
    Rule("||net/es/", "block", 1, "net/es/"),
    Rule("||net/fr/", "block", 1, "net/fr/"),
]
#: Words of hosts and paths that are blocked where no site rule fits.
BLOCKED_WORDS = ["adserver", "adult", "bets", "betting", "casino", "escort", "malware", "phishing", "pills", "poker", "porn", "track", "viagra", "xxx"]
WORD_RULES = [Rule(f"^{word}^", "block") for word in BLOCKED_WORDS]

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def literal_tokens(pattern: str) -> list[str]:
    """Tokens that every matching URL holds whole: not next to a ``*`` or an open end."""
    open_start = not pattern.startswith("||")
    body = pattern.removeprefix("||")
    found = []
    for m in re.finditer(r"[A-Za-z0-9]+", body):
        before, after = body[: m.start()][-1:], body[m.end() :][:1]
        if before != "*" and (before or not open_start) and after not in ("", "*"):
            found.append(m[0])
    return found


def expression(pattern: str) -> str:
    """The regular expression over host and path, in syntax that Spark and other engines share."""
    body = pattern.removeprefix("||")
    parts = {"*": ".*", "^": "(?:[^A-Za-z0-9]|^|$)"}
    text = "".join(parts.get(c) or (c if c.isalnum() or c in "/-_" else "\\" + c) for c in body)
    return ("^(?:[^/]*\\.)?" if pattern.startswith("||") else "") + text


def host_and_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + F.lit(3))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substr(rest, F.char_length(host) + F.lit(1)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(host, _UPPER, _LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def judge(pages: DataFrame, rules: list[Rule], default: str = "allow") -> DataFrame:
    spark = pages.sparkSession
    rows = [(r.pattern, expression(r.pattern), r.verdict, r.level, len(r.pattern), r.name, literal_tokens(r.pattern)) for r in rules]
    if bare := [r[0] for r in rows if not r[-1]]:
        raise ValueError(f"rules without a literal token would run on every URL: {bare}")
    table = spark.createDataFrame(rows, "pattern string, expression string, verdict string, level int, size int, rule string, tokens array<string>")

    host, path = host_and_path(F.col("url"))
    parsed = cut_lineage(pages.select("page_id", host.alias("host"), path.alias("path")), "urls")
    target = F.concat("host", "path")
    tokens = F.array_distinct(F.regexp_extract_all(target, F.lit("[A-Za-z0-9]+"), F.lit(0)))
    held = parsed.select("host", "path").distinct().select("host", "path", F.explode(tokens).alias("token"))
    choices = table.withColumn("token", F.explode("tokens"))
    known = held.join(choices.select("token").distinct(), "token")  # only tokens that a rule holds
    known = cut_lineage(known, "url-tokens")
    counts = known.groupBy("token").agg(F.count("*").alias("n"))
    rarest = Window.partitionBy("pattern").orderBy(F.coalesce("n", F.lit(0)), "token")
    index = choices.join(counts, "token", "left").withColumn("turn", F.row_number().over(rarest)).where("turn = 1")
    index = cut_lineage(index.drop("turn", "n", "tokens"), "rule-index")

    matches = known.join(index, "token").where(F.rlike(target, F.col("expression")))
    order = F.struct("level", "size", "pattern")
    best = matches.groupBy("host", "path").agg(F.max_by(F.struct("rule", "verdict"), order).alias("best"))
    judged = parsed.join(cut_lineage(best, "url-verdicts"), ["host", "path"], "left")
    return judged.select("page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
