"""URL filter: pattern rules found through their rarest literal token.

A rule is a pattern over host + path: ``||`` anchors it at a label of the host, ``^`` is a separator
or an end, ``*`` any run of characters; the rest is literal. Every literal run between separators is a
token of each url that the rule fits, so the url's tokens fetch all rules that can fit, and only
those run as regular expressions.
"""

from __future__ import annotations

import re
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardline.llm.tables import fold_ascii, small


class Rule(NamedTuple):
    name: str
    pattern: str
    verdict: str
    #: Rules that name a host and path decide by length; the others only where none of these fits.
    exact: bool = False


#: The host and path rules.
HOST_RULES = (
    Rule("com/", "||com/", "allow", True),
    Rule("example.com/en/", "||example.com/en/", "block", True),
    Rule("www.example.com/en/", "||www.example.com/en/", "allow", True),
    Rule("net/es/", "||net/es/", "block", True),
    Rule("net/fr/", "||net/fr/", "block", True),
)
#: Topics that no training corpus wants, as words of their own in host or path.
TOPIC_RULES = tuple(
    Rule(f"topic:{w}", f"^{w}^", "block")
    for w in ("ads", "adserver", "tracker", "casino", "poker", "betting", "porn", "xxx", "adult", "bets", "pills", "spam", "escort", "viagra", "torrent", "warez", "phishing")
)
RULES = HOST_RULES + TOPIC_RULES


def as_regex(rule: Rule) -> str:
    anchored = rule.pattern.startswith("||")
    parts = re.split(r"([*^])", rule.pattern[2:] if anchored else rule.pattern)
    body = "".join({"*": "(?s:.*)", "^": "(?:[^A-Za-z0-9]|^|$)"}.get(p, re.sub(r"([^A-Za-z0-9])", r"\\\1", p)) for p in parts)
    return ("" if rule.exact else "(?i)") + (r"^(?:[^/]*\.)?" if anchored else "") + body


def tokens_of(rule: Rule) -> list[str]:
    """Literal runs with a separator or the host's anchor on either side, in lower case."""
    text = rule.pattern.lower()
    text = " " + text[2:] if text.startswith("||") else "*" + text
    text = (text + "*").replace("^", " ")
    return sorted(set(re.findall(r"(?<=[^a-z0-9*])[a-z0-9]+(?=[^a-z0-9*])", text)))


def url_parts(df: DataFrame, url: str = "url") -> DataFrame:
    """Adds ``host`` and ``path``; both are empty for null and where there is no ``://``."""
    at = F.instr(F.col(url), "://")
    rest = F.when(at > 0, F.expr(f"substring(`{url}`, instr(`{url}`, '://') + 3)")).otherwise("")
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return df.withColumns({"host": fold_ascii(host), "path": F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)})


def judge_urls(df: DataFrame, url: str = "url", rules=RULES) -> DataFrame:
    """Adds ``host``, ``path``, ``rule`` (of the host and path rules, else null) and ``verdict``.

    The longest host and path rule decides, a tie by name; where none fits, a pattern that blocks
    does unless one that allows fits too; else allow. Rows stay as they are, also repeated ones and
    those with a null or empty url (allow); columns called like the new ones are replaced.
    """
    spark: SparkSession = df.sparkSession
    parts = url_parts(df.drop("host", "path", "rule", "verdict"), url)
    folded = fold_ascii(F.concat("host", "path"))
    urls = parts.select("host", "path").distinct().select(
        "host", "path", F.explode(F.array_distinct(F.concat(F.split(folded, "[^a-z0-9]+"), F.array(F.lit(""))))).alias("token"))

    named = [(r.name, as_regex(r), r.verdict, r.exact, len(r.name), tokens_of(r) or [""]) for r in rules]
    table = spark.createDataFrame(
        named, "name string, regex string, verdict string, exact boolean, size int, tokens array<string>")
    of_rules = table.select("name", F.explode("tokens").alias("token"))
    known = small(of_rules.select("token").distinct())
    frequency = urls.join(known, "token").groupBy("token").agg(F.count("*").alias("n"))
    rarest = (of_rules.join(frequency, "token", "left")
              .groupBy("name").agg(F.min_by("token", F.struct(F.coalesce("n", F.lit(0)), "token")).alias("token")))
    index = small(rarest.join(table.drop("tokens"), "name"))

    fitting = urls.join(index, "token").where(F.expr("concat(host, path) rlike regex"))
    longest = F.max(F.when(F.col("exact"), F.struct("size", "name", "verdict")))
    verdicts = fitting.groupBy("host", "path").agg(
        longest.alias("best"),
        F.max(F.col("verdict").eqNullSafe("allow") & ~F.col("exact")).alias("spared"),
        F.max(F.col("verdict").eqNullSafe("block") & ~F.col("exact")).alias("caught"),
    )
    verdict = F.coalesce("best.verdict", F.when(F.col("caught") & ~F.col("spared"), "block"), F.lit("allow"))
    return (parts.join(verdicts, ["host", "path"], "left")
            .select(*[c for c in parts.columns], F.col("best.name").alias("rule"), verdict.alias("verdict")))
