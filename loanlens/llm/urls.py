"""URL filter: pattern rules found by their rarest literal token.

A rule is either a site rule (a host, with all its subdomains, and the start of a path) or
a pattern (literal text with ``*`` for anything, found anywhere in host, path and query).
Both become one regular expression over ".host/path?query".  Every rule is filed under
that of its literal tokens which the fewest URLs hold; the tokens of a URL (runs of letters
a-z and digits) fetch the rules filed under them, and only those run their expression.  Rules
without a whole literal token are filed under the empty token, which every URL has.

Among the site rules that fit, the longest wins.  Where none fits, the longest pattern that
fits decides (ties: the first by text), and otherwise the verdict is "allow".

All work is on distinct URLs: one row per URL and rule fetched, then one per URL; a host or
URL with a third of all rows is met once.  The rules come from a list, so the size of their index is
known: up to ``MOST_BROADCAST`` rules (some hundred bytes each) it is broadcast and a token that
most URLs hold is not shuffled; a longer list is joined by token.

Defined results: a null url or one without "://" has an empty host and path, no rule, and the
default verdict; a very long url is judged whole; of patterns that tie the first by text decides; an empty table
gives an empty result; repeated rows, and rows with a null id, are judged alike.  Only page_id and url are
read, so other columns may have any name.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TOKEN = re.compile("[a-z0-9]+")
SPECIAL = re.compile(r"([\\.^$|?*+()\[\]{}\-])")


@dataclass(frozen=True)
class Rule:
    text: str
    verdict: str
    site: bool

    @property
    def expression(self) -> str:
        if self.site:
            return r"(?s)^[^/?#]*\." + SPECIAL.sub(r"\\\1", self.text)
        return "(?s)" + ".*".join(SPECIAL.sub(r"\\\1", part) for part in self.text.split("*"))

    @property
    def tokens(self) -> list[str]:
        """Tokens that any fitting URL holds whole: bounded in the rule's own text on both sides."""
        text = "." + self.text if self.site else self.text
        found = set()
        for part in text.lower().split("*"):
            for m in TOKEN.finditer(part):
                if m.start() > 0 and m.end() < len(part):
                    found.add(m[0])
        return sorted(found) or [""]


def site(text: str, verdict: str) -> Rule:
    return Rule(text, verdict, True)


def pattern(text: str, verdict: str) -> Rule:
    return Rule(text, verdict, False)


#: The site rules, then patterns for pages that carry no text of their own.
RULES = [
    site("org/", "allow"),
    site("example.org/es/", "block"),
    site("example.org/en/1", "block"),
    site("com/fr/", "allow"),
    site("com/de/", "block"),
    pattern("/login/", "block"),
    pattern("/cart/", "block"),
    pattern("/wp-admin/", "block"),
    pattern("?sessionid=", "block"),
    pattern("?page=*&ref=", "block"),
    pattern("?utm_source=feed", "allow"),
]
DEFAULT = "allow"
MOST_BROADCAST = 100_000


def _small(index: DataFrame, rules: list[Rule]) -> DataFrame:
    return F.broadcast(index) if len(rules) <= MOST_BROADCAST else index


def parts(url: Column) -> tuple[Column, Column, Column]:
    """Host, path, and what follows the path; all empty for a null url or one without ``://``."""
    at = F.instr(url, "://")
    after = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, "^[^/?#]*", 0)
    behind = F.substring(after, F.length(host) + 1, F.length(after))
    path = F.regexp_extract(behind, "^[^?#]*", 0)
    rest = F.substring(behind, F.length(path) + 1, F.length(behind))
    low = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return low, path, rest


def judge(pages: DataFrame, rules: list[Rule] = RULES) -> DataFrame:
    """``page_id``, ``host``, ``path``, ``rule`` (a site rule's text or null), ``verdict`` and ``pattern`` for every row."""
    spark = pages.sparkSession
    host, path, rest = parts(F.col("url"))
    urls = pages.select("url").where(F.col("url").isNotNull()).distinct().select(
        "url", F.concat(F.lit("."), host, path, rest).alias("subject"))
    tokens = F.array_append(F.array_distinct(F.regexp_extract_all(F.lower("subject"), F.lit("[a-z0-9]+"), F.lit(0))), "")
    tokened = urls.select("url", "subject", F.explode(tokens).alias("token"))

    # file each rule under its rarest token: count the rules' tokens over all URLs
    wanted = spark.createDataFrame([(t,) for t in sorted({t for r in rules for t in r.tokens})], "token string")
    held = {r["token"]: r["n"] for r in tokened.join(_small(wanted, rules), "token").groupBy("token").agg(F.count("*").alias("n")).collect()}
    index = spark.createDataFrame(
        [(min(r.tokens, key=lambda t: (held.get(t, 0), t)), r.text, r.verdict, r.site, r.expression) for r in rules],
        "token string, rule string, verdict string, site boolean, expression string")

    fits = tokened.join(_small(index, rules), "token").where(F.regexp_like("subject", F.col("expression")))
    won, rank = F.struct("rule", "verdict"), F.struct((-F.length("rule")).alias("size"), "rule")
    best = fits.groupBy("url").agg(F.min_by(won, F.when(F.col("site"), rank)).alias("of_site"),
                                   F.min_by(won, F.when(~F.col("site"), rank)).alias("of_pattern"))
    judged = pages.select("page_id", F.col("url").alias("at"), host.alias("host"), path.alias("path")).join(
        best, F.col("at") == F.col("url"), "left")
    return judged.select(
        "page_id", "host", "path", F.col("of_site.rule").alias("rule"),
        F.coalesce("of_site.verdict", "of_pattern.verdict", F.lit(DEFAULT)).alias("verdict"),
        F.when(F.col("of_site").isNull(), F.col("of_pattern.rule")).alias("pattern"))
