"""URL filters: pattern rules fetched through their rarest literal token.

A rule is a host rule (``example.com/en/``: that host and its subdomains, where
the path starts with the rule's; the longest that fits wins) or a pattern (a
literal that must stand between non-alphanumeric characters, ``*`` for any
text; a fitting one blocks a URL that no host rule decides).  Every rule
becomes one regular expression and the set of its literal tokens, the runs of
``[a-z0-9]`` that a matching URL must hold as whole tokens.  The URLs' own
token counts choose each rule's rarest token; a URL's distinct tokens fetch the
candidate rules by a join, and only those run their expression.  A rule
without a whole literal token is a candidate for every URL.

Only DataFrame functions are used.  Rules are a small driver-side list, so
their table is broadcast when Spark finds it below its own threshold, and
shuffled otherwise.  Decisions are made once per distinct URL.

Results for odd input: a null URL, or one without ``://``, has an empty host
and path and fits no host rule; patterns do not apply to it and it is allowed.
Repeated rows and rows without a page_id each get the decision of their URL.
An empty table gives an empty table.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


@dataclass(frozen=True)
class Rule:
    """``host``: a host and path; ``pattern``: a literal with ``*``."""

    rule: str
    verdict: str
    kind: str = "host"

    def expression(self) -> str:
        escape = lambda x: re.sub(r"([^A-Za-z0-9/_])", r"\\\1", x)
        if self.kind == "host":
            return "^(?:[^/]*\\.)?" + escape(self.rule)
        return "(?:^|[^a-z0-9])" + ".*".join(escape(x) for x in self.rule.split("*")) + "(?:[^a-z0-9]|$)"

    def tokens(self) -> list[str]:
        text = self.rule.lower()
        # a host rule's path may go on after its last character; a pattern's ends are token ends
        text = f"/{text}*" if self.kind == "host" else f"/{text}/"
        return sorted({m[0] for m in re.finditer(r"(?<![a-z0-9*])[a-z0-9]+(?![a-z0-9*])", text)})


#: Patterns of unwanted hosts and paths.
PATTERNS = [Rule(x, "block", "pattern") for x in (
    "casino-*.", "online-casino", "free-bets", "sports-betting", "cheap-pills", "viagra", "adult-*.", "porn", "xxx", "ads-track",
    "doubleclick", "payday-loans", "/cgi-bin/", "/wp-login", "/trackback/")]


def low(c: Column) -> Column:
    return F.translate(c, UPPER, LOWER)


def split_url(url: str = "url") -> tuple[Column, Column]:
    """Host and path of a URL column."""
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    path = F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1)
    return low(F.coalesce(host, F.lit(""))), F.coalesce(path, F.lit(""))


def indexed(rules: list[Rule], tokens: DataFrame) -> DataFrame:
    """The rules with their rarest token by the counts of ``tokens`` (column token)."""
    spark = tokens.sparkSession
    rows = [(i, r.rule, r.verdict, r.kind, r.expression(), len(r.rule)) for i, r in enumerate(rules)]
    table = spark.createDataFrame(rows, "id int, rule string, rule_verdict string, kind string, expression string, size int")
    pairs = spark.createDataFrame([(i, t) for i, r in enumerate(rules) for t in r.tokens()], "id int, token string")
    seen = tokens.join(pairs.select("token").distinct(), "token").groupBy("token").count()
    rarest = pairs.join(seen, "token", "left").groupBy("id").agg(F.min(F.struct(F.coalesce("count", F.lit(0)), "token")).alias("r"))
    return table.join(rarest.select("id", F.col("r.token").alias("token")), "id", "left")


def judge(pages: DataFrame, rules: list[Rule]) -> DataFrame:
    """page_id, url, host, path, rule (the deciding host rule) and verdict of every row."""
    host, path = split_url()
    urls = (pages.where("instr(url, '://') > 0").select("url").distinct().withColumn("host", host).withColumn("path", path)
            .withColumn("exact", F.concat("host", "path")).withColumn("lower", low(F.concat("host", "path"))))
    tokens = urls.select("url", "exact", "lower", F.explode(F.array_distinct(F.split("lower", "[^a-z0-9]+"))).alias("token"))
    index = indexed(rules, tokens)
    candidates = tokens.join(index.where("token is not null"), "token")
    if loose := [r for r in rules if not r.tokens()]:
        each = F.array(*[F.struct(F.lit(r.rule).alias("rule"), F.lit(r.verdict).alias("rule_verdict"), F.lit(r.kind).alias("kind"),
                                  F.lit(r.expression()).alias("expression"), F.lit(len(r.rule)).alias("size")) for r in loose])
        every = urls.select("url", "exact", "lower", F.explode(each).alias("r")).select("url", "exact", "lower", "r.*")
        candidates = candidates.select(every.columns).union(every)
    fits = candidates.where(F.expr("if(kind = 'host', exact, lower) rlike expression"))
    found = fits.groupBy("url").agg(
        F.max(F.when(F.col("kind") == "host", F.struct("size", "rule", "rule_verdict"))).alias("h"),
        F.bool_or(F.expr("kind = 'pattern' and rule_verdict = 'block'")).alias("blocked"))
    found = found.select(F.col("url").alias("__llm_url"), F.col("h.rule").alias("rule"),
                         F.coalesce("h.rule_verdict", F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"))
    rows = pages.select("page_id", "url").withColumn("host", host).withColumn("path", path)
    return (rows.join(found, F.col("url") == F.col("__llm_url"), "left")
            .select("page_id", "url", "host", "path", "rule", F.coalesce("verdict", F.lit("allow")).alias("verdict")))
