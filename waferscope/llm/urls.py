"""URL rules indexed by their rarest literal token.

A rule is a regular expression and the whole tokens that every URL it fits must hold. Each rule is filed under the
one of its tokens that is rarest among all URLs; a URL's tokens fetch the rules filed under them, and only those run. Work
per URL therefore depends on its tokens, not on the number of rules.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BETWEEN_TOKENS = r"[^\p{L}\p{N}]+"


@dataclass(frozen=True)
class Rule:
    """A verdict on URLs whose subject the pattern finds: `place` is host and path, `address` all after ://, lower-cased.

    The larger rank wins, then the text. `named` rules are reported by their text.
    """

    text: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    subject: str = "place"
    rank: int = 0
    named: bool = True


def host_rule(verdict: str, text: str) -> Rule:
    """A rule `host/path` for the host and its subdomains and for paths that begin with the path; a longer one wins."""
    host, _, path = text.partition("/")
    pattern = rf"^(?:[^/]*\.)?{re.escape(host)}{re.escape('/' + path)}"
    # A path that ends in a sign between tokens holds its last token whole, any other may go on.
    whole = f"{host}/{path}"
    pieces = re.split(r"[^\w]+|_", whole if re.search(r"[\W_]$", whole) else re.sub(r"[^\W_]+$", "", whole))
    return Rule(text, verdict, pattern, tuple(sorted({p.lower() for p in pieces if p})), "place", 1_000 + len(text))


def word_rule(word: str) -> Rule:
    """Blocks addresses that hold a word between other signs."""
    return Rule(f"word:{word}", "block", rf"(?:^|[^\p{{L}}\p{{N}}]){re.escape(word)}(?:[^\p{{L}}\p{{N}}]|$)", (word,), "address", 0, False)


# Words of addresses that are blocked where no named rule decides.
BLOCKED_WORDS = ("adserver", "betting", "casino", "doubleclick", "malware", "phishing", "poker", "porn", "viagra", "warez", "xxx")
DEFAULT_RULES = tuple(word_rule(word) for word in BLOCKED_WORDS)


def _after_scheme(url: Column) -> Column:
    return F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url))).otherwise("")


def parts(url: Column) -> tuple[Column, Column, Column]:
    """(host, path, address) of a URL; empty where it is null or has no ://."""
    rest = F.coalesce(_after_scheme(url), F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return host, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lower(rest)


def judge(
    pages: DataFrame, rules: list[Rule], url_col: str = "url", default: str = "allow", keep: tuple[str, ...] = ("page_id",)
) -> DataFrame:
    """The kept columns with host, path, rule and verdict for every row of pages, whatever other columns it has.

    rule is the text of the named rule that decided, null where another rule or the default did. A URL that is null or has no
    :// has an empty host and path and gets the default. Each different URL is judged once. Repeated rows keep a row
    each. No rows: no rows.
    """
    spark = pages.sparkSession
    rows = pages.select(*keep, F.col(url_col).cast("string").alias("_url"))
    host, path, address = parts(F.col("_url"))
    urls = rows.select("_url").where("_url is not null").distinct()
    urls = urls.select("_url", F.concat(host, path).alias("place"), address.alias("address"))
    lowered = F.lower(F.concat_ws("/", "place", "address"))
    tokens = urls.withColumn("token", F.explode(F.array_distinct(F.split(lowered, _BETWEEN_TOKENS))))
    wanted = sorted({t for rule in rules for t in rule.tokens})
    # One row for each token of the rules at most.
    filed = spark.createDataFrame([(t,) for t in wanted], "token string")
    often = {r.token: r["count"] for r in tokens.join(F.broadcast(filed), "token").groupBy("token").count().collect()}
    index = [
        (min(rule.tokens, key=lambda t: (often.get(t, 0), t)), rule.text, rule.verdict, rule.pattern, rule.subject, rule.rank, rule.named)
        for rule in rules
    ]
    index_rows = spark.createDataFrame(
        index, "token string, text string, rule_verdict string, pattern string, subject string, rank int, named boolean"
    )
    subject = F.when(F.col("subject") == "place", F.col("place")).otherwise(F.col("address"))
    fitting = tokens.join(index_rows, "token").where(F.regexp_like(subject, F.col("pattern")))
    best = fitting.groupBy("_url").agg(F.max(F.struct("rank", "text", "rule_verdict", "named")).alias("best"))
    return rows.join(best, "_url", "left").select(
        *keep,
        host.alias("host"),
        path.alias("path"),
        F.when(F.col("best.named"), F.col("best.text")).alias("rule"),
        F.coalesce("best.rule_verdict", F.lit(default)).alias("verdict"),
    )
