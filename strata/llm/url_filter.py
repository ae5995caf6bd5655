"""URL rules indexed by their rarest literal token.

Two kinds of rules.  *Place rules* name a host and a path (``example.org/es/``)
and a verdict; one fits its host and all subdomains if the URL's path starts
with the rule's, and the longest that fits wins.  *Patterns* block a URL that
no place rule decides; they are written ``||label.`` (at a host label),
``*`` (any run), ``^`` (one separator, or the end) and ``|`` (end), and match
the lower-cased URL after ``://``.

Each rule holds some literal tokens, ``[a-z0-9]+`` runs that any URL it fits
must have whole.  The rule is indexed by the one of them that is rarest among
all URLs given (counted by one aggregation over all of them).  A URL's tokens
fetch candidate rules by an equality join, and only candidates run their
regular expression.  A rule without a whole token is indexed under the empty
token, which every URL has.  Each different URL is judged once, so a URL that
fills a third of the table is one row of the join; the index is broadcast if
its measured size allows, else the join is a shuffle that adaptive execution
can split.

Defined results: a URL that is null or lacks ``://`` has an empty host and
path, no rule fits it, and it is allowed; repeated rows get equal verdicts;
empty tables give empty results; all columns of the pages are carried, and
one named like a result is replaced by it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_limit, fits, measure
from .common import packed, stored, unpacked

ALLOW, BLOCK = "allow", "block"
RESULTS = ["host", "path", "rule", "pattern", "verdict"]

#: Place rules, by verdict.
PLACES = (("org/", ALLOW), ("example.org/es/", BLOCK), ("example.org/en/1", BLOCK),
          ("com/fr/", ALLOW), ("com/de/", BLOCK))

#: Patterns that block.
PATTERNS = ("||ads-track.", "||spam-farm.", "||click-farm.", "||casino.", "||malware.",
            "/wp-login.php", "/banner-ads/", "/doubleclick^", "?phpsessid=", "&phpsessid=",
            "/trackback^", ".exe|", "/xxx/")

TOKEN = re.compile(r"[a-z0-9]+")


@dataclass(frozen=True)
class Rule:
    rule: str
    regex: str        # understood alike by Java and RE2
    tokens: tuple[str, ...]
    kind: str         # place or pattern
    verdict: str


def _whole_tokens(parts: list[tuple[str, bool, bool]]) -> tuple[str, ...]:
    """Tokens of literal pieces (text, closed on the left, on the right): those
    that cannot be part of a longer one in a URL."""
    out = []
    for text, left, right in parts:
        for m in TOKEN.finditer(text):
            if (m.start() or left) and (m.end() < len(text) or right):
                out.append(m[0])
    return tuple(dict.fromkeys(out))


def place_rule(rule: str, verdict: str) -> Rule:
    host, slash, path = rule.partition("/")
    host = host.lower()
    regex = r"^(?:[^/]*\.)?" + re.escape(host) + re.escape(slash + path)
    return Rule(rule, regex, _whole_tokens([((host + slash + path).lower(), True, False)]),
                "place", verdict)


def pattern(rule: str) -> Rule:
    text, regex, parts = rule.lower(), "", []
    anchored = text.startswith("||")
    if anchored:
        text, regex = text[2:], r"^(?:[^/?#]*\.)?"
    end = text.endswith("|")
    text = text.removesuffix("|")
    pieces = re.split(r"([*^])", text)
    for i in range(0, len(pieces), 2):
        before = pieces[i - 1] if i else "||" if anchored else ""
        after = pieces[i + 1] if i + 1 < len(pieces) else "|" if end else ""
        parts.append((pieces[i], before in ("^", "||"), after in ("^", "|")))
        regex += re.escape(pieces[i]) + {"*": ".*", "^": r"(?:[^0-9a-z_.%-]|$)"}.get(after, "")
    return Rule(rule, regex + ("$" if end else ""), _whole_tokens(parts), "pattern", BLOCK)


def default_rules() -> list[Rule]:
    return [place_rule(*x) for x in PLACES] + [pattern(x) for x in PATTERNS]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, "://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, ascii_uppercase, ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_index(tokens: DataFrame, rules: list[Rule], spark: SparkSession) -> DataFrame:
    """(token, rule, regex, kind, verdict): each rule under the rarest of its
    tokens; ``tokens`` holds a row per URL and token."""
    named = spark.createDataFrame(
        [(r.rule, r.regex, r.kind, r.verdict, list(r.tokens)) for r in rules],
        "rule string, regex string, kind string, verdict string, tokens array<string>")
    each = named.select("rule", "regex", "kind", "verdict", F.explode_outer("tokens").alias("token"))
    wanted = sorted({t for r in rules for t in r.tokens})
    those = spark.createDataFrame([(t,) for t in wanted] or [(None,)], "w string")
    if fits(len(wanted), sum(map(len, wanted)), broadcast_limit(spark)):
        those = F.broadcast(those)
    seen = tokens.join(those, F.col("token") == F.col("w"), "left_semi")
    n = seen.groupBy(F.col("token").alias("t")).agg(F.count(F.lit(1)).alias("n"))
    each = each.join(n, F.col("token") == F.col("t"), "left")
    rank = F.struct(F.coalesce("n", F.lit(0)), "token")
    return each.groupBy("rule", "regex", "kind", "verdict").agg(
        F.coalesce(F.min_by("token", rank), F.lit("")).alias("token"))


def filter_urls(pages: DataFrame, rules: list[Rule] | None = None, url: str = "url") -> DataFrame:
    """``pages`` with host, path, rule (the place rule that decides, or null),
    pattern (a pattern that fits, or null) and verdict."""
    rules = default_rules() if rules is None else rules
    spark = pages.sparkSession
    urls = pages.select(F.col(f"`{url}`").alias("u")).where("u like '%://%'").distinct()
    rest = F.lower(F.regexp_extract("u", r"://([\s\S]*)", 1))
    urls = stored(urls.select("u", F.concat(host_of(F.col("u")), path_of(F.col("u"))).alias("place"),
                              rest.alias("rest")), "urls")
    keys = F.array_distinct(F.array_append(F.split("rest", "[^a-z0-9]+"), F.lit("")))
    tokens = urls.select("u", "place", "rest", F.explode(keys).alias("token"))
    index = stored(rule_index(tokens, rules, spark), "index")
    if fits(*measure(index), broadcast_limit(spark)):
        index = F.broadcast(index)
    text = F.when(F.col("kind") == "place", F.col("place")).otherwise(F.col("rest"))
    hits = tokens.join(index, "token").where(F.rlike(text, F.col("regex")))
    of = F.col("kind") == "place"
    longest = F.struct(F.char_length("rule").alias("n"), "rule", F.col("verdict").alias("says"))
    best = hits.groupBy("u").agg(F.max(F.when(of, longest)).alias("best"),
                                 F.min(F.when(~of, F.col("rule"))).alias("pattern"))
    # stored, so that both sides of the join are plain exchanges
    best = stored(best.select("u", "best.rule", "best.says", "pattern"), "judged")
    p = packed(pages, url)
    link = F.col(f"__{url}")
    # dealt out by URL at every size: the verdicts grow with the pages
    out = p.join(best.hint("merge"), link == F.col("u"), "left")
    by_pattern = F.when(F.col("pattern").isNotNull(), F.lit(BLOCK)).otherwise(F.lit(ALLOW))
    return out.select(*unpacked(pages.columns, RESULTS), host_of(link).alias("host"),
                      path_of(link).alias("path"), "rule", "pattern",
                      F.coalesce("says", by_pattern).alias("verdict"))
