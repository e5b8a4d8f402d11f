"""URL filters: pattern rules indexed by their rarest literal token.

Every rule is compiled to a regular expression and to the literal tokens (runs of a-z and 0-9) that
stand between signs in any url it fits. The index files a rule under the one of these that is
rarest in the urls at hand; rules without such a token are filed under the empty one, which every url
has. A url's tokens fetch its candidate rules, and only those run their regular expression.

Each distinct url is judged once, so a url or host that holds any share of all rows costs no more.
Null urls and those without ``://`` have an empty host and path, and still meet the pattern rules
(a null url as an empty text). Rows are kept as they are, repeated ones included.
"""

import re
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import functions as F

from .common import ascii_lower, bounded

TOKEN = r"[^0-9a-z]+"


@dataclass(frozen=True)
class PrefixRule:
    """A host with its subdomains and the start of the path."""

    verdict: str
    host: str
    path: str

    @property
    def name(self):
        return self.host + self.path

    def row(self):
        # Host labels are whole tokens; the path's last one may go on in the url.
        tokens = re.split(TOKEN, self.host) + re.split(TOKEN, self.path.lower())[:-1]
        regex = rf"^(?:[^/\x00]*\.)?{re.escape(self.host)}\x00{re.escape(self.path)}"
        return (self.name, self.verdict, "site", regex, sorted(set(tokens) - {""}), len(self.name))


@dataclass(frozen=True)
class PatternRule:
    """A regular expression over the lower-cased url, with the whole tokens any match must contain."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple = ()

    def row(self):
        return (self.name, self.verdict, "url", self.pattern, sorted(self.tokens), 0)


# The site rules that come first.
SITE_RULES = (
    PrefixRule("allow", "org", "/"),
    PrefixRule("block", "example.org", "/es/"),
    PrefixRule("block", "example.org", "/en/1"),
    PrefixRule("allow", "com", "/fr/"),
    PrefixRule("block", "com", "/de/"),
)
# What decides where no site rule fits: any of these blocks.
PATTERN_RULES = (
    PatternRule("link-farm", "block", r"^[^/]*://(?:[^/?#]*[.])?spam-farm[.]", ("spam", "farm")),
    PatternRule("tracker", "block", r"[?&]utm_source=spam(?:&|#|$)", ("utm", "source", "spam")),
    PatternRule("casino", "block", r"[./-]casino[./-]", ("casino",)),
    PatternRule("adult", "block", r"[./-]porn[./-]", ("porn",)),
    PatternRule("sign-in copy", "block", r"[./-]login[./-].*[./-]verify[./-]", ("login", "verify")),
    PatternRule("address as host", "block", r"^[a-z]+://[0-9]{1,3}(?:[.][0-9]{1,3}){3}(?:[:/?#]|$)"),
    PatternRule("many hyphens", "block", r"^[a-z]+://[^/?#]*-[^/?#-]*-[^/?#-]*-[^/?#-]*-"),
)


def host_and_path(url):
    """Host (after the first ``://``, A-Z lower-cased) and path (up to ``?`` or ``#``) of a url."""
    after = F.when(F.contains(url, F.lit("://")), F.substr(url, F.locate("://", url) + 3))
    host = ascii_lower(F.coalesce(F.regexp_extract(after, r"^[^/?#]*", 0), F.lit("")))
    path = F.coalesce(F.regexp_extract(after, r"^[^/?#]*([^?#]*)", 1), F.lit(""))
    return host, path


def rule_table(spark, rules):
    """``rule, verdict, kind, regex, tokens, length`` of some rules."""
    names = ("rule", "verdict", "kind", "regex", "tokens", "length")
    kinds = (pa.string(), pa.string(), pa.string(), pa.string(), pa.list_(pa.string()), pa.int32())
    columns = zip(*[rule.row() for rule in rules]) if rules else [()] * len(names)
    return spark.createDataFrame(pa.table({n: pa.array(c, k) for n, k, c in zip(names, kinds, columns)}))


def rule_index(rules, urls):
    """Rules with the ``token`` they are filed under: their rarest in ``urls`` (ties: the smallest)."""
    tokens = rules.select(F.explode("tokens").alias("token")).distinct()
    seen = urls.select(F.explode("tokens").alias("token")).join(bounded(tokens), "token", "left_semi")
    counts = seen.groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    filed = rules.withColumn("token", F.explode_outer("tokens")).join(counts, "token", "left")
    rarest = filed.groupBy("rule", "kind").agg(
        F.min(F.struct(F.coalesce("n", F.lit(0)), "token"))["token"].alias("token"))
    return rules.join(rarest.withColumn("token", F.coalesce("token", F.lit(""))), ["rule", "kind"]).drop("tokens")


def judge_urls(pages, rules=(*SITE_RULES, *PATTERN_RULES), default="allow"):
    """``page_id, url, host, path, rule, verdict, pattern`` of each row.

    ``rule`` is the longest site rule that fits (null if none) and decides; else ``pattern``, the
    first by name of the pattern rules that match, does; else ``default``.
    """
    spark = pages.sparkSession
    table = rule_table(spark, rules)
    host, path = host_and_path(F.col("url"))
    urls = pages.select("url").distinct().select(
        "url", host.alias("host"), path.alias("path"), ascii_lower(F.coalesce("url", F.lit(""))).alias("_small"))
    urls = urls.withColumn("tokens", F.array_distinct(F.concat(F.array(F.lit("")), F.split("_small", TOKEN))))
    index = rule_index(table, urls)
    fetched = urls.select("url", "host", "path", "_small", F.explode("tokens").alias("token")).join(
        bounded(index), "token")
    subject = F.when(F.col("kind") == "site", F.concat("host", F.lit("\0"), "path")).otherwise(F.col("_small"))
    fits = fetched.filter(F.rlike(subject, F.col("regex"))).groupBy("url").agg(
        F.max(F.when(F.col("kind") == "site", F.struct("length", "rule", "verdict"))).alias("_site"),
        F.min(F.when(F.col("kind") == "url", F.struct("rule", "verdict"))).alias("_pattern"),
    ).withColumnRenamed("url", "_url")
    named = pages.select("page_id", "url").join(fits, F.col("url").eqNullSafe(F.col("_url")), "left")
    return named.select(
        "page_id", "url", host.alias("host"), path.alias("path"), F.col("_site.rule").alias("rule"),
        F.coalesce("_site.verdict", "_pattern.verdict", F.lit(default)).alias("verdict"),
        F.col("_pattern.rule").alias("pattern"),
    )
