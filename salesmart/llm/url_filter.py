"""URL filters: hashed host-suffix / path-prefix rules.

A rule is (host, path, action).  It fits a URL whose host is the rule's host
or a subdomain of it and whose path starts with the rule's path.  Each URL is
expanded into its host suffixes times its path prefixes that end in ``/``
(and the empty one); each rule into its host and the part of its path up to
the last ``/``.  Both sides are equi-joined on the first 32 bits of the
SHA-256 of that text, the full digest is compared, and the rest of the rule's
path is confirmed on the URL's own path.  Of the rules that fit, the longest
rule text wins, then the longer host, then ``block`` over ``allow``.

Scale: URLs are reduced to distinct (host, path) pairs before the expansion,
so a URL that a third of all pages share is expanded once.  Suffixes and
prefixes longer than any rule's are not built (two maxima of the rule table,
so nothing is lost).  The verdicts, only of URLs that some rule fits, are
written to the shared folder; the pages are joined to them on (host, path),
a join whose hot keys adaptive execution splits.  No side is broadcast
by hint.

Defined cases: a null URL or one without ``://`` has an empty host and path
and fits no rule.  Repeated pages and pages without an id keep their rows.
Empty tables give empty results; an empty rule table gives the default
verdict.  Rules with a null host or path are ignored.  Input columns named as
an output column are replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from salesmart.llm.common import lower_ascii, with_columns_last, written

#: The rules of the registered query, as (host, path, action).
RULES = (
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
)
SHORT_HEX = 8


def url_host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))


def _stem(path: Column) -> Column:
    """The path up to and including its last ``/``."""
    return F.regexp_extract(path, r"(?s)^(?:.*/)?", 0)


def _digest(host: Column, stem: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\u0000"), stem), 256)


def host_suffixes(host: Column, most_labels: int) -> Column:
    """The host and its parent domains, of at most ``most_labels`` labels."""
    labels = F.split(host, r"\.")
    n = F.size(labels)
    return F.transform(
        F.sequence(F.greatest(n - F.lit(most_labels - 1), F.lit(1)), n),
        lambda i: F.array_join(F.slice(labels, i, n), "."))


def path_stems(path: Column, deepest: int) -> Column:
    """The empty prefix and the prefixes that end in one of the first ``deepest`` slashes."""
    parts = F.split(path, "/")
    slashes = F.least(F.size(parts) - 1, F.lit(deepest))
    return F.transform(
        F.sequence(F.lit(0), slashes),
        lambda k: F.when(k == 0, F.lit("")).otherwise(
            F.concat(F.array_join(F.slice(parts, F.lit(1), F.greatest(k, F.lit(1))), "/"), F.lit("/"))))


def rule_table(spark, rules=RULES) -> DataFrame:
    return spark.createDataFrame(list(rules), "host string, path string, action string")


def hashed_rules(rules: DataFrame) -> DataFrame:
    host = lower_ascii(F.col("host"))
    return (rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
            .select(host.alias("r_host"), F.col("path").alias("r_path"), F.col("action").alias("r_action"))
            .distinct()
            .withColumn("r_digest", _digest(F.col("r_host"), _stem(F.col("r_path"))))
            .withColumn("r_short", F.substring("r_digest", 1, SHORT_HEX)))


def rule_verdicts(urls: DataFrame, rules: DataFrame) -> DataFrame:
    """(u_host, u_path, u_rule, u_verdict) of the distinct (u_host, u_path) that a rule fits."""
    hashed = hashed_rules(rules)
    most = hashed.agg(
        F.max(F.size(F.split("r_host", r"\."))).alias("labels"),
        F.max(F.size(F.split("r_path", "/")) - 1).alias("slashes")).first()
    labels, slashes = most["labels"] or 1, most["slashes"] or 0
    expressions = (urls.select("u_host", "u_path").distinct()
                   .withColumn("u_suffix", F.explode(host_suffixes(F.col("u_host"), labels)))
                   .withColumn("u_stem", F.explode(path_stems(F.col("u_path"), slashes)))
                   .withColumn("u_digest", _digest(F.col("u_suffix"), F.col("u_stem")))
                   .select("u_host", "u_path", "u_digest",
                           F.substring("u_digest", 1, SHORT_HEX).alias("u_short")))
    fits = expressions.join(hashed, F.col("u_short") == F.col("r_short")).where(
        (F.col("u_digest") == F.col("r_digest")) & F.col("u_path").startswith(F.col("r_path")))
    rule = F.concat("r_host", "r_path")
    best = F.max(F.struct(F.length(rule).alias("n"), F.length("r_host").alias("h"),
                          (F.col("r_action") == "block").alias("b"), rule.alias("rule"),
                          F.col("r_action").alias("action")))
    return (fits.groupBy("u_host", "u_path").agg(best.alias("u_best"))
            .select("u_host", "u_path", F.col("u_best.rule").alias("u_rule"),
                    F.col("u_best.action").alias("u_verdict")))


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url",
                default: str = "allow") -> DataFrame:
    """``pages`` with host, path, rule (null if none fits) and verdict."""
    parsed = pages.select(F.struct("*").alias("u_record"), url_host(F.col(url)).alias("p_host"),
                          url_path(F.col(url)).alias("p_path"))
    urls = parsed.select(F.col("p_host").alias("u_host"), F.col("p_path").alias("u_path"))
    verdicts = written(rule_verdicts(urls, rules), "url-verdicts")
    joined = parsed.join(
        verdicts, (F.col("p_host") == F.col("u_host")) & (F.col("p_path") == F.col("u_path")), "left")
    return with_columns_last(
        joined, "u_record",
        [F.col("p_host"), F.col("p_path"), F.col("u_rule"), F.coalesce("u_verdict", F.lit(default))],
        ["host", "path", "rule", "verdict"])
