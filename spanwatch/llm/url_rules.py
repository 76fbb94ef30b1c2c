"""URL filter rules, found through their rarest literal token. DataFrame functions only.

A rule is a pattern over ``host + path + query + fragment`` of a URL (the host in lower case):
``||`` anchors at a host or any of its subdomains, ``|`` at the start or the end, ``*`` stands for
any text, ``^`` for a separator or the end. A literal token of a rule is a whole run of ASCII
letters and digits that any fitting URL must contain as a whole run too. Each rule is filed under
the token that the fewest URLs have. A URL's tokens fetch the rules filed under them, and only
these run as regular expressions. A rule without a literal token is filed under the empty token,
which every URL then has.

Of the rules that fit, a higher ``tier`` wins, then the longer rule, then ``block``, then the
smaller text. A URL that no rule fits is allowed.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from spanwatch.llm.common import lower_ascii, settle

RULE_SCHEMA = "rule string, pattern string, verdict string, tier int"


def host_of(url: Column) -> Column:
    """Text between the first ``://`` and ``/``, ``?``, ``#`` or the end; empty without ``://``."""
    return lower_ascii(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _tail_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^?#]*(.*)", 1), F.lit(""))


def subject_of(url: Column) -> Column:
    return F.concat(host_of(url), path_of(url), _tail_of(url))


def path_rules(spark: SparkSession, rules: Iterable[tuple[str, str, str]], tier: int = 1) -> DataFrame:
    """Rules ``(host, path, verdict)``: the host and its subdomains, paths starting with ``path``."""
    rows = [(host + path, f"||{host}{path}", verdict, tier) for host, path, verdict in rules]
    return spark.createDataFrame(rows, RULE_SCHEMA)


def pattern_rules(spark: SparkSession, patterns: Iterable[tuple[str, str]], tier: int = 0) -> DataFrame:
    """Rules ``(pattern, verdict)`` in the syntax above."""
    return spark.createDataFrame([(p, p, verdict, tier) for p, verdict in patterns], RULE_SCHEMA)


def _regex(pattern: Column) -> Column:
    """The pattern as a Java regular expression."""
    host_anchor = pattern.startswith("||")
    start_anchor = pattern.startswith("|") & ~host_anchor
    body = F.regexp_replace(pattern, r"^\|{1,2}", "")
    end_anchor = body.endswith("|")
    body = F.regexp_replace(body, r"\|$", "")
    body = F.regexp_replace(body, r"([\\.+?()\[\]{}|$])", r"\\$1")
    body = F.regexp_replace(body, r"\^", r"(?:[^A-Za-z0-9_.%-]|\$)")
    body = F.regexp_replace(body, r"\*", ".*")
    head = F.when(host_anchor, F.lit(r"^(?:[^/?#]*\.)?")).when(start_anchor, F.lit("^")).otherwise(F.lit(""))
    return F.concat(F.lit("(?s)"), head, body, F.when(end_anchor, F.lit(r"\z")).otherwise(F.lit("")))


def _literal_tokens(pattern: Column) -> Column:
    """Runs that stand whole in any fitting URL: not at an open end, not beside ``*``."""
    closed = F.concat(
        F.when(pattern.startswith("|"), F.lit("")).otherwise(F.lit("*")),
        pattern,
        F.when(pattern.endswith("|"), F.lit("")).otherwise(F.lit("*")),
    )
    return F.array_distinct(
        F.regexp_extract_all(closed, F.lit(r"(?<![A-Za-z0-9*])[A-Za-z0-9]+(?![A-Za-z0-9*])"), F.lit(0))
    )


def _url_tokens(subject: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(subject, F.lit("[A-Za-z0-9]+"), F.lit(0)))


def index_rules(rules: DataFrame, subjects: DataFrame) -> DataFrame:
    """Each rule with its regular expression and the literal token that the fewest URLs have."""
    tokens = rules.select(
        "rule",
        "verdict",
        "tier",
        _regex(F.col("pattern")).alias("regex"),
        F.explode_outer(_literal_tokens(F.col("pattern"))).alias("token"),
    )
    seen = (
        subjects.select(F.explode(_url_tokens(F.col("subject"))).alias("token"))
        .join(tokens.select("token").distinct(), "token", "left_semi")
        .groupBy("token")
        .agg(F.count(F.lit(1)).alias("urls"))
    )
    rarest = F.min_by("token", F.struct(F.coalesce("urls", F.lit(0)), -F.length("token"), "token"))
    return (
        tokens.join(seen, "token", "left")
        .groupBy("rule", "verdict", "tier", "regex")
        .agg(F.coalesce(rarest, F.lit("")).alias("token"))
    )


def judge_urls(pages: DataFrame, rules: DataFrame, url: str = "url") -> DataFrame:
    """``pages`` with ``host``, ``path``, ``rule`` (the winning one, else null), ``tier``, ``verdict``.

    Every row stays, repeated rows too, with all its columns; the five new columns replace columns
    of these names. A null URL or one without ``://`` has an empty host and path and is judged as
    the empty text; an empty rule table allows everything. Each distinct URL is judged once, so a
    URL or host that most rows share is no hot group: its verdict is joined back.
    """
    new = ["host", "path", "rule", "tier", "verdict"]
    kept = pages.select(*[F.col(f"`{c}`") for c in pages.columns if c not in new])
    keyed = kept.withColumn("__subject", subject_of(F.col(f"`{url}`")))
    subjects = keyed.select(F.col("__subject").alias("subject")).distinct()
    index = settle(index_rules(rules, subjects), "url-rule-index")
    open_rules = index.filter(F.col("token") == "").limit(1).count() > 0
    tokens = _url_tokens(F.col("subject"))
    tokens = F.array_append(tokens, F.lit("")) if open_rules else tokens
    order = F.struct(
        "tier", F.length("rule").alias("n"), (F.col("verdict") == "block").alias("block"), "rule"
    )
    won = (
        subjects.select("subject", F.explode(tokens).alias("token"))
        .join(index, "token")
        .filter(F.expr("subject rlike regex"))
        .groupBy("subject")
        .agg(F.max_by(F.struct("rule", "tier", "verdict"), order).alias("won"))
    )
    return keyed.join(won, keyed["__subject"] == won["subject"], "left").select(
        *[keyed[f"`{c}`"] for c in kept.columns],
        host_of(keyed[f"`{url}`"]).alias("host"),
        path_of(keyed[f"`{url}`"]).alias("path"),
        F.col("won.rule").alias("rule"),
        F.col("won.tier").alias("tier"),
        F.coalesce("won.verdict", F.lit("allow")).alias("verdict"),
    )
