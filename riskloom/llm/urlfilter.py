"""URL filtering by site rules and pattern rules, found through the rarest literal token.

Every rule is a regular expression over ``host + path`` together with the literal tokens (runs of
a-z and 0-9) that any url it fits must hold in full. Rules are indexed by the one of their tokens
that the fewest urls hold. The tokens of a url fetch the rules indexed under them, and only these
candidates run their regular expression. Everything is DataFrame functions.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Up to this many rules the index is a literal of the plan and nothing is shuffled.
LITERAL_RULES = 200
# Up to this many rules the index is broadcast to the token join (well under 100 MB).
BROADCAST_RULES = 200_000


@dataclass(frozen=True)
class UrlRule:
    """``site`` rules win over pattern rules, then the longer name wins, then the greater name."""

    name: str
    verdict: str
    pattern: str
    tokens: tuple[str, ...]
    site: bool = False


def site_rule(rule: str, verdict: str) -> UrlRule:
    """A rule ``host/path``: fits the host and all its subdomains where the path starts alike."""
    host, slash, path = rule.partition("/")
    host = host.translate(str.maketrans(_UPPER, _LOWER))
    pattern = r"^(?:[^/]*\.)?" + _quote(host) + _quote(slash + path)
    # The last token of a path prefix may go on in the url, so it counts only if something ends it.
    tokens = re.findall("[a-z0-9]+", re.sub("[a-z0-9]+$", "", (host + slash + path).translate(str.maketrans(_UPPER, _LOWER))))
    return UrlRule(rule, verdict, pattern, tuple(tokens), True)


def pattern_rule(name: str, verdict: str, pattern: str, tokens: Sequence[str] = ()) -> UrlRule:
    """A rule by regular expression; without ``tokens`` it is a candidate for every url."""
    return UrlRule(name, verdict, pattern, tuple(tokens))


def _quote(literal: str) -> str:
    return re.sub(r"([^A-Za-z0-9/])", r"\\\1", literal)


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Lower-case host, and path without query and fragment; both empty without ``://``."""
    url = F.coalesce(url.cast("string"), F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(host) + 1, F.length(rest)), "^[^?#]*", 0)
    return F.translate(host, _UPPER, _LOWER), path


def url_tokens(subject: Column) -> Column:
    """Distinct runs of letters and digits, A-Z in lower case."""
    return F.array_distinct(F.filter(F.split(F.translate(subject, _UPPER, _LOWER), "[^a-z0-9]+"), lambda t: t != ""))


def index_rules(urls: DataFrame, rules: Sequence[UrlRule], subject: str = "_subject") -> list[tuple[str | None, UrlRule]]:
    """Each rule with the token it is indexed under: the one that the fewest of all urls hold."""
    wanted = sorted({t for r in rules for t in r.tokens})
    counts: dict[str, int] = {}
    if wanted and any(len(set(r.tokens)) > 1 for r in rules):
        held = urls.select(F.explode(url_tokens(F.col(subject))).alias("token"))
        if len(wanted) <= LITERAL_RULES:
            held = held.where(F.col("token").isin(wanted))
        else:
            held = held.join(urls.sparkSession.createDataFrame([(t,) for t in wanted], "token string"), "token", "left_semi")
        # One row per token of the rules at most.
        counts = {r["token"]: r["n"] for r in held.groupBy("token").agg(F.count("*").alias("n")).collect()}
    return [(min(r.tokens, key=lambda t: (counts.get(t, 0), t)) if r.tokens else None, r) for r in rules]


def _rank(rule: Column) -> Column:
    return F.struct(rule["site"].alias("site"), F.length(rule["name"]).alias("size"), rule["name"].alias("name"), rule["verdict"].alias("verdict"))


def judge_urls(
    df: DataFrame,
    rules: Sequence[UrlRule],
    url: str = "url",
    default: str = "allow",
    literal_rules: int = LITERAL_RULES,
) -> DataFrame:
    """Verdict on every row's url.

    Adds ``host``, ``path``, ``rule`` (the site rule that won, else null), ``pattern`` (the pattern
    rule that won where no site rule fits, else null) and ``verdict`` (the winner's, or ``default``).
    Columns of ``df`` with these names are replaced. A null url, or one without ``://``, has an
    empty host and path, which only rules on empty text can fit. Rows are kept once each, equal
    rows alike.

    One aggregate counts the urls per rule token. Few rules then work row by row; more rules are
    joined by token, distinct urls only, and the verdicts joined back by url.
    """
    added = ["host", "path", "rule", "pattern", "verdict"]
    names = [c for c in df.columns if c not in added]
    host, path = host_and_path(df[url])
    # The caller's columns travel as one, whatever they are called.
    row = F.struct(*[df[c] for c in names]) if names else F.struct(F.lit(0).alias("none"))
    base = df.select(row.alias("_row"), host.alias("host"), path.alias("path")).withColumn("_subject", F.concat("host", "path"))
    index = index_rules(base, rules)
    if len(index) <= literal_rules:
        judged = base.withColumn("_best", _by_literal(index))
    else:
        judged = base.join(_by_join(base.select("_subject").distinct(), index), "_subject", "left")
    site = F.col("_best.site")
    return judged.select(
        *[F.col("_row").getField(c).alias(c) for c in names],
        "host",
        "path",
        F.when(site, F.col("_best.name")).alias("rule"),
        F.when(~site, F.col("_best.name")).alias("pattern"),
        F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"),
    )


def _by_literal(index: list[tuple[str | None, UrlRule]]) -> Column:
    if not index:
        return F.lit(None).cast("struct<site:boolean,size:int,name:string,verdict:string>")
    listed = F.array(
        *[
            F.struct(
                F.lit(token).cast("string").alias("token"),
                F.lit(r.pattern).alias("pattern"),
                F.lit(r.site).alias("site"),
                F.lit(r.name).alias("name"),
                F.lit(r.verdict).alias("verdict"),
            )
            for token, r in index
        ]
    )
    tokens = url_tokens(F.col("_subject"))
    candidates = F.filter(listed, lambda r: r["token"].isNull() | F.array_contains(tokens, r["token"]))
    fits = F.filter(candidates, lambda r: F.regexp_like(F.col("_subject"), r["pattern"]))
    return F.array_max(F.transform(fits, _rank))


def _by_join(subjects: DataFrame, index: list[tuple[str | None, UrlRule]]) -> DataFrame:
    spark = subjects.sparkSession
    rows = [(token or "", r.pattern, r.site, r.name, r.verdict) for token, r in index]
    listed = spark.createDataFrame(rows, "token string, pattern string, site boolean, name string, verdict string")
    if len(rows) <= BROADCAST_RULES:
        listed = F.broadcast(listed)
    # The empty token stands for rules without literals; every url holds it.
    held = subjects.select("_subject", F.explode(F.concat(F.array(F.lit("")), url_tokens(F.col("_subject")))).alias("token"))
    fits = held.join(listed, "token").where(F.regexp_like("_subject", "pattern"))
    best = F.struct("site", F.length("name").alias("size"), "name", "verdict")
    return fits.groupBy("_subject").agg(F.max(best).alias("_best"))
