"""URL filter: stated rules first, then empirical-Bayes reputation of hosts.

Labelled pages give each host a count of bad outcomes.  A suffix's rate is shrunk towards the rate of
all, a registered domain's towards its suffix's, a host's towards its domain's, each by a beta prior
whose strength is estimated from the spread of the units' rates (method of moments).  A host is
blocked if the lower posterior bound of its bad rate exceeds ``LIMIT``: a host with few pages is
judged mostly by its domain.

Counts are added up before they move; only sums of a level meet in one task.  All of it is
DataFrame expressions.

A null url, or one without ``://``, has an empty host and path and is judged by the pages like it.
Labels that repeat an id are bad if any is; null labels count as absent.  Null page ids have no
label.  Extra columns are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kindred.sources.staging import cut

LIMIT = 0.5
# One-sided 95 % bound.
DEVIATIONS = 1.645
LEAST_SPREAD, MOST_SPREAD = 1e-4, 0.99
# Suffixes of two labels.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "org.au", "org.uk")

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    after = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    return F.translate(F.regexp_extract(after, "^([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: str) -> Column:
    after = F.expr(f"CASE WHEN instr({url}, '://') > 0 THEN substring({url}, instr({url}, '://') + 3) ELSE '' END")
    return F.regexp_extract(after, "^[^/?#]*([^?#]*)", 1)


def rule_of(host: str, path: str, rules: tuple[tuple[str, str, str], ...]) -> Column:
    """The longest rule ``(verdict, host, path)`` that fits, as a struct of its text and verdict; else null."""

    def fits(rule: tuple[str, str, str]) -> Column:
        _, h, p = rule
        return ((F.col(host) == h) | F.endswith(F.col(host), F.lit("." + h))) & F.startswith(F.col(path), F.lit(p))

    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[1] + r[2]))
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return reduce(
        lambda rest, r: F.when(fits(r), F.struct(F.lit(r[1] + r[2]).alias("rule"), F.lit(r[0]).alias("verdict"))).otherwise(rest),
        reversed(longest),
        none,
    )


def domain_levels(host: str) -> dict[str, Column]:
    """Registered domain and suffix of a host (without user and port)."""
    name = F.regexp_replace(F.regexp_replace(F.col(host), "^.*@", ""), ":[0-9]*$", "")
    labels = F.split(name, "\\.")
    two = F.substring_index(name, ".", -2)
    suffix = F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(name, ".", -1))
    kept = F.size(F.split(suffix, "\\.")) + 1
    return {"domain": F.when(F.size(labels) <= kept, name).otherwise(F.array_join(F.slice(labels, -kept, kept), ".")), "suffix": suffix}


def _strength(units: DataFrame) -> float:
    """Strength of the prior, from the spread of the units' rates around their parents'.

    Rows: ``n``, ``bad`` and the parent's observed rate ``around``.
    """
    got = units.where("n > 0").agg(
        F.count("*").alias("k"),
        F.sum("n").alias("total"),
        F.sum(F.col("n") * F.col("n")).alias("squares"),
        F.sum("bad").alias("bad"),
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("around"), 2)).alias("spread"),
    ).first()
    if not got["k"]:
        return (1 - LEAST_SPREAD) / LEAST_SPREAD
    p, free = got["bad"] / got["total"], got["k"] - 1
    below = p * (1 - p) * (got["total"] - got["squares"] / got["total"] - free)
    rho = (got["spread"] - p * (1 - p) * free) / below if below > 0 else LEAST_SPREAD
    rho = min(max(rho, LEAST_SPREAD), MOST_SPREAD)
    return (1 - rho) / rho


def reputations(outcomes: DataFrame) -> DataFrame:
    """``(host, rate, bound)`` from rows ``(host, bad)``; bad is null for pages without a label."""
    hosts = outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = cut(hosts.withColumns(domain_levels("host")))
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    n, bad = suffixes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("bad"), F.lit(0))).first()

    def observed(units: DataFrame, key: str) -> DataFrame:
        return units.select(key, (F.col("bad") / F.greatest("n", F.lit(1))).alias("around"))

    def shrunk(units: DataFrame, strength: float) -> DataFrame:
        """Posterior beta of each unit, given its parent's posterior rate ``prior``."""
        alpha = F.col("bad") + strength * F.col("prior")
        beta = F.col("n") - F.col("bad") + strength * (1 - F.col("prior"))
        return units.withColumn("weight", alpha + beta).withColumn("rate", alpha / F.col("weight"))

    of_all = F.lit((bad + 0.5) / (n + 1))
    around_all = F.lit(bad / max(n, 1))
    by_suffix = shrunk(suffixes.withColumn("prior", of_all), _strength(suffixes.withColumn("around", around_all)))
    by_domain = shrunk(
        domains.join(by_suffix.select("suffix", F.col("rate").alias("prior")), "suffix"),
        _strength(domains.join(observed(suffixes, "suffix"), "suffix")),
    )
    by_host = shrunk(
        hosts.join(by_domain.select("domain", "suffix", F.col("rate").alias("prior")), ["domain", "suffix"]),
        _strength(hosts.join(observed(domains, "domain"), "domain")),
    )
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("weight") + 1))
    return by_host.select("host", "rate", (F.col("rate") - DEVIATIONS * deviation).alias("bound"))


def judged(pages: DataFrame, labels: DataFrame, rules: tuple[tuple[str, str, str], ...] = (), limit: float = LIMIT) -> DataFrame:
    """``(page_id, host, path, rule, verdict, bound)`` of every row.

    A labelled page is bad if its quality is 0 or it is toxic.
    """
    split = pages.select("page_id", host_of("url").alias("host"), path_of("url").alias("path"))
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)").groupBy(F.col("doc_id").alias("_id")).agg(
        F.max(((F.coalesce("quality", F.lit(1)) == 0) | (F.coalesce("toxic", F.lit(0)) == 1)).cast("int")).alias("bad")
    )
    outcomes = split.join(known, F.col("page_id") == F.col("_id"), "left").select("host", "bad")
    told = split.withColumn("_rule", rule_of("host", "path", rules))
    return told.join(reputations(outcomes), "host").select(
        "page_id",
        "host",
        "path",
        F.col("_rule.rule").alias("rule"),
        F.coalesce(F.col("_rule.verdict"), F.when(F.col("bound") > limit, "block").otherwise("allow")).alias("verdict"),
        "bound",
    )
