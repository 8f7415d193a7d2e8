"""Host reputation by empirical Bayes, and URL rules.

Labelled page outcomes (1 good, 0 bad) are counted per host with map-side combine and rolled up to
registered domain (the last two labels of the host) and suffix (the last label). At each level the
rate is beta-binomial: its prior has the posterior mean of the level above and a strength fitted by
the method of moments over all groups of the level, so a host without outcomes inherits its domain,
a domain its suffix, a suffix the whole corpus. A host is blocked when the upper bound of its
posterior good rate, mean + z standard deviations of the beta, lies below ``min_good``.

Rules come first: a rule (host, path) fits its host and all subdomains if the url's path starts with
the rule's path; the longest rule that fits wins.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower

#: Bounds of a prior's strength, in outcomes: what the moments give is held between them.
STRENGTH = (1.0, 1000.0)


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty where there is no ``://``."""
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def registered_domain(host: Column) -> Column:
    return F.substring_index(host, ".", -2)


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


def matched_rule(host: Column, path: Column, rules: Sequence[Rule]) -> tuple[Column, Column]:
    """(rule text, its verdict) of the longest rule that fits; nulls if none does."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # later, longer rules override
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        text, verdict = F.when(fits, rule.text).otherwise(text), F.when(fits, rule.verdict).otherwise(verdict)
    return text, verdict


def _strength(mean: Column, n: Column, good: Column) -> Column:
    """Prior strength by moments: how far the groups' rates vary beyond binomial noise (intra-group correlation)."""
    groups = F.count(F.lit(1)).cast("double")
    spread = F.sum(F.try_divide(n * F.pow(good / n - mean, F.lit(2)), mean * (1 - mean)))
    room = F.sum(n) - F.sum(n * n) / F.sum(n) - (groups - 1)
    rho = F.try_divide(spread - (groups - 1), room)
    fitted = F.when(rho > 0, 1 / rho - 1).otherwise(F.lit(STRENGTH[1]))
    return F.least(F.greatest(F.coalesce(fitted, F.lit(STRENGTH[1])), F.lit(STRENGTH[0])), F.lit(STRENGTH[1]))


def host_posteriors(outcomes: DataFrame, hosts: DataFrame) -> DataFrame:
    """outcomes (host, good 0/1), hosts (host) -> (host, a, b): the beta posterior of every host.

    Both tables are aggregated by host before anything else; the roll-ups hold at most one row per
    host. Without any outcome the corpus rate is 1/2.
    """
    counts = outcomes.filter("good is not null").groupBy("host").agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum("good").cast("double").alias("k"))
    every = hosts.select("host").distinct().join(counts, "host", "full").select(
        "host", F.coalesce("n", F.lit(0.0)).alias("n"), F.coalesce("k", F.lit(0.0)).alias("k"),
        registered_domain(F.col("host")).alias("domain"), suffix(F.col("host")).alias("suffix"))
    domains = every.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    corpus = suffixes.agg(F.coalesce(F.try_divide(F.sum("k"), F.sum("n")), F.lit(0.5)).alias("mean"))
    suffixes = _shrink(suffixes.withColumn("mean", corpus.scalar())).select("suffix", F.col("post").alias("mean"))
    domains = _shrink(domains.join(suffixes, "suffix")).select("domain", F.col("post").alias("mean"))
    return _shrink(every.join(domains, "domain")).select(
        "host", (F.col("strength") * F.col("mean") + F.col("k")).alias("a"),
        (F.col("strength") * (1 - F.col("mean")) + F.col("n") - F.col("k")).alias("b"))


def _shrink(level: DataFrame) -> DataFrame:
    """Adds the level's fitted ``strength`` (one number) and each group's posterior mean ``post``."""
    fit = level.filter("n > 0").agg(_strength(F.col("mean"), F.col("n"), F.col("k")).alias("strength"))
    out = level.withColumn("strength", fit.scalar())
    return out.withColumn("post", (F.col("strength") * F.col("mean") + F.col("k")) / (F.col("strength") + F.col("n")))


def judge_urls(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], id_col: str = "page_id", url: str = "url",
    outcome_id: str = "page_id", good: str = "good", min_good: float = 0.5, z: float = 2.0, keep: tuple[str, ...] = (),
) -> DataFrame:
    """One row per page: ``id_col``, ``keep``, host, path, rule, verdict, and the posterior (good_rate, good_upper).

    ``outcomes`` (``outcome_id``, ``good``: 1, 0 or null) names pages by id; a page with several
    outcomes counts each, outcomes of unknown pages count for nothing. A null url, or one without
    ``://``, has an empty host, whose reputation is that of all such urls. Repeated rows each keep
    their row. An empty table gives an empty result.
    """
    cols = [id_col, *keep]
    u = F.col(f"`{url}`")
    rows = pages.select(
        *[F.col(f"`{c}`").alias(f"k{i}") for i, c in enumerate(cols)], url_host(u).alias("host"), url_path(u).alias("path"))
    told = outcomes.select(F.col(f"`{outcome_id}`").alias("id2"), F.col(f"`{good}`").alias("good")).filter("good is not null")
    seen = rows.select("k0", "host").join(told, F.col("k0") == F.col("id2"))
    post = host_posteriors(seen.select("host", "good"), rows)
    a, b = F.col("a"), F.col("b")
    mean = a / (a + b)
    post = post.select(F.col("host").alias("host2"), mean.alias("good_rate"),
                       (mean + z * F.sqrt(mean * (1 - mean) / (a + b + 1))).alias("good_upper"))
    text, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    judged = rows.join(post, F.col("host") == F.col("host2"), "left")
    method = F.when(F.col("good_upper") < min_good, F.lit("block")).otherwise(F.lit("allow"))
    return judged.select(
        *[F.col(f"k{i}").alias(c) for i, c in enumerate(cols)], "host", "path", text.alias("rule"),
        F.coalesce(verdict, method).alias("verdict"), "good_rate", "good_upper")
