"""URL filter: fixed rules first, then the reputation of the host.

Reputation is an empirical-Bayes estimate of the share of bad pages. Labelled
pages are counted per host, registered domain and suffix. Each level is a
beta-binomial around the estimate of the level above it, and how far a level
strays from its parents (its intra-class correlation) is estimated from the
counts themselves, by moments. A host is blocked where the lower posterior
bound of its share of bad pages is above `max_bad`: a host with few labels is
held near its domain, one without any is its domain's prior.

All of it is SQL functions over counts. Hosts with many pages are summed
map-side; verdicts reach the pages by a join that keeps hot hosts off the key.

A null url, or one without `://`, has an empty host and path; these pages are a
host of their own. A null id has no label. Labels that repeat an id all count;
a null label counts as none. Empty tables: no pages, or no labels, where every
host is its prior and nothing is blocked but by rule.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlens.operators.joins import lookup_join
from ledgerlens.sources.scratch import stored

# Fixed by the task: verdict, host, path.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Suffixes of two labels; every other suffix is the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "co.nz", "com.br")
MAX_BAD = 0.5
# One-sided 95 % bound.
BOUND_SDS = 1.645
# The correlation within a level stays between these, so a prior weighs 1 to 999 labels.
LEAST_RHO, MOST_RHO = 0.001, 0.5


def ascii_lower(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, else null. Among equally long ones, that of the longer host."""
    by_length = sorted(rules, key=lambda r: (-len(r[1] + r[2]), -len(r[1]), r[1:]))
    fits = [((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p)) for _, h, p in by_length]
    named = [F.struct(F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")) for v, h, p in by_length]
    return F.coalesce(*[F.when(fit, name) for fit, name in zip(fits, named)]) if named else F.lit(None).cast("struct<rule:string,verdict:string>")


def _labels_of(host: Column) -> Column:
    """Labels of the host's name, without user, port and closing dot."""
    return F.split(F.regexp_replace(host, r"^.*@|:[0-9]*$|\.+(:[0-9]*)?$", ""), r"\.")


def suffix_of(host: Column) -> Column:
    """The last label, or two where these are a known suffix. An IPv4 address has none."""
    labels = _labels_of(host)
    last, two = F.element_at(labels, -1), F.array_join(F.slice(labels, F.greatest(F.size(labels) - 1, F.lit(1)), 2), ".")
    return F.when(F.regexp_like(last, F.lit("^[0-9]+$")), "").when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(last)


def domain_of(host: Column, suffix: Column) -> Column:
    """The suffix and the label before it; the whole name, if it has no more labels or no suffix."""
    labels = _labels_of(host)
    kept = F.when(suffix == "", F.size(labels)).otherwise(F.size(F.split(suffix, r"\.")) + 1)
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - kept + 1, F.lit(1)), kept), ".")


def _prior_weight(level: DataFrame) -> Column:
    """How many labels the prior of a level (`n`, `bad`, `mean` of the parent) weighs: 1 / rho - 1.

    Under a beta-binomial, n * (bad / n - mean)**2 is mean * (1 - mean) * (1 + (n - 1) * rho) on average.
    """
    spread = F.col("mean") * (1 - F.col("mean"))
    seen = level.filter("n > 0").agg(
        F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - F.col("mean"), F.lit(2.0))).alias("found"),
        F.sum(spread).alias("alone"),
        F.sum(spread * (F.col("n") - 1)).alias("shared"),
    )
    rho = F.when(F.col("shared") > 0, (F.col("found") - F.col("alone")) / F.col("shared"))
    held = F.least(F.greatest(F.coalesce(rho, F.lit(LEAST_RHO)), F.lit(LEAST_RHO)), F.lit(MOST_RHO))
    return seen.select(1 / held - 1).scalar()


def _shrunk(level: DataFrame) -> DataFrame:
    """A level with the beta posterior of each member: `weight` labels, prior included, and their share of bad ones."""
    level = level.withColumn("prior", _prior_weight(level)).withColumn("weight", F.col("n") + F.col("prior"))
    return level.withColumn("share", (F.col("bad") + F.col("prior") * F.col("mean")) / F.col("weight"))


def host_reputation(outcomes: DataFrame) -> DataFrame:
    """Posterior of the share of bad pages per host: (host, n, bad, share, weight, bound).

    `outcomes`: rows (host, n, bad) of labelled pages and of those among them that are bad; n is 0 for hosts without any.
    """
    hosts = outcomes.groupBy("host").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    hosts = stored(hosts.withColumn("suffix", suffix_of(F.col("host"))).withColumn("domain", domain_of(F.col("host"), F.col("suffix"))))
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    overall = hosts.agg(((F.coalesce(F.sum("bad"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("mean"))
    suffixes = stored(_shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("mean", overall.scalar())))
    domains = hosts.groupBy("suffix", "domain").agg(*counts)
    domains = stored(_shrunk(_under(domains, suffixes, "suffix", "domain")))
    hosts = _shrunk(_under(hosts.drop("suffix"), domains, "domain", "host"))
    deviation = F.sqrt(F.col("share") * (1 - F.col("share")) / (F.col("weight") + 1))
    return hosts.select("host", "n", "bad", "share", "weight", (F.col("share") - BOUND_SDS * deviation).alias("bound"))


def _under(level: DataFrame, parents: DataFrame, key: str, name: str) -> DataFrame:
    """`level` with the estimate of its parent as `mean`; a parent of a third of all members is spread."""
    return lookup_join(level, parents.select(key, F.col("share").alias("mean")), [key], spread_by=name)


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    max_bad: float = MAX_BAD,
) -> DataFrame:
    """(page_id, host, path, rule, verdict) of every row of `pages` (page_id, url).

    `outcomes`: (page_id, bad boolean) of labelled pages, any number a page.
    """
    seen = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    labelled = stored(
        outcomes.filter("page_id IS NOT NULL AND bad IS NOT NULL")
        .groupBy("page_id")
        .agg(F.count("*").alias("n"), F.count_if("bad").alias("bad"))
    )
    counted = lookup_join(seen, labelled, ["page_id"], spread_by="host, path")
    counted = counted.select("host", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "bad")])
    blocked = stored(host_reputation(counted).filter(F.col("bound") > max_bad).select("host", F.lit(True).alias("_bad_host")))
    ruled = lookup_join(seen, blocked, ["host"], spread_by="page_id, path").withColumn("_rule", rule_of(F.col("host"), F.col("path"), rules))
    own = F.when(F.col("_bad_host"), "block").otherwise("allow")
    return ruled.select("page_id", "host", "path", "_rule.rule", F.coalesce("_rule.verdict", own).alias("verdict"))
