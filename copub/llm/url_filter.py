"""URL filter by empirical-Bayes host reputation, with DataFrame functions only.

Labelled page outcomes (1 good, 0 bad) are counted per host, registered domain and
suffix.  A level's rates vary around the level above it like a beta law; how much is
estimated from the data by the method of moments for beta-binomial counts, and
each rate is shrunk towards its parent's by that much: suffix towards all pages,
domain towards suffix, host towards domain.  A host is blocked if the lower posterior
bound of its good rate lies under a threshold.  Explicit rules come before that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import tables

BOUND_ERRORS = 1.645  # posterior standard deviations below the mean
LEAST_RATE = 0.75
# (host, path) -> verdict, as the service's owner states them
RULES = {"net/": "block", "example.net/en/": "allow", "example.com/de/": "block", "org/fr/": "allow"}
# Labels that countries use for kinds of registrants, so that "co.uk" is a suffix as a whole,
KINDS = "ac co com edu firm gen go gob gov govt gouv id in ind info ltd me mil ne net nhs nom or org plc re sch web"
# and domains whose subdomains belong to different owners
SHARED = "appspot.com azurewebsites.net blogspot.com cloudfront.net github.io gitlab.io herokuapp.com netlify.app pages.dev vercel.app web.app wordpress.com"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _LOWER)


def path(url: Column) -> Column:
    """Behind the host, up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site(host: Column) -> Column:
    """The host without user part, port and trailing dots: what a reputation belongs to."""
    return F.regexp_replace(host, r"(?s)^.*@|\.*(:[0-9]*)?\z", "")


def suffix_labels(site: Column) -> Column:
    """How many labels the site's public suffix has: 2 for a kind under a country, or a shared domain; 0 for addresses."""
    two = f"(^|\\.)(({KINDS.replace(' ', '|')})\\.[a-z][a-z]|{SHARED.replace('.', '[.]').replace(' ', '|')})\\z"
    address = r"(?s)^(\[.*|[0-9]+(\.[0-9]+){3})\z"
    return F.when(site.rlike(address), 0).when(site.rlike(two), 2).otherwise(1)


def _last_labels(site: Column, n: Column) -> Column:
    labels = F.split(site, r"\.")
    return F.array_join(F.slice(labels, F.greatest(F.size(labels) - n + 1, F.lit(1)), F.size(labels)), ".")


def matching_rule(rules: dict[str, str], host: Column, path: Column) -> Column:
    """The longest rule that fits: its host or a subdomain, and a path that begins with the rule's."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=len):  # the last that fits is the longest
        at = rule.index("/")
        name, start = rule[:at], rule[at:]
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(start)
        out = F.when(fits, F.lit(rule)).otherwise(out)
    return out


def _shrunk(level: DataFrame, key: str) -> DataFrame:
    """Adds the posterior mean ``rate`` and the prior strength ``weight``.

    ``level`` has n and good per ``key`` and the parent's rate ``up``.  With correlation r within a
    key, the squared deviation n (good/n - up)^2 has the mean up (1 - up) (1 + (n - 1) r).
    """
    spread = F.col("up") * (1 - F.col("up"))
    excess = F.col("n") * F.pow(F.col("good") / F.col("n") - F.col("up"), 2) - spread
    moments = level.where("n > 0").agg(F.sum(F.round(excess, 9).cast("decimal(38,9)")).cast("double").alias("over"), F.sum(F.round(spread * (F.col("n") - 1), 9).cast("decimal(38,9)")).cast("double").alias("room"))
    ratio = moments.select(F.least(F.lit(0.9), F.greatest(F.lit(0.001), F.coalesce(F.try_divide("over", "room"), F.lit(0.001)))).alias("r")).scalar()
    weight = 1 / ratio - 1
    return level.withColumn("weight", weight).withColumn("rate", (F.col("good") + F.col("weight") * F.col("up")) / (F.col("n") + F.col("weight")))


def reputation(outcomes: DataFrame) -> DataFrame:
    """Per host (as ``site`` gives it): n and good pages, the shrunk ``rate`` and its lower posterior ``bound``.

    ``outcomes`` has host and outcome (1, 0 or null) per page; hosts without labelled pages are
    judged by their domain or suffix.  The registered domain is the public suffix and the label before it; an
    address is its own domain, under the suffix of all addresses.  Without any labels every rate is one half.
    """
    hosts = outcomes.groupBy("host").agg(F.count("outcome").alias("n"), F.sum(F.coalesce("outcome", F.lit(0))).alias("good"))
    n = suffix_labels(F.col("host"))
    suffix = F.when(n == 0, F.lit("address")).otherwise(_last_labels(F.col("host"), n))
    domain = F.when(n == 0, F.col("host")).otherwise(_last_labels(F.col("host"), n + 1))
    hosts = tables.written(hosts.withColumns({"domain": domain, "suffix": suffix}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("good").alias("good"))
    overall = hosts.agg(((F.sum("good") + 1) / (F.sum("n") + 2)).alias("up")).scalar()
    suffixes = _shrunk(suffixes.withColumn("up", F.coalesce(overall, F.lit(0.5))), "suffix")
    domains = _shrunk(domains.join(suffixes.select("suffix", F.col("rate").alias("up")), "suffix"), "domain")
    hosts = _shrunk(hosts.join(domains.select("domain", F.col("rate").alias("up")), "domain"), "host")
    deviation = F.sqrt(F.col("rate") * (1 - F.col("rate")) / (F.col("n") + F.col("weight") + 1))
    return hosts.select("host", "n", "good", "rate", F.round(F.col("rate") - BOUND_ERRORS * deviation, 6).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: dict[str, str] = RULES, least: float = LEAST_RATE) -> DataFrame:
    """page_id, host, path, rule and verdict (allow or block) of every row of ``pages``.

    ``outcomes`` has page_id and outcome; contradicting outcomes of a page are averaged out (its
    outcome is null unless all agree).  A null url, or one without ``://``, has an empty host, which is
    judged like any other.  Repeated rows each give a row; other columns are ignored.
    """
    url = F.col("url").cast("string")
    parsed = pages.select("page_id", host(url).alias("host"), path(url).alias("path")).withColumn("site", site(F.col("host")))
    known = outcomes.where("outcome in (0, 1)").groupBy("page_id").agg(F.min("outcome").alias("outcome"), F.max("outcome").alias("other")).where("outcome = other").select("page_id", F.col("outcome").cast("long"))
    scored = reputation(parsed.join(known, "page_id", "left").select(F.col("site").alias("host"), "outcome"))
    judged = parsed.join(scored.select(F.col("host").alias("site"), "bound"), "site")
    rule = matching_rule(rules, F.col("host"), F.col("path"))
    verdicts = F.create_map(*(F.lit(x) for pair in rules.items() for x in pair))
    by_method = F.when(F.col("bound") < least, F.lit("block")).otherwise(F.lit("allow"))
    return judged.withColumn("rule", rule).select("page_id", "host", "path", "rule", F.coalesce(F.element_at(verdicts, F.col("rule")), by_method).alias("verdict"))
