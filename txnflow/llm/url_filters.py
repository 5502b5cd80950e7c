"""URL filters: fixed rules first, then empirical-Bayes host reputation.

Labelled page outcomes are counted per host. A beta-binomial prior is handed down from all
hosts to the suffix, from the suffix to the registered domain and from there to the host;
its strength at each level is fitted by moments. A host is blocked when even the lower bound
of its posterior share of bad pages is above a threshold.

Defined cases: a null URL, or one without ``://``, has an empty host and path and is judged
with the other empty hosts. A numeric or bracketed address is its own domain and suffix. A host without labelled pages has its domain's posterior. Without
any labelled page nothing is blocked by reputation. Repeated pages count as often as they
occur. Other columns of the inputs are ignored, so names may clash.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnflow.session import work_folder

BLOCK, ALLOW = "block", "allow"
#: Suffixes of two labels under which names are registered.
SUFFIXES = (
    "ac.uk", "co.uk", "gov.uk", "ltd.uk", "me.uk", "net.uk", "org.uk", "plc.uk", "sch.uk",
    "com.au", "edu.au", "gov.au", "net.au", "org.au", "ac.nz", "co.nz", "govt.nz", "net.nz", "org.nz",
    "ac.jp", "co.jp", "go.jp", "ne.jp", "or.jp", "ac.kr", "co.kr", "go.kr", "or.kr",
    "ac.in", "co.in", "gov.in", "net.in", "org.in", "ac.za", "co.za", "gov.za", "org.za",
    "com.cn", "edu.cn", "gov.cn", "net.cn", "org.cn", "com.tw", "edu.tw", "gov.tw", "org.tw",
    "com.br", "edu.br", "gov.br", "net.br", "org.br", "com.mx", "edu.mx", "gob.mx", "org.mx",
    "com.ar", "edu.ar", "gob.ar", "org.ar", "com.tr", "edu.tr", "gov.tr", "org.tr",
    "ac.il", "co.il", "gov.il", "org.il", "com.sg", "edu.sg", "gov.sg", "com.hk", "edu.hk", "gov.hk", "org.hk",
)


@dataclass(frozen=True)
class UrlRule:
    """``net/`` or ``example.com/de/``: a host with its subdomains, and a prefix of the path."""

    text: str
    verdict: str

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        return self.text[len(self.host) :]


@dataclass(frozen=True)
class Reputation:
    """``z`` standard deviations below the posterior mean must still exceed ``threshold``.

    A prior counts as many pages as the moments say, from ``weakest`` to ``strongest``, and
    ``weakest`` where no host has two labelled pages to tell. Under ``suffixes`` of two labels
    a registered domain has three.
    """

    z: float = 1.645
    threshold: float = 0.5
    weakest: float = 4.0
    strongest: float = 1000.0
    suffixes: tuple[str, ...] = SUFFIXES


def url_host(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def matched_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> tuple[Column, Column]:
    """Text and verdict of the longest rule that fits; nulls without one."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        inside = (host == rule.host) | host.endswith("." + rule.host)
        fits = inside & path.startswith(rule.path)
        text = F.when(fits, F.lit(rule.text)).otherwise(text)
        verdict = F.when(fits, F.lit(rule.verdict)).otherwise(verdict)
    return text, verdict


def registered_domain(host: Column, suffixes: tuple[str, ...] = SUFFIXES) -> tuple[Column, Column]:
    """Registered domain and its suffix, without a port: the last two labels, three under ``suffixes``."""
    bracketed = F.concat(F.substring_index(host, "]", 1), F.lit("]"))
    name = F.when(host.startswith("["), bracketed).otherwise(F.substring_index(host, ":", 1))
    address = name.startswith("[") | name.rlike(r"^[0-9]+(\.[0-9]+){3}$")
    two = F.substring_index(name, ".", -2)
    wide = two.isin(*suffixes)
    domain = F.when(address, name).when(wide, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, F.when(address, name).when(wide, two).otherwise(F.substring_index(name, ".", -1))


def _strength(children: DataFrame, mean: str, settings: Reputation) -> float:
    """Pages a level's prior counts, from the spread of the children's outcomes about their means."""
    n, k, m = F.col("n").cast("double"), F.col("k").cast("double"), F.col(mean)
    spread, chance, pairs = children.agg(
        F.sum((k - n * m) * (k - n * m)), F.sum(n * m * (1 - m)), F.sum(n * (n - 1) * m * (1 - m))
    ).first()
    if not pairs:
        return settings.weakest
    share = (spread - chance) / pairs
    if share <= 0:
        return settings.strongest
    return min(max(1 / share - 1, settings.weakest), settings.strongest)


def _posterior(mean: str, strength: float) -> Column:
    return (F.col("k") + F.lit(strength) * F.col(mean)) / (F.col("n") + F.lit(strength))


def host_reputation(hosts: DataFrame, settings: Reputation = Reputation()) -> DataFrame:
    """Posterior of every host from ``host``, labelled pages ``n`` and bad ones ``k``.

    The driver sees four numbers: the overall share and the strength of each level's prior.
    """
    total, bad = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("k"), F.lit(0))).first()
    overall = (bad + 1) / (total + 2)
    domain, suffix = registered_domain(F.col("host"), settings.suffixes)
    hosts = hosts.select("host", "n", "k", domain.alias("domain"), suffix.alias("suffix"))
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = suffixes.withColumn("parent", F.lit(overall))
    suffixes = suffixes.withColumn("suffix_mean", _posterior("parent", _strength(suffixes, "parent", settings)))
    domains = domains.join(suffixes.select("suffix", "suffix_mean"), "suffix")
    domains = domains.withColumn("domain_mean", _posterior("suffix_mean", _strength(domains, "suffix_mean", settings)))
    hosts = hosts.join(domains.select("domain", "domain_mean"), "domain")
    strength = F.lit(_strength(hosts, "domain_mean", settings))
    mean = (F.col("k") + strength * F.col("domain_mean")) / (F.col("n") + strength)
    weight = F.col("n") + strength + 1
    bound = F.greatest(mean - settings.z * F.sqrt(mean * (1 - mean) / weight), F.lit(0.0))
    return hosts.select("host", "n", "k", mean.alias("bad_share"), bound.alias("bad_bound"))


def judge_urls(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: tuple[UrlRule, ...],
    settings: Reputation = Reputation(),
) -> DataFrame:
    """Verdict for every row of ``pages`` (page_id, url); ``outcomes`` has page_id and bad (0/1).

    Several outcomes of a page count once, as bad if any is. The counts per host are written
    to the shared work folder, since every level of the prior reads them.
    """
    spark = pages.sparkSession
    located = pages.select("page_id", "url").select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    known = outcomes.where(F.col("bad").isNotNull()).groupBy("page_id").agg(F.max("bad").alias("bad"))
    folder = work_folder(spark, "host-outcomes")
    (
        located.select("page_id", "host").join(known, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("long").alias("k"))
        .write.parquet(folder)
    )
    hosts = spark.read.schema("host string, n long, k long").parquet(folder)
    scored = host_reputation(hosts, settings)
    rule, fixed = matched_rule(F.col("host"), F.col("path"), rules)
    learned = F.when(F.col("bad_bound") > settings.threshold, BLOCK).otherwise(ALLOW)
    return (
        located.join(scored, "host", "left")
        .withColumn("rule", rule)
        .select(
            "page_id", "host", "path", "rule", F.coalesce(fixed, learned).alias("verdict"),
            F.col("n").alias("n_labelled"), F.col("k").alias("n_bad"),
            F.round("bad_share", 6).alias("bad_share"), F.round("bad_bound", 6).alias("bad_bound"),
        )
    )
