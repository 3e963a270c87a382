"""URL filter: fixed rules, else the empirical-Bayes reputation of the host.

Rules are (host, path, verdict): one fits its host and every subdomain if the path starts with its
path; the longest fitting rule decides. Where no rule fits, the host's reputation does.

Reputation: labelled pages are trials, bad ones successes. The rate of bad pages has a beta prior
at each level, whose mean is the posterior mean of the level above (all pages, suffix, registered
domain, host) and whose strength comes from the data: by the method of moments for beta-binomial
counts, sum((k - n m)^2) = sum(n m (1 - m) (1 + (n - 1) rho)) over the groups of a level gives
rho, and the prior counts as 1 / rho - 1 trials. A host with few labels thus stays close to its
domain, and a domain to its suffix. A host is blocked when the lower bound of its posterior (mean
less `z` standard deviations) exceeds `max_bad`.

Everything is a DataFrame expression: outcomes are partially aggregated per host, the levels above
are sums over hosts (each level is a written table, so no level is computed twice), and pages join
one row per host (a host with a third of the pages is split by AQE's skew join).

A null URL, or one without "://", has empty host and path, which are a host like any other. Null
outcomes are unlabelled pages; repeated pages count as often as they occur.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from txnguard.llm.common import settle

# public suffixes of two labels that hosts are commonly registered under (fixed values)
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp",
                      "co.nz", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr")


@dataclass(frozen=True)
class ReputationParams:
    max_bad: float = 0.5
    z: float = 1.6448536269514722          # one-sided 95 %
    min_rho: float = 1e-4
    max_rho: float = 0.5
    start_bad: float = 0.5                 # mean where nothing is labelled


def url_host(url) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("://")), _lower(host)).otherwise("")


def url_path(url) -> Column:
    path = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)
    return F.when(F.contains(F.coalesce(url, F.lit("")), F.lit("://")), path).otherwise("")


def _lower(c) -> Column:
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def bare_host(host) -> Column:
    """Without user, port and final dot."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r":\d*$|\.$", "")


def suffix_of(bare) -> Column:
    two = F.substring_index(bare, ".", -2)
    number = F.regexp_like(bare, F.lit(r"^[\d.]+$"))
    return (F.when(number, F.lit("")).when(two.isin(*TWO_LABEL_SUFFIXES), two)
            .otherwise(F.substring_index(bare, ".", -1)))


def domain_of(bare) -> Column:
    """The suffix and one label more; numeric addresses are their own domain."""
    number = F.regexp_like(bare, F.lit(r"^[\d.]+$"))
    labels = F.when(F.substring_index(bare, ".", -2).isin(*TWO_LABEL_SUFFIXES),
                    F.substring_index(bare, ".", -3)).otherwise(F.substring_index(bare, ".", -2))
    return F.when(number, bare).otherwise(labels)


def fitting_rule(host, path, rules: list[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as struct(rule, verdict); null if none does."""
    out = None
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1], r[2]))
    for rule_host, rule_path, verdict in ordered:
        fits = (((host == rule_host) | F.endswith(host, F.lit("." + rule_host)))
                & F.startswith(path, F.lit(rule_path)))
        value = F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
        out = F.when(fits, value) if out is None else out.when(fits, value)
    none = F.lit(None).cast("struct<rule:string,verdict:string>")
    return none if out is None else out.otherwise(none)


def _rho(n, k, mean, p: ReputationParams) -> Column:
    """Aggregate: overdispersion of a level's groups around their parents' means."""
    spread = mean * (1 - mean)
    excess = F.sum((k - n * mean) * (k - n * mean) - n * spread)
    room = F.sum(n * (n - 1) * spread)
    return F.greatest(F.lit(p.min_rho), F.least(F.lit(p.max_rho), F.coalesce(
        F.try_divide(excess, room), F.lit(p.min_rho))))


def reputation(outcomes: DataFrame, p: ReputationParams = ReputationParams()) -> DataFrame:
    """`outcomes` (host, bad: 1, 0 or null) to one row per host: host, n, bad_mean, bad_low,
    verdict. The mean of all pages and the strength of each level are scalar subqueries."""
    hosts = outcomes.groupBy("host").agg(
        F.count("bad").cast("double").alias("n"),
        F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k"))
    bare = bare_host(F.col("host"))
    hosts = settle(hosts.withColumns({"suffix": suffix_of(bare), "domain": domain_of(bare)}),
                   "hosts")
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    start = hosts.agg(F.coalesce(F.try_divide(F.sum("k"), F.sum("n")), F.lit(p.start_bad))).scalar()

    def shrunk(level: DataFrame, name: str) -> DataFrame:
        """Adds a, b of the posterior, given parent means."""
        level = settle(level, name)
        rho = level.agg(_rho(F.col("n"), F.col("k"), F.col("parent"), p)).scalar()
        return (level.withColumn("prior", 1 / rho - 1)
                .withColumn("a", F.col("parent") * F.col("prior") + F.col("k"))
                .withColumn("b", (1 - F.col("parent")) * F.col("prior") + F.col("n") - F.col("k")))

    def mean(level: DataFrame, *keys: str) -> DataFrame:
        return level.select(*keys, (F.col("a") / (F.col("a") + F.col("b"))).alias("parent"))

    suffixes = shrunk(hosts.groupBy("suffix").agg(*sums).withColumn("parent", start), "suffixes")
    domains = shrunk(hosts.groupBy("suffix", "domain").agg(*sums)
                     .join(mean(suffixes, "suffix"), "suffix"), "domains")
    judged = shrunk(hosts.join(mean(domains, "suffix", "domain"), ["suffix", "domain"]), "judged")
    a, b = F.col("a"), F.col("b")
    low = a / (a + b) - p.z * F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return judged.select("host", F.col("n").cast("long").alias("n"),
                         (a / (a + b)).alias("bad_mean"), low.alias("bad_low"),
                         F.when(low > p.max_bad, "block").otherwise("allow").alias("verdict"))


def judge(pages: DataFrame, rules: list[tuple[str, str, str]], bad: Column, page: str = "page_id",
          url: str = "url", p: ReputationParams = ReputationParams()) -> DataFrame:
    """page_id, host, path, rule, verdict, bad_mean, bad_low for each page. `bad` is an expression
    over `pages`: 1 or 0 where the page is labelled, else null."""
    rows = pages.select(F.col(page).alias("page_id"), url_host(F.col(url)).alias("host"),
                        url_path(F.col(url)).alias("path"), bad.cast("int").alias("bad"))
    hosts = reputation(rows.select("host", "bad"), p).withColumnRenamed("verdict", "by_method")
    fit = fitting_rule(F.col("host"), F.col("path"), rules)
    return (rows.drop("bad").join(hosts, "host").withColumn("fit", fit)
            .select("page_id", "host", "path", F.col("fit.rule").alias("rule"),
                    F.coalesce("fit.verdict", "by_method").alias("verdict"), "bad_mean",
                    "bad_low"))
