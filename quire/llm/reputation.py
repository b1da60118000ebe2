"""URL filters: empirical-Bayes reputation of hosts.

Labelled page outcomes (good or not) are counted by host, registered domain and
suffix. Each level's rate is shrunk towards the one above by a beta-binomial
prior: mean from the parent's posterior, strength from the spread of all
children of that level around their parents (method of moments). A host is
blocked when the upper bound of its posterior rate of good pages (``Z``
standard deviations above the mean) lies below ``LEAST_GOOD``; a host without
outcomes has its domain's prior. Rules given by the user go first: a rule
``[host]/[path]`` fits its host and all subdomains if the url's path starts with
the rule's path, and the longest fitting rule decides.

Counts are pre-aggregated by host before anything is joined; the tables of
domains and suffixes are derived from the hosts'.

Defined results: a null url, or one without ``://``, has an empty host and path,
fits no rule and is judged by the prior of its empty host; null outcomes count
for nothing; repeated pages are counted and judged as often as they stand
there; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quire.llm.common import only, saved

LEAST_GOOD = 0.5
Z = 1.96
WEAKEST, STRONGEST = 1.0, 10_000.0  # bounds of a prior's strength, in pages

# fixed values: suffixes of two labels under which names are registered
TWO_LABEL_SUFFIXES = ["ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp", "co.nz", "co.za",
                      "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "com.ar", "com.tw"]


def host_of(url: Column) -> Column:
    """Between the first ``://`` and the next ``/``, ``?``, ``#`` or end; A-Z in lower case."""
    return F.translate(F.regexp_extract(after_scheme(url), "^[^/?#]*", 0), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    """From there up to ``?``, ``#`` or end."""
    return F.regexp_extract(after_scheme(url), "^[^/?#]*([^?#]*)", 1)


def after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    """The suffix and one label more."""
    return F.when(F.substring_index(host, ".", -2).isin(TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def plain_host(host: Column) -> Column:
    """Without user name and port: the name that has the reputation."""
    return F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")


def fitting_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """The longest of the (verdict, rule) pairs that fits, and its verdict; nulls if none does."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, r in sorted(rules, key=lambda x: (len(x[1]), x[1])):   # later ones go over earlier ones
        name, _, rest = r.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, r).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def shrunk(children: DataFrame, parents: DataFrame, parent: str) -> DataFrame:
    """``children`` (name, its parent's name, n, s) with the mean ``m0`` and strength
    ``k`` of the prior, and the posterior mean ``m``."""
    rows = children.join(parents.select(F.col("name").alias(parent), F.col("m").alias("m0")), parent)
    v = F.col("m0") * (1 - F.col("m0"))
    sums = rows.filter("n > 0").agg(
        F.coalesce(F.sum(F.col("n") * F.pow(F.col("s") / F.col("n") - F.col("m0"), 2) - v), F.lit(0.0)).alias("over"),
        F.coalesce(F.sum((F.col("n") - 1) * v), F.lit(0.0)).alias("room"))
    rho = F.when(F.col("room") > 0, F.col("over") / F.col("room")).otherwise(0.0)
    over, room = sums.first()   # one row
    rho = over / room if room > 0 else 0.0
    k = min(STRONGEST, max(WEAKEST, 1 / max(rho, 1e-9) - 1)) if rho > 0 else STRONGEST
    return rows.withColumn("k", F.lit(k)).withColumn("m", (F.lit(k) * F.col("m0") + F.col("s")) / (F.lit(k) + F.col("n")))


def reputations(pages: DataFrame, outcomes: DataFrame, page_col: str = "page_id", url_col: str = "url", good_col: str = "good") -> DataFrame:
    """For each host of ``pages``: host, n and s (outcomes, good ones), prior mean and
    strength, posterior mean and ``bound``, its upper bound."""
    seen = only(pages, page=page_col, url=url_col).select("page", plain_host(host_of(F.coalesce("url", F.lit("")))).alias("name"))
    told = only(outcomes, page=page_col, good=good_col).filter("good is not null").groupBy("page").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("s"))
    zero = F.lit(0).cast("long")
    hosts = (seen.join(told, "page", "left").groupBy("name").agg(F.coalesce(F.sum("n"), zero).alias("n"), F.coalesce(F.sum("s"), zero).alias("s"))
             .withColumn("domain", domain_of(F.col("name"))).withColumn("suffix", suffix_of(F.col("name"))))
    hosts = saved(hosts, "hosts")
    add = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    domains = hosts.groupBy(F.col("domain").alias("name"), "suffix").agg(*add)
    suffixes = hosts.groupBy(F.col("suffix").alias("name")).agg(*add).withColumn("root", F.lit("all"))
    root = hosts.agg(*[F.coalesce(c, zero).alias(x) for c, x in zip((F.sum("n"), F.sum("s")), "ns")]).select(F.lit("all").alias("name"), ((F.col("s") + 1) / (F.col("n") + 2)).alias("m"))
    # the means of each level are a table of their own: no level is computed twice
    suffixes = saved(shrunk(suffixes, root, "root").select("name", "m"), "suffixes")
    domains = saved(shrunk(domains, suffixes, "suffix").select("name", "m"), "domains")
    total = F.col("k") + F.col("n") + 1
    return shrunk(hosts, domains, "domain").select(
        F.col("name").alias("host"), "n", "s", F.col("m0").alias("prior"), F.col("k").alias("strength"), F.col("m").alias("mean"),
        F.least(F.lit(1.0), F.col("m") + Z * F.sqrt(F.col("m") * (1 - F.col("m")) / total)).alias("bound"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] = (), page_col: str = "page_id", url_col: str = "url", good_col: str = "good",
          least_good: float = LEAST_GOOD) -> DataFrame:
    """Each page's id, host, path, rule (or null) and verdict (allow or block)."""
    src = only(pages, page=page_col, url=url_col)
    host, path = host_of(F.coalesce("url", F.lit(""))), path_of(F.coalesce("url", F.lit("")))
    ranks = reputations(pages, outcomes, page_col, url_col, good_col).select(F.col("host").alias("name"), F.when(F.col("bound") < least_good, "block").otherwise("allow").alias("earned"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), list(rules))
    return (src.select("page", host.alias("host"), path.alias("path")).withColumn("name", plain_host(F.col("host"))).join(ranks, "name")
            .select(F.col("page").alias(page_col), "host", "path", rule.alias("rule"), F.coalesce(verdict, F.col("earned")).alias("verdict")))
