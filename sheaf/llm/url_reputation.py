"""URL filter: rules first, then an empirical-Bayes reputation of the host.

Labelled page outcomes are counted per host. Each level of the name (suffix,
registered domain, host) has a beta prior whose mean is the posterior mean
of the level above and whose strength is the moment estimate of how much
members of that level differ from their parents. A host is blocked when the
lower bound of its posterior bad rate (mean - z * sd) passes a limit, so a
host with little evidence is judged by its domain and suffix.

All counts are partial aggregates: a host holding a third of all pages is
one row per task after the map side. Pages meet verdicts in an ordinary
equality join on the host, which Spark broadcasts or splits by measured size.

Defined cases: NULL url or one without ``://`` has empty host and path; it
takes the verdict of the empty host. A NULL outcome is no outcome. No
outcomes at all: the prior mean is ``DEFAULT_BAD`` and everything passes.
Repeated pages are judged alike, repeated outcomes count each, an url of any
length is taken whole; an empty table gives no rows. Other columns are not
read, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick

#: fixed values
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
RULES = [
    ("allow", "com/"),
    ("block", "example.com/en/"),
    ("allow", "www.example.com/en/"),
    ("block", "net/es/"),
    ("block", "net/fr/"),
]
#: name endings of two labels under which names are registered
SECOND_LEVEL = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.nz", "co.jp", "co.kr", "com.br", "co.in"]
Z = 1.645
MAX_BAD = 0.5
DEFAULT_BAD = 0.1
STRENGTH = (1.0, 1000.0)  # prior pseudo-counts are held within these


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(SECOND_LEVEL), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(SECOND_LEVEL), F.substring_index(host, ".", -3)).otherwise(two)


def rule_column(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, NULL where none does.
    Rules are configuration: a list in the plan, not data."""
    rule = verdict = None
    for act, text in sorted(rules, key=lambda r: (-len(r[1]), r[1])):
        h, slash, p = text.partition("/")
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(slash + p)
        rule = F.when(fits, F.lit(text)) if rule is None else rule.when(fits, F.lit(text))
        verdict = F.when(fits, F.lit(act)) if verdict is None else verdict.when(fits, F.lit(act))
    none = F.lit(None).cast("string")
    return (none, none) if rule is None else (rule, verdict)


def _level(counts: DataFrame, parent: DataFrame, keys: list[str], up: list[str]) -> DataFrame:
    """Posterior of every group of one level. ``counts``: keys, n, bad;
    ``parent``: up, mean. The strength is one row, from sums over all groups."""
    g = counts.join(parent.select(*up, F.col("mean").alias("m")), up) if up else counts.withColumn("m", parent.select("mean").scalar())
    v = F.col("m") * (1 - F.col("m"))
    low, high = 1 / (STRENGTH[1] + 1), 1 / (STRENGTH[0] + 1)
    # nothing to estimate from (no group of two outcomes): the weakest prior
    over, base = F.sum((F.col("bad") - F.col("n") * F.col("m")) ** 2 - F.col("n") * v), F.sum(F.col("n") * (F.col("n") - 1) * v)
    rho = F.coalesce(F.when(base > 0, F.try_divide(over, base)), F.lit(high))
    fit = g.agg(F.greatest(F.lit(low), F.least(F.lit(high), rho)).alias("rho"))
    strength = fit.select((1 / F.col("rho") - 1).alias("k")).scalar()
    out = g.withColumn("k", strength)
    a, b = F.col("k") * F.col("m") + F.col("bad"), F.col("k") * (1 - F.col("m")) + F.col("n") - F.col("bad")
    return out.select(*keys, "n", "bad", (a / (a + b)).alias("mean"), F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))).alias("sd"))


def reputations(hosts: DataFrame, z: float = Z, max_bad: float = MAX_BAD) -> DataFrame:
    """``hosts``: host, n labelled outcomes, bad of them bad (one row each,
    n may be 0). Adds mean, sd, bound and blocked."""
    named_ = hosts.select("host", F.col("n").cast("double").alias("n"), F.col("bad").cast("double").alias("bad"),
                          suffix_of(F.col("host")).alias("suffix"), domain_of(F.col("host")).alias("domain"))
    sums = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    root = named_.agg(F.coalesce(F.try_divide(F.sum("bad"), F.sum("n")), F.lit(DEFAULT_BAD)).alias("mean"))
    suffixes = _level(named_.groupBy("suffix").agg(*sums), root, ["suffix"], [])
    domains = _level(named_.groupBy("suffix", "domain").agg(*sums), suffixes, ["domain"], ["suffix"])
    out = _level(named_.select("host", "domain", "n", "bad"), domains, ["host"], ["domain"])
    bound = F.col("mean") - F.lit(z) * F.col("sd")
    return out.select("*", bound.alias("bound"), (bound > max_bad).alias("blocked"))


def judge(pages: DataFrame, outcomes: DataFrame, rules=RULES, z: float = Z, max_bad: float = MAX_BAD) -> DataFrame:
    """Every page with host, path, rule, verdict and its host's posterior.
    ``outcomes``: page_id, bad (0/1, NULL ignored; rows of one page add up)."""
    at = pick(pages, "page_id", "url").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    seen = pick(outcomes, "page_id", "bad").filter("bad IS NOT NULL AND page_id IS NOT NULL")
    seen = seen.groupBy("page_id").agg(F.count("*").alias("n"), F.sum("bad").alias("bad"))
    hosts = (
        at.select("page_id", "host").join(seen, "page_id", "left").groupBy("host")
        .agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    )
    rep = reputations(hosts, z, max_bad).select("host", F.col("n").cast("long").alias("n_outcomes"), F.col("mean").alias("bad_rate"), "bound", "blocked")
    rule, verdict = rule_column(F.col("host"), F.col("path"), rules)
    return at.join(rep, "host", "left").select(
        "page_id", "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), F.lit("block")).otherwise(F.lit("allow"))).alias("verdict"),
        F.coalesce("n_outcomes", F.lit(0)).cast("long").alias("n_outcomes"),
        F.round("bad_rate", 6).alias("bad_rate"),
    )


def url_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """The query: the label of id i is taken as the outcome of page i, bad
    when it is toxic or of low quality."""
    bad = ((F.col("toxic") == 1) | (F.col("quality") == 0)).cast("int")
    return judge(pages, pick(labels, "doc_id", "quality", "toxic").select(F.col("doc_id").alias("page_id"), bad.alias("bad")))


_CTE = """
{name}_g AS ({counts}),
{name}_k AS (SELECT 1.0 / greatest(1.0 / 1001, least(1.0 / 2, coalesce(CASE WHEN sum(n * (n - 1) * (m * (1 - m))) > 0
     THEN sum(pow(bad - n * m, 2) - n * (m * (1 - m))) / sum(n * (n - 1) * (m * (1 - m))) END, 1.0 / 2))) - 1 AS k FROM {name}_g),
{name}_p AS (SELECT *, k * m + bad AS a, k * (1 - m) + n - bad AS b FROM {name}_g, {name}_k),
{name} AS (SELECT *, a / (a + b) AS mean, sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) AS sd FROM {name}_p)"""

_TWO = "regexp_extract(host, '([^.]*\\.)?[^.]*$')"
ORACLE = (
    """WITH p AS (SELECT page_id, translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path FROM pages),
s AS (SELECT doc_id AS page_id, count(*) AS n, sum(CASE WHEN toxic = 1 OR quality = 0 THEN 1 ELSE 0 END) AS bad FROM labels
      WHERE (toxic = 1 OR quality = 0) IS NOT NULL AND doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, CAST(coalesce(sum(n), 0) AS DOUBLE) AS n, CAST(coalesce(sum(bad), 0) AS DOUBLE) AS bad FROM p LEFT JOIN s USING (page_id) GROUP BY host),
h2 AS (SELECT *, CASE WHEN """ + _TWO + " IN (" + ", ".join(f"'{x}'" for x in SECOND_LEVEL) + ") THEN " + _TWO
    + " ELSE regexp_extract(host, '[^.]*$') END AS suffix, CASE WHEN " + _TWO + " IN (" + ", ".join(f"'{x}'" for x in SECOND_LEVEL)
    + ") THEN regexp_extract(host, '([^.]*\\.)?([^.]*\\.)?[^.]*$') ELSE " + _TWO + """ END AS domain FROM h),
r AS (SELECT coalesce(sum(bad) / nullif(sum(n), 0), 0.1) AS m FROM h2),"""
    + ",".join(_CTE.format(name=n, counts=c) for n, c in (
        ("x", "SELECT suffix, sum(n) AS n, sum(bad) AS bad, any_value(r.m) AS m FROM h2, r GROUP BY suffix"),
        ("y", "SELECT domain, o.n, o.bad, x.mean AS m FROM (SELECT suffix, domain, sum(n) AS n, sum(bad) AS bad FROM h2 GROUP BY ALL) o JOIN x USING (suffix)"),
        ("w", "SELECT host, h2.n, h2.bad, y.mean AS m FROM h2 JOIN y USING (domain)"),
    ))
    + """, v AS (SELECT page_id, host, path, CASE
  WHEN (host = 'www.example.com' OR suffix(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
  WHEN (host = 'example.com' OR suffix(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
  WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
  WHEN (host = 'net' OR suffix(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
  WHEN (host = 'com' OR suffix(host, '.com')) AND starts_with(path, '/') THEN 'com/' END AS rule,
  w.n, w.mean, w.mean - 1.645 * w.sd > 0.5 AS blocked FROM p LEFT JOIN w USING (host))
SELECT page_id, host, path, rule, CASE WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' WHEN rule IS NOT NULL OR blocked THEN 'block' ELSE 'allow' END AS verdict,
  CAST(coalesce(n, 0) AS BIGINT) AS n_outcomes, round(mean, 6) AS bad_rate FROM v"""
)
