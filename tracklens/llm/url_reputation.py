"""URL filtering by empirical-Bayes host reputation (native).

Every page gets the verdict of the longest fitting rule.  Pages that a rule
decides are the labelled outcomes (allow: good, block: bad); each host's share
of good pages is shrunk towards its registered domain, the domain towards its
suffix and the suffix towards the whole table by beta-binomial priors whose
strengths are estimated from the table (method of moments).  A page without a
rule is allowed when the lower bound of its host's posterior reaches
``min_bound``.

Edge cases: a null url, or one without ``://``, has the empty host and path and
no rule; it is judged by the posterior of the empty host.  Repeated rows count
as often as they occur.  Without any labelled page every mean is 0.5.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tracklens.llm.stages import settle

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
MAX_RULES = 1000
Z = 1.0
MIN_BOUND = 0.5
RHO_RANGE = (1e-4, 0.9)  # within-group correlation: prior strength 1 / rho - 1


def url_host_path(url: Column) -> tuple[Column, Column]:
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    raw = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(F.substring(rest, F.length(raw) + 1, F.length(rest)), r"^[^?#]*", 0)
    return F.coalesce(F.translate(raw, UPPER, LOWER), F.lit("")), F.coalesce(path, F.lit(""))


def rule_columns(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest fitting rule; null without one.
    Rules become one CASE expression, hence the bound on their number."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    text = verdict = F.lit(None).cast("string")
    for v, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text = F.when(fits, F.lit(h + p)).otherwise(text)
        verdict = F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def registered_domain(host: Column, labels: int = 2) -> Column:
    return F.substring_index(host, ".", -labels)


def shrink(groups: DataFrame, key: str, parent: Column, parents: DataFrame | None, parent_key: str) -> DataFrame:
    """Posterior (mean, strength) of each group of one level: columns key,
    parent key, n, s, mean, weight.  ``groups`` has key, n, s; ``parents`` has
    the parent level's key and mean (None: the Beta(1, 1) root)."""
    g = groups.withColumn(parent_key, parent)
    if parents is None:
        g = g.withColumn("mu", F.lit(0.5))
    else:
        g = g.join(parents.select(F.col(parent_key), F.col("mean").alias("mu")), parent_key)
    v = F.col("mu") * (1 - F.col("mu"))
    seen = F.col("n") > 0
    moments = g.agg(
        F.sum(F.when(seen, F.col("n") * F.pow(F.col("s") / F.nullif(F.col("n"), F.lit(0)) - F.col("mu"), 2))).alias("a"),
        F.sum(F.when(seen, v)).alias("b"),
        F.sum(F.when(seen, v * (F.col("n") - 1))).alias("c"),
    )
    raw = F.when(F.col("c") > 0, (F.col("a") - F.col("b")) / F.col("c")).otherwise(0.5)
    rho = F.least(F.greatest(F.coalesce(raw, F.lit(0.5)), F.lit(RHO_RANGE[0])), F.lit(RHO_RANGE[1]))
    k = moments.select((1 / rho - 1).alias("k"))
    total = F.col("k") + F.col("n")
    done = g.crossJoin(F.broadcast(k)).select(  # k is one row
        key, parent_key, "n", "s", ((F.col("k") * F.col("mu") + F.col("s")) / total).alias("mean"), total.alias("weight")
    )
    return settle(done, "level")  # the next level reads it, not all above it


def host_reputation(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """Posterior of every host of ``outcomes`` (host, good: 1, 0 or null for a
    page without a label): host, n, s, mean, bound."""
    hosts = settle(outcomes.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("s")), "hosts")
    level = lambda key, col: hosts.groupBy(col.alias(key)).agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    host, domain = F.col("host"), registered_domain(F.col("host"))
    suffix = F.substring_index(F.col("domain"), ".", -1)
    root = shrink(level("root", F.lit("")), "root", F.lit(""), None, "none")
    suffixes = shrink(level("suffix", F.substring_index(host, ".", -1)), "suffix", F.lit(""), root, "root")
    domains = shrink(level("domain", domain), "domain", suffix, suffixes, "suffix")
    posts = shrink(hosts, "host", domain, domains, "domain")
    m, w = F.col("mean"), F.col("weight")
    return posts.select("host", "n", "s", "mean", (m - z * F.sqrt(m * (1 - m) / (w + 1))).alias("bound"))


def judge_urls(pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, min_bound: float = MIN_BOUND, z: float = Z) -> DataFrame:
    """All columns of ``pages`` (which has url) plus host, path, rule, verdict,
    posterior_mean and posterior_bound (rounded to 6 digits)."""
    own = ["host", "path", "rule", "verdict", "posterior_mean", "posterior_bound"]
    names = [c for c in pages.columns if c not in own]
    kept = [f"c{i}" for i in range(len(names))]  # no clash with the columns made on the way
    host, path = url_host_path(F.col("url"))
    p = pages.select(*[F.col(f"`{c}`").alias(k) for c, k in zip(names, kept, strict=True)], host.alias("host"), path.alias("path"))
    rule, ruled = rule_columns(F.col("host"), F.col("path"), rules)
    p = p.withColumns({"rule": rule, "ruled": ruled})
    outcome = F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", 0)
    rep = settle(host_reputation(p.select("host", outcome.alias("good")), z).select("host", "mean", "bound"), "reputation")
    bound = F.round("bound", 6)
    return p.join(rep, "host").select(
        *[F.col(k).alias(c) for c, k in zip(names, kept, strict=True)], "host", "path", "rule",
        F.coalesce("ruled", F.when(bound >= min_bound, "allow").otherwise("block")).alias("verdict"),
        F.round("mean", 6).alias("posterior_mean"), bound.alias("posterior_bound"),
    )


def query(spark, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    return judge_urls(pages).drop("url")


def _level_sql(name: str, key: str, parent: str, table: str, parents: str) -> str:
    lo, hi = RHO_RANGE
    return f"""
{name}_g AS (SELECT g.*, p.mean AS mu FROM ({table}) g JOIN {parents} p ON {parent}),
{name}_k AS (SELECT 1 / least(greatest(coalesce(CASE WHEN c > 0 THEN (a - b) / c ELSE 0.5e0 END, 0.5e0), {lo}), {hi}) - 1 AS k FROM (
  SELECT sum(CASE WHEN n > 0 THEN n * pow(s::DOUBLE / nullif(n, 0) - mu, 2) END) AS a, sum(CASE WHEN n > 0 THEN mu * (1 - mu) END) AS b,
         sum(CASE WHEN n > 0 THEN mu * (1 - mu) * (n - 1) END) AS c FROM {name}_g)),
{name} AS (SELECT {key}, n, s, (k * mu + s) / (k + n) AS mean, k + n AS weight FROM {name}_g, {name}_k)"""


def _oracle() -> str:
    ordered = sorted(RULES, key=lambda r: (len(r[1] + r[2]), r[1] + r[2]), reverse=True)
    fits = lambda h, p: f"(host = '{h}' OR ends_with(host, '.{h}')) AND starts_with(path, '{p}')"
    rule = " ".join(f"WHEN {fits(h, p)} THEN '{h + p}'" for _, h, p in ordered)
    ruled = " ".join(f"WHEN {fits(h, p)} THEN '{v}'" for v, h, p in ordered)
    domain = "CASE WHEN contains(host, '.') THEN regexp_extract(host, '[^.]*[.][^.]*$') ELSE host END"
    return f"""
WITH u AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), '{UPPER}', '{LOWER}') AS host,
             regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path FROM u),
p AS (SELECT *, CASE {rule} END AS rule, CASE {ruled} END AS ruled FROM h),
hosts AS (SELECT host, {domain} AS domain, regexp_extract(host, '[^.]*$') AS suffix, count(ruled) AS n,
                 coalesce(sum(CASE WHEN ruled = 'allow' THEN 1 ELSE 0 END), 0) AS s FROM p GROUP BY host),
base AS (SELECT 0.5e0 AS mean),
{_level_sql("root", "1 AS one", "true", "SELECT sum(n) AS n, sum(s) AS s FROM hosts", "base")},
{_level_sql("suffixes", "suffix", "true", "SELECT suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY 1", "root")},
{_level_sql("domains", "domain", "g.suffix = p.suffix", "SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(s) AS s FROM hosts GROUP BY 1", "suffixes")},
{_level_sql("posts", "host", "g.domain = p.domain", "SELECT * FROM hosts", "domains")},
r AS (SELECT host, round(mean, 6) AS posterior_mean, round(mean - {Z} * sqrt(mean * (1 - mean) / (weight + 1)), 6) AS posterior_bound FROM posts)
SELECT page_id, p.host, path, rule, coalesce(ruled, CASE WHEN posterior_bound >= {MIN_BOUND} THEN 'allow' ELSE 'block' END) AS verdict,
       posterior_mean, posterior_bound FROM p JOIN r ON p.host = r.host
"""


ORACLE = _oracle()
