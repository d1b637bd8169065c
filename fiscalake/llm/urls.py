"""URL filters: rules for hosts and paths, else the reputation of the host.

Labelled page outcomes (bad or not) are shrunk by beta-binomial priors: every host has
its registered domain's rate as prior mean, the domain its suffix's and the suffix the
overall rate. How strong a prior is (its pseudo-count) is estimated for each level from
how much the units of that level differ from their parents. A page is blocked where the
lower posterior bound of its host's bad share lies above a limit.

Cases: a null url or one without ``://`` has an empty host and path and is judged as a
page of the empty host; hosts without labels are judged by their domain's rate; repeated
pages count and are returned repeatedly; several labels of a page count once, as bad if
any is; labels without quality and toxicity count as good; no labels at all: every
posterior is the same wide one and nothing is blocked; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fiscalake.llm.common import lower_ascii, stored, table

# Fixed values of the contract: (verdict, host, path).
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)

#: Suffixes of two labels; everything else has one.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.br", "com.au", "co.jp", "co.nz")

#: Block where the lower bound of the bad share is above this.
MAX_BAD = 0.25
#: Standard deviations below the posterior mean: a one-sided bound of 90 %.
BOUND_Z = 1.2816
#: Bounds of the correlation within a unit; a pseudo-count is 1 / correlation - 1.
LEAST_RHO, MOST_RHO = 1 / 201, 1 / 3


def url_host(url: Column) -> Column:
    return lower_ascii(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def url_path(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    # locate is 1-based and 0 if absent; what it finds first is the first "://"
    at = F.locate("://", url)
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def registered_domain(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), F.substring_index(host, ".", -3)).otherwise(two)


def host_suffix(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES), two).otherwise(F.substring_index(host, ".", -1))


def matching_rule(host: Column, path: Column, rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits; nulls if none does."""
    found = None
    for verdict, rule_host, rule_path in sorted(rules, key=lambda r: (-len(r[1] + r[2]), r)):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        value = F.struct(
            F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict")
        )
        found = F.when(fits, value) if found is None else found.when(fits, value)
    return found if found is not None else F.lit(None).cast("struct<rule:string,verdict:string>")


def _pseudo_count(units: DataFrame) -> float:
    """Strength of the prior of ``units`` (n, bad, prior): moments of the beta-binomial."""
    n, bad, m = F.col("n"), F.col("bad"), F.col("prior")
    row = units.agg(
        F.sum((bad - n * m) * (bad - n * m) - n * m * (1 - m)).alias("excess"),
        F.sum(n * (n - 1) * m * (1 - m)).alias("pairs"),
    ).first()
    rho = row["excess"] / row["pairs"] if row["pairs"] else MOST_RHO
    return 1 / min(max(rho, LEAST_RHO), MOST_RHO) - 1


def _shrunk(units: DataFrame, rate: str) -> DataFrame:
    k = _pseudo_count(units)
    return units.withColumn(rate, (F.col("bad") + k * F.col("prior")) / (F.col("n") + k))


def host_reputation(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, n_labelled, bad_mean, bad_lower) of every host in ``pages`` (page_id, url)."""
    outcome = labels.groupBy(F.col("doc_id").alias("page_id")).agg(
        F.max(
            F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1.0).otherwise(0.0)
        ).alias("bad")
    )
    hosts = stored(
        pages.select("page_id", url_host(F.col("url")).alias("host"))
        .join(outcome, "page_id", "left")
        .groupBy("host")
        .agg(F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0.0)).alias("bad"))
        .select(
            "host",
            registered_domain(F.col("host")).alias("domain"),
            host_suffix(F.col("host")).alias("suffix"),
            "n",
            "bad",
        ),
        "hosts",
    )
    counts = [F.sum("n").alias("n"), F.sum("bad").alias("bad")]
    whole = hosts.agg(*counts).first()
    overall = ((whole["bad"] or 0.0) + 1) / ((whole["n"] or 0.0) + 2)
    suffixes = _shrunk(hosts.groupBy("suffix").agg(*counts).withColumn("prior", F.lit(overall)), "rate")
    domains = _shrunk(
        hosts.groupBy("domain", "suffix")
        .agg(*counts)
        .join(suffixes.select("suffix", F.col("rate").alias("prior")), "suffix"),
        "rate",
    )
    units = hosts.join(domains.select("domain", F.col("rate").alias("prior")), "domain")
    k = _pseudo_count(units)
    a = F.col("bad") + k * F.col("prior")
    b = F.col("n") - F.col("bad") + k * (1 - F.col("prior"))
    spread = F.sqrt(a * b / ((a + b) * (a + b) * (a + b + 1)))
    return units.select(
        "host",
        F.col("n").cast("long").alias("n_labelled"),
        (a / (a + b)).alias("bad_mean"),
        (a / (a + b) - BOUND_Z * spread).alias("bad_lower"),
    )


def judge_urls(pages: DataFrame, labels: DataFrame, rules=RULES, max_bad: float = MAX_BAD) -> DataFrame:
    """(page_id, host, path, rule, verdict, n_labelled, bad_mean, bad_lower) of every page.

    The join on the host is a plain one: the few hosts of a small web are broadcast by
    their measured size, many are shuffled, and a hot host's pages are split then.
    """
    parts = pages.select(
        "page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path")
    )
    ruled = parts.withColumn("fit", matching_rule(F.col("host"), F.col("path"), rules))
    return ruled.join(host_reputation(pages, labels), "host", "left").select(
        "page_id",
        "host",
        "path",
        F.col("fit.rule").alias("rule"),
        F.coalesce(
            F.col("fit.verdict"), F.when(F.col("bad_lower") > max_bad, "block").otherwise("allow")
        ).alias("verdict"),
        "n_labelled",
        "bad_mean",
        "bad_lower",
    )


def op3_url_reputation(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = judge_urls(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def _rate_sql(units: str, name: str) -> str:
    """The pseudo-count of a level's units, as a one-row relation."""
    return f"""{name} as (
      select 1 / least(greatest(coalesce(
          sum((bad - n * prior) * (bad - n * prior) - n * prior * (1 - prior))
          / nullif(sum(n * (n - 1) * prior * (1 - prior)), 0), 1), 1 / 201.0::double), 1 / 3.0::double) - 1 as k
      from {units})"""


OP3_SQL = f"""
with cut as (
  select page_id, url, case when position('://' in url) > 0
    then substr(url, position('://' in url) + 3) else '' end as rest from pages),
parts as (
  select page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) as path from cut),
outcome as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1.0 else 0.0 end)::double as bad
  from labels group by doc_id),
hosts as (
  select host, array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') as domain,
    list_extract(string_split(host, '.'), -1) as suffix,
    count(bad)::double as n, coalesce(sum(bad), 0)::double as bad
  from parts left join outcome on page_id = doc_id group by host),
whole as (select (sum(bad) + 1) / (sum(n) + 2) as rate from hosts),
s0 as (select suffix, sum(n) as n, sum(bad) as bad, any_value(rate) as prior from hosts, whole group by suffix),
{_rate_sql('s0', 'ks')},
s1 as (select suffix, (bad + k * prior) / (n + k) as rate from s0, ks),
d0 as (
  select domain, d.n, d.bad, rate as prior
  from (select domain, suffix, sum(n) as n, sum(bad) as bad from hosts group by all) d join s1 using (suffix)),
{_rate_sql('d0', 'kd')},
d1 as (select domain, (bad + k * prior) / (n + k) as rate from d0, kd),
h0 as (select host, n, bad, rate as prior from hosts join d1 using (domain)),
{_rate_sql('h0', 'kh')},
h1 as (select host, bad + k * prior as a, n - bad + k * (1 - prior) as b from h0, kh),
fit as (
  select *, case
    when (host = 'example.org' or host like '%.example.org') and path like '/en/1%' then 'example.org/en/1'
    when (host = 'example.org' or host like '%.example.org') and path like '/es/%' then 'example.org/es/'
    when (host = 'com' or host like '%.com') and path like '/fr/%' then 'com/fr/'
    when (host = 'com' or host like '%.com') and path like '/de/%' then 'com/de/'
    when (host = 'org' or host like '%.org') and path like '/%' then 'org/' end as rule
  from parts)
select page_id, host, path, rule,
  case when rule in ('org/', 'com/fr/') then 'allow' when rule is not null then 'block'
    when a / (a + b) - 1.2816 * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))) > 0.25 then 'block'
    else 'allow' end as verdict
from fit join h1 using (host)
"""
