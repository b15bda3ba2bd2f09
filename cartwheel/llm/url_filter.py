"""URL filters: explicit rules, else empirical-Bayes host reputation.

Labelled page outcomes (bad or good) are counted per site: the host without user
info, port and a final dot. Each site's share of bad pages is shrunk towards its
registered domain's, that towards its public suffix's, that towards the share of
all pages (half an outcome of either kind added), through beta-binomial priors whose
strengths are estimated from the spread between groups at each level. Where the spread
tells nothing (one group, or outcomes of one kind only) the prior counts as one page.
A site is blocked when the lower bound of its posterior exceeds a threshold.

The bounds are the one-sided ones of Wilson's form for the posterior's mean and its
weight (labelled pages and prior strength): they lie between 0 and 1, and are not
certain however alike the outcomes are.

A registered domain is one label more than its suffix, the suffix the last label, or the
last two where these are in a fixed list of shared suffixes. IP addresses are domains of
their own, under one suffix that no name has.

Defined cases: a null url, or one without ``://``, has empty host and path and
the reputation of the empty host; null outcomes do not count; an unlabelled site
takes its domain's shrunk share; without any label nothing is blocked. Pages are
returned row by row (repeated rows stay), extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import LETTERS_LOWER, LETTERS_UPPER, table, take

#: (verdict, host, path prefix); fixed values of the query's contract
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
#: suffixes of two labels under which unrelated owners register (fixed values)
SHARED_SUFFIXES = (
    "ac.uk co.uk gov.uk ltd.uk me.uk net.uk org.uk plc.uk sch.uk ac.jp co.jp go.jp ne.jp or.jp com.au edu.au gov.au net.au org.au "
    "ac.nz co.nz net.nz org.nz com.br gov.br net.br org.br com.cn edu.cn gov.cn net.cn org.cn ac.in co.in gov.in net.in org.in "
    "co.kr or.kr co.za org.za com.ar com.co com.hk com.mx com.my com.pl com.sg com.tr com.tw com.ua com.vn co.id co.il co.th "
    "github.io gitlab.io blogspot.com").split()
#: block where the one-sided 95 % lower bound of the share of bad pages is over a half
Z = 1.645
BLOCK_OVER = 0.5
LEVELS = ("host", "domain", "suffix")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, LETTERS_UPPER, LETTERS_LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def site_of(host: Column) -> Column:
    """The host without user info, port and a final dot."""
    bare = F.regexp_replace(host, r"(?s)^.*@", "")
    return F.regexp_replace(F.regexp_replace(bare, r":[0-9]*$", ""), r"\.$", "")


def is_address(site: Column) -> Column:
    """IPv4 in four numbers, or anything in brackets."""
    return site.rlike(r"^(?:[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+|\[.*\])$")


def suffix_of(site: Column) -> Column:
    two = F.substring_index(site, ".", -2)
    last = F.when(two.isin(SHARED_SUFFIXES), two).otherwise(F.substring_index(site, ".", -1))
    return F.when(is_address(site), F.lit("[]")).otherwise(last)


def domain_of(site: Column) -> Column:
    """Registered domain: a label and the suffix."""
    two = F.substring_index(site, ".", -2)
    labels = F.when(two.isin(SHARED_SUFFIXES), F.substring_index(site, ".", -3)).otherwise(two)
    return F.when(is_address(site), site).otherwise(labels)


def first_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null where none does."""
    rule = verdict = F.lit(None).cast("string")
    for kind, rule_host, prefix in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(prefix)
        rule = F.when(fits, F.lit(f"{rule_host}{prefix}")).otherwise(rule)
        verdict = F.when(fits, F.lit(kind)).otherwise(verdict)
    return rule, verdict


def _strength(groups: DataFrame) -> DataFrame:
    """One row (m): prior strength from the variance between groups (analysis of
    variance of binomial shares: intra-class correlation r, strength 1/r - 1)."""
    sums = groups.agg(
        F.sum("n").alias("total"), F.sum("bad").alias("bads"), F.count("*").alias("k"),
        F.sum(F.col("n") * F.col("n") / 1.0).alias("squares"),
        F.sum(F.col("bad") * F.col("bad") / F.col("n")).alias("within"))
    p = F.try_divide("bads", "total")
    spread = F.col("within") - F.col("bads") * p
    noise = (F.col("k") - 1) * p * (1 - p)
    scale = p * (1 - p) * (F.col("total") - F.col("squares") / F.col("total") - (F.col("k") - 1))
    r = F.try_divide(spread - noise, scale)
    r = F.least(F.greatest(F.round(F.coalesce(r, F.lit(0.5)), 6), F.lit(0.001)), F.lit(0.5))
    whole = (F.coalesce("bads", F.lit(0)) + 0.5) / (F.coalesce("total", F.lit(0)) + 1)
    return sums.select((1 / r - 1).alias("m"), whole.alias("p"))


def reputations(outcomes: DataFrame, z: float = Z) -> DataFrame:
    """Posterior of each site of ``outcomes`` (site, bad 0/1 or null): columns
    site, n_labelled, n_bad, share, lower, upper (bounds of the share)."""
    hosts = outcomes.groupBy("site").agg(
        F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"),
    ).withColumns({"domain": domain_of(F.col("site")), "suffix": suffix_of(F.col("site"))})
    up = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))
    top = up.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def shrunk(groups: DataFrame, prior: Column, like: DataFrame) -> Column:
        m = like.select("m").scalar()
        return (F.col("bad") + m * prior) / (F.col("n") + m)

    fits = {k: _strength(g.filter("n > 0")) for k, g in zip(LEVELS, (hosts, up, top), strict=True)}
    whole = fits["host"].select("p").scalar()
    top = top.select("suffix", shrunk(top, whole, fits["suffix"]).alias("p_suffix"))
    up = up.join(top, "suffix").select(
        "domain", shrunk(up, F.col("p_suffix"), fits["domain"]).alias("p_domain"))
    m = fits["host"].select("m").scalar()
    share, weight = F.col("share"), F.col("n") + F.col("m")
    middle = share + z * z / (2 * weight)
    reach = z * F.sqrt(share * (1 - share) / weight + z * z / (4 * weight * weight))
    below, above = (middle - reach) / (1 + z * z / weight), (middle + reach) / (1 + z * z / weight)
    return (
        hosts.join(up, "domain").withColumn("m", m)
        .withColumn("share", (F.col("bad") + F.col("m") * F.col("p_domain")) / (F.col("n") + F.col("m")))
        .select("site", F.col("n").alias("n_labelled"), F.col("bad").alias("n_bad"), "share",
                below.alias("lower"), above.alias("upper")))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, block_over: float = BLOCK_OVER) -> DataFrame:
    """Each page's host, path, rule, verdict and its site's posterior.

    ``labels`` share their ids with the pages; a page labelled toxic or of low
    quality is a bad outcome. Of repeated labels of an id, any bad one counts."""
    pages = take(pages, page_id="bigint", url="string")
    pages = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    pages = pages.withColumn("site", site_of(F.col("host")))
    marks = take(labels, doc_id="bigint", quality="int", toxic="int").select(
        F.col("doc_id").alias("page_id"),
        ((F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)).cast("int").alias("bad"),
    ).groupBy("page_id").agg(F.max("bad").alias("bad"))
    known = reputations(pages.select("page_id", "site").join(marks, "page_id", "left"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.round("lower", 6) > block_over, "block").otherwise("allow")
    return pages.join(known, "site", "left").select(
        "page_id", "host", "path", rule.alias("rule"), F.coalesce(verdict, own).alias("verdict"),
        "n_labelled", "n_bad", F.round("share", 6).alias("share"), F.round("lower", 6).alias("lower"))


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge(table(spark, sf_dir, "pages"), table(spark, sf_dir, "labels"))


OP9_SQL = r"""
WITH marks AS (
  SELECT doc_id, max(CASE WHEN coalesce(toxic, 0) = 1 OR coalesce(quality, 1) = 0 THEN 1 ELSE 0 END) AS bad
  FROM labels GROUP BY doc_id),
p AS (
  SELECT page_id,
    coalesce(translate(regexp_extract(url, '^.*?://([^/?#]*)', 1, 's'),
                       'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') AS host,
    coalesce(regexp_extract(url, '^.*?://[^/?#]*([^?#]*)', 1, 's'), '') AS path
  FROM pages),
sites AS (
  SELECT *, CASE WHEN bare LIKE '%.' THEN bare[:-2] ELSE bare END AS site FROM (
    SELECT *, regexp_replace(CASE WHEN contains(host, '@') THEN string_split(host, '@')[-1] ELSE host END, ':[0-9]*$', '') AS bare
    FROM p)),
parts AS (
  SELECT site, regexp_full_match(site, '[0-9]+[.][0-9]+[.][0-9]+[.][0-9]+') OR (site LIKE '[%' AND site LIKE '%]') AS ip,
         string_split(site, '.') AS labels,
         CASE WHEN array_to_string(string_split(site, '.')[-2:], '.') IN (SELECT unnest(string_split('SHARED', ' '))) THEN 2 ELSE 1 END AS long
  FROM (SELECT DISTINCT site FROM sites)),
h AS (
  SELECT site, CASE WHEN any_value(ip) THEN site ELSE array_to_string(any_value(labels)[-1 - any_value(long):], '.') END AS domain,
         CASE WHEN any_value(ip) THEN '[]' ELSE array_to_string(any_value(labels)[-any_value(long):], '.') END AS suffix,
         count(bad) AS n, coalesce(sum(bad), 0) AS bad
  FROM sites JOIN parts USING (site) LEFT JOIN marks ON marks.doc_id = sites.page_id GROUP BY site),
d AS (SELECT domain, suffix, sum(n) AS n, sum(bad) AS bad FROM h GROUP BY ALL),
s AS (SELECT suffix, sum(n) AS n, sum(bad) AS bad FROM d GROUP BY ALL),
g AS (SELECT 'host' AS lv, n, bad FROM h UNION ALL SELECT 'domain', n, bad FROM d
      UNION ALL SELECT 'suffix', n, bad FROM s),
t AS (SELECT lv, sum(n)::DOUBLE AS total, sum(bad)::DOUBLE AS bads, count(*)::DOUBLE AS k,
             sum(n::DOUBLE * n) AS sq, sum(bad::DOUBLE * bad / n) AS wi
      FROM g WHERE n > 0 GROUP BY lv),
f AS (SELECT lv, (bads + 0.5) / (total + 1) AS p, 1 / least(greatest(round(coalesce(
        (wi - bads * bads / total - (k - 1) * bads / total * (1 - bads / total))
        / nullif(bads / total * (1 - bads / total) * (total - sq / total - (k - 1)), 0), 0.5), 6), 0.001), 0.5) - 1 AS m
      FROM t),
sp AS (SELECT suffix, (bad + m * p) / (n + m) AS ps FROM s, f WHERE lv = 'suffix'),
dp AS (SELECT domain, (bad + m * ps) / (n + m) AS pd FROM d JOIN sp USING (suffix), f WHERE lv = 'domain'),
hp AS (SELECT site, n, bad, n + m AS w, (bad + m * pd) / (n + m) AS share
       FROM h JOIN dp USING (domain), f WHERE lv = 'host'),
r AS (SELECT site, n AS n_labelled, bad AS n_bad, round(share, 6) AS share,
             round((share + 1.645 * 1.645 / (2 * w) - 1.645 * sqrt(share * (1 - share) / w + 1.645 * 1.645 / (4 * w * w)))
                   / (1 + 1.645 * 1.645 / w), 6) AS lower FROM hp),
rules(verdict, rh, rp) AS (VALUES ('block', 'net', '/'), ('allow', 'example.net', '/en/'),
                                  ('block', 'example.com', '/de/'), ('allow', 'org', '/fr/')),
best AS (
  SELECT host, path, arg_max(rh || rp, length(rh || rp)) AS rule, arg_max(verdict, length(rh || rp)) AS verdict
  FROM (SELECT DISTINCT host, path FROM p), rules
  WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp) GROUP BY ALL)
SELECT page_id, host, path, rule,
       coalesce(best.verdict, CASE WHEN lower > 0.5 THEN 'block' ELSE 'allow' END) AS verdict,
       n_labelled::BIGINT AS n_labelled, n_bad::BIGINT AS n_bad, share, lower
FROM sites JOIN r USING (site) LEFT JOIN best USING (host, path)
""".replace("SHARED", " ".join(SHARED_SUFFIXES))
