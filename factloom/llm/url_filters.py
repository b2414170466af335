"""URL filters: rules first, then empirical-Bayes host reputation, in DataFrame operations only.

Labelled page outcomes (bad or not) are summed by host. A host's bad rate is shrunk to its registered
domain's, that one to its public suffix's, that one to the overall rate, through beta-binomial priors.
The prior's strength at each level is estimated by moments from the spread of the groups about their
parents. A host's posterior is a beta; a page is blocked if the lower credible bound of its host's bad
rate is over a limit, so that few or mixed labels never block.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import read, staged

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rules of the query: verdict, host, path prefix.
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Suffixes of more than one label; a parameter, as a public list is not at hand.
MULTI_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "com.au", "co.jp", "com.br", "co.in", "co.nz", "com.cn")
BAD_LIMIT, TAIL = 0.3, 0.05
LEAST_STRENGTH, MOST_STRENGTH = 1.0, 200.0
#: The posterior's quantile is read off this grid on the logit scale, +-GRID_SPAN around the posterior's mean.
GRID_STEPS, GRID_SPAN = 400, 16.0
MOST_RULES = 1000


def url_parts(url: Column) -> tuple[Column, Column]:
    """(host, path); both empty for null and where there is no ://."""
    rest = F.when(F.instr(url, "://") > 0, F.expr("substring({0}, instr({0}, '://') + 3)".format("`__url`")))
    host = F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, LOWER)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def matched_rule(host: Column, path: Column, rules) -> Column:
    """Struct(rule, verdict) of the longest rule that fits; ties go to the longer host, then by name. Null without one."""
    if len(rules) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), len(r[1]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        out = F.when(fits, F.struct(F.lit(h + p).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(out)
    return out


def host_levels(host: Column, multi_suffixes=MULTI_SUFFIXES) -> tuple[Column, Column]:
    """(registered domain, suffix) of a host; a port is left out, a numeric address is its own domain under 'ip'."""
    bare = F.regexp_replace(host, r":\d*$", "")
    two = F.substring_index(bare, ".", -2)
    long = two.isin(*multi_suffixes) if multi_suffixes else F.lit(False)
    ip = bare.rlike(r"^[0-9.]+$")
    suffix = F.when(ip, F.lit("ip")).when(long, two).otherwise(F.substring_index(bare, ".", -1))
    domain = F.when(ip, bare).when(long, F.substring_index(bare, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(groups: DataFrame) -> DataFrame:
    """One row: the prior's strength from groups with n, k and the parent's rate p, by the second moment of k."""
    v = F.col("p") * (1 - F.col("p"))
    over = F.sum(F.pow(F.col("k") - F.col("n") * F.col("p"), 2) - F.col("n") * v)
    room = F.sum(F.col("n") * (F.col("n") - 1) * v)
    rho = F.coalesce(F.when(room > 0, over / room), F.lit(1.0))
    rho = F.greatest(F.lit(1 / (1 + MOST_STRENGTH)), F.least(F.lit(1 / (1 + LEAST_STRENGTH)), rho))
    return groups.agg((1 / rho - 1).alias("m"))


def lower_bound(a: Column, b: Column, tail: float = TAIL) -> Column:
    """The tail quantile of Beta(a, b), on a grid of the logit scale, where the density is smooth for all a, b > 0."""
    centre = F.log(a / b)
    us = F.transform(
        F.sequence(F.lit(0), F.lit(GRID_STEPS)),
        lambda i: centre + (i / F.lit(float(GRID_STEPS)) - F.lit(0.5)) * F.lit(2 * GRID_SPAN) / F.sqrt(F.least(a, b) + F.lit(0.05)),
    )
    soft = lambda u: F.greatest(u, F.lit(0.0)) + F.log1p(F.exp(-F.abs(u)))  # noqa: E731  log(1 + e^u)
    at_centre = -a * soft(-centre) - b * soft(centre)
    weigh = lambda u: F.exp(-a * soft(-u) - b * soft(u) - at_centre)

    def crossing(xs: Column, total: Column) -> Column:
        start = F.struct(F.lit(0.0).alias("s"), F.lit(None).cast("double").alias("u"))
        step = lambda x, w: F.struct((x.s + w.w).alias("s"), F.when(x.u.isNull() & (x.s + w.w >= F.lit(tail) * total), w.u).otherwise(x.u).alias("u"))
        return F.aggregate(xs, start, step).u

    weighed = F.transform(us, lambda u: F.struct(u.alias("u"), weigh(u).alias("w")))
    # The arrays of one element bind the weights and their total to a name, so that each is worked out once a row.
    found = F.flatten(F.transform(F.array(weighed), lambda xs: F.transform(F.array(F.aggregate(xs, F.lit(0.0), lambda t, x: t + x.w)), lambda total: crossing(xs, total))))[0]
    return 1 / (1 + F.exp(-found))


def host_reputation(outcomes: DataFrame, multi_suffixes=MULTI_SUFFIXES) -> dict[str, DataFrame]:
    """From outcomes(host, bad): tables host, domain, suffix and all with the posterior's a and b.

    A host without labels takes its domain's posterior as prior, and so on upwards; without any label the prior is Beta(1, 9).
    """
    domain, suffix = host_levels(F.col("host"), multi_suffixes)
    hosts = staged(outcomes.groupBy("host").agg(F.count("bad").alias("n"), F.sum("bad").alias("k")), "host-outcomes").withColumns({"domain": domain, "suffix": suffix})
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    overall = suffixes.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 10)).alias("p"))
    mean = (F.col("k") + F.col("m") * F.col("p")) / (F.col("n") + F.col("m"))
    a, b = F.col("k") + F.col("m") * F.col("p"), F.col("n") - F.col("k") + F.col("m") * (1 - F.col("p"))

    def level(groups: DataFrame, parent: DataFrame, on: list[str]) -> DataFrame:
        joined = groups.join(parent, on) if on else groups.crossJoin(F.broadcast(parent))  # parent: one row
        return joined.crossJoin(F.broadcast(_strength(joined))).withColumns({"mean": mean, "a": a, "b": b})

    s = level(suffixes, overall, [])
    d = level(domains, s.select("suffix", F.col("mean").alias("p")), ["suffix"])
    h = level(hosts, d.select("domain", "suffix", F.col("mean").alias("p")), ["domain", "suffix"])
    a0, none = overall.select((10 * F.col("p")).alias("a"), (10 * (1 - F.col("p"))).alias("b")), F.lit(None).cast("string")
    levels = [("host", h.withColumn("name", F.col("host"))), ("domain", d.withColumn("name", F.col("domain"))), ("suffix", s.withColumn("name", F.col("suffix"))), ("all", a0.withColumns({"name": none, "suffix": none}))]
    tables = [t.select(F.lit(k).alias("level"), "name", "suffix", "a", "b") for k, t in levels]
    posterior = staged(reduce(DataFrame.unionByName, tables), "host-posteriors")
    keys = {"host": ["host"], "domain": ["domain", "suffix"], "suffix": ["suffix"], "all": []}
    return {k: posterior.where(F.col("level") == k).select(*[F.col("suffix" if c == "suffix" else "name").alias(c) for c in on], "a", "b") for k, on in keys.items()}


def filter_urls(pages: DataFrame, labels: DataFrame, rules=RULES, bad_limit: float = BAD_LIMIT, tail: float = TAIL, multi_suffixes=MULTI_SUFFIXES) -> DataFrame:
    """pages(page_id, url) judged: page_id, host, path, rule, verdict, bad_bound.

    labels(doc_id, quality, toxic) are the outcomes of the pages of that id: bad if quality is 0 or toxic is 1; labels
    of one id that disagree count as bad; a label without either value, or without an id, is none. A null url, or one
    without ://, has empty host and path and is judged by the reputation of the empty host. Repeated page rows each
    count and each return. Without labels nothing is blocked but by rules. Other columns are left out.
    """
    host, path = url_parts(F.col("__url"))
    urls = pages.select("page_id", F.col("url").alias("__url")).select("page_id", host.alias("host"), path.alias("path"))
    known = labels.where("doc_id is not null and (quality is not null or toxic is not null)")
    known = known.groupBy(F.col("doc_id").alias("page_id")).agg(F.max(F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)).alias("bad"))
    tables = host_reputation(urls.join(known, "page_id").select("host", "bad"), multi_suffixes)
    bounds = {k: t.withColumn(f"{k}_bound", lower_bound(F.col("a"), F.col("b"), tail)).drop("a", "b") for k, t in tables.items()}
    domain, suffix = host_levels(F.col("host"), multi_suffixes)
    # Each table has a row for each labelled name. Spark broadcasts it where its size allows, else splits what a hot host brings to the join.
    out = urls.withColumns({"domain": domain, "suffix": suffix}).join(bounds["host"], "host", "left")
    out = out.join(bounds["domain"], ["domain", "suffix"], "left").join(bounds["suffix"], "suffix", "left")
    out = out.crossJoin(F.broadcast(bounds["all"]))
    bound = F.coalesce("host_bound", "domain_bound", "suffix_bound", "all_bound")
    hit = matched_rule(F.col("host"), F.col("path"), rules)
    out = out.select("page_id", "host", "path", hit.alias("hit"), bound.alias("bound"))
    verdict = F.coalesce(F.col("hit.verdict"), F.when(F.col("bound") > bad_limit, F.lit("block")).otherwise(F.lit("allow")))
    return out.select("page_id", "host", "path", F.col("hit.rule").alias("rule"), verdict.alias("verdict"), F.round("bound", 4).alias("bad_bound"))


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_urls(read(spark, sf_dir, "pages"), read(spark, sf_dir, "labels"))


ORACLE_SQL = r"""
with u as (
  select page_id, case when strpos(url, '://') > 0 then substr(url, strpos(url, '://') + 3) end rest from pages),
p as (
  select page_id, coalesce(translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '') host,
    coalesce(regexp_extract(rest, '^[^/?#]*([^?#]*)', 1), '') path from u),
b as (select *, regexp_replace(host, ':\d*$', '') bare from p),
l as (
  select *, regexp_matches(bare, '^[0-9.]+$') ip,
    array_to_string(string_split(bare, '.')[-2:], '.') two, array_to_string(string_split(bare, '.')[-3:], '.') three,
    array_to_string(string_split(bare, '.')[-2:], '.') in ('co.uk','org.uk','ac.uk','com.au','co.jp','com.br','co.in','co.nz','com.cn') lng from b),
v as (
  select page_id, host, path, case when ip then bare when lng then three else two end domain,
    case when ip then 'ip' when lng then two else string_split(bare, '.')[-1] end suffix from l),
known as (
  select doc_id, max(case when quality = 0 or toxic = 1 then 1 else 0 end) bad from labels
  where doc_id is not null and (quality is not null or toxic is not null) group by doc_id),
h as (select host, domain, suffix, count(*)::double n, sum(bad)::double k from v join known on doc_id = page_id group by all),
d as (select domain, suffix, sum(n) n, sum(k) k from h group by all),
s as (select suffix, sum(n) n, sum(k) k from d group by all),
g as (select (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 10) p from s),
sm as (
  select 1 / greatest(1 / 201.0, least(0.5, coalesce(case when sum(n * (n - 1) * p * (1 - p)) > 0 then sum(power(k - n * p, 2) - n * p * (1 - p)) / sum(n * (n - 1) * p * (1 - p)) end, 1))) - 1 m
  from s, g),
s2 as (select suffix, n, k, k + m * p a, n - k + m * (1 - p) b, (k + m * p) / (n + m) mean from s, g, sm),
dp as (select d.*, s2.mean p from d join s2 using (suffix)),
dm as (
  select 1 / greatest(1 / 201.0, least(0.5, coalesce(case when sum(n * (n - 1) * p * (1 - p)) > 0 then sum(power(k - n * p, 2) - n * p * (1 - p)) / sum(n * (n - 1) * p * (1 - p)) end, 1))) - 1 m
  from dp),
d2 as (select domain, suffix, k + m * p a, n - k + m * (1 - p) b, (k + m * p) / (n + m) mean from dp, dm),
hp as (select h.*, d2.mean p from h join d2 using (domain, suffix)),
hm as (
  select 1 / greatest(1 / 201.0, least(0.5, coalesce(case when sum(n * (n - 1) * p * (1 - p)) > 0 then sum(power(k - n * p, 2) - n * p * (1 - p)) / sum(n * (n - 1) * p * (1 - p)) end, 1))) - 1 m
  from hp),
h2 as (select host, k + m * p a, n - k + m * (1 - p) b from hp, hm),
post as (
  select 'h' lev, host key, '' key2, a, b from h2 union all select 'd', domain, suffix, a, b from d2
  union all select 's', suffix, '', a, b from s2 union all select 'g', '', '', 10 * p, 10 * (1 - p) from g),
grid as (
  select lev, key, key2, a, b, ln(a / b) c, i, ln(a / b) + (i / 400.0::double - 0.5) * 32 / sqrt(least(a, b) + 0.05) x from post, range(401) r(i)),
w as (
  select *, exp(-a * (greatest(-x, 0) + ln(1 + exp(-abs(x)))) - b * (greatest(x, 0) + ln(1 + exp(-abs(x))))
    + a * (greatest(-c, 0) + ln(1 + exp(-abs(c)))) + b * (greatest(c, 0) + ln(1 + exp(-abs(c))))) wt from grid),
cum as (select *, sum(wt) over (partition by lev, key, key2 order by i) run, sum(wt) over (partition by lev, key, key2) total from w),
bound as (select lev, key, key2, 1 / (1 + exp(-min(x))) q from cum where run >= 0.05 * total group by all),
rules(rule, rh, rp, rv) as (values
  ('org/', 'org', '/', 'allow'), ('example.org/es/', 'example.org', '/es/', 'block'), ('example.org/en/1', 'example.org', '/en/1', 'block'),
  ('com/fr/', 'com', '/fr/', 'allow'), ('com/de/', 'com', '/de/', 'block')),
judged as (
  select page_id, host, path,
    (select arg_max({'rule': rule, 'rv': rv}, length(rule)) from rules where (host = rh or ends_with(host, '.' || rh)) and starts_with(path, rp)) hit,
    coalesce(bh.q, bd.q, bs.q, bg.q) q
  from v left join bound bh on bh.lev = 'h' and bh.key = host left join bound bd on bd.lev = 'd' and bd.key = domain and bd.key2 = suffix
  left join bound bs on bs.lev = 's' and bs.key = suffix left join bound bg on bg.lev = 'g')
select page_id, host, path, hit.rule as rule, coalesce(hit.rv, case when q > 0.3 then 'block' else 'allow' end) verdict, round(q, 4) bad_bound from judged
"""
