"""URL filter: allow and block rules first, else an empirical-Bayes reputation of the host.

Outcomes of labelled pages are good (quality 1 and not toxic) or bad. Good counts are shrunk through beta-binomial priors down a
chain: the corpus is the prior of a suffix, a suffix of its registered domains, a domain of its hosts. Each level's posterior mean,
weighted by a strength fitted on the spread of that level's rates by the method of moments, is the next level's prior.
A page passes unless even the upper end of its host's posterior interval lies below the wanted rate of good pages.
Everything is DataFrame functions: counts are summed before they are shuffled, and a host's row is joined to its pages by a
join that AQE can split, so a host with a third of all pages doesn't land in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import settle

#: The rules of the contract, (host, path, verdict).
RULES = [
    ("org", "/", "allow"),
    ("example.org", "/es/", "block"),
    ("example.org", "/en/1", "block"),
    ("com", "/fr/", "allow"),
    ("com", "/de/", "block"),
]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: A host is blocked if its rate of good pages is below this with the confidence that Z gives.
WANTED, Z = 0.75, 1.645
#: Weight of a prior, in pages, where the spread of rates can't tell one; bounds of the fitted weight.
STRENGTH, WEAKEST, STRONGEST = 10.0, 1.0, 1000.0


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host and path of a url; both empty for null or where there is no '://'."""
    at = F.locate("://", url)
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise(F.lit(""))
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), UPPER, LOWER)
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1)
    return F.coalesce(host, F.lit("")), F.coalesce(path, F.lit(""))


def rule_of(host: Column, path: Column, rules) -> tuple[Column, Column]:
    """The longest fitting rule, written as host and path, and its verdict. Rules are a short list given by the caller."""
    name, verdict = None, None
    for at, prefix, what in sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1])):
        fits = ((host == at) | host.endswith("." + at)) & path.startswith(prefix)
        name = F.when(fits, at + prefix) if name is None else name.when(fits, at + prefix)
        verdict = F.when(fits, what) if verdict is None else verdict.when(fits, what)
    if name is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return name, verdict


def _name(host: Column) -> Column:
    """A host without its port."""
    return F.regexp_replace(host, r":[0-9]*$", "")


def domain_of(host: Column) -> Column:
    return F.substring_index(_name(host), ".", -2)


def suffix_of(host: Column) -> Column:
    return F.substring_index(_name(host), ".", -1)


def _moments(parts: list[str]) -> list[Column]:
    """Groups of labelled rows below a parent, and their mean and variance of rates, by which the prior's weight is fitted."""
    rate = F.col("good") / F.col("n")
    return [F.sum("good").alias("p_good"), F.sum("n").alias("p_n"), F.count(F.lit(1)).alias("p_groups"), F.sum(rate).alias("s1"), F.sum(rate * rate).alias("s2"), F.sum(1 / F.col("n")).alias("s_inv")]


def _strength() -> Column:
    """Beta-binomial weight M: with mean m and variance v of k rates over n_i pages, v = m(1-m)(1 + (M... )); solved for M and bounded."""
    mean = F.col("s1") / F.col("p_groups")
    var = F.greatest(F.col("s2") / F.col("p_groups") - mean * mean, F.lit(0.0))
    noise = F.col("s_inv") / F.col("p_groups")  # mean of 1/n
    spread = mean * (1 - mean)
    rho = F.try_divide(var - spread * noise, spread * (1 - noise))  # correlation within a group
    fitted = F.try_divide(1 - rho, rho)
    return F.when((F.col("p_groups") < 3) | fitted.isNull() | (rho <= 0), F.when(F.col("p_groups") < 3, STRENGTH).otherwise(STRONGEST)).otherwise(F.least(F.greatest(fitted, F.lit(WEAKEST)), F.lit(STRONGEST)))


def reputations(outcomes: DataFrame) -> DataFrame:
    """(host, alpha, beta) of every host in `outcomes` (host, good), where good is 1, 0 or null for an unlabelled page."""
    hosts = outcomes.groupBy("host").agg(F.coalesce(F.sum("good"), F.lit(0)).cast("double").alias("good"), F.count("good").cast("double").alias("n"))
    hosts = settle(hosts.select("host", domain_of(F.col("host")).alias("domain"), suffix_of(F.col("host")).alias("suffix"), "good", "n"), "reputation-hosts")  # read at each level below
    seen = hosts.where("n > 0")
    domains = seen.groupBy("suffix", "domain").agg(*_moments(["domain"])).withColumn("m", _strength()).select("suffix", "domain", F.col("p_good").alias("good"), F.col("p_n").alias("n"), F.col("m").alias("m_host"))
    suffixes = domains.groupBy("suffix").agg(*_moments(["suffix"])).withColumn("m", _strength()).select("suffix", F.col("p_good").alias("good"), F.col("p_n").alias("n"), F.col("m").alias("m_domain"))
    whole = suffixes.groupBy().agg(*_moments([])).withColumn("m", _strength()).select(((F.coalesce("p_good", F.lit(0.0)) + 1) / (F.coalesce("p_n", F.lit(0.0)) + 2)).alias("p0"), F.coalesce("m", F.lit(STRENGTH)).alias("m0"), (F.coalesce("p_n", F.lit(0.0)) + 2).alias("most"))
    # one row, the corpus: joining it is a broadcast of one row
    suffixes = suffixes.crossJoin(F.broadcast(whole)).select("suffix", ((F.col("good") + F.col("m0") * F.col("p0")) / (F.col("n") + F.col("m0"))).alias("p_suffix"), "m_domain")
    domains = domains.join(suffixes, "suffix").select("suffix", "domain", ((F.col("good") + F.col("m_domain") * F.col("p_suffix")) / (F.col("n") + F.col("m_domain"))).alias("p_domain"), "m_host")
    known = hosts.join(domains, ["suffix", "domain"], "left").join(suffixes.select("suffix", "p_suffix"), "suffix", "left").crossJoin(F.broadcast(whole))
    prior = F.coalesce("p_domain", "p_suffix", "p0")
    weight = F.least(F.coalesce("m_host", F.lit(STRENGTH)), "most")  # no prior weighs more than all labelled pages
    return known.select("host", (F.col("good") + weight * prior).alias("alpha"), (F.col("n") - F.col("good") + weight * (1 - prior)).alias("beta"))


def posterior(alpha: Column, beta: Column, z: float = Z) -> tuple[Column, Column, Column]:
    """Posterior mean and the ends of its interval (normal form), within 0 and 1."""
    total = alpha + beta
    mean = alpha / total
    half = z * F.sqrt(mean * (1 - mean) / (total + 1))
    return mean, F.greatest(mean - half, F.lit(0.0)), F.least(mean + half, F.lit(1.0))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, wanted: float = WANTED, z: float = Z) -> DataFrame:
    """(page_id, host, path, rule, verdict, reputation, upper_bound) of every row of `pages` (page_id, url).

    A page's outcome is its row in `labels` (doc_id equal to page_id): good if quality is 1 and toxic is not 1; without a row or with
    nulls it is unlabelled and only judged. Null or malformed urls have an empty host, judged like any other host. Repeated pages stay
    repeated; repeated label rows count once, a bad one winning. Without labels every host has the corpus prior of one half, whose
    interval reaches the wanted rate, so all pages are allowed. Other columns are ignored.
    """
    host, path = url_parts(F.col("url"))
    rows = pages.select("page_id", F.col("url").cast("string").alias("url")).select("page_id", host.alias("host"), path.alias("path"))
    outcome = labels.select(F.col("doc_id").alias("page_id"), ((F.col("quality") == 1) & ~(F.coalesce(F.col("toxic"), F.lit(0)) == 1)).cast("int").alias("good")).where("page_id is not null").groupBy("page_id").agg(F.min("good").alias("good"))
    scores = reputations(rows.select("page_id", "host").join(outcome, "page_id", "left").select("host", "good"))
    rule, said = rule_of(F.col("host"), F.col("path"), rules)
    mean, _, upper = posterior(F.col("alpha"), F.col("beta"), z)
    return rows.join(scores, "host", "left").select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, F.when(upper < wanted, "block").otherwise("allow")).alias("verdict"), mean.alias("reputation"), upper.alias("upper_bound"))


def _strength_sql() -> str:
    rho = "((greatest(s2 / g - (s1 / g) * (s1 / g), 0) - (s1 / g) * (1 - s1 / g) * (s_inv / g)) / nullif((s1 / g) * (1 - s1 / g) * (1 - s_inv / g), 0))"
    return f"CASE WHEN g < 3 THEN {STRENGTH}::DOUBLE WHEN {rho} IS NULL OR {rho} <= 0 THEN {STRONGEST}::DOUBLE ELSE least(greatest((1 - {rho}) / {rho}, {WEAKEST}::DOUBLE), {STRONGEST}::DOUBLE) END"


def sql(rules=RULES, wanted: float = WANTED, z: float = Z) -> str:
    """judge() in SQL, bounds rounded to nine places."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0] + r[1]))
    fits = [(f"(host = '{at}' OR ends_with(host, '.{at}')) AND starts_with(path, '{prefix}')", at + prefix, what) for at, prefix, what in ordered]
    rule = " ".join(f"WHEN {test} THEN '{name}'" for test, name, _ in fits)
    said = " ".join(f"WHEN {test} THEN '{what}'" for test, _, what in fits)
    sums = "sum(good) AS good, sum(n) AS n, count(*) AS g, sum(good / n) AS s1, sum((good / n) * (good / n)) AS s2, sum(1 / n) AS s_inv"
    m = _strength_sql()
    mean = "alpha / (alpha + beta)"
    upper = f"least({mean} + {z}::DOUBLE * sqrt({mean} * (1 - {mean}) / (alpha + beta + 1)), 1)"
    tail = lambda k: f"array_to_string(list_reverse(list_reverse(string_split(regexp_replace(host, ':[0-9]*$', ''), '.'))[1:{k}]), '.')"
    return f"""WITH t AS (SELECT page_id, CASE WHEN contains(url, '://') THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages),
p AS (SELECT page_id, translate(regexp_extract(rest, '^([^/?#]*)', 1), '{UPPER}', '{LOWER}') AS host, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM t),
o AS (SELECT doc_id AS page_id, min(CAST(quality = 1 AND NOT (coalesce(toxic, 0) = 1) AS INTEGER)) AS good FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
h AS (SELECT host, {tail(2)} AS domain, {tail(1)} AS suffix, coalesce(sum(good), 0)::DOUBLE AS good, count(good)::DOUBLE AS n FROM p LEFT JOIN o USING (page_id) GROUP BY host),
d AS (SELECT suffix, domain, good, n, {m} AS m_host FROM (SELECT suffix, domain, {sums} FROM h WHERE n > 0 GROUP BY suffix, domain)),
s AS (SELECT suffix, good, n, {m} AS m_domain FROM (SELECT suffix, {sums} FROM d GROUP BY suffix)),
w AS (SELECT (coalesce(good, 0) + 1) / (coalesce(n, 0) + 2) AS p0, coalesce({m}, {STRENGTH}::DOUBLE) AS m0, coalesce(n, 0) + 2 AS most FROM (SELECT {sums} FROM s)),
s2 AS (SELECT suffix, (good + m0 * p0) / (n + m0) AS p_suffix, m_domain FROM s, w),
d2 AS (SELECT d.suffix, domain, (good + m_domain * p_suffix) / (n + m_domain) AS p_domain, m_host FROM d JOIN s2 USING (suffix)),
k AS (SELECT host, good, n, coalesce(p_domain, p_suffix, p0) AS prior, least(coalesce(m_host, {STRENGTH}::DOUBLE), most) AS weight
  FROM h LEFT JOIN d2 ON d2.suffix = h.suffix AND d2.domain = h.domain LEFT JOIN (SELECT suffix, p_suffix FROM s2) x ON x.suffix = h.suffix, w),
ab AS (SELECT host, good + weight * prior AS alpha, n - good + weight * (1 - prior) AS beta FROM k)
SELECT page_id, host, path, CASE {rule} END AS rule, CASE {said} WHEN {upper} < {wanted}::DOUBLE THEN 'block' ELSE 'allow' END AS verdict, round({mean}, 9) AS reputation, round({upper}, 9) AS upper_bound FROM p JOIN ab USING (host)"""
