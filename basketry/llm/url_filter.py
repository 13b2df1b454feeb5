"""URL filters: fixed rules first, then empirical-Bayes reputation of hosts.

Labelled outcomes (bad or not) are counted per host in one aggregate and summed upwards: host to
registered domain to suffix to all. Rates are shrunk on the way down: a suffix towards the
overall rate, a domain towards its suffix, a host towards its domain. Each step is a
beta-binomial update whose prior has the parent's mean and a strength estimated from the spread
of the level's own rates (method of moments). A url is blocked if the lower posterior bound of
its host's bad rate is above a threshold.

A host without outcomes has the mean of the nearest level seen and no evidence of its own: it is
as uncertain as a new member of that level, whose prior is worth the least strength of the levels
between, however many outcomes its neighbours have. A prior is worth at most 100 outcomes.

Defined results. A null url, or one without ``://``, has an empty host and an empty path, fits no
rule and gets the overall rate, as no member of any level. For the levels, a port is cut off, a host
with one label is its own domain and suffix, and so is an IP address. Suffixes have one label but
for those of ``suffixes``; a full list of public suffixes can be given there. Without any labels every
rate is the prior 0.5, which no bound blocks. An empty table gives an empty result. Rows that repeat
a page_id are judged one by one. Of rules of one length that fit, a block goes first. Extra columns
are not read.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketry.llm.words import LOWER, UPPER
from basketry.session import materialize, small_broadcast

# The rules that a page filter starts from, (verdict, host, path).
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)
# Public suffixes of two labels; any other suffix has one.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "com.cn", "gov.uk", "org.uk")
MAX_BAD_RATE = 0.5
# Standard deviations between the posterior mean and its bound: about one chance in forty.
BOUND = 1.96
STRENGTHS = (1.0, 100.0)
SMALL_SIDE = 200_000


def url_host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, UPPER, LOWER)


def url_path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


# An IPv4 address, or an IPv6 address in its brackets.
ADDRESS = r"^(\d{1,3}(\.\d{1,3}){3}|\[.*\])$"


def without_port(host: Column) -> Column:
    return F.regexp_replace(host, r":\d*$", "")


def _levels(host: Column, suffixes: Sequence[str]) -> list[Column]:
    """(named, domain, suffix): the host without its port, its registered domain and its public
    suffix; all null for an empty host."""
    named = F.nullif(without_port(host), F.lit(""))
    address, two = named.rlike(ADDRESS), F.substring_index(named, ".", -2)
    long = two.isin(*suffixes) if suffixes else F.lit(False)
    domain = F.when(address, named).when(long, F.substring_index(named, ".", -3)).otherwise(two)
    suffix = F.when(address, named).when(long, two).otherwise(F.substring_index(named, ".", -1))
    return [named.alias("named"), domain.alias("domain"), suffix.alias("suffix")]


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct (rule, verdict), or null; a block goes before an
    allow of the same length."""
    ordered = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r[0] != "block", r[1], r[2]))
    found = F.lit(None)
    for verdict, rule_host, rule_path in reversed(ordered):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))
                       ).otherwise(found)
    return found


def _strength(prior: str) -> Column:
    """Prior strength of a level from the spread of its rates around their priors: the
    beta-binomial variance is p(1 - p)(1 + (n - 1) / (s + 1)) / n, solved for s and summed over
    the level, kept within STRENGTHS."""
    p = F.col(prior)
    noise = p * (1 - p)
    excess = F.sum(F.col("n") * (F.col("bad") / F.col("n") - p) ** 2 - noise)
    room = F.sum((F.col("n") - 1) * noise)
    rho = excess / F.when(room > 0, room)
    s = F.when(rho > 0, 1 / rho - 1).otherwise(STRENGTHS[1])
    return F.least(F.greatest(F.coalesce(s, F.lit(STRENGTHS[1])), F.lit(STRENGTHS[0])), F.lit(STRENGTHS[1]))


def _shrink(rows: DataFrame, level: str) -> tuple[DataFrame, float]:
    """((level, mean, weight) of (level, n, bad, prior): posterior mean of each key and the weight
    behind it; the strength of the level's prior)."""
    rows = materialize(rows, f"rates-by-{level}")
    strength = rows.agg(_strength("prior")).first()[0]
    return rows.select(
        level, ((F.col("bad") + strength * F.col("prior")) / (F.col("n") + strength)).alias("mean"),
        (F.col("n") + strength).alias("weight")), strength


def reputations(outcomes: DataFrame, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES):
    """Posteriors from (host, bad) by level, from hosts upwards; the strength of a new member's
    prior below each of them, and the overall mean with its own."""
    known = outcomes.where(F.col("bad").isNotNull()).select(*_levels(F.col("host"), suffixes), "bad")
    counts = materialize(known.groupBy("named", "domain", "suffix").agg(
        F.count("*").alias("n"), F.sum(F.col("bad").cast("long")).alias("bad")), "outcomes-by-host")
    total = counts.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    mean = ((total["bad"] or 0) + 1) / ((total["n"] or 0) + 2.0)
    counts = counts.where(F.col("named").isNotNull())

    def summed(*keys):
        return counts.groupBy(*keys).agg(F.sum("n").alias("n"), F.sum("bad").alias("bad"))

    def below(level, parent, posterior):
        priors = posterior.select(parent, F.col("mean").alias("prior"))
        return summed(level, parent).join(small_broadcast(priors, SMALL_SIDE), parent)

    suffix, of_suffix = _shrink(summed("suffix").withColumn("prior", F.lit(mean)), "suffix")
    domain, of_domain = _shrink(below("domain", "suffix", suffix), "domain")
    host, of_host = _shrink(below("named", "domain", domain), "named")
    new = {"domain": of_host, "suffix": min(of_host, of_domain)}
    return {"named": host, "domain": domain, "suffix": suffix}, new, (mean, min(of_host, of_domain, of_suffix))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES,
          max_bad_rate: float = MAX_BAD_RATE, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """(page_id, host, path, rule, verdict, bad_rate, bound) of every page.

    ``outcomes`` has (page_id, bad); several outcomes of a page count once, bad if any is.
    """
    urls = pages.select("page_id", F.col("url").cast("string").alias("url"))
    urls = urls.select("page_id", url_host(F.col("url")).alias("host"), url_path(F.col("url")).alias("path"))
    once = outcomes.groupBy("page_id").agg(F.max("bad").alias("bad")).withColumnRenamed("page_id", "outcome_of")
    labelled = urls.join(once, urls["page_id"] == once["outcome_of"]).select("host", "bad")
    levels, new, overall = reputations(labelled, suffixes)
    # Every host that occurs gets its posterior once; pages then only look their host up.
    hosts = urls.select("host").distinct().select("host", *_levels(F.col("host"), suffixes))
    for level, posterior in levels.items():
        weight = F.lit(new[level]) if level in new else F.col("weight")
        found = posterior.select(level, F.struct("mean", weight.alias("weight")).alias(f"by_{level}"))
        hosts = hosts.join(small_broadcast(found, SMALL_SIDE), level, "left")
    best = F.coalesce("by_named", "by_domain", "by_suffix", F.struct(
        F.lit(overall[0]).alias("mean"), F.lit(overall[1]).alias("weight")))
    mean, weight = best["mean"], best["weight"]
    scored = hosts.select("host", mean.alias("bad_rate"),
                          (mean - BOUND * F.sqrt(mean * (1 - mean) / (weight + 1))).alias("bound"))
    found = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = urls.withColumn("found", found) if rules else urls.withColumn(
        "found", F.lit(None).cast("struct<rule:string,verdict:string>"))
    # A host may have any share of all pages, so a counted list of hosts is broadcast.
    scored = small_broadcast(materialize(scored, "host-bounds"), SMALL_SIDE)
    return ruled.join(scored, "host", "left").select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), F.when(F.col("bound") > max_bad_rate, "block").otherwise("allow")
                   ).alias("verdict"), "bad_rate", "bound")
