"""URL filter: fixed rules first, else the reputation of the page's host (DataFrame functions only).

Reputation is an empirical-Bayes hierarchy. Labelled pages are counted per
host; counts add up to the registered domain, its suffix and the whole corpus.
At each level the groups' shares of bad pages are taken as draws of a
beta-binomial law around the posterior mean of the level above; the spread
(intra-group correlation) of each level is fitted by moments over all its
groups, and gives the strength with which a group is shrunk towards its
parent. A host is blocked when the lower posterior bound of its bad share
exceeds ``max_bad``: the bound is the quantile of the normal law with the
exact mean and variance of the logit of the host's beta posterior.

A page meets one host row: pages and outcomes are folded per host map-side,
and hosts with very many pages are joined by a bounded broadcast.

Defined cases: a null url, or one without ``://``, has an empty host and path
and counts with the others of an empty host; ports and user names stay in
``host`` but not in the registered domain; addresses in digits are their own
domain; a host without labels has its domain's law; outcomes with a null
``bad`` count as good, with a null url as of the empty host; repeated rows are
judged and counted each; an empty table gives no rows; further columns are
kept in the struct ``row``.
"""

from __future__ import annotations

from collections.abc import Sequence
from statistics import NormalDist

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import by_shuffle, materialize
from .skew import join_even

RULES = (("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/"))
# fixed values: public suffixes of two labels that the registered domain lies below
SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.in", "co.jp", "ne.jp", "or.jp",
            "co.kr", "co.nz", "co.za", "com.br", "com.cn", "com.mx", "com.tr")
MAX_BAD, CONFIDENCE = 0.5, 0.95
SPREADS = (0.0001, 0.5)  # of the fitted intra-group correlation; 0.5 is a prior worth one page
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEVELS = ("suffix", "domain", "host")


def host_of(url: Column) -> Column:
    after = F.substring_index(F.substr(url, F.locate("://", url) + 3), "/", 1)
    host = F.substring_index(F.substring_index(after, "?", 1), "#", 1)
    return F.when(F.locate("://", url) > 0, F.translate(host, UPPER, LOWER)).otherwise("")


def path_of(url: Column) -> Column:
    rest = F.substring_index(F.substring_index(F.substr(url, F.locate("://", url) + 3), "?", 1), "#", 1)
    return F.when((F.locate("://", url) > 0) & (F.locate("/", rest) > 0), F.substr(rest, F.locate("/", rest))).otherwise("")


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """The longest rule whose host (or a subdomain of it) and beginning of the path fit; else null."""
    fits = []
    for _, rule in sorted(rules, key=lambda r: -len(r[1])):
        domain, slash, rest = rule.partition("/")
        fits.append(F.when(((host == domain) | host.endswith("." + domain)) & path.startswith(slash + rest), F.lit(rule)))
    return F.coalesce(*fits) if fits else F.lit(None).cast("string")


def with_domains(hosts: DataFrame, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Adds the registered domain and its suffix to a table with ``host``."""
    bare = F.regexp_replace(F.regexp_replace("host", "^.*@", ""), ":[0-9]*$", "")
    two, three = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -3)
    known = two.isin(*suffixes) if suffixes else F.lit(False)
    address = bare.rlike("^[0-9.]+$")
    return hosts.withColumns({
        "domain": F.when(address, bare).when(known, three).otherwise(two),
        "suffix": F.when(address, "").when(known, two).otherwise(F.substring_index(bare, ".", -1))})


def page_outcomes(pages: DataFrame, labels: DataFrame, url_col: str = "url") -> DataFrame:
    """url_host, bad, n: labelled pages. A page's path ends in the number of its document, whose label it has.

    Pages are counted per host and number before the join, so copies of one address are one row of it.
    """
    url = F.col(url_col)
    number = F.regexp_extract(path_of(url), "/([0-9]{1,18})(?:[./][^/]*)?$", 1)
    counted = pages.select(host_of(url).alias("host"), number.try_cast("long").alias("number")) \
        .where(F.col("number").isNotNull()).groupBy("host", "number").agg(F.count(F.lit(1)).alias("n"))
    bad = (F.coalesce("toxic", F.lit(0)) == 1) | (F.coalesce("quality", F.lit(1)) == 0)
    judged = labels.where(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("number")).agg(
        F.max(bad.cast("int")).alias("bad"))
    return by_shuffle(counted).join(judged, "number").groupBy("host", "bad").agg(F.sum("n").alias("n"))


def _spread(table: DataFrame) -> float:
    """Intra-group correlation by moments: sum((k - nm)^2 / (m(1-m))) = sum(n) + rho * sum(n(n-1))."""
    n, k, m = F.col("n_labelled").cast("double"), F.col("n_bad").cast("double"), F.col("parent")
    got = table.agg(F.sum((k - n * m) * (k - n * m) / (m * (1 - m))).alias("t"), F.sum(n).alias("n"),
                    F.sum(n * (n - 1)).alias("p")).first()
    low, high = SPREADS
    return round(min(high, max(low, (got.t - got.n) / got.p)), 9) if got.p else high


def _digamma(x: Column) -> Column:
    y = x + 6
    s = F.log(y) - 1 / (2 * y) - 1 / (12 * y * y) + 1 / (120 * y * y * y * y) - 1 / (252 * y * y * y * y * y * y)
    for i in range(6):
        s = s - 1 / (x + i)
    return s


def _trigamma(x: Column) -> Column:
    y = x + 6
    s = 1 / y + 1 / (2 * y * y) + 1 / (6 * y * y * y) - 1 / (30 * y * y * y * y * y) + 1 / (42 * y * y * y * y * y * y * y)
    for i in range(6):
        s = s + 1 / ((x + i) * (x + i))
    return s


def lower_bound(a: Column, b: Column, confidence: float = CONFIDENCE) -> Column:
    """What a share with posterior Beta(a, b) exceeds with the given probability."""
    z = NormalDist().inv_cdf(confidence)
    logit = _digamma(a) - _digamma(b) - z * F.sqrt(_trigamma(a) + _trigamma(b))
    return 1 / (1 + F.exp(-logit))


def reputation(hosts: DataFrame, confidence: float = CONFIDENCE, suffixes: Sequence[str] = SUFFIXES) -> DataFrame:
    """Adds alpha, beta and bad_bound to a table of host, n_pages, n_labelled, n_bad (one row per host)."""
    table = with_domains(hosts, suffixes)
    counts = [F.sum(c).alias(c) for c in ("n_pages", "n_labelled", "n_bad")]
    whole = table.agg(*counts).first()
    mean = ((whole.n_bad or 0) + 0.5) / ((whole.n_labelled or 0) + 1)
    above = None
    for level in LEVELS:  # each step joins a level with the posterior means of the one above
        own = table.groupBy(level, *(["suffix"] if level == "domain" else [])).agg(
            *counts, F.count(F.lit(1)).alias("n_hosts")) if level != "host" else table
        if above is None:
            own = own.withColumn("parent", F.lit(mean))
        else:
            up, means = above
            own = join_even(own, means, up, "n_below", ["host" if level == "host" else level])
            own = own.drop("n_below")
        own = materialize(own, f"hosts-{level}")  # for the fit, the means and the last join
        rho = _spread(own)
        strength = 1 / rho - 1
        a = strength * F.col("parent") + F.col("n_bad")
        b = strength * (1 - F.col("parent")) + (F.col("n_labelled") - F.col("n_bad"))
        if level == "host":
            return own.withColumns({"alpha": a, "beta": b, "bad_bound": lower_bound(a, b, confidence)})
        below = own.select("domain", F.col("n_hosts").alias("n_below")) if level == "domain" else \
            table.select("domain", "suffix").distinct().groupBy("suffix").agg(F.count(F.lit(1)).alias("n_below"))
        above = level, materialize(own.join(by_shuffle(below), level).select(
            level, "n_below", (a / (a + b)).alias("parent")), f"means-{level}")
    raise AssertionError


def filter_urls(pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str]] = RULES, max_bad: float = MAX_BAD,
                confidence: float = CONFIDENCE, suffixes: Sequence[str] = SUFFIXES, url_col: str = "url") -> DataFrame:
    """Every page as struct ``row`` with host, path, rule, verdict, n_pages, n_labelled, n_bad, bad_bound of its host.

    ``outcomes`` has host, bad (0 or 1) and n (pages), as ``page_outcomes`` gives.
    """
    url = F.col(url_col)
    judged = pages.select(F.struct(*[pages[c] for c in pages.columns]).alias("row"), host_of(url).alias("host"),
                          path_of(url).alias("path"))
    zero = F.lit(0).cast("long")
    seen = judged.select("host", F.lit(1).cast("long").alias("n_pages"), zero.alias("n_labelled"), zero.alias("n_bad"))
    labelled = outcomes.select(F.coalesce("host", F.lit("")).alias("host"), zero.alias("n_pages"), F.col("n").alias("n_labelled"),
                               (F.coalesce("bad", F.lit(0)) * F.col("n")).cast("long").alias("n_bad"))
    hosts = seen.unionByName(labelled).groupBy("host").agg(*[F.sum(c).alias(c) for c in ("n_pages", "n_labelled", "n_bad")])
    known = reputation(materialize(hosts, "hosts"), confidence, suffixes)
    known = materialize(known.select("host", "n_pages", "n_labelled", "n_bad", "bad_bound"), "reputation")
    spread = [f"row.`{f.name}`" for f in pages.schema if "map<" not in f.dataType.simpleString()]
    out = join_even(judged, known, "host", "n_pages", spread)
    rule = rule_of(F.col("host"), F.col("path"), rules)
    by_rule = F.create_map(*[F.lit(x) for verdict, r in rules for x in (r, verdict)]) if rules else None
    method = F.when(F.col("bad_bound") > max_bad, "block").otherwise("allow")
    out = out.withColumn("rule", rule)
    verdict = F.coalesce(by_rule[F.col("rule")], method) if rules else method
    return out.select("row", "host", "path", "rule", verdict.alias("verdict"), "n_pages", "n_labelled", "n_bad", "bad_bound")


def drop_blocked(pages: DataFrame, outcomes: DataFrame, **options) -> DataFrame:
    """``pages`` without those that a rule or their host's reputation blocks."""
    return filter_urls(pages, outcomes, **options).where(F.col("verdict") == "allow").select("row.*")
