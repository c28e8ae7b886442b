"""URL filter against plain Python: hosts, paths, rules, the hierarchy of priors; edge cases; one very common host."""

import math
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import url_filter as U

PAGES = "page_id long, url string, html string, host string, verdict string, row string, n_pages int, _even_by string, tags map<string,int>"


def pages_df(spark, urls):
    return spark.createDataFrame([(i, u, None, "x", "y", "z", 1, "w", {"a": 1}) for i, u in enumerate(urls)], PAGES).repartition(4)


def cut(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    for stop in "?#":
        rest = rest.split(stop, 1)[0]
    host, slash, path = rest.partition("/")
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), slash + path


def rule(host, path):
    fits = [r for _, r in U.RULES for h, s, p in [r.partition("/")]
            if (host == h or host.endswith("." + h)) and path.startswith(s + p)]
    return max(fits, key=len, default=None)


def levels(host):
    bare = host.rsplit("@", 1)[-1]
    head, colon, port = bare.rpartition(":")
    if colon and (not port or port.isdigit()):
        bare = head
    labels = bare.split(".")
    if bare and not bare.strip("0123456789."):
        return bare, ""
    two = ".".join(labels[-2:])
    return (".".join(labels[-3:]), two) if two in U.SUFFIXES else (two, labels[-1])


def digamma(x):
    s = 0.0
    while x < 30:
        s, x = s - 1 / x, x + 1
    return s + math.log(x) - 1 / (2 * x) - 1 / (12 * x ** 2) + 1 / (120 * x ** 4)


def trigamma(x):
    s = 0.0
    while x < 30:
        s, x = s + 1 / x ** 2, x + 1
    return s + 1 / x + 1 / (2 * x ** 2) + 1 / (6 * x ** 3) - 1 / (30 * x ** 5)


def brute_bounds(hosts, counts):
    """host -> lower bound, from (n, bad) by host, in plain loops."""
    n = lambda h: counts.get(h, (0, 0))[0]
    k = lambda h: counts.get(h, (0, 0))[1]
    groups = [defaultdict(list), defaultdict(list), {h: [h] for h in hosts}]
    for h in hosts:
        d, s = levels(h)
        groups[0][s].append(h)
        groups[1][d].append(h)
    parents = [lambda g: None, lambda g: levels(groups[1][g][0])[1], lambda g: levels(g)[0]]
    total_n, total_k = sum(map(n, hosts)), sum(map(k, hosts))
    means = {None: (total_k + 0.5) / (total_n + 1)}
    for level in range(3):
        size = {g: (sum(map(n, hs)), sum(map(k, hs)), means[parents[level](g)]) for g, hs in groups[level].items()}
        pairs = sum(a * (a - 1) for a, _, _ in size.values())
        t = sum((b - a * m) ** 2 / (m * (1 - m)) for a, b, m in size.values())
        rho = min(0.5, max(0.0001, (t - total_n) / pairs)) if pairs else 0.5
        s = 1 / rho - 1
        law = {g: (s * m + b, s * (1 - m) + a - b) for g, (a, b, m) in size.items()}
        means = {g: a / (a + b) for g, (a, b) in law.items()}
    return {h: 1 / (1 + math.exp(-(digamma(a) - digamma(b) - 1.6448536269514722 * math.sqrt(trigamma(a) + trigamma(b)))))
            for h, (a, b) in law.items()}


def urls(seed=3, n=600):
    rng = random.Random(seed)
    hosts = ["hot.example.net"] * 10 + [f"{a}.{b}" for a in ("www", "m", "a.b") for b in (
        "example.org", "example.com", "bad.net", "x.co.uk", "y.co.uk", "z.com", "fr.com")]
    out = [f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}/{rng.choice(['en', 'es', 'fr', 'de'])}/{rng.randint(1, 300)}"
           + rng.choice(["", "/", ".html", "?a=/b#c", "#x?y"]) for _ in range(n)]
    return out + [None, "", "no scheme", "://", "HTTP://EXAMPLE.ORG/es/1", "http://example.org/en/1x", "http://example.org",
                  "http://org/", "http://xorg/", "http://notexample.org/es/1", "http://org?x=/en/", "http://a.com/FR/1",
                  "http://u:p@www.z.com:8080/de/5", "http://10.0.0.1/en/7", "http://İ.com/fr/2", "a://b://c/d/3", "x://h#/fr/9",
                  out[0], out[0]]


def test_against_brute_force(spark):
    rows, rng = urls(), random.Random(5)
    labels = [(i, rng.choice([0, 1, 1, None]), rng.choice([0, 0, 1, None])) for i in range(1, 301, 2)] + [(None, 0, 1)]
    bad = {i: int(t == 1 or q == 0) for i, q, t in labels}
    df = pages_df(spark, rows)
    outcomes = U.page_outcomes(df, spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    counts = defaultdict(lambda: [0, 0])
    for u in rows:
        host, path = cut(u)
        last = path.rstrip("/").split("/")[-1] if not path.endswith("//") else ""
        number = last.split(".")[0]
        if number.isdigit() and int(number) in bad:
            counts[host][0] += 1
            counts[host][1] += bad[int(number)]
    bounds = brute_bounds(sorted({cut(u)[0] for u in rows}), counts)
    limits = sorted(set(bounds.values()))
    limit = (limits[len(limits) // 2 - 1] + limits[len(limits) // 2]) / 2  # some hosts lie on either side
    got = U.filter_urls(df, outcomes, max_bad=limit).collect()
    assert Counter(r.row.page_id for r in got) == Counter(range(len(rows)))
    for r in got:
        host, path = cut(rows[r.row.page_id])
        want = rule(host, path)
        assert (r.host, r.path, r.rule) == (host, path, want)
        assert (r.n_labelled, r.n_bad) == tuple(counts[host]) and r.n_pages == sum(cut(u)[0] == host for u in rows)
        assert r.bad_bound == pytest.approx(bounds[host], rel=1e-6)
        verdict = dict((b, a) for a, b in U.RULES).get(want) or ("block" if bounds[host] > limit else "allow")
        assert r.verdict == verdict
        assert (r.row.verdict, r.row.host, r.row.html) == ("y", "x", None)
    assert {r.verdict for r in got if r.rule is None} == {"allow", "block"}


def test_reputation_blocks_hosts_that_are_surely_bad(spark):
    rows = [f"http://{h}.example.net/en/{i}" for h in ("good", "bad", "few") for i in range(40 if h != "few" else 1)]
    df = pages_df(spark, rows + ["http://new.example.net/en/x"])
    outcomes = spark.createDataFrame([("good.example.net", 0, 40), ("bad.example.net", 1, 40), ("few.example.net", 1, 1)],
                                     "host string, bad int, n long")
    verdict = {r.host: r.verdict for r in U.filter_urls(df, outcomes).collect()}
    assert verdict == {"good.example.net": "allow", "bad.example.net": "block", "few.example.net": "allow",
                       "new.example.net": "allow"}
    assert U.drop_blocked(df, outcomes).count() == 42 and U.drop_blocked(df, outcomes).columns == df.columns


def test_empty_tables_and_no_labels(spark):
    none = spark.createDataFrame([], "host string, bad int, n long")
    assert U.filter_urls(pages_df(spark, []), none).count() == 0
    got = U.filter_urls(pages_df(spark, ["http://a.net/", None]), none).collect()
    assert {r.verdict for r in got} == {"allow"} and len(got) == 2
    nulls = spark.createDataFrame([(None, None, 2), ("a.net", None, 1)], "host string, bad int, n long")
    assert sorted((r.host, r.n_labelled, r.n_bad) for r in U.filter_urls(pages_df(spark, ["http://a.net/", None]), nulls).collect()) \
        == [("", 2, 0), ("a.net", 1, 0)]


def test_lower_bound_is_near_the_quantile(spark):
    rng = np.random.default_rng(1)
    for a, b in ((1.5, 8.0), (30.0, 70.0), (400.0, 20.0)):
        got = spark.range(1).select(U.lower_bound(F.lit(a), F.lit(b))).first()[0]
        assert got == pytest.approx(np.quantile(rng.beta(a, b, 400_000), 0.05), abs=0.02)
