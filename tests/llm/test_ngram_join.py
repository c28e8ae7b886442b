import math
from collections import Counter
from fractions import Fraction

import numpy as np

from planmart.llm import ngram_join as J
from planmart.llm.components import connected_components

from .helpers import corpus, docs_df


def grams(t):
    w = (t or "").split()
    n = min(5, len(w))
    return frozenset(tuple(w[i:i + n]) for i in range(len(w) - n + 1)) if w else frozenset()


def brute(rows):
    sets = Counter(grams(t) for _, t in rows)
    keys = [s for s in sets if s]
    parent = {s: s for s in keys}

    def find(s):
        while parent[s] != s:
            s = parent[s]
        return s

    links = Counter()
    for a, s in enumerate(keys):
        for t in keys[:a]:
            inter = len(s & t)
            if 5 * inter >= 4 * (len(s) + len(t) - inter):
                links[s] += 1
                links[t] += 1
                parent[find(s)] = find(t)
    least = {}
    for i, t in rows:
        if i is not None and grams(t):
            root = find(grams(t))
            least[root] = min(i, least.get(root, i))
    out = []
    for i, t in rows:
        s = grams(t)
        out.append((i, least.get(find(s), i) if s else i, links[s], sets[s] if s else 1))
    return out


def near_copies(n=150, words=200):
    rng = np.random.default_rng(2)
    base = [f"w{k}" for k in range(words)]
    out = []
    for i in range(n):
        w = list(base)
        for k in rng.choice(words, rng.integers(0, 12), replace=False):
            w[k] = f"x{i}_{k}"
        out.append((5000 + i, " ".join(w)))
    return out


def run(spark, rows):
    return Counter(map(tuple, J.ngram_join(docs_df(spark, rows)).select("doc_id", "class_id", "n_links", "n_copies").collect()))


def test_against_brute_force(spark):
    rows = corpus() + near_copies()
    assert run(spark, rows) == Counter(brute(rows))


def test_one_of_each_class_stays(spark):
    rows = [r for r in corpus(n=60) + near_copies(30)]
    df = docs_df(spark, rows)
    kept = J.keep_one(df)
    assert kept.columns == df.columns
    classes = {}
    for (i, t), (_, c, _, _) in zip(rows, brute(rows), strict=True):
        if grams(t):
            classes.setdefault(c if c is not None else t, []).append(i)
    want = Counter(min(x for x in ids if x is not None) for ids in classes.values() if any(x is not None for x in ids))
    got = Counter(r.doc_id for r in kept.collect() if grams(r.text))
    assert got == want
    assert Counter(r.doc_id for r in kept.collect() if not grams(r.text)) == Counter(i for i, t in rows if not grams(t))


def test_blocks_change_nothing(spark, monkeypatch):
    monkeypatch.setattr(J, "BUCKET_BLOCK", 16)
    monkeypatch.setattr(J, "VERIFY_BLOCK", 8)
    rows = near_copies(90) + corpus(seed=4, n=40)
    assert run(spark, rows) == Counter(brute(rows))


def test_empty_table(spark):
    assert run(spark, []) == Counter()
    assert run(spark, [(1, None), (2, ""), (2, "")]) == Counter({(1, 1, 0, 1): 1, (2, 2, 0, 1): 2})


def test_pruning_needs_more_matches_as_values_are_seen():
    needed = J.least_matches()
    assert [n for n, _ in needed] == list(range(16, 97, 16))
    shares = [m / n for n, m in needed]
    assert shares == sorted(shares) and 0.2 < shares[0] < 0.5 and 0.55 < shares[-1] < 0.8


def test_intersections_and_links():
    rng = np.random.default_rng(0)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(20)]
    want = [[len(set(a.tolist()) & set(b.tolist())) for b in sets] for a in sets]
    assert J.intersections(sets).tolist() == want
    pairs = [(i, j) for i in range(20) for j in range(i + 1, 20) if (i + j) % 3]
    for chosen in (pairs, pairs[::9], []):
        first, second = (np.array([p[k] for p in chosen], np.int64) for k in (0, 1))
        assert J.pair_intersections(sets, first, second).tolist() == [want[i][j] for i, j in chosen]
        links, forest = J.verified_links(sets, first, second, Fraction(1, 3))
        true = [(i, j) for i, j in chosen if 3 * want[i][j] >= len(sets[i]) + len(sets[j]) - want[i][j]]
        assert links.tolist() == [sum(k in p for p in true) for k in range(20)]
        assert set(forest) <= set(true)
        assert components_of(20, forest) == components_of(20, true)


def components_of(n, edges):
    group = list(range(n))
    for a, b in edges:
        group = [group[a] if g == group[b] else g for g in group]
    return {frozenset(k for k in range(n) if group[k] == g) for g in group}


def test_pairs_of_a_chain_are_dropped_before_the_exact_check():
    words = [f"w{k}" for k in range(600)]
    texts = [" ".join(words[4 * k:4 * k + 100]) for k in range(100)]  # neighbours overlap, distant ones share nothing
    sets = [J.ngram_set(t) for t in texts]
    sigs = np.stack([J.signature(s) for s in sets])
    first, second = J.surviving_pairs(sigs, None, J.least_matches(tolerance=J.VERIFY_TOLERANCE))
    survived = set(zip(first.tolist(), second.tolist(), strict=True))
    true = {(i, j) for i in range(100) for j in range(i + 1, 100)
            if 5 * (inter := len(np.intersect1d(sets[i], sets[j]))) >= 4 * (len(sets[i]) + len(sets[j]) - inter)}
    assert true and true <= survived and len(survived) < 1000  # of 4950
    side = np.arange(100) % 2
    across = set(zip(*(x.tolist() for x in J.surviving_pairs(sigs, side, J.least_matches())), strict=True))
    assert across <= {(i, j) for i, j in survived if side[i] != side[j]}


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, 200), (200, 300), (7, 7)] + [(500, 500 + k) for k in range(1, 80)]
    found = connected_components(spark.createDataFrame([*edges, (9, None), (None, 3), (0, 1)], "u int, v int")).collect()
    got = {r.node: (r.component, r.members) for r in found}
    assert len(found) == len(got)
    assert got == ({i: (0, 61) for i in range(61)} | {i: (100, 3) for i in (100, 200, 300)}
                   | {500 + k: (500, 80) for k in range(80)})
    assert connected_components(spark.createDataFrame([], "u int, v int")).count() == 0


def test_chance_to_drop_a_link_over_all_comparisons():
    def lost(similarity, tolerance=J.TOLERANCE):
        alive, gone = {0: 1.0}, 0.0
        for _, least in J.least_matches(tolerance=tolerance):
            after = Counter()
            for m, p in alive.items():
                for k in range(J.COMPARE + 1):
                    after[m + k] += p * math.comb(J.COMPARE, k) * similarity ** k * (1 - similarity) ** (J.COMPARE - k)
            gone += sum(p for m, p in after.items() if m < least)
            alive = {m: p for m, p in after.items() if m >= least}
        return gone

    assert 0 < lost(0.85) < lost(0.82) < lost(0.8) < 1e-4
    assert 0 < lost(0.8, J.VERIFY_TOLERANCE) < 1e-7
