"""Lexical search against plain Python over all documents; exactness of the bounds on clustered lists; edge cases."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import lexical_search as S

from .helpers import corpus, docs_df

TERM = re.compile("[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
lower = lambda s: "".join(c.lower() if "A" <= c <= "Z" else c for c in s)


def brute(docs, items, top=10):
    counts = [(i, Counter(TERM.findall(lower(t or "")))) for i, t in docs]
    counts = [(i, c) for i, c in counts if c]
    n_docs, n_terms = len(counts), sum(sum(c.values()) for _, c in counts)
    df = Counter(t for _, c in counts for t in c)
    out = []
    for item, text in items:
        terms = {t: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) for t in TERM.findall(lower(text or ""))}
        scored = []
        for i, c in counts:
            m = 10 + 90 * sum(c.values()) * n_docs // n_terms
            score = sum(w * (10 ** 9 * c[t] // (1000 * c[t] + 8 * m)) for t, w in terms.items() if t in c)
            if score > 0:
                scored.append((-score, i is None, i or 0, i))
        out += [(item, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored)[:top])]
    return sorted(out, key=str)


def items_df(spark, items):
    return spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, rank int")


def searched(spark, docs, items, **options):
    return sorted((tuple(r) for r in S.search(docs_df(spark, docs), items_df(spark, items), **options).collect()), key=str)


def items_of(docs, seed=4, n=25):
    rng = random.Random(seed)
    words = sorted({w for _, t in docs for w in (t or "").split()})
    some = [" ".join(rng.choice(words) for _ in range(rng.randint(1, 30))) for _ in range(n)]
    texts = [t for _, t in docs if t]
    some += [" ".join(rng.choice(texts).split()[3:25]).upper() for _ in range(n)]
    return list(enumerate(some)) + [(90, None), (91, ""), (92, "?! --"), (93, "absent0 nowhere1"), (94, "é ß İ x"), (None, texts[0])]


def test_against_brute_force(spark):
    docs = corpus(7, 260)
    docs += [(20000 + i, docs[0][1]) for i in range(150)]  # copies: equal scores go by id
    items = items_of(docs)
    assert searched(spark, docs, items) == brute(docs, items)


def test_several_blocks_of_items_small_shards_and_rounds(spark, monkeypatch):
    docs, items = corpus(8, 150), items_of(corpus(8, 150))
    monkeypatch.setattr(S, "ROUNDS", (8, 2, 1))
    monkeypatch.setattr(S, "SHARD_DOCS", 20)
    monkeypatch.setattr(S, "BLOCK_DOCS", 4)
    assert searched(spark, docs, items, item_bytes=900, top=5) == brute(docs, items, 5)


def test_blocks_are_skipped_only_when_bounds_fail():
    """Documents of twenty topics that share one heavy term: most blocks of its list are skipped, scores stay exact."""
    rng = np.random.default_rng(3)
    rows = [np.unique(np.concatenate([[0], 20 * (k % 20) + rng.integers(1, 21, 12)])) for k in range(2000)]
    sizes = np.array([len(r) for r in rows])
    terms = np.concatenate(rows)
    values = rng.integers(1, 1000, len(terms))
    queries = [np.concatenate([[0], 20 * (k % 20) + np.arange(1, 9)]) for k in range(30)]
    shard = S.Shard(np.concatenate([[0], np.cumsum(sizes)]), terms, values, 401, queries)
    weight = np.append(3000, rng.integers(1000, 2000, 400))
    dense = np.zeros((2000, 401), np.int64)
    dense[np.repeat(np.arange(2000), sizes), terms] = values
    taken = skipped = 0
    for q in queries:
        want = dense[:, q] @ weight[q]
        docs, scores, t, s = shard.search(q, weight[q], 0, 10)
        assert (scores == want[docs]).all()
        assert sorted(scores)[::-1][:10] == sorted(want)[::-1][:10]
        assert set(np.flatnonzero(want >= sorted(want)[-10])) <= set(docs)
        taken, skipped = taken + t, skipped + s
    assert skipped > taken
    members, begin, columns, summary = shard.blocked(0)
    assert sorted(members) == list(range(2000)) and np.diff(begin).max() <= S.BLOCK_DOCS
    for b in range(len(begin) - 1):
        assert (summary[b] == dense[members[begin[b]:begin[b + 1]]][:, columns].max(axis=0)).all()


def test_edge_cases(spark):
    assert searched(spark, [], [(1, "a b")]) == []
    assert searched(spark, [(1, "a b")], []) == []
    assert searched(spark, [(1, None), (2, ""), (3, "-- !")], [(1, "a")]) == []
    same = [(1, "a"), (1, "a"), (None, "a")]
    assert searched(spark, same, [(1, "A"), (1, "A")]) == sorted(brute(same, [(1, "A")]) * 2, key=str)
    assert searched(spark, [(i, "a") for i in range(1100)], [(1, "a")]) == []  # a term of every document weighs nothing
    docs = [(i, "a b") for i in (5, 3, None, 3)] + [(9, "c " * 30000), (8, "d")]
    items = [(1, "B c"), (1, "B c")]
    assert searched(spark, docs, items) == brute(docs, items)


def test_large_counts_stay_exact():
    n = np.array([3, 1 << 50])
    got = S.contributions(n, np.array([1, 1]), np.array([2, 5]), 1 << 10, 1 << 40)
    assert list(got) == [2 * 10 ** 9 // (2000 + 8 * (10 + 90 * 3 * (1 << 10) // (1 << 40))),
                         5 * 10 ** 9 // (5000 + 8 * (10 + 90 * (1 << 50) * (1 << 10) // (1 << 40)))]


def test_lists_are_cut_per_term(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    table = S.term_table(docs.select("doc_id", "text"), {b"the": 0, b"of": 1}, "doc_id", "text")
    assert table.where(F.array_contains("terms", 0)).count() == sum(
        "the" in TERM.findall(lower(r[0] or "")) for r in docs.select("text").collect())
    assert pytest.approx(table.agg(F.sum("n")).first()[0]) == sum(
        len(TERM.findall(lower(r[0] or ""))) for r in docs.select("text").collect())
