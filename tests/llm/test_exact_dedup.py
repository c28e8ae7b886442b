import hashlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from planmart.llm.exact_dedup import exact_dedup

from .helpers import corpus, docs_df


def brute(rows, keep, norm=lambda t: t):
    groups = defaultdict(list)
    for i, t in rows:
        groups[norm(t or "")].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        best = (min if keep == "smallest" else max)(known) if known else None
        left = True
        for i in ids:
            out.append((i, best, len(ids), i == best and left, hashlib.sha256(text.encode()).hexdigest()))
            left = left and i != best
    return out


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_against_brute_force(spark, keep):
    rows = corpus() + [(5000 + i, "hot " * 20) for i in range(300)]
    got = [tuple(r) for r in exact_dedup(docs_df(spark, rows), keep).collect()]
    assert Counter(got) == Counter(brute(rows, keep))


def test_normalisation_and_empty_table(spark):
    rows = [(1, "A b"), (2, "a  B"), (3, "c"), (None, "c"), (None, "d"), (None, "d")]
    squeeze = lambda c: F.lower(F.regexp_replace(c, " +", " "))
    got = [tuple(r) for r in exact_dedup(docs_df(spark, rows), normalise=squeeze).collect()]
    assert Counter(got) == Counter(brute(rows, "smallest", lambda t: " ".join(t.lower().split())))
    assert exact_dedup(docs_df(spark, [])).count() == 0


def test_texts_alike_but_for_their_ends(spark):
    rows = [(i, "same start " * 50 + str(i % 3)) for i in range(60)]
    got = [tuple(r) for r in exact_dedup(docs_df(spark, rows)).collect()]
    assert Counter(got) == Counter(brute(rows, "smallest"))
