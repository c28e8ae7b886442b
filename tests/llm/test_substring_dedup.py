import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import substring_dedup as S

from .helpers import corpus, docs_df


def words(t):
    return re.findall(r"[^\x20\x09-\x0D]+", t or "")


def brute(rows, n=13):
    least = {}
    for i, t in rows:
        if i is not None:
            w = words(t)
            for k in range(len(w) - n + 1):
                g = tuple(w[k:k + n])
                least[g] = min(i, least.get(g, i))
    out = []
    for i, t in rows:
        w = words(t)
        gone = set()
        for k in range(len(w) - n + 1):
            if i is not None and least[tuple(w[k:k + n])] < i:
                gone.update(range(k, k + n))
        out.append((i, len(w), len(gone), " ".join(x for k, x in enumerate(w) if k not in gone)))
    return out


def run(spark, rows, **options):
    got = S.remove_repeats(docs_df(spark, rows), **options).collect()
    return Counter((r.doc_id, r.n_words, sum(s.end - s.start for s in r.spans), r.kept_text) for r in got)


@pytest.mark.parametrize("heavy", [False, True])
def test_against_brute_force(spark, monkeypatch, heavy):
    options = {}
    if heavy:  # every document is sampled, what is seen twice is heavy: whole windows, long prefixes, salts
        monkeypatch.setattr(S, "SAMPLE", 1)
        options = {"group_rows": 1, "window_rows": 2}
    rows = corpus(n=200)
    hot = " ".join(f"h{k}" for k in range(40))
    rows += [(7000 + i, f"own{i} {hot} tail{i} " + " ".join(["z"] * (i % 30))) for i in range(150)]
    assert run(spark, rows, **options) == Counter(brute(rows))


def test_rows_that_share_an_id(spark):
    a, b = (" ".join(f"{c}{k}" for k in range(20)) for c in "ab")
    rows = [(1, a), (2, a), (2, b), (2, "c " + a), (2, a), (3, b), (None, a)]
    assert run(spark, rows) == Counter(brute(rows))


def test_empty_tables_and_texts(spark):
    assert run(spark, []) == Counter()
    rows = [(1, None), (2, ""), (3, "a " * 12), (4, "a " * 12), (5, "b " * 30), (6, "b " * 13), (7, "\x0b".join("c" * 13))]
    assert run(spark, rows) == Counter(brute(rows))


def test_groups_are_bounded_under_one_prefix_with_differing_neighbours(spark):
    """One 5-gram in nearly all documents, between words that differ: its group is split, results stay whole."""
    side = lambda i, k: " ".join(f"{k}{i % 90}x{j}" for j in range(8))
    rows = [(i, f"{side(i, 'l')} one two three four five {side(i, 'r')}") for i in range(300)]
    rows += [(900 + i, " ".join(f"w{i}q{j}" for j in range(20))) for i in range(20)]
    assert run(spark, rows, group_rows=50) == Counter(brute(rows))

    docs = docs_df(spark, rows).selectExpr("doc_id AS doc_key", "text AS doc_text", "1 AS tag")
    marks = S.repeated_marks(docs, np.zeros(0, np.int64))
    counts = {r[0]: r[1] for r in marks.selectExpr("explode(arrays_zip(marks, places)) m").groupBy("m.marks")
              .agg(F.sum("m.places")).collect()}
    heavy = S.heavy_prefixes(marks, 50)
    assert sorted(heavy.tolist()) == sorted(m for m, n in counts.items() if n > 50) and len(heavy)
    marked = docs.join(marks.drop("places"), "doc_key")

    def held(lengthened):
        groups = {}
        for r in S.suffix_rows(marked, lengthened, {}).collect():
            for back in range(S.SPAN):
                if r.open >> back & 1:
                    at = (S.SPAN - 1 - back) * S.WORD_BYTES
                    groups.setdefault(r.grp, set()).add(bytes(r.words[at:at + S.WINDOW * S.WORD_BYTES]))
        return max(len(g) for g in groups.values())

    assert held(np.zeros(0, np.int64)) > 50 >= held(heavy)
