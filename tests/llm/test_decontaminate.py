import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from planmart.llm import decontaminate as D

from .helpers import docs_df


def words(t):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), t or ""))


def brute(docs, items, window=10):
    out = {}
    for i, t in docs:
        w, hit, ids = words(t), set(), set()
        for item, text in items:
            x = words(text)
            n = min(window, len(x))
            grams = {tuple(x[k:k + n]) for k in range(len(x) - n + 1)} if x else set()
            for k in range(len(w) - n + 1 if x else 0):
                if tuple(w[k:k + n]) in grams:
                    hit.update(range(k, k + n))
                    if item is not None:
                        ids.add(str(item))
        out[i] = (len(w), sorted(hit), sorted(ids))
    return out


ITEMS = [(1, "The QUICK brown fox, jumps over the lazy dog and then some more words follow here"),
         (2, "Two words"), (3, ""), (4, None), (5, "éclair Über straße"), (6, "two words"), (None, "lazy dog"),
         (10, "aa aa aa aa aa aa aa aa aa aa aa"), (11, "İstanbul K 7")]
DOCS = [(1, "xx the quick; BROWN fox jumps over the lazy dog and then -- some more"), (2, "Two\nwords! two words"),
        (3, None), (4, ""), (5, "ÉCLAIR über straße éclair Über Straße"), (6, "éclair Über straße"),
        (7, " ".join(["aa"] * 30)), (8, "twowords two wordsx xtwo words"), (9, "İstanbul k 7 K"), (10, "lazy ... dog"),
        (11, "the quick brown fox jumps over the lazy cat " * 3000 + "two words")]


@pytest.mark.parametrize("block_bytes", [D.BLOCK_BYTES, 40])
def test_against_brute_force(spark, block_bytes):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    found = D.find_contamination(docs_df(spark, DOCS), items, block_bytes=block_bytes).select("row.*", "n_words", "hit_words",
                                                                                             "items").collect()
    want = brute(DOCS, ITEMS)
    assert {r[0]: (r[-3], r[-2], r[-1]) for r in found} == want


def test_spans_map_to_the_original(spark):
    text = "... Two,\twords -- and TWO words two words."
    found = D.find_contamination(docs_df(spark, [(1, text)]), spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert [text[s.start:s.end] for s in found.first().spans] == ["Two,\twords", "TWO words two words"]


def test_drop_keeps_columns_and_clean_rows(spark):
    df = docs_df(spark, DOCS + DOCS[:1])
    kept = D.drop_contaminated(df, spark.createDataFrame(ITEMS, "item_id long, text string"))
    assert kept.columns == df.columns
    assert {r.doc_id for r in kept.collect()} == {i for i, (_, hit, _) in brute(DOCS, ITEMS).items() if not hit}


def test_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.drop_contaminated(docs_df(spark, DOCS), none).count() == len(DOCS)
    assert D.find_contamination(docs_df(spark, []), spark.createDataFrame(ITEMS, none.schema)).count() == 0


def test_long_texts_random_words(spark):
    rng = random.Random(5)
    draw = lambda n, k: " ".join(f"w{rng.randrange(k)}" for _ in range(n))
    items = [(i, draw(rng.choice([1, 2, 5, 9, 10, 11, 40]), 3)) for i in range(30)] + [(99, draw(700, 40))]
    # more words than a lane has, windows across lane borders, and a text without any word of an item
    docs = [(i, draw(n, 4)) for i, n in enumerate([0, 1, 9, 10, D.LANE - 1, D.LANE, D.LANE + 1, 3 * D.LANE + 5, 2000])]
    docs += [(20, "x " * 250 + items[-1][1] + " y" * 300), (21, "x y z " * 1000), (22, items[-1][1])]
    want = brute(docs, items)
    table = spark.createDataFrame(items, "item_id long, text string")
    for block_bytes in (D.BLOCK_BYTES, 300):
        found = D.find_contamination(docs_df(spark, docs), table, block_bytes=block_bytes)
        got = {r[0]: (r[1], r[2], r[3]) for r in found.select("row.doc_id", "n_words", "hit_words", "items").collect()}
        assert got == want


def test_blocks_keep_repeated_rows_and_nulls(spark):
    docs = DOCS + DOCS[:3] + [(3, None), (None, "two words")]
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    digest = docs_df(spark, docs).withColumn("digest", F.lit("x")).withColumn("hit_words", F.lit(7))  # clashing names
    one, many = (D.find_contamination(digest, items, block_bytes=b) for b in (D.BLOCK_BYTES, 40))
    assert many.columns == one.columns and many.count() == len(docs)
    assert one.exceptAll(many).count() == many.exceptAll(one).count() == 0


def test_states_are_few_and_flat():
    rng = random.Random(6)
    words = [f"word{rng.randrange(50_000)}" for _ in range(100_000)]
    automaton = D.Automaton([(k, " ".join(words[k * 500:(k + 1) * 500])) for k in range(200)], 10)
    flat = sum(x.nbytes for x in vars(automaton).values() if isinstance(x, np.ndarray))
    assert len(automaton) <= 10 * len(words) and flat <= 30 * len(automaton)
