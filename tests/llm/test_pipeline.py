"""The pipeline against its stages by brute force, each on what the one before it kept."""

from collections import Counter

import pytest

import corpus_pipeline as P
from planmart.llm import common as C
from planmart.llm import language_id as L

from . import test_decontaminate, test_line_dedup, test_ngram_join
from .helpers import COLUMNS, corpus


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("tables"))
    rows = [(i, t, ("en" if i % 2 else "fr"), "s", len(t or "")) for i, t in corpus(n=80) if i is not None]
    words = rows[10][1].split()
    rows += [(20000, "clean start here " + " ".join(words[:14]), "en", "s", 1), (20001, "12 34 !!", "en", "s", 8)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(1, " ".join(words[:12])), (2, "never seen anywhere")], "item_id long, text string").write.parquet(
        f"{folder}/benchmark.parquet")
    return folder


def test_stages_by_brute_force(spark, tables):
    docs = C.documents(spark, tables)
    model = L.train(docs)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    letters = L.letter_table()
    rows = [r for r in rows if not L.predict([r[1]], model, letters)[2][0]]
    rows = [(i, t) for i, t, _, gone in test_line_dedup.brute(rows, 2) if not gone or t]
    leaders = Counter(c for _, c, _, _ in test_ngram_join.brute(rows))
    once = {r[0]: r for r in rows if r[0] in leaders}
    rows = list(once.values())
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{tables}/benchmark.parquet").collect()]
    hit = test_decontaminate.brute(rows, items)
    want = {i: t for i, t in rows if not hit[i][1]}
    got = P.run(spark, tables)
    assert got.columns[:5] == COLUMNS
    got = got.collect()
    assert {r.doc_id: r.text for r in got} == want and len(got) == len(want)
    assert 20000 not in want and 20001 not in want
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(P.public_tokenizer())
    for r in got:
        ids = library.encode(r.text, add_special_tokens=False).ids
        assert r.ids == ids and r.n_tokens == len(ids) and r.n_chars == len(r.text)


def test_every_stage_but_the_last_keeps_the_columns(spark, tables):
    docs = C.documents(spark, tables)
    for _, stage in P.STAGES[:-1]:
        assert stage(spark, docs, tables).columns == docs.columns
    assert [name for name, _ in P.STAGES] == ["language_id", "line_dedup", "ngram_join", "decontamination", "bpe"]


def test_empty_documents(spark, tables, tmp_path):
    docs = C.documents(spark, tables)
    docs.limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    spark.read.parquet(f"{tables}/benchmark.parquet").write.parquet(f"{tmp_path}/benchmark.parquet")
    assert P.run(spark, str(tmp_path)).count() == 0
