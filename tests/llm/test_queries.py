"""Every registered query on the driver's tables: against its SQL where there is some, else against brute force."""

import hashlib
import zlib
from collections import Counter

import pytest

import __spark_entry__ as E
from planmart.llm.oracle import ORACLE
from planmart.llm.queries import QUERIES, public_tokenizer
from planmart.verify import compare, duckdb_connection

from . import test_ngram_join as ngram_join
from . import test_secrets as secrets

sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


@pytest.fixture(scope="module")
def docs(spark, sf_small):
    return [tuple(r) for r in spark.read.parquet(f"{sf_small}/documents.parquet").select("doc_id", "text").collect()]


def run(spark, sf_small, name):
    return [r.asDict() for r in E.queries()[name](spark, sf_small).collect()]


def test_one_query_per_operator():
    assert sorted(int(k[2:].split("_")[0]) for k in QUERIES) == list(range(1, 14))
    assert {"pipeline", *QUERIES} <= set(E.queries()) and set(ORACLE) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_matches_sql(spark, sf_small, name):
    ok, message = compare(E.queries()[name](spark, sf_small), duckdb_connection(sf_small), ORACLE[name], strict=True)
    assert ok, message


def test_sharding(spark, sf_small, docs):
    got = run(spark, sf_small, "op1_sharding")
    want = {i: (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in docs}
    assert {r["doc_id"]: (r["size"], r["text_crc32"]) for r in got} == want and len(got) == len(docs)
    loads = Counter()
    for r in got:
        loads[r["shard"]] += r["size"]
        assert r["law"] == "bytes" and r["grown_shard"] is None
    assert set(loads) == set(range(8))
    assert max(loads.values()) - min(loads.values()) <= max(s for s, _ in want.values())
    for shard in range(8):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(sum(r["shard"] == shard for r in got)))


def test_lm_score(spark, sf_small, docs):
    got = run(spark, sf_small, "op2_lm_score")
    assert {r["doc_id"]: r["n_tokens"] for r in got} == {i: len((t or "").encode().split()) for i, t in docs}
    assert all(r["log_likelihood"] < 0 for r in got if r["n_tokens"])


def test_secrets(spark, sf_small, docs):
    texts = dict(docs)
    for r in run(spark, sf_small, "op5_secrets"):
        base = secrets.brute(texts[r["doc_id"]])
        line = [":".join(map(str, s)) for s in base]
        kinds = Counter(s[0] for s in base)
        assert (r["n_assign"], r["n_access"], r["n_hex"]) == (kinds["assign"], kinds["access"], kinds["hex"])
        assert r["base_sha256"] == sha(",".join(line))
        spans = r["spans"].split(",") if r["spans"] else []
        assert [s for s in spans if not s.startswith("random:")] == line
        assert [int(s.split(":")[1]) for s in spans] == sorted(int(s.split(":")[1]) for s in spans)


def test_bpe(spark, sf_small, docs):
    tokenizers = pytest.importorskip("tokenizers")
    library = tokenizers.Tokenizer.from_file(public_tokenizer())
    texts = dict(docs)
    for r in run(spark, sf_small, "op6_bpe"):
        ids = library.encode(texts[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids) and r["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert r["decoded_sha256"] == sha(library.decode(ids, skip_special_tokens=False))


def test_ngram_join(spark, sf_small, docs):
    got = Counter((r["doc_id"], r["class_id"], r["n_links"], r["n_copies"]) for r in run(spark, sf_small, "op7_ngram_join"))
    assert got == Counter(ngram_join.brute(docs))


def test_language_id(spark, sf_small, docs):
    got = run(spark, sf_small, "op9_language_id")
    assert len(got) == len(docs)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert {r["lang_pred"] for r in got} <= {"de", "en", "es", "fr", "und"}
