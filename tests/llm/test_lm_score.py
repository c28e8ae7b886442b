import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from planmart.llm import lm_score as M

from .helpers import corpus, docs_df


def tokens(t):
    return [w for w in re.split(r"[ \t-\r]+", (t or "").lower()) if w]


def hashes_of(text):
    found = [h for _, _, h, _ in M.batch_tokens(pa.array([text]))]
    return np.concatenate(found) if found else np.zeros(0, np.uint64)


def brute(p, ids):
    """Pseudo-log-likelihood token by token."""
    total = 0.0
    for i, t in enumerate(ids):
        h = p["hid"].astype(float).copy()
        for k, o in enumerate(M.OFFSETS):
            h += p["emb"][k][ids[i + o] if 0 <= i + o < len(ids) else M.VOCABULARY]
        h = np.tanh(h)
        c = t // M.PER_CLASS
        for z, pick in ((h @ p["cls"] + p["cls_b"], c), (h @ p["tok"][c] + p["tok_b"][c], t % M.PER_CLASS)):
            total += z[pick] - np.log(np.exp(z).sum())
    return total


def test_scores_against_brute_force(spark):
    rows = corpus()
    docs = docs_df(spark, rows)
    words = M.vocabulary(docs)
    counts = Counter(w for _, t in rows for w in tokens(t))
    assert len(words) == min(M.WORDS, len(counts))
    best = max(counts.values())
    assert words[0] in {hashes_of(w)[0] for w, n in counts.items() if n == best}
    params = M.train(docs, words)
    got = M.score(docs, words, params).select("row.doc_id", "row.text", "n_tokens", "log_likelihood", "mean_log_likelihood").collect()
    assert len(got) == len(rows)
    for r in got:
        own = tokens(r.text)
        assert r.n_tokens == len(own)
        assert (r.mean_log_likelihood is None) == (not own)
        if len(own) <= 500:
            ids = [int(M.ids_of(hashes_of(w), words)[0]) for w in own]
            assert abs(r.log_likelihood - brute(params, ids)) < 1e-3 * max(1, len(own))


def test_probabilities_sum_to_one():
    p = M.initial()
    around = np.tile(np.array([[1], [2], [3], [4]], np.int32), M.VOCABULARY)
    total = np.exp(M.log_probabilities(p, np.arange(M.VOCABULARY, dtype=np.int32), around)).sum()
    assert abs(total - 1) < 1e-3


def test_gradient_by_differences():
    rng = np.random.default_rng(0)
    p = {k: v.astype(np.float64) + rng.normal(0, 0.1, v.shape) for k, v in M.initial(1).items()}
    t = np.array([5, 40, 900, 5, 77, 41, 5], np.int32)
    around = M.contexts(t, np.array([0, 0, 0, 0, 2, 2, 2]))
    assert around[:, 3].tolist() == [40, 900, M.VOCABULARY, M.VOCABULARY]
    loss = lambda q: -M.log_probabilities(q, t, around).sum()
    grad = M.gradients(p, t, around)
    for k in p:
        way = rng.normal(0, 1, p[k].shape)
        up, down = ({j: v + s * 1e-5 * way if j == k else v for j, v in p.items()} for s in (1, -1))
        want = (loss(up) - loss(down)) / 2e-5
        assert abs((grad[k] * way).sum() - want) <= 1e-4 * max(1, abs(want)), k


def test_training_helps(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    words = M.vocabulary(docs)
    mean = lambda p: M.score(docs, words, p).selectExpr("sum(log_likelihood) / sum(n_tokens)").first()[0]
    assert mean(M.train(docs, words)) > mean(M.initial()) + 0.7


def test_empty_table(spark):
    assert M.lm_score(docs_df(spark, [])).count() == 0


@pytest.mark.parametrize("head", [0, 40, 1 << 17])
def test_rare_words_are_scored_themselves(spark, monkeypatch, head):
    monkeypatch.setattr(M, "HEAD", head)
    rng = random.Random(4)
    rows = [(i, " ".join(f"w{int(rng.paretovariate(0.4)) % 5000}" for _ in range(200))) for i in range(60)]
    rows += [(100, "w4999x " * 30), (101, " ".join(f"zq{k}" for k in range(30))), (102, "w4999x"), (103, "zq1 zq1 zq2"), (104, None)]
    docs = docs_df(spark, rows)
    words = M.vocabulary(docs)
    params = M.train(docs, words)
    counts = Counter(w for _, t in rows for w in tokens(t))
    known = set(words.tolist())
    place = {w: int(M.ids_of(hashes_of(w), words)[0]) for w in [*counts, "unseen"]}
    rare = {w: n for w, n in counts.items() if int(hashes_of(w)[0]) not in known}
    assert len(rare) > 200
    total = Counter()
    for w, n in rare.items():
        total[place[w]] += n + 1
    share = lambda w: np.log((rare.get(w, 0) + 0.5) / (total[place[w]] + 0.5)) if place[w] >= M.WORDS else 0
    want = lambda t: brute(params, [place[w] for w in tokens(t)]) + sum(map(share, tokens(t)))
    got = {r.row.doc_id: r for r in M.score(docs, words, params).collect()}
    assert len(got) == len(rows)
    for i, t in rows:
        assert got[i].n_tokens == len(tokens(t))
        assert abs(got[i].log_likelihood - want(t)) < 1e-3 * max(1, len(tokens(t)))
    other = M.score(docs_df(spark, [(1, "unseen w4999x")]), words, params, counts=M.word_counts(docs)).first()
    assert abs(other.log_likelihood - want("unseen w4999x")) < 1e-2


def test_few_tokens_make_steps_too():
    for n, seen in ((0, 0), (3000, 0), (200_000, 0), (9000, 10_000_000)):
        parts = list(M.steps(n, seen))
        assert [i for p in parts for i in range(p.start, p.stop)] == list(range(n))
        assert all(p.stop - p.start <= M.STEP for p in parts)
    assert len(list(M.steps(3000, 0))) >= 10


@pytest.mark.parametrize("parts", [1, 32])
def test_training_helps_by_one(spark, sf_small, parts):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet").repartition(parts, "doc_id").cache()
    words = M.vocabulary(docs)
    mean = lambda p: M.score(docs, words, p).selectExpr("sum(log_likelihood) / sum(n_tokens)").first()[0]
    assert mean(M.train(docs, words)) > mean(M.initial()) + 1.0
