import math
import zlib

import pytest

from planmart.llm import language_id as L

from .helpers import docs_df


def test_held_out_accuracy(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    got = L.identify(docs, L.train(docs)).select("row.*", "lang_pred", "score", "rejected").collect()
    held = [r for r in got if zlib.crc32(str(r.doc_id).encode()) % 4 == 2]
    assert len(held) > 20
    assert sum(r.lang_pred == r.lang for r in held) / len(held) >= 0.97
    assert all(0 <= r.score <= 1 for r in got)
    assert sum(r.rejected for r in got if any(map(str.isalpha, r.text))) <= 0.01 * len(got)


def test_learns_only_from_allowed_rows(spark):
    rows = []
    for i in range(400):
        allowed = zlib.crc32(str(i).encode()) % 4 != 2
        rows.append((i, "alpha beta gamma " * 3 if i % 2 else "ütz örk äpf " * 3, ("aa" if i % 2 else "bb") if allowed else "zz"))
    rows += [(900, "", "aa"), (901, None, "aa"), (902, "123 !!", "aa"), (903, "alpha beta", None), (None, "alpha gamma", "qq")]
    docs = docs_df(spark, rows)
    model = L.train(docs)
    assert model.labels == ["aa", "bb"]
    got = {r.doc_id: r for r in L.identify(docs, model).select("row.doc_id", "lang_pred", "score", "rejected").collect()}
    assert [(got[i].lang_pred, got[i].score, got[i].rejected) for i in (900, 901, 902)] == [("und", 0.0, True)] * 3
    assert got[903].lang_pred == got[None].lang_pred == "aa" and got[1].lang_pred == "aa" and got[2].lang_pred == "bb"
    same = L.train(docs.repartition(3))
    assert (same.table == model.table).all()


def test_without_labels_or_rows(spark):
    docs = docs_df(spark, [(1, "abc", None), (1, "abc", None)])
    assert L.train(docs) is None
    assert [r.lang_pred for r in L.identify(docs, None).collect()] == ["und", "und"]
    assert L.identify(docs_df(spark, []), None).count() == 0


def test_subwords_do_not_depend_on_pieces(monkeypatch):
    letters = L.letter_table()
    text = "Straße, Über 123 𝒜bc naïve!  " * 50
    whole = L.bucket_counts(text, letters)
    monkeypatch.setattr(L, "_PIECE", 64)
    assert (L.bucket_counts(text, letters) == whole).all()
    words = "ab c"  # boundary bigrams and trigrams by hand: _a ab b_ _c c_ | _ab ab_ _c_ | _ab_
    assert L.bucket_counts(words, letters).sum() == 9


def plain_prediction(text, model):
    """The same prediction by loops over n-grams cut from strings."""
    counts = [0.0] * len(model.labels)
    words = "".join(c if c.isalpha() else " " for c in (text or "").lower()).split(" ")
    grams = [w[i:i + n] for w in (f"\0{x}\0" for x in words if x) for n in (2, 3, 4) for i in range(len(w) - n + 1)]
    if not grams:
        return "und", 0.0
    for gram in grams:
        h = len(gram)
        for c in gram:
            h = (h * 0x100000001B3 % (1 << 64)) ^ (0 if c == "\0" else ord(c))
        bucket = (h * 0x9E3779B97F4A7C15 % (1 << 64) >> 40) % len(model.table)
        for k in range(len(counts)):
            counts[k] += float(model.table[bucket][k])
    z = [(c / len(grams) + float(b)) / model.temperature for c, b in zip(counts, model.bias, strict=True)]
    e = [math.exp(x - max(z)) for x in z]
    best = max(range(len(e)), key=lambda k: e[k])
    return model.labels[best], e[best] / sum(e)


def test_prediction_against_brute_force(spark, sf_small):
    docs = spark.read.parquet(f"{sf_small}/documents.parquet")
    model = L.train(docs)
    extra = docs_df(spark, [(1, "İstanbul Straße 𝒜bc"), (2, None), (3, "12 ?"), (4, "a"), (5, "ʼn ß-ß" * 40)]).select(*docs.columns)
    got = L.identify(docs.unionByName(extra), model).select("row.text", "lang_pred", "score", "rejected").collect()
    assert len(got) == docs.count() + 5
    for r in got:
        lang, score = plain_prediction(r.text, model)
        assert r.lang_pred == lang and r.score == pytest.approx(score, abs=1e-5)
        assert r.rejected == (lang == "und" or score < model.threshold) or abs(score - model.threshold) < 1e-5


def test_every_label_is_learned_and_too_many_are_an_error(spark):
    rows = [(i, f"{chr(97 + i % 26) * 5} {chr(98 + i // 26 % 20) * 4}", f"l{i % 300}") for i in range(3000)]
    rows += [(90_000, "same text", "twice")] * 500  # a row that repeats altogether
    docs = docs_df(spark, rows)
    model = L.train(docs, epochs=1, least_steps=1)
    assert set(model.labels) >= {f"l{k}" for k in range(300)}
    with pytest.raises(ValueError, match="max_labels"):
        L.train(docs, max_labels=299)
