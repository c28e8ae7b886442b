import random

import pytest
from pyspark.sql import functions as F

from planmart.llm import bpe as B
from planmart.llm.queries import public_tokenizer

from .helpers import corpus, docs_df


@pytest.fixture(scope="module")
def library():
    tokenizers = pytest.importorskip("tokenizers")
    t = tokenizers.Tokenizer.from_file(public_tokenizer())
    t.no_truncation(), t.no_padding()
    return t


def check(library, texts, encoder):
    ids = encoder.encode(texts)
    for text, got in zip(texts, ids, strict=True):
        want = library.encode(text, add_special_tokens=False).ids
        assert got == want, repr(text[:200])
        assert encoder.decode(got) == library.decode(want, skip_special_tokens=False)


def test_odd_texts(library):
    texts = ["", " ", "Hello, World's end I'LL we've 'S", "a<|endoftext|>B <|startoftext|><|endoftext|>", "<|endoftext", "ΣΑΣ Σ ς",
             "İstanbul ǅ ﬁ Å Å é é", "123 4५६ Ⅷ ½", "x\x1cy\x85z w v​u﻿", "🙂👍🏽 é́ ́a", "日本語テキスト ไทย العربية",
             "\x00\x01 a\x00b", "'s't're'", "a" * 5000, "ab" * 40, "!?" * 300, "thequickbrownfoxjumpsoverthelazydogagain" * 20, "_a_ b-c"]
    check(library, texts, B.Encoder(B.read_tokenizer(public_tokenizer())))


def test_random_unicode(library):
    rng = random.Random(3)
    pools = [range(32, 127), range(0, 0x250), range(0x300, 0x600), range(0x1E00, 0x2100), range(0x2F00, 0x3200), range(0x1F300, 0x1F700),
             range(9, 14), range(0xAC00, 0xAC80)]
    texts = ["".join(chr(rng.choice(rng.choice(pools))) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    check(library, texts, B.Encoder(B.read_tokenizer(public_tokenizer())))


def test_characters_of_any_unicode_version(library):
    codes = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"a{chr(c)}{chr(c)}9 " for c in codes[k:k + 512]) for k in range(0, len(codes), 512)]
    check(library, texts, B.Encoder(B.read_tokenizer(public_tokenizer())))


def test_cache_is_bounded(library, monkeypatch):
    monkeypatch.setattr(B, "CACHE_WORDS", 50)
    encoder = B.Encoder(B.read_tokenizer(public_tokenizer()))
    for k in range(5):
        check(library, [t or "" for _, t in corpus(seed=k, n=30)], encoder)


def test_table(spark, library):
    rows = corpus()
    got = B.encode_decode(docs_df(spark, rows), public_tokenizer()).select("row.doc_id", "row.text", "ids", "decoded").collect()
    assert len(got) == len(rows)
    for r in got:
        want = library.encode(r.text or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)
    assert B.encode_decode(docs_df(spark, []), public_tokenizer()).where(F.size("ids") > 0).count() == 0
