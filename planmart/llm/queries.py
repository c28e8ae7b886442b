"""The registered queries ``opN_<name>``: each applies its operator to whole tables and derives the digest columns."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import common as C

SHARDS = 8


def sha256(text):
    return F.sha2(F.encode(text, "UTF-8"), 256)


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .sharding import shard
    rows, _ = shard(C.documents(spark, sf_dir), SHARDS)
    return rows.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"), "virtual_slot")


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lm_score import lm_score
    return lm_score(C.documents(spark, sf_dir).select("doc_id", "text")).select(
        "row.doc_id", "n_tokens", "log_likelihood", "mean_log_likelihood")


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .decontaminate import find_contamination
    found = find_contamination(C.documents(spark, sf_dir).select("doc_id", "text"),
                               spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", F.size("hit_words").cast("long").alias("n_hit"),
        F.size("items").cast("long").alias("n_items"), sha256(F.array_join("items", ",")).alias("items_sha256"),
        (F.size("hit_words") > 0).alias("contaminated"))


def op4_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .exact_dedup import exact_dedup
    return exact_dedup(C.documents(spark, sf_dir), keep="largest")


def _spans(spans):
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .secrets_scan import find_secrets
    found = find_secrets(C.documents(spark, sf_dir))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    return found.select("doc_id", count("assign"), count("access"), count("hex"),
                        sha256(_spans("base")).alias("base_sha256"), _spans("spans").alias("spans"))


def op6_bpe(spark: SparkSession, sf_dir: str, tokenizer_path: str | None = None) -> DataFrame:
    from .bpe import encode_decode
    coded = encode_decode(C.documents(spark, sf_dir).select("doc_id", "text"), tokenizer_path or public_tokenizer())
    return bpe_digests(coded)


def public_tokenizer() -> str:
    import public_tokenizers
    return public_tokenizers.path("word_bpe_49k.json")


def bpe_digests(coded: DataFrame) -> DataFrame:
    return coded.select(
        "row.doc_id", F.size("ids").cast("long").alias("n_tokens"),
        sha256(F.array_join(F.col("ids").cast("array<string>"), " ")).alias("ids_sha256"),
        sha256("decoded").alias("decoded_sha256"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .line_dedup import LONG_WORDS, line_dedup
    return line_dedup(C.documents(spark, sf_dir).select("doc_id", "text"), long_words=LONG_WORDS).select(
        "doc_id", "n_lines", "n_removed", sha256("text").alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .language_id import identify, learnable, train
    docs = C.documents(spark, sf_dir)
    found = identify(docs.select("doc_id", "text"), train(docs))
    return found.select("row.doc_id", F.coalesce(~learnable("row.doc_id"), F.lit(False)).alias("held_out"), "lang_pred",
                        "score", "rejected")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .ngram_join import ngram_join
    return ngram_join(C.documents(spark, sf_dir)).select("doc_id", "class_id", "n_links", "n_copies")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .substring_dedup import remove_repeats
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + (s["end"] - s["start"]))
    return remove_repeats(C.documents(spark, sf_dir)).select(
        "doc_id", "n_words", removed.alias("n_removed"), sha256("kept_text").alias("kept_sha256"))


def op11_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .lexical_search import search
    return search(C.documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .whitening import whiten
    return whiten(spark.read.parquet(f"{sf_dir}/embeddings.parquet").select("vec_id", "embedding")).select(
        "row.vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error")


def op13_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    from .url_filter import filter_urls, page_outcomes
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url")
    outcomes = page_outcomes(pages, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return filter_urls(pages, outcomes).select("row.page_id", "host", "path", "rule", "verdict", "n_labelled", "n_bad")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (
        op1_sharding, op2_lm_score, op3_decontamination, op4_exact_dedup, op5_secrets, op6_bpe, op7_ngram_join,
        op8_line_dedup, op9_language_id, op10_substring_dedup,
        op11_lexical_search, op12_whitening, op13_url_filter)
}
