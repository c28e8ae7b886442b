"""A corpus-cleaning pipeline over ``documents``: each stage is written as Parquet and reread as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from planmart.llm import common as C
from planmart.llm.bpe import encode_decode
from planmart.llm.decontaminate import drop_contaminated
from planmart.llm.language_id import identify, train
from planmart.llm.line_dedup import LONG_WORDS, line_dedup
from planmart.llm.ngram_join import keep_one
from planmart.llm.queries import public_tokenizer


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a letter, or in no language that the model is sure of, go."""
    return identify(docs, train(docs)).where(~F.col("rejected")).select("row.*")


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Delete runs of lines, and long single lines, that occur earlier in the corpus; documents of which nothing is left go."""
    columns = docs.columns
    deduped = line_dedup(docs, long_words=LONG_WORDS)
    left = deduped.where((F.col("n_removed") == 0) | (F.length("text") > 0))
    return left.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text").cast("long"))
                           .otherwise(F.col("n_chars"))).select(*columns)


def drop_benchmark_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item go."""
    return drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group joined by links of 0.8 or more the document with the smallest id stays."""
    return keep_one(docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that are left, as token ids; ``decoded`` is what the ids decode to."""
    return encode_decode(docs, public_tokenizer()).select(
        "row.*", F.size("ids").cast("long").alias("n_tokens"), "ids", "decoded")


STAGES = [
    ("language_id", keep_known_languages),
    ("line_dedup", drop_repeated_lines),
    ("ngram_join", keep_one_of_near_copies),
    ("decontamination", drop_benchmark_copies),
    ("bpe", encode),
]

ORACLE_SQL = None  # models and tokenizers can't be put in SQL: tested against a brute-force version


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = C.documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = C.materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
