"""A corpus cleaned in stages, each written as Parquet and read again by the next.

A stage takes what its predecessor kept.  All but the last return the columns of
``documents``; documents that stay keep their id, language and source, and the stage
that shortens texts also counts their characters anew.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import bpe, decontaminate, language, lsh_forest, suffix_dedup
from orderflow.llm.common import long_rows, saved, table

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
TOKENIZER = "byte_bpe_50k.json"
# A text whose language is less likely than this is rejected; a long one also if it has
# less than this share of the words that texts of the language let expect.
LEAST_SCORE = 0.5


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without a letter, or whose language is in doubt, go; so do null and empty ones.

    The model learns from the documents that have a language.
    """
    long_rows(spark)
    docs = docs.select(*COLUMNS)
    found = language.identify(docs, language.fit(docs))
    known = (F.col("lang_pred") != language.UNKNOWN) & (F.col("score") >= LEAST_SCORE)
    return found.where(known).select(*COLUMNS)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of near copies stays."""
    long_rows(spark)
    return lsh_forest.keep_first(docs.select(*COLUMNS))


def remove_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Strings of 100 bytes that occur earlier are cut out, in whole characters.

    A document of which nothing is left goes.
    """
    long_rows(spark)
    cut = suffix_dedup.remove_repeats(docs.select(*COLUMNS), whole_characters=True)
    text = F.when(F.size("removed") > 0, F.col("kept").cast("string")).otherwise(F.col("text"))
    cut = cut.withColumn("text", text).where((F.size("removed") == 0) | (F.length("text") > 0))
    chars = F.when(F.size("removed") > 0, F.length("text")).otherwise(F.col("n_chars"))
    return cut.withColumn("n_chars", chars.cast("bigint")).select(*COLUMNS)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    long_rows(spark)
    return decontaminate.decontaminate(docs.select(*COLUMNS), table(spark, sf_dir, "benchmark"))


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's tokens, and a digest of the text that they decode to."""
    long_rows(spark)
    path = public_tokenizers.path(TOKENIZER)
    # Saved between, as a task would else need a Python worker for each of the two.
    encoded = saved(bpe.encode(docs, path), "encoded")
    decoded = bpe.decode(encoded, path)
    return decoded.select(
        "doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256")
    )


STAGES = [
    ("language", identify_language),
    ("near_dedup", near_dedup),
    ("suffix_dedup", remove_repeats),
    ("decontaminate", drop_contaminated),
    ("bpe", tokenize),
]

# Models and iterations are beyond SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name)
    return docs
