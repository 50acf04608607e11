"""The registered queries: each operator over its whole table, with production settings."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orderflow.llm import (
    bpe,
    conversation_repair,
    decontaminate,
    embedding_dedup,
    language,
    lsh_forest,
    quality,
    revisits,
    shards,
    spelling,
    sql,
    suffix_dedup,
    token_files,
    url_filter,
)
from orderflow.llm.common import in_fold, table

Query = Callable[[SparkSession, str], DataFrame]

TOKENIZER = "byte_bpe_50k.json"
# (verdict, host, path): the longest rule that fits a url decides.
URL_RULES = [
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
]
# Hosts with one of these words as a label, or a part of one between hyphens, are listed.
LISTED_HOST = r"(^|[.-])(adult|bets|casino|porn|spam)([.-]|$)"


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path(TOKENIZER)
    decoded = bpe.decode(bpe.encode(table(spark, sf_dir, "documents"), path), path)
    return decoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_contained(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )
    return found.drop("hash")


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = shards.assign_shards(table(spark, sf_dir, "documents"))
    return placed.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    held_out = in_fold(F.col("doc_id"), 5, 0)
    scored = quality.score_documents(table(spark, sf_dir, "documents"), labels, held_out)
    return scored.withColumn("predicted", (F.col("score") >= 0.3).cast("int"))


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    length = F.aggregate("removed", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["begin"])
    return suffix_dedup.remove_repeats(docs).select(
        "doc_id",
        "n_bytes",
        length.alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_vectors(table(spark, sf_dir, "embeddings"))


def captures(pages: DataFrame) -> DataFrame:
    """Archive records derived from pages: each is a capture of its site's section.

    A third are full responses.  Sections change every 64 pages; most revisits name
    the entity tag of their time, some the modification time, some nothing.
    """
    page, version = F.col("page_id"), F.floor(F.col("page_id") / 64).cast("string")
    full = (page % 10).isin(0, 4, 7)
    tag = F.concat(F.lit('"v'), version, F.lit('"'))
    pair = lambda name, value: F.struct(
        F.lit(name).alias("key"), value.cast("string").alias("value")
    )
    response = F.array(
        pair("ETag", F.concat(F.lit("W/"), tag)),
        pair("Last-Modified", version),
        pair("Content-Length", F.octet_length("html")),
        pair("Cache-Control", F.lit("max-age=60")),
    )
    revisit = F.array(
        F.when(page % 7 == 0, F.lit(None))
        .when(page % 5 == 0, pair("Last-Modified", version))
        .otherwise(pair("etag", tag)),
        pair("Content-Length", F.lit("0")),
        pair("cache-control", F.concat(F.lit("max-age="), page)),
    )
    headers = F.filter(F.when(full, response).otherwise(revisit), lambda p: p.isNotNull())
    return pages.select(
        page.alias("record_id"),
        F.regexp_replace("url", r"(://[^/]*/[a-z]+)/[^?#]*", "$1").alias("url"),
        page.alias("time"),
        F.when(full, "response").otherwise("revisit").alias("type"),
        F.map_from_entries(headers).alias("headers"),
        F.when(full, F.md5(F.col("html").cast("binary"))).alias("digest"),
    )


def op7_revisits(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = revisits.resolve_revisits(captures(table(spark, sf_dir, "pages")))
    fields = F.transform("headers", lambda h: F.concat(h["name"], F.lit("="), h["value"]))
    return found.withColumn("headers", F.array_join(fields, ";"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lsh_forest.near_duplicates(table(spark, sf_dir, "documents"), size=4).drop("hash")


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = in_fold(F.col("doc_id"), 4, 2)
    model = language.fit(docs.where(~held_out))
    found = language.identify(docs.select("doc_id", "text"), model)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages")
    return url_filter.judge_pages(pages, URL_RULES, F.col("key").rlike(LISTED_HOST))


def damaged(conversations: DataFrame) -> DataFrame:
    """Rows dropped, emptied, cut off, repeated or given a wrong role by a hash of their place."""
    text = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in conversations.columns}
    fault = F.crc32(F.concat(text["conv_id"], F.lit(":"), text["turn"])) % 20
    copies = F.when(fault == 0, 0).when(fault == 3, 2).otherwise(1)
    return conversations.select(
        "conv_id",
        "turn",
        F.when(fault == 4, "user").otherwise(text["role"]).alias("role"),
        F.when(fault == 1, "")
        .when(fault == 2, F.translate(text["text"], ".!?", ""))
        .otherwise(text["text"])
        .alias("text"),
        F.explode(F.array_repeat(F.lit(True), copies)).alias("copy"),
    ).drop("copy")


def op11_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    conversations = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    faults, repaired = conversation_repair.repair(damaged(conversations))
    digests = conversation_repair.digests(repaired)
    every = conversations.select(F.col("conv_id").alias("id")).distinct()
    found = every.join(faults, F.col("id").eqNullSafe(faults["conv_id"]), "left").drop("conv_id")
    found = found.join(digests, F.col("id").eqNullSafe(digests["conv_id"]), "left")
    counts = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]
    return found.select(
        F.col("id").alias("conv_id"),
        # A conversation without a row has no fault; a span beyond 64 bits stays null.
        *[F.when(F.col("audit").isNull(), 0).otherwise(F.col(n)).cast("bigint").alias(n) for n in counts],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"),
    )


def op12_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    path = token_files.write_tokens(documents, public_tokenizers.path(TOKENIZER))
    rows = token_files.read_tokens(spark, path)
    return rows.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return spelling.group_variants(spelling.count_words(documents, spelling.drop_letters))


QUERIES: dict[str, Query] = {
    "op1_bpe": op1_bpe,
    "op2_decontaminate": op2_decontaminate,
    "op3_shards": op3_shards,
    "op4_quality": op4_quality,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_embedding_dedup": op6_embedding_dedup,
    "op7_revisits": op7_revisits,
    "op8_near_dedup": op8_near_dedup,
    "op9_language": op9_language,
    "op10_url_filter": op10_url_filter,
    "op11_repair": op11_repair,
    "op12_token_files": op12_token_files,
    "op13_spelling": op13_spelling,
}

SQL: dict[str, str] = {
    "op2_decontaminate": sql.OP2,
    "op6_embedding_dedup": sql.OP6,
    "op7_revisits": sql.OP7,
    "op8_near_dedup": sql.OP8,
    "op10_url_filter": sql.OP10,
    "op11_repair": sql.OP11,
    "op13_spelling": sql.OP13,
}
