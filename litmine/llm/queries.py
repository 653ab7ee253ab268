"""The operators as queries over the given tables, with SQL where it can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmine.llm import sql
from litmine.llm.conversation_trie import conversation_trie
from litmine.llm.host_reputation import judge_urls
from litmine.llm.line_dedup import line_dedup
from litmine.llm.line_quality import line_quality
from litmine.llm.merkle_manifest import audited, merkle_manifest
from litmine.llm.minmax_dedup import minmax_components
from litmine.llm.source_mix import mix_sources
from litmine.llm.jaccard_join import jaccard_components
from litmine.llm.substring_dedup import substring_dedup
from litmine.llm.surrogates import with_surrogates
from litmine.llm.tables import documents
from litmine.session import fresh_path
from litmine.llm.template_decontamination import template_matches
from litmine.llm.token_shards import read_shards, write_shards
from litmine.llm.toxicity import fit_toxicity, score_toxicity


URL_RULES = [
    ("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"),
]


def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup(documents(spark, sf_dir), tau=2, min_chars=40)
    return found.withColumn("kept_sha256", F.sha2("kept", 256)).drop("kept")


def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A page's number in its url is the document it shows; a document is bad if it is toxic or of low quality."""
    pages, labels = (spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in ("pages", "labels"))
    shown = pages.select("url", F.regexp_extract("url", "://[^/?#]*/[a-z]+/([0-9]+)", 1).try_cast("long").alias("doc_id"))
    bad = ((F.col("quality") == 0) | (F.col("toxic") == 1)).cast("int")
    outcomes = shown.join(labels.select("doc_id", bad.alias("bad")), "doc_id").select("url", "bad")
    return judge_urls(pages, outcomes, URL_RULES).select("page_id", "host", "path", "rule", "verdict")


def op3_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), weights=(3, 1, 2), share=1.5, most=2)


def op4_token_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The index of the shards written to the shared folder, each record compared with what was read back."""
    path = fresh_path(spark, "shards")
    index = write_shards(documents(spark, sf_dir), path, length=1024, per_shard=4096, key=2024)
    back = read_shards(spark, path, length=1024).select("slot", F.col("crc").alias("_crc"))
    return index.join(back, "slot", "left").withColumn("read_back", F.coalesce(F.col("crc") == F.col("_crc"), F.lit(False))).drop("_crc")


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0, F.lit(False))


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = fit_toxicity(docs, labels.where(~held_out()))
    scored = score_toxicity(docs.select("doc_id", "text"), model)
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"), "evidence")


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_surrogates(documents(spark, sf_dir).select("doc_id", "text"), key=b"corpus key")


def op7_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each document and benchmark item in it."""
    found = template_matches(documents(spark, sf_dir).select("doc_id", "text"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select("doc_id", F.explode("matches").alias("m")).select("doc_id", "m.*")


def op8_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup(documents(spark, sf_dir), window=20)
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_quality(documents(spark, sf_dir)).drop("cleaned")


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_components(documents(spark, sf_dir), gram=4, percent=85)


def op11_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audited(merkle_manifest(documents(spark, sf_dir)))


def op12_minmax_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minmax_components(documents(spark, sf_dir), gram=2, percent=80)


def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


QUERIES = {
    "op1_line_dedup": (op1_line_dedup, None),
    "op2_url_filters": (op2_url_filters, sql.HOSTS),
    "op3_source_mix": (op3_source_mix, sql.MIX),
    "op4_token_shards": (op4_token_shards, None),
    "op5_toxicity": (op5_toxicity, None),
    "op6_surrogates": (op6_surrogates, None),
    "op7_benchmark_decontamination": (op7_benchmark_decontamination, None),
    "op8_substring_dedup": (op8_substring_dedup, sql.SUBSTRING),
    "op9_quality_rules": (op9_quality_rules, sql.QUALITY),
    "op10_ngram_jaccard_join": (op10_ngram_jaccard_join, sql.JACCARD),
    "op11_merkle_manifest": (op11_merkle_manifest, sql.MERKLE),
    "op12_minmax_dedup": (op12_minmax_dedup, sql.NEAR),
    "op13_conversation_trie": (op13_conversation_trie, sql.TRIE),
}
