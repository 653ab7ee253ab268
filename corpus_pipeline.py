"""From raw documents to shards of token ids: the training-data operators as stages.

Each stage takes all that its predecessor kept. Toxic documents go; of similar documents the first stays; documents with
a benchmark passage go; sources are mixed to target weights, which repeats and at the targets' ends cuts documents; what
results is tokenised and written in training order to the shared folder. The result is the index of the shards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmine.llm.jaccard_join import one_of_each
from litmine.llm.queries import QUERIES as OPERATORS
from litmine.llm.queries import held_out
from litmine.llm.source_mix import mixed_documents
from litmine.llm.tables import documents
from litmine.llm.template_decontamination import decontaminated
from litmine.llm.token_shards import write_shards
from litmine.llm.toxicity import fit_toxicity, score_toxicity
from litmine.session import fresh_path, written


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    columns = docs.columns
    scored = score_toxicity(docs, fit_toxicity(docs, labels.where(~held_out())))
    return scored.where(F.col("score") < 0.5).select(*columns)


def ngram_jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return one_of_each(docs, gram=5, percent=80)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixed_documents(docs, weights=(3, 1, 2), share=1.5, most=2)


def token_shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return write_shards(docs, fresh_path(spark, "shards"), length=1024, per_shard=4096, key=2024)


STAGES = [
    ("toxicity", toxicity),
    ("ngram_jaccard_join", ngram_jaccard_join),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mix", source_mix),
    ("token_shards", token_shards),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)


QUERIES = OPERATORS | {"pipeline": (run, ORACLE_SQL)}
