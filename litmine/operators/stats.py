"""Per-file load statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from litmine.functions import terms as T
from litmine.operators.triples import TRIPLE_COLUMNS, literal


def load_stats(articles: DataFrame, triples: DataFrame) -> DataFrame:
    """``(source_file, n_articles, n_triples)``; triples are counted per article, not made distinct."""
    counts = articles.groupBy("source_file").agg(F.count("*").alias("n_articles"))
    statements = triples.groupBy("source_file").agg(F.count("*").alias("n_triples"))
    return counts.join(statements, "source_file", "left").na.fill(0, ["n_triples"])


def stats_triples(stats: DataFrame, seconds: Column | None = None) -> DataFrame:
    """The statistics as statements about each file; ``seconds`` adds the processing time."""
    subject = F.col("source_file")
    facts = [
        literal(subject, T.ARTICLE_COUNT, F.col("n_articles").cast("string"), T.XSD_INTEGER),
        literal(subject, T.TRIPLE_COUNT, F.col("n_triples").cast("string"), T.XSD_INTEGER),
    ]
    if seconds is not None:
        facts.append(literal(subject, T.TIME_TAKEN, F.concat(F.lit("PT"), seconds.cast("string"), F.lit("S")), T.XSD_DURATION))
    return stats.select(F.inline(F.array(*facts)), "source_file").select(*TRIPLE_COLUMNS, "source_file")
