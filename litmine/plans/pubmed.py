"""Article XML to articles, triples and edges."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from litmine.functions.text import escape_query_syntax
from litmine.operators.annotate import annotate_terms
from litmine.operators.articles import articles_from_parsed, malformed_records, parse_records
from litmine.operators.edges import edges_from_triples
from litmine.operators.stats import load_stats, stats_triples
from litmine.operators.triples import GROUPS, article_triples
from litmine.session import fresh_path, written
from litmine.sources.sinks import write_edges, write_triples
from litmine.sources.articles_xml import read_article_records


@dataclass(frozen=True)
class ArticleTables:
    articles: DataFrame
    rejects: DataFrame
    triples: DataFrame
    edges: DataFrame
    stats: DataFrame


def term_edges(articles: DataFrame, vocab: DataFrame | None, **options) -> DataFrame | None:
    """``(iri, source_file, blank_seed, term_iri)`` found in the articles' text; None without a vocabulary."""
    if vocab is None:
        return None
    keys = ["iri", "source_file", "blank_seed"]
    texts = articles.select(*keys, escape_query_syntax(F.col("as_string")).alias("text"))
    found = annotate_terms(texts, vocab, keys=keys, **options)
    return found.select(*keys, "term_iri")


def triples_of(articles: DataFrame, vocab: DataFrame | None = None, **options) -> DataFrame:
    """All statements of the articles: metadata, MeSH and annotation references.

    The terms found join the article's own row (records with the same content share them), and its set of
    statements is built there; versions of one article stay apart.
    """
    found = term_edges(articles, vocab, **options)
    if found is None:
        return article_triples(articles)
    keys = ["iri", "source_file", "blank_seed"]
    terms = found.groupBy(*keys).agg(F.collect_set("term_iri").alias("terms"))
    with_terms = articles.join(terms, keys, "left").withColumn("terms", F.coalesce("terms", F.array().cast("array<string>")))
    return article_triples(with_terms, (*GROUPS, "terms"))


def load_articles(
    spark: SparkSession, path: str | list[str], vocab: DataFrame | None = None, glob: str | None = None,
    work_path: str | None = None,
) -> ArticleTables:
    """Read, parse once into a table, and derive everything from that table."""
    target = work_path or fresh_path(spark, "articles")
    parsed = written(parse_records(read_article_records(spark, path, glob)), "parsed")
    articles_from_parsed(parsed).write.parquet(target)
    articles = spark.read.parquet(target)
    triples = written(triples_of(articles, vocab if vocab is None else written(vocab, "vocabulary")), "triples")
    return ArticleTables(articles, malformed_records(parsed), triples, edges_from_triples(triples), load_stats(articles, triples))


def publish_articles(tables: ArticleTables, path: str) -> None:
    """Write statements, file statistics and edges per source file under ``path``; a second run replaces the same folders."""
    write_triples(tables.triples, f"{path}/triples")
    write_triples(stats_triples(tables.stats), f"{path}/stats")
    write_edges(edges_from_triples(tables.triples, by_file=True), f"{path}/edges")
