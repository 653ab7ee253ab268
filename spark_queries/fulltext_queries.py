"""Metadata rows and full text."""

from __future__ import annotations

from pyspark.sql import functions as F

from litmine.functions import article_id, last_of_list, preferred_file, row_id
from litmine.operators.kwic import attach_fulltext, describe_rows
from litmine.operators.ranges import fixed_chunks
from litmine.operators.rows import row_slice, with_row_index
from litmine.session import fresh_path
from litmine.sources.cord import METADATA_COLUMNS, assemble_fulltext, decode_fulltext, fulltext_rejects, read_metadata
from spark_queries.tables import documents, table


def metadata(spark, sf_dir):
    """Documents as metadata rows; ids and files are left out in turn."""
    k = F.col("doc_id")
    filled = {
        "cord_uid": F.concat(F.lit("u"), k % 100), "title": F.concat(F.lit("Document "), k), "abstract": F.col("source"),
        "pubmed_id": F.when(k % 4 == 0, k.cast("string")), "doi": F.when(k % 4 == 1, F.concat(F.lit("10.1/"), k)).otherwise(""),
        "pmcid": F.when(k % 4 == 2, F.concat(F.lit("PMC0; PMC"), k)).when(k % 8 == 3, F.concat(F.lit(" PMC"), k, F.lit(" ; "))),
        "pmc_json_files": F.when(k % 5 == 0, F.concat(F.lit("pmc/a.json; pmc/"), k, F.lit(".xml.json"))).when(k % 5 == 1, " ; "),
        "pdf_json_files": F.when(k % 5 <= 2, F.concat(F.lit("pdf/"), k, F.lit(".json"))),
    }
    docs = table(spark, sf_dir, "documents")
    indexed = with_row_index(docs.select("doc_id", "source"))
    return indexed.select(*[filled.get(c, F.lit(None)).cast("string").alias(c) for c in METADATA_COLUMNS], "row_index")


METADATA = """
described AS (
  SELECT doc_id AS k, 'u' || (doc_id % 100) || ':' || doc_id AS id,
    CASE doc_id % 4 WHEN 0 THEN 'PMID:' || doc_id WHEN 1 THEN 'DOI:10.1/' || doc_id WHEN 2 THEN 'PMCID:PMC' || doc_id
      ELSE CASE WHEN doc_id % 8 = 3 THEN 'PMCID:PMC' || doc_id ELSE 'CORD_UID:u' || (doc_id % 100) || ':' || doc_id END END AS article_id,
    CASE WHEN doc_id % 4 = 2 OR doc_id % 8 = 3 THEN 'PMCID:PMC' || doc_id ELSE '' END AS pmcid,
    CASE WHEN doc_id % 5 = 0 THEN 'pmc/' || doc_id || '.xml.json' WHEN doc_id % 5 IN (1, 2) THEN 'pdf/' || doc_id || '.json' ELSE '' END AS json_file,
    'Document ' || doc_id AS title, source AS abstract, text
  FROM documents
)"""


def article_ids(spark, sf_dir):
    return describe_rows(metadata(spark, sf_dir))


ARTICLE_IDS = "WITH " + METADATA.strip() + "\nSELECT id, article_id, pmcid, json_file, title, abstract FROM described"


def last_file(spark, sf_dir):
    """Identifier and file choice on orders."""
    k = F.col("o_orderkey")
    pmc = F.when(k % 3 == 0, F.concat(F.lit("a;b ; "), k)).when(k % 3 == 1, "")
    pdf = F.concat(k, F.lit("; ;"))
    picked = table(spark, sf_dir, "orders").select("o_orderkey", preferred_file(pmc, pdf).alias("file"), last_of_list(pmc).alias("pmc"))
    return picked.withColumn("article_id", article_id(F.lit(None), F.lit(""), F.col("pmc"), row_id(F.lit("x"), F.col("o_orderkey"))))


LAST_FILE = """
SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS file, CASE WHEN o_orderkey % 3 = 0 THEN CAST(o_orderkey AS VARCHAR) ELSE '' END AS pmc,
  CASE WHEN o_orderkey % 3 = 0 THEN 'PMCID:' || o_orderkey ELSE 'CORD_UID:x:' || o_orderkey END AS article_id FROM orders"""


def json_documents(spark, sf_dir):
    """Every document's text as full-text JSON, one paragraph per line.

    Every seventh lacks a required field, every eleventh is cut off.
    """
    k = F.col("doc_id")
    lines = F.split("text", "\n")
    no_refs = F.array().cast("array<struct<start:int>>")

    def paragraph(text):
        return F.struct(F.lit("s").alias("section"), text.alias("text"), no_refs.alias("cite_spans"), no_refs.alias("ref_spans"))

    doc = F.struct(
        k.cast("string").alias("paper_id"),
        F.struct(F.concat(F.lit("Document "), k).alias("title"), F.array().cast("array<struct<first:string>>").alias("authors")).alias("metadata"),
        F.when(k % 2 == 0, F.array(paragraph(F.lit("Abstract one")), paragraph(F.lit("two")))).alias("abstract"),
        F.transform(lines, paragraph).alias("body_text"),
        F.map_from_arrays(F.array(), F.array()).cast("map<string,struct<title:string>>").alias("bib_entries"),
        F.create_map(F.lit("F2"), F.struct(F.lit("Second").alias("text"), F.lit("figure").alias("type")),
                     F.lit("F1"), F.struct(F.lit("First").alias("text"), F.lit("table").alias("type"))).alias("ref_entries"),
        F.when(k % 7 != 0, F.array(paragraph(F.lit("Back")))).alias("back_matter"),
    )
    text = F.to_json(doc)
    content = F.when(k % 11 == 0, F.substring(text, F.lit(1), F.length(text) - 9)).otherwise(text)
    name = F.when(k % 5 == 0, F.concat(F.lit("pmc/"), k, F.lit(".xml.json"))).otherwise(F.concat(F.lit("pdf/"), k, F.lit(".json")))
    return documents(spark, sf_dir).select("doc_id", name.alias("json_path"), content.alias("content"))


TEXTS = """
texts AS (
  SELECT doc_id AS k, CASE WHEN doc_id % 7 = 0 OR doc_id % 11 = 0 THEN '' ELSE 'Document ' || doc_id || chr(10) ||
    CASE WHEN doc_id % 2 = 0 THEN 'Abstract one' || chr(10) || 'two' ELSE '' END || chr(10) || text || chr(10) ||
    'Second' || chr(10) || 'First' || chr(10) || 'Back' END AS full_text FROM documents
)"""


def fulltext_concat(spark, sf_dir):
    text = assemble_fulltext(F.col("doc"))
    return decode_fulltext(json_documents(spark, sf_dir)).select("doc_id", F.length(text).cast("long").alias("n_chars"), F.md5(text).alias("digest"))


FULLTEXT_CONCAT = "WITH " + TEXTS.strip() + "\nSELECT k AS doc_id, length(full_text) AS n_chars, md5(full_text) AS digest FROM texts"


def json_rejects(spark, sf_dir):
    return fulltext_rejects(decode_fulltext(json_documents(spark, sf_dir)))


JSON_REJECTS = """
SELECT CASE WHEN doc_id % 5 = 0 THEN 'pmc/' || doc_id || '.xml.json' ELSE 'pdf/' || doc_id || '.json' END AS json_path,
  'Could not decode document' AS reason FROM documents WHERE doc_id % 7 = 0 OR doc_id % 11 = 0"""


def fulltext_fallback(spark, sf_dir):
    decoded = decode_fulltext(json_documents(spark, sf_dir))
    files = decoded.select(F.col("json_path").alias("json_file"), assemble_fulltext(F.col("doc")).alias("full_text"))
    texts = attach_fulltext(describe_rows(metadata(spark, sf_dir)), files)
    return texts.select("id", "article_id", "text_source", F.md5("text").alias("digest"))


FULLTEXT_FALLBACK = "WITH " + METADATA.strip() + ", " + TEXTS.strip() + """
SELECT id, article_id, CASE WHEN json_file = '' THEN 'without full text' ELSE 'with full text from ' || json_file END AS text_source,
  md5(CASE WHEN json_file = '' THEN title || chr(10) || abstract ELSE full_text END) AS digest
FROM described JOIN texts USING (k)"""


def row_index(spark, sf_dir):
    return with_row_index(table(spark, sf_dir, "documents").select("doc_id"))


ROW_INDEX = "SELECT doc_id, row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents"


def rows_between(spark, sf_dir):
    """Rows [120, 171) of the indexed documents; inverted and far windows add none."""
    indexed = row_index(spark, sf_dir)
    parts = [row_slice(indexed, *window) for window in ((120, 171), (512, 440), (15000000, 16000000))]
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


ROWS_BETWEEN = f"SELECT * FROM ({ROW_INDEX}) WHERE row_index >= 120 AND row_index < 171"


def chunks(spark, sf_dir):
    return fixed_chunks(table(spark, sf_dir, "orders").agg(F.count("*").alias("n_rows")), 399)


CHUNKS = """
SELECT task, least(task * greatest(n // 399, 1), n) AS from_row,
    CASE WHEN task = 399 THEN n ELSE least((task + 1) * greatest(n // 399, 1), n) END AS until_row
FROM (SELECT unnest(range(0, 400)) AS task), (SELECT count(*) AS n FROM orders)"""

def metadata_csv(spark, sf_dir):
    """Documents as metadata files in the order of their ids: whole texts as abstracts, with quotes, commas and line ends in them, read by many tasks."""
    k = F.col("doc_id")
    filled = {
        "cord_uid": F.concat(F.lit("u"), k), "title": F.concat(F.lit('A "quoted", title '), k), "doi": F.when(k % 3 == 0, F.concat(F.lit("10.1/"), k)),
        "abstract": F.concat(F.lit("text: "), "text", F.lit('\n\n"end", ')), "journal": F.col("source"), "license": F.col("lang"),
    }
    columns = [F.coalesce(filled.get(c, F.lit(None)).cast("string"), F.lit("")) for c in METADATA_COLUMNS]
    line = F.concat_ws(",", *[F.concat(F.lit('"'), F.replace(c, F.lit('"'), F.lit('""')), F.lit('"')) for c in columns])
    path = fresh_path(spark, "csv")
    docs = table(spark, sf_dir, "documents").select(k.alias("_k"), line.alias("value"))
    dealt = docs.repartitionByRange(F.col("_k").asc_nulls_first()).sortWithinPartitions(F.col("_k").asc_nulls_first())
    # The numbers of a task's rows begin at a multiple of 2^33: the first row of each file brings its header.
    first = F.monotonically_increasing_id() % (1 << 33) == 0
    header = F.when(first, ",".join(METADATA_COLUMNS) + "\n").otherwise("")
    dealt.select("value", header.alias("_header")).select(F.concat("_header", "value").alias("value")).write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        found = with_row_index(read_metadata(spark, path))
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    return found.select(
        F.substring("cord_uid", 2, 20).cast("long").alias("doc_id"), "title", F.coalesce("doi", F.lit("")).alias("doi"), F.sha2(F.regexp_replace("abstract", "\r\n?", "\n"), 256).alias("digest"),
        F.coalesce("journal", F.lit("")).alias("journal"), F.coalesce("license", F.lit("")).alias("license"), "row_index")


METADATA_CSV = r"""
SELECT doc_id, 'A "quoted", title ' || doc_id AS title, CASE WHEN doc_id % 3 = 0 THEN '10.1/' || doc_id ELSE '' END AS doi,
  sha256('text: ' || regexp_replace(text, '\r\n?', chr(10), 'g') || chr(10) || chr(10) || '"end", ') AS digest, source AS journal, lang AS license,
  row_number() OVER (ORDER BY doc_id) - 1 AS row_index FROM documents"""

QUERIES = {
    "metadata_csv": (metadata_csv, METADATA_CSV),
    "article_id_coalesce": (article_ids, ARTICLE_IDS),
    "pick_last_file": (last_file, LAST_FILE),
    "fulltext_concat": (fulltext_concat, FULLTEXT_CONCAT),
    "json_rejects": (json_rejects, JSON_REJECTS),
    "fulltext_fallback": (fulltext_fallback, FULLTEXT_FALLBACK),
    "row_index": (row_index, ROW_INDEX),
    "row_slice": (rows_between, ROWS_BETWEEN),
    "fixed_chunks": (chunks, CHUNKS),
}
