"""Article metadata CSV and full-text JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from litmine.functions.text import text_or_empty
from litmine.operators.sizing import broadcast_if_small
from litmine.session import spread, written
from litmine.operators.rows import split_sums

# The metadata header, in order.
METADATA_COLUMNS = [
    "cord_uid", "sha", "source_x", "title", "doi", "pmcid", "pubmed_id", "license", "abstract",
    "publish_time", "authors", "journal", "mag_id", "who_covidence_id", "arxiv_id",
    "pdf_json_files", "pmc_json_files", "url", "s2_id",
]

# The full-text layout.
_REF = "struct<start:int,end:int,text:string,ref_id:string>"
_AUTHOR = (
    "struct<first:string,middle:array<string>,last:string,suffix:string,"
    "affiliation:struct<laboratory:string,institution:string,"
    "location:struct<postCode:string,settlement:string,region:string,country:string>>,email:string>"
)
_PARAGRAPH = f"struct<section:string,text:string,cite_spans:array<{_REF}>,ref_spans:array<{_REF}>,eq_spans:array<{_REF}>>"
FULLTEXT_SCHEMA = (
    f"paper_id string, metadata struct<title:string,authors:array<{_AUTHOR}>>, "
    f"abstract array<struct<section:string,text:string,cite_spans:array<{_REF}>,ref_spans:array<{_REF}>>>, "
    f"body_text array<{_PARAGRAPH}>, "
    f"bib_entries map<string,struct<ref_id:string,title:string,authors:array<{_AUTHOR}>,year:int,venue:string,"
    "volume:string,issn:string,pages:string,other_ids:map<string,array<string>>>>, "
    "ref_entries map<string,struct<text:string,type:string>>, "
    f"back_matter array<{_PARAGRAPH}>, _corrupt_record string"
)
# Fields that must be present (the others may be missing).
_REQUIRED_AUTHOR = ("first", "middle", "last", "suffix")
_REQUIRED_PARAGRAPH = ("section", "text", "cite_spans", "ref_spans")
_REQUIRED_BIB = ("title", "authors", "venue", "volume", "issn", "other_ids")


class HeaderMismatch(ValueError):
    """The metadata file does not have the expected columns."""


def csv_records(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``(source_file, record, text)``: the records of CSV files, in order, each read by the task that holds its lines.

    A line begins a record if an even number of quotes lies before it in its file. Files are split like any text; quotes are
    summed within each split, and what the splits before it add is one number for each (``rows.split_sums``). The lines of a record
    meet by the number of the line that began it. Line ends inside quotes are read as newlines; records without any character are none.
    """
    split = [F.col("_metadata.file_path").alias("_file"), F.col("_metadata.file_block_start").alias("_block")]
    quotes = (F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))).cast("long")
    lines = written(spark.read.text(path).select("value", *split, F.monotonically_increasing_id().alias("_line"), quotes.alias("_quotes")), "lines")
    keys = ["_file", "_block"]
    before = Window.partitionBy(*keys).orderBy("_line").rowsBetween(Window.unboundedPreceding, -1)
    sums = split_sums(lines.groupBy(*keys).agg(F.sum("_quotes").alias("_n")), "_n", within=["_file"])
    counted = lines.withColumn("_inside", F.coalesce(F.sum("_quotes").over(before), F.lit(0))).join(broadcast_if_small(sums), keys)
    begins = written(counted.select("value", *keys, "_line", ((F.col("_inside") + F.col("_start")) % 2 == 0).alias("_begins")), "begins")
    upto = Window.partitionBy(*keys).orderBy("_line").rowsBetween(Window.unboundedPreceding, 0)
    last = begins.where("_begins").groupBy(*keys).agg(F.max("_line").alias("_last"))
    carried = split_sums(begins.groupBy(*keys).agg(F.count("*").alias("_n")).join(last, keys, "left"), "_last", within=["_file"], largest=True)
    first = F.last(F.when(F.col("_begins"), F.col("_line")), ignorenulls=True).over(upto)
    owned = begins.withColumn("_own", first).join(broadcast_if_small(carried), keys).select(
        F.col("_file").alias("source_file"), F.coalesce("_own", "_start").alias("record"), F.struct("_line", "value").alias("_part"))
    joined = owned.groupBy("source_file", "record").agg(F.array_join(F.transform(F.array_sort(F.collect_list("_part")), lambda p: p["value"]), "\n").alias("text"))
    return joined.where("text != ''")


def read_metadata(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """All 19 metadata columns as text; raises unless every file's header is exactly as expected.

    Quoted fields may span lines; a file is read by as many tasks as it has splits (:func:`csv_records`). Rows are sorted
    in file order.
    """
    records = written(csv_records(spark, path), "records")
    heads = records.groupBy("source_file").agg(F.min("record").alias("record"))
    options = {"quote": '"', "escape": '"'}
    columns = [f"c{i}" for i in range(len(METADATA_COLUMNS) + 1)]
    named = records.join(broadcast_if_small(heads), ["source_file", "record"]).select(
        F.from_csv("text", ", ".join(f"{c} string" for c in columns), options).alias("h"))
    for (found,) in named.select(F.array(*[f"h.{c}" for c in columns])).distinct().limit(2).collect():
        if found != [*METADATA_COLUMNS, None]:
            raise HeaderMismatch(f"expected {METADATA_COLUMNS}, found {[c for c in found if c is not None]}")
    schema = ", ".join(f"`{c}` string" for c in METADATA_COLUMNS)
    rows = records.join(broadcast_if_small(heads), ["source_file", "record"], "left_anti")
    parsed = rows.select("source_file", "record", F.from_csv("text", schema, options).alias("r"))
    return written(parsed.sort("source_file", "record").select("r.*"), "metadata")


def read_fulltext_files(spark: SparkSession, path: str | list[str], recursive: bool = True) -> DataFrame:
    """``(json_path, file_name, content)``, one row per JSON file."""
    reader = spark.read.option("recursiveFileLookup", recursive).option("pathGlobFilter", "*.json")
    files = reader.text(path, wholetext=True)
    return files.select(
        F.col("_metadata.file_path").alias("json_path"), F.col("_metadata.file_name").alias("file_name"),
        F.col("value").alias("content"),
    )


def select_by_ids(files: DataFrame, shas: DataFrame, pmcids: DataFrame, name: str = "file_name") -> DataFrame:
    """Files whose stem is a wanted PMC id (``*.xml.json``) or a wanted SHA (``*.json``).

    Ids are one-column tables and are compared in lower case.
    """
    lowered = F.lower(F.col(name))
    wanted = (
        pmcids.select(F.concat(F.lower(F.col(pmcids.columns[0])), F.lit(".xml.json")).alias("_name"))
        .unionByName(shas.select(F.concat(F.lower(F.col(shas.columns[0])), F.lit(".json")).alias("_name")))
        .distinct()
    )
    return files.withColumn("_name", lowered).join(wanted, "_name", "left_semi").drop("_name")


def _has(fields: tuple[str, ...], item: Column) -> Column:
    return reduce(lambda a, b: a & b, [item[f].isNotNull() for f in fields])


def _each(values: Column, check) -> Column:
    return F.coalesce(F.forall(values, lambda v: v.isNotNull() & check(v)), F.lit(False))


def _complete(doc: Column) -> Column:
    """All required fields are there; a missing one rejects the document."""
    def authors(values: Column) -> Column:
        return _each(values, lambda a: _has(_REQUIRED_AUTHOR, a))

    def paragraphs(values: Column) -> Column:
        return _each(values, lambda p: _has(_REQUIRED_PARAGRAPH, p))

    return (
        doc["_corrupt_record"].isNull() & doc["paper_id"].isNotNull() & doc["metadata"]["title"].isNotNull()
        & authors(doc["metadata"]["authors"])
        & (doc["abstract"].isNull() | paragraphs(doc["abstract"]))
        & paragraphs(doc["body_text"]) & paragraphs(doc["back_matter"])
        & _each(F.map_values(doc["bib_entries"]), lambda b: _has(_REQUIRED_BIB, b) & authors(b["authors"]))
        & _each(F.map_values(doc["ref_entries"]), lambda r: _has(("text", "type"), r))
    )


def decode_fulltext(files: DataFrame, content: str = "content", strict: bool = True) -> DataFrame:
    """Add ``doc`` (the decoded struct, NULL if undecodable) and ``decoded``.

    ``strict`` rejects a document that lacks a required field, however deep.
    """
    parsed = files.withColumn("_doc", F.from_json(F.col(content), FULLTEXT_SCHEMA))
    usable = _complete(F.col("_doc")) if strict else F.col("_doc._corrupt_record").isNull() & F.col("_doc").isNotNull()
    checked = parsed.withColumn("decoded", F.coalesce(usable, F.lit(False)))
    return checked.withColumn("doc", F.when(F.col("decoded"), F.col("_doc"))).drop("_doc")


def assemble_fulltext(doc: Column) -> Column:
    """Title, abstract, body, captions and back matter, a newline between all parts.

    An undecodable document gives the empty string.
    """
    def part(values: Column) -> Column:
        return F.coalesce(F.array_join(F.transform(values, lambda p: text_or_empty(p["text"])), "\n"), F.lit(""))

    text = F.concat_ws(
        "\n", text_or_empty(doc["metadata"]["title"]), part(doc["abstract"]), part(doc["body_text"]),
        part(F.map_values(doc["ref_entries"])), part(doc["back_matter"]),
    )
    return F.when(doc.isNull(), F.lit("")).otherwise(text)


def fulltext_rejects(decoded: DataFrame) -> DataFrame:
    return decoded.where(~F.col("decoded")).select("json_path", F.lit("Could not decode document").alias("reason"))


def qualified(spark: SparkSession, path: str) -> str:
    """A path as its file system names it, without a trailing slash (``file:`` paths without empty authority)."""
    jvm = spark.sparkContext._jvm
    found = jvm.org.apache.hadoop.fs.Path(path)
    system = found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.makeQualified(found).toString().rstrip("/")


def relative_names(spark: SparkSession, location: Column, roots: list[str]) -> Column:
    """File locations (as URIs) relative to the longest root that holds them; others stay whole."""
    plain = F.regexp_replace(F.url_decode(F.replace(location, F.lit("+"), F.lit("%2B"))), "^file:/+", "file:/")
    out = plain
    for base in sorted({qualified(spark, r) + "/" for r in roots}, key=len):
        out = F.when(plain.startswith(base), F.substring(plain, F.lit(len(base) + 1), F.length(plain))).otherwise(out)
    return out


def read_fulltext(
    spark: SparkSession, path: str | list[str], root: str | None = None, strict: bool = True, only: DataFrame | None = None
) -> DataFrame:
    """``(json_file, full_text)``; ``json_file`` is relative to ``root`` (default: the path read, or that of a list it came from).

    Paths may be relative, absolute or URIs. ``only`` names the files to decode (``json_file``); others are left out
    before they are decoded or moved.
    """
    roots = [root] if root else [path] if isinstance(path, str) else list(path)
    files = read_fulltext_files(spark, path)
    files = files.withColumn("json_file", relative_names(spark, F.col("json_path"), roots))
    if only is not None:
        files = files.join(broadcast_if_small(only.select("json_file").distinct()), "json_file", "left_semi")
    decoded = decode_fulltext(spread(files), strict=strict)
    return decoded.select("json_file", assemble_fulltext(F.col("doc")).alias("full_text"))
