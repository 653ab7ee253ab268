import csv
import json

import pytest
from pyspark.sql import functions as F

from litmine.operators.kwic import KWIC_COLUMNS, attach_fulltext, describe_rows, kwic_lines, kwic_rows
from litmine.operators.rows import with_row_index
from litmine.operators.vocabulary import finish_vocabulary
from litmine.sources.cord import (
    METADATA_COLUMNS, HeaderMismatch, csv_records, assemble_fulltext, decode_fulltext, fulltext_rejects, read_fulltext,
    read_fulltext_files, read_metadata, select_by_ids,
)
from litmine.sources.sinks import write_lines


def paragraph(text, **extra):
    return {"section": "s", "text": text, "cite_spans": [{"start": 1, "end": 2}], "ref_spans": [], **extra}


def document(**changes):
    doc = {
        "paper_id": "p1",
        "metadata": {"title": "The title", "authors": [
            {"first": "A", "middle": [], "last": "B", "suffix": "", "affiliation": {}, "email": ""}]},
        "abstract": [paragraph("Abs one."), paragraph("Abs two.")],
        "body_text": [paragraph("Body one.", eq_spans=[]), paragraph("Body two.")],
        "bib_entries": {"B0": {"title": "t", "authors": [], "year": 2001, "venue": "", "volume": "", "issn": "", "other_ids": {"DOI": ["x"]}}},
        "ref_entries": {"F2": {"text": "Cap two", "type": "figure"}, "F1": {"text": "Cap one", "type": "table"}},
        "back_matter": [paragraph("Back.")],
    }
    doc.update(changes)
    return {k: v for k, v in doc.items() if v is not None}


FULL = "The title\nAbs one.\nAbs two.\nBody one.\nBody two.\nCap two\nCap one\nBack."


def test_decode(spark):
    without_bib_title = document(bib_entries={"B0": {"authors": [], "venue": "", "volume": "", "issn": "", "other_ids": {}}})
    bad_author = document(metadata={"title": "t", "authors": [{"first": "A", "middle": [], "last": "B"}]})
    cases = [
        (json.dumps(document()), FULL, True),
        (json.dumps(document(abstract=None)), FULL.replace("Abs one.\nAbs two.", ""), True),
        (json.dumps(document(body_text=[], ref_entries={}, back_matter=[], bib_entries={})), "The title\nAbs one.\nAbs two.\n\n\n", True),
        (json.dumps(document(bib_entries=None)), "", False),
        (json.dumps(document(body_text=[{"section": "s", "text": "x", "cite_spans": []}])), "", False),
        (json.dumps(without_bib_title), "", False), (json.dumps(bad_author), "", False),
        (json.dumps(document())[:-30], "", False), ("{}", "", False), ("", "", False), ('{"metadata":{}}', "", False),
    ]
    files = spark.createDataFrame([(str(i), c[0]) for i, c in enumerate(cases)], "json_path string, content string").coalesce(1)
    decoded = decode_fulltext(files)
    got = decoded.select(assemble_fulltext(F.col("doc")).alias("t"), "decoded").collect()
    assert [(r.t, r.decoded) for r in got] == [(c[1], c[2]) for c in cases]
    assert fulltext_rejects(decoded).count() == sum(not c[2] for c in cases)
    lenient = decode_fulltext(files.where("json_path = '3'"), strict=False)
    assert lenient.select(assemble_fulltext(F.col("doc")).alias("t")).first().t == FULL


def write_metadata(path, rows, header=METADATA_COLUMNS):
    with open(path, "w", newline="") as f:
        writer = csv.writer(f)
        writer.writerow(header)
        for row in rows:
            writer.writerow([row.get(c, "") for c in header])


ROWS = [
    {"cord_uid": "u1", "title": "Lung cancer", "abstract": 'A "cell"\nline, lung', "pubmed_id": "11", "doi": "10.1/a"},
    {"cord_uid": "u1", "title": "T", "doi": "10.1/b", "pmcid": "PMC1; PMC2", "pmc_json_files": "d/x.xml.json; d/full.xml.json", "pdf_json_files": "d/no.json"},
    {"cord_uid": "u2", "pmcid": "PMC3", "title": "lung", "pdf_json_files": "d/broken.json"},
    {"cord_uid": "u3", "title": "the lung (a cell)", "pmc_json_files": " ; "},
]


@pytest.fixture
def corpus(spark, tmp_path):
    write_metadata(tmp_path / "metadata.csv", ROWS)
    folder = tmp_path / "json" / "d"
    folder.mkdir(parents=True)
    (folder / "full.xml.json").write_text(json.dumps(document()))
    (folder / "broken.json").write_text(json.dumps(document())[:40])
    metadata = with_row_index(read_metadata(spark, str(tmp_path / "metadata.csv")))
    fulltext = read_fulltext(spark, str(tmp_path / "json"))
    return metadata, fulltext, tmp_path


def test_header_contract(spark, tmp_path):
    write_metadata(tmp_path / "bad.csv", [], METADATA_COLUMNS[1:] + ["cord_uid"])
    with pytest.raises(HeaderMismatch):
        read_metadata(spark, str(tmp_path / "bad.csv"))


def test_texts(corpus):
    metadata, fulltext, _ = corpus
    rows = {r.id: r for r in attach_fulltext(describe_rows(metadata), fulltext).collect()}
    assert {i: (r.article_id, r.pmcid, r.text_source, r.text) for i, r in rows.items()} == {
        "u1:0": ("PMID:11", "", "without full text", 'Lung cancer\nA "cell"\nline, lung'),
        "u1:1": ("DOI:10.1/b", "PMCID:PMC2", "with full text from d/full.xml.json", FULL),
        "u2:2": ("PMCID:PMC3", "PMCID:PMC3", "with full text from d/broken.json", ""),
        "u3:3": ("CORD_UID:u3:3", "", "without full text", "the lung (a cell)\n"),
    }


def test_kwic(spark, corpus):
    metadata, fulltext, tmp_path = corpus
    vocab = finish_vocabulary(spark.createDataFrame(
        [("t:lc", "lung cancer", "label"), ("t:cell", "cell", "label"), ("t:lung", "lung", "label"), ("t:body", "Body", "label")],
        "term_iri string, surface string, kind string"))
    rows = kwic_rows(attach_fulltext(describe_rows(metadata), fulltext), vocab, context=12)
    got = {(r.id, r.before, r.matched, r.cleaned, r.after, r.term_iri) for r in rows.collect()}
    assert rows.columns == KWIC_COLUMNS
    texts = {"u1:0": 'Lung cancer A \\"cell\\" line, lung', "u1:1": FULL.replace("\n", " "), "u3:3": "the lung \\(a cell\\) "}
    places = [
        ("u1:0", 0, "Lung cancer", "t:lc"), ("u1:0", 16, "cell", "t:cell"), ("u1:0", 29, "lung", "t:lung"),
        ("u1:1", 28, "Body", "t:body"), ("u1:1", 38, "Body", "t:body"), ("u3:3", 4, "lung", "t:lung"), ("u3:3", 13, "cell", "t:cell"),
    ]
    assert got == {
        (i, texts[i][max(0, at - 12):at], word, word, texts[i][at + len(word):at + len(word) + 12], term)
        for i, at, word, term in places
    }
    assert all(texts[i][at:at + len(word)] == word for i, at, word, _ in places)
    write_lines(kwic_lines(rows.where("id = 'u3:3' AND term_iri = 't:cell'")), str(tmp_path / "out"))
    line = spark.read.text(str(tmp_path / "out")).first()[0]
    assert line == (
        'u3:3\tCORD_UID:u3:3\t\twithout full text\t"he lung \\(a "\t"cell"\t"cell"\t"\\) "\tt:cell\t'
        '{"term_iri":"t:cell","start":13,"end":17}')
    assert kwic_rows(attach_fulltext(describe_rows(metadata), fulltext), None).count() == 0


def test_select_by_ids(spark, tmp_path):
    for name in ("PMC1.xml.json", "pmc2.xml.json", "ABC.json", "def.json", "x.txt"):
        (tmp_path / name).write_text("{}")
    files = read_fulltext_files(spark, str(tmp_path))
    shas = spark.createDataFrame([("abc",), ("pmc2.xml",)], "sha string")
    pmcids = spark.createDataFrame([("pmc1",), ("def",)], "pmcid string")
    kept = {r.file_name for r in select_by_ids(files, shas, pmcids).collect()}
    assert kept == {"PMC1.xml.json", "ABC.json", "pmc2.xml.json"}


def test_metadata_of_several_splits_is_what_the_plain_reader_gives(spark, tmp_path):
    import csv
    import random

    r = random.Random(1)
    rows = [[r.choice(["", "plain", 'with "quotes" in', "two\nlines", "three\n\nlines, and\n", 'a "\n" b', "é,ü"]) for _ in METADATA_COLUMNS] for _ in range(400)]
    for name, part in (("a.csv", rows[:250]), ("b.csv", rows[250:])):
        with open(tmp_path / name, "w", newline="") as f:
            out = csv.writer(f, lineterminator="\n")
            out.writerow(METADATA_COLUMNS)
            out.writerows(part)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2000")
    try:
        found = read_metadata(spark, str(tmp_path))
        assert csv_records(spark, str(tmp_path)).count() == 402 and spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    plain = spark.read.options(header=True, multiLine=True, quote='"', escape='"').csv(str(tmp_path))
    assert [tuple(x) for x in found.collect()] == [tuple(x) for x in plain.collect()]
    indexed = [x[0] for x in with_row_index(found).select("row_index").collect()]
    assert sorted(indexed) == list(range(400))
