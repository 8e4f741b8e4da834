"""Ingest quarantine, the row-extractor slot, fetches that leave the text in
place, and vectors that survive their text form."""

import struct

import pytest
from pyspark.sql import functions as F

from docsift.functions.vectors import format_vector_text, parse_vector_text
from docsift.jobs import ingest
from docsift.operators.extraction import TextPages, extract_pages
from docsift.operators.listing import filter_allowed, scrape_links
from docsift.operators.retrieval import fetch_context, fetch_pages, wrong_dimension
from docsift.session import scratch_path
from docsift.sources.files import EMBEDDED_CSV_SCHEMA, read_embedded_csv, write_embedded_csv

BASE = "https://forms.test"


def line_rows():
    """Another listing layout: one ``href;section;topic`` line per document."""
    def extract(pages):
        return [[tuple(c or None for c in line.split(";")) for line in (html or "").splitlines()] for html in pages]

    return extract


@pytest.fixture()
def pages(spark):
    return spark.createDataFrame([(1, "/files/a.pdf;0842;tax\n/files/b.pdf;;\n/files/c.pdf;9;x"), (2, None), (3, "/files/gone.pdf;1;y")], "page_id long, html string")


def test_another_row_extractor(spark, pages):
    got = scrape_links(pages, BASE, extractor=line_rows()).orderBy("page_id", "row_no").collect()
    assert [(r.page_id, r.row_no, r.File_Name, r.SEC_Number, r.Topic) for r in got] == [
        (1, 0, "a", "0842", "tax"), (1, 1, "b", None, None), (1, 2, "c", "9", "x"), (3, 0, "gone", "1", "y")]
    with pytest.raises(Exception, match="one list per page"):
        scrape_links(pages, BASE, extractor=lambda html: [[]] * (len(html) + 1)).collect()


def test_two_texts_of_one_stem_are_quarantined(spark, pages):
    texts = spark.createDataFrame([("a", "**T** one"), ("a", "**T** other"), ("b", "**T** two"), ("c", "## T ## refused"), ("zzz", "**T** unlinked"), ("zzz", "**T** twice")],
                                  "File_Name string, text string")
    emb, missing, aside = ingest(pages, texts, BASE, "sections", dim=8, row_extractor=line_rows())
    assert [(r.File_Name, r.Chunk_Content) for r in emb.collect()] == [("b", "T\ntwo")]
    assert [r.File_Name for r in missing.collect()] == ["gone"]
    assert sorted((r.File_Name, r.reason) for r in aside.collect()) == [("a", "several texts"), ("c", "section guard")]
    plan = emb._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan  # the texts stream past the links


@pytest.mark.parametrize("strategy, want", [("pages", [("a", 1, "p one"), ("a", 2, ""), ("a", 3, "**H** q")]), ("sections", [("a", 1, "H\nq")])])
def test_bytes_to_embedded_chunks(spark, pages, strategy, want):
    files = spark.createDataFrame([("a", bytearray(b"p one\f\f**H** q")), ("b", bytearray(b"\xff"))], "File_Name string, content binary")
    docs, failed = extract_pages(files, TextPages())
    emb, missing, _ = ingest(pages, docs, BASE, strategy, dim=8, row_extractor=line_rows())
    assert sorted((r.File_Name, r.Chunk_No, r.Chunk_Content) for r in emb.collect()) == want
    assert sorted(r.File_Name for r in missing.collect()) == ["b", "c", "gone"]
    assert [r.File_Name for r in failed.collect()] == ["b"]


def test_allow_list_is_broadcast_by_its_bytes(spark):
    df = spark.createDataFrame([("a",), ("b",), (None,), ("a",)], "link string")
    allow = spark.createDataFrame([("a",), ("a",), (None,), ("x" * 1000,)], "u string")
    plans = {}
    for limit in (64 << 20, 500):
        out = filter_allowed(df, "link", allow, broadcast_bytes=limit)
        assert sorted(r.link for r in out.collect()) == ["a", "a"]
        plans[limit] = "ResolvedHint (strategy=broadcast)" in out._jdf.queryExecution().analyzed().toString()
    assert plans == {64 << 20: True, 500: False}


def test_fetches_do_not_shuffle_the_text(spark):
    path = scratch_path(spark, "texts")
    spark.range(200).select(F.col("id").alias("doc_id"), F.concat_ws("\n", *[F.concat(F.lit(f"page {k} of "), "id") for k in range(1, 6)]).alias("text")).write.parquet(path)
    docs = spark.read.parquet(path)
    matches = spark.createDataFrame([(q, 7, p, q) for q in range(300) for p in (1, 5)] + [(1, 9, 2, 1), (2, 9, 77, 2)], "qid long, doc_id long, page long, rank long")
    out = fetch_pages(matches, docs, "doc_id", "page")
    got = {(r.doc_id, r.page): r.Chunk_Content for r in out.collect()}
    assert got == {(7, 1): "page 1 of 7", (7, 5): "page 5 of 7", (9, 2): "page 2 of 9", (9, 77): None} and out.count() == 602
    shuffled = fetch_pages(matches, docs, "doc_id", "page", broadcast_bytes=0)
    assert sorted(map(str, shuffled.collect())) == sorted(map(str, out.collect()))

    def exchanged(df):  # columns that a shuffle of the plan carries
        lines = df._jdf.queryExecution().executedPlan().toString().splitlines()
        return [x for x in lines if "Exchange hashpartitioning" in x]

    store = docs.select(F.col("doc_id").alias("ID"), "text")
    ids = matches.select("qid", F.col("doc_id").alias("ID"), "rank")
    context = fetch_context(ids, store, ["ID"], ["text"])
    assert context.columns == ["ID", "qid", "rank", "text"] and context.count() == 602 and not exchanged(context)
    assert fetch_context(ids.limit(0), store, ["ID"], ["text"]).count() == 0


def test_wrong_dimension_on_either_side(spark):
    df = spark.createDataFrame([(1, [1.0, 2.0]), (2, [1.0]), (3, None), (4, [])], "id long, vec array<double>")
    assert sorted(r.id for r in wrong_dimension(df, "vec", 2).collect()) == [2, 3, 4]


VALUES = [1e-8, 1e30, -0.0, 0.1, 1 / 3, 3.4028235e38, 1e-45, float("inf"), float("-inf"), 123456.789, -2.5]


@pytest.mark.parametrize("kind, pack", [("float", "f"), ("double", "d")])
def test_vector_text_is_bit_exact(spark, kind, pack):
    df = spark.createDataFrame([(VALUES,), ([],)], f"v array<{kind}>")
    back = df.select("v", F.transform(parse_vector_text(format_vector_text("v")), lambda x: x.cast(kind)).alias("w")).collect()
    for r in back:
        assert [struct.pack(pack, x) for x in r.w] == [struct.pack(pack, x) for x in r.v]
    assert df.limit(1).select(format_vector_text("v", 2)).first()[0].startswith("[[ 0.00 ")


def test_embedded_chunks_through_csv(spark):
    names = [f.name for f in EMBEDDED_CSV_SCHEMA.fields]
    rows = spark.createDataFrame([("f", "0842", None, "u", 1, ' a "b"\n, c ', 3, 3, [1e-8, 1e30, -0.5], 3), ("g", "", "t", "u", 2, "", 0, 3, [0.0, 0.1, 2.0], 3)],
                                 ", ".join(f"{f.name} {'array<float>' if f.name == 'Embeddings' else f.dataType.simpleString()}" for f in EMBEDDED_CSV_SCHEMA.fields))
    path = scratch_path(spark, "embedded")
    write_embedded_csv(rows, path)
    back = read_embedded_csv(spark, path)
    assert back.columns == names and sorted(map(str, back.collect())) == sorted(map(str, rows.collect()))
