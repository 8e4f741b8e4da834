"""Chunking queries: pages, sections, parity guard, strategy switch,
quarantine of documents without chunks, word counts and running totals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.text import word_count
from docsift.operators.chunking import (
    BODY_SPLIT_RE,
    HEADING_RE,
    chunk_documents,
    chunk_pages,
    chunk_sections,
    quarantine_missing,
    section_arrays,
)
from docsift.plans import sqltext as S
from docsift.plans.catalog import register
from docsift.plans.scenarios import documents, form_documents

LINK_COLS = ["File_Name", "SEC_Number", "Topic", "PDF_Link"]
OUT_COLS = ["doc_id", *LINK_COLS, "Chunk_No", "Chunk_Content", "Number_of_Words", "Total_Tokens_in_PDF"]

# SQL: documents with the four link columns (see scenarios.form_documents)
FORM_DOCS_SQL = """
SELECT d.doc_id, d.text, d.source AS File_Name, d.lang AS SEC_Number,
       CASE WHEN l.quality IS NOT NULL THEN 'quality ' || l.quality::VARCHAR END AS Topic,
       'https://forms.example.org/files/doc' || d.doc_id::VARCHAR || '.pdf' AS PDF_Link
FROM documents d LEFT JOIN labels l USING (doc_id)
"""


def _typed(df: DataFrame) -> DataFrame:
    return df.select(
        F.col("doc_id").cast("long"), *LINK_COLS, F.col("Chunk_No").cast("long"), "Chunk_Content",
        F.col("Number_of_Words").cast("long"), F.col("Total_Tokens_in_PDF").cast("long"),
    )


def _typed_sql(rel: str) -> str:
    return f"""
SELECT doc_id::BIGINT AS doc_id, File_Name, SEC_Number, Topic, PDF_Link, chunk_no::BIGINT AS Chunk_No,
       Chunk_Content, nw::BIGINT AS Number_of_Words,
       (sum(nw) OVER (PARTITION BY doc_id ORDER BY chunk_no
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))::BIGINT AS Total_Tokens_in_PDF
FROM ({rel})
"""


PAGES_SQL = _typed_sql(f"""
SELECT doc_id, File_Name, SEC_Number, Topic, PDF_Link, chunk_no, chunk AS Chunk_Content,
       {S.word_count('chunk')} AS nw
FROM (SELECT doc_id, File_Name, SEC_Number, Topic, PDF_Link,
             unnest(p) AS chunk, generate_subscripts(p, 1) AS chunk_no
      FROM (SELECT *, string_split(text, chr(10)) AS p FROM ({FORM_DOCS_SQL}) WHERE text IS NOT NULL))
""")

def section_arrays_sql(form_docs: str = FORM_DOCS_SQL) -> str:
    """Heading array h and body array b of every non-null text."""
    return f"""
SELECT *, regexp_extract_all(text, '{HEADING_RE}') AS h,
       string_split_regex(text, '{BODY_SPLIT_RE}')[2:] AS b
FROM ({form_docs}) WHERE text IS NOT NULL
"""


def sections_sql(form_docs: str = FORM_DOCS_SQL) -> str:
    """Section chunks (CHK-2/3/9) of a relation with doc_id, text and the
    four link columns."""
    arrays = section_arrays_sql(form_docs)
    return _typed_sql(f"""
SELECT doc_id, File_Name, SEC_Number, Topic, PDF_Link, chunk_no,
       {S.py_strip("replace(head, '**', '')")} || chr(10) || body AS Chunk_Content,
       {S.word_count('body')} AS nw
FROM (SELECT doc_id, File_Name, SEC_Number, Topic, PDF_Link, head, chunk_no,
             {S.py_strip("replace(replace(rawbody, '{', ''), '}', '')")} AS body
      FROM (SELECT *, unnest(h) AS head, unnest(b) AS rawbody, generate_subscripts(h, 1) AS chunk_no
            FROM ({arrays}) WHERE len(h) = len(b) AND len(h) > 0))
""")


SECTIONS_SQL = sections_sql()


@register("page_chunks", sql=PAGES_SQL)
def page_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """One chunk per line (page) of every document, blank pages kept."""
    return _typed(chunk_pages(form_documents(spark, sf), "text"))


@register("section_chunks", sql=SECTIONS_SQL)
def section_chunks(spark: SparkSession, sf: str) -> DataFrame:
    """One chunk per ``**heading**`` section of every valid document."""
    return _typed(chunk_sections(form_documents(spark, sf), "text"))


@register("word_count", sql=f"""
SELECT doc_id::BIGINT AS doc_id, {S.word_count('text')}::BIGINT AS n_words,
       len(string_split(text, chr(10)))::BIGINT AS n_pages
FROM documents
""")
def word_count_q(spark: SparkSession, sf: str) -> DataFrame:
    d = documents(spark, sf)
    return d.select(F.col("doc_id").cast("long"), word_count("text").cast("long").alias("n_words"),
                    F.size(F.split("text", "\n", -1)).cast("long").alias("n_pages"))


@register("running_words", sql=f"""
SELECT doc_id, max(Total_Tokens_in_PDF)::BIGINT AS doc_total_words, count(*)::BIGINT AS n_chunks,
       max(Chunk_No)::BIGINT AS last_chunk_no
FROM ({PAGES_SQL}) GROUP BY doc_id
""")
def running_words(spark: SparkSession, sf: str) -> DataFrame:
    """Last running total per document (equals its total word count)."""
    ch = chunk_pages(documents(spark, sf).select("doc_id", "text"), "text", keep=["doc_id"])
    return ch.groupBy("doc_id").agg(
        F.max("Total_Tokens_in_PDF").cast("long").alias("doc_total_words"),
        F.count(F.lit(1)).cast("long").alias("n_chunks"),
        F.max("Chunk_No").cast("long").alias("last_chunk_no"),
    ).select(F.col("doc_id").cast("long"), "doc_total_words", "n_chunks", "last_chunk_no")


@register("section_parity", sql=f"""
SELECT doc_id::BIGINT AS doc_id, len(h)::BIGINT AS n_headings, len(b)::BIGINT AS n_bodies,
       len(h) = len(b) AS parity_ok
FROM ({section_arrays_sql()})
""")
def section_parity(spark: SparkSession, sf: str) -> DataFrame:
    """Heading and body counts per document and the parity verdict."""
    heads, bodies = section_arrays("text")
    d = documents(spark, sf).where(F.col("text").isNotNull())
    return d.select(F.col("doc_id").cast("long"), F.size(heads).cast("long").alias("n_headings"),
                    F.size(bodies).cast("long").alias("n_bodies"),
                    (F.size(heads) == F.size(bodies)).alias("parity_ok"))


@register("chunk_strategy", sql=f"""
SELECT doc_id, 'pages' AS strategy, count(*)::BIGINT AS n_chunks,
       sum(Number_of_Words)::BIGINT AS n_words FROM ({PAGES_SQL}) GROUP BY doc_id
UNION ALL
SELECT doc_id, 'sections' AS strategy, count(*)::BIGINT AS n_chunks,
       sum(Number_of_Words)::BIGINT AS n_words FROM ({SECTIONS_SQL}) GROUP BY doc_id
""")
def chunk_strategy(spark: SparkSession, sf: str) -> DataFrame:
    """Both strategies of the switch over all documents, counted per document."""
    docs = documents(spark, sf).select("doc_id", "text")
    outs = []
    for strategy in ("pages", "sections"):
        chunks, _ = chunk_documents(docs, strategy, "text", keep=["doc_id"], running=False)
        outs.append(chunks.groupBy("doc_id").agg(
            F.count(F.lit(1)).cast("long").alias("n_chunks"),
            F.sum("Number_of_Words").cast("long").alias("n_words"),
        ).select(F.col("doc_id").cast("long"), F.lit(strategy).alias("strategy"), "n_chunks", "n_words"))
    return outs[0].unionByName(outs[1])


@register("missing_documents", sql=f"""
SELECT doc_id::BIGINT AS doc_id, File_Name, SEC_Number FROM ({FORM_DOCS_SQL}) f
WHERE NOT EXISTS (SELECT 1 FROM ({SECTIONS_SQL}) s WHERE s.doc_id = f.doc_id)
""")
def missing_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents that yield no section chunk, set aside for the log."""
    docs = form_documents(spark, sf)
    chunks, _ = chunk_documents(docs, "sections", "text", running=False)
    miss = quarantine_missing(docs, chunks, ["doc_id"])
    return miss.select(F.col("doc_id").cast("long"), "File_Name", "SEC_Number")
