"""Document chunkers.

Both chunkers turn one document row into N chunk rows with built-in array
functions and one ``posexplode``: all the work of a document stays in the
task that read it, so chunking never shuffles document text.  Running word
totals are computed on the per-document count array before the explode.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.text import py_strip, word_count

# Heading and body-split patterns of the section chunker.
# A heading is **text**, ### text ### or ## text ## (first alternative wins);
# bodies are split on **text** only.
HEADING_RE = r"\*\*[^*]+\*\*|### [^#]+ ###|## [^#]+ ##"
BODY_SPLIT_RE = r"\*\*[^*]+\*\*"

STRATEGIES = ("sections", "pages")

CHUNK_COLUMNS = ["Chunk_No", "Chunk_Content", "Number_of_Words", "Total_Tokens_in_PDF"]


@F.pandas_udf(T.ArrayType(T.LongType()))
def _running_sum(counts: pd.Series) -> pd.Series:
    """Inclusive prefix sums of each int array (one numpy cumsum per batch)."""
    lens = counts.map(lambda a: 0 if a is None else len(a)).to_numpy()
    if lens.sum() == 0:
        return pd.Series([None if a is None else np.zeros(0, dtype=np.int64) for a in counts])
    flat = np.concatenate([a for a in counts if a is not None and len(a)]).astype(np.int64)
    csum = np.cumsum(flat)
    ends = np.cumsum(lens)
    starts = ends - lens
    base = np.where(starts > 0, csum[np.maximum(starts - 1, 0)], 0)
    out = []
    for a, s, e, b in zip(counts, starts, ends, base):
        out.append(None if a is None else csum[s:e] - b)
    return pd.Series(out)


# evaluated exactly once (see functions.vectors.count_vector)
_running_sum_once = _running_sum.asNondeterministic()


def running_sum(counts_col) -> Column:
    return _running_sum_once(F.col(counts_col) if isinstance(counts_col, str) else counts_col)


def _explode_chunks(df: DataFrame, keep: list[str], pieces: Column, content: Callable[[Column], Column],
                    counted: Callable[[Column], Column], running: bool = True) -> DataFrame:
    """One row per entry of the array ``pieces``: its content, and the words of
    what is ``counted`` in it.  Without the running total words are counted
    after the explode, and only if the plan asks for their number."""
    if running:
        chunks = F.transform(pieces, lambda p: F.struct(content(p).alias("c"), word_count(counted(p)).alias("n")))
    else:
        chunks = F.transform(pieces, lambda p: F.struct(p.alias("p")))
    staged = df.select(*keep, chunks.alias("_chunks"))
    zipped = F.col("_chunks")
    if running:
        staged = staged.withColumn("_running", running_sum(F.col("_chunks.n")))
        zipped = F.arrays_zip(F.col("_chunks.c").alias("c"), F.col("_chunks.n").alias("n"),
                              F.col("_running").alias("r"))
    # a plain posexplode would make the optimizer infer a filter on the array
    # and evaluate its expressions again below it
    exploded = staged.select(*keep, F.posexplode_outer(zipped).alias("_pos", "_z")).where(F.col("_pos").isNotNull())
    cols = [
        *keep,
        (F.col("_pos") + 1).cast("int").alias("Chunk_No"),
        (F.col("_z.c") if running else content(F.col("_z.p"))).alias("Chunk_Content"),
        (F.col("_z.n") if running else word_count(counted(F.col("_z.p")))).cast("int").alias("Number_of_Words"),
    ]
    if running:
        cols.append(F.col("_z.r").cast("long").alias("Total_Tokens_in_PDF"))
    return exploded.select(*cols)


def chunk_pages(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                page_sep: str = "\n", running: bool = True) -> DataFrame:
    """One row per page, blank pages kept, numbered from 1.

    Pages are the pieces of the document text between ``page_sep``
    (a regex).  Null text gives no rows.  ``running=False`` leaves out the
    running word total (and its vectorised helper) when it is not needed.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    pages = F.split(F.col(text_col), page_sep, -1)
    return _explode_chunks(df, keep, pages, _whole, _whole, running)


def chunk_page_arrays(df: DataFrame, pages_col: str = "pages", keep: list[str] | None = None,
                      running: bool = True) -> DataFrame:
    """One row per entry of an array of page texts (an extractor's output),
    as :func:`chunk_pages`; a null or empty array gives no rows."""
    keep = keep if keep is not None else [c for c in df.columns if c != pages_col]
    return _explode_chunks(df, keep, F.col(pages_col), _whole, _whole, running)


def _whole(page: Column) -> Column:
    return page


def section_arrays(text_col: str) -> tuple[Column, Column]:
    """(headings, bodies) arrays of a text, before cleaning."""
    t = F.col(text_col)
    heads = F.regexp_extract_all(t, F.lit(HEADING_RE), 0)
    parts = F.split(t, BODY_SPLIT_RE, -1)
    bodies = F.slice(parts, 2, F.size(parts) - 1)
    return heads, bodies


def split_valid(df: DataFrame, text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """Parity guard: documents whose heading count differs from their body
    count go to quarantine instead of failing the whole job."""
    heads, bodies = section_arrays(text_col)
    flagged = df.withColumn("_parity_ok", F.coalesce(F.size(heads) == F.size(bodies), F.lit(True)))
    good = flagged.where("_parity_ok").drop("_parity_ok")
    bad = flagged.where(~F.col("_parity_ok")).drop("_parity_ok")
    return good, bad


def chunk_sections(df: DataFrame, text_col: str = "text", keep: list[str] | None = None,
                   running: bool = True) -> DataFrame:
    """One row per ``**heading**`` section; the preamble is dropped.

    Content is ``heading + "\\n" + body``; the heading loses every ``**``,
    the body every brace, both are stripped; the word count is of the body.
    A document whose heading count differs from its body count gives no
    chunk; :func:`split_valid` returns such documents.  The guard is part of
    the array expression (a filter would evaluate both patterns again below
    the projection), so each pattern runs once per document.
    ``running=False`` leaves out the running word total.
    """
    keep = keep if keep is not None else [c for c in df.columns if c != text_col]
    heads, bodies = section_arrays(text_col)
    found = df.select(*keep, heads.alias("_heads"), bodies.alias("_bodies"))
    clean = found.select(*keep, F.when(
        F.size("_heads") == F.size("_bodies"),
        F.transform(F.arrays_zip(F.col("_heads").alias("h"), F.col("_bodies").alias("b")), lambda p: F.struct(
            py_strip(F.replace(p["h"], F.lit("**"), F.lit(""))).alias("h"),
            py_strip(F.replace(F.replace(p["b"], F.lit("{"), F.lit("")), F.lit("}"), F.lit(""))).alias("b"))),
    ).alias("_pairs"))
    return _explode_chunks(clean, keep, F.col("_pairs"), lambda p: F.concat(p["h"], F.lit("\n"), p["b"]), lambda p: p["b"], running)


def chunk_documents(df: DataFrame, strategy: str, text_col: str = "text", keep: list[str] | None = None,
                    running: bool = True) -> tuple[DataFrame, DataFrame]:
    """Strategy switch.  Returns (chunks, quarantined documents)."""
    if strategy not in STRATEGIES:
        raise ValueError(f"unknown chunking strategy {strategy!r}; expected one of {STRATEGIES}")
    if strategy == "pages":
        return chunk_pages(df, text_col, keep, running=running), df.limit(0)
    _, bad = split_valid(df, text_col)
    return chunk_sections(df, text_col, keep, running), bad


def quarantine_missing(documents: DataFrame, chunks: DataFrame, key: list[str]) -> DataFrame:
    """Documents that produced no chunk (logged and skipped downstream)."""
    return documents.join(chunks.select(*key).distinct(), on=key, how="left_anti")


def doc_total_words(chunks: DataFrame, key: list[str]) -> DataFrame:
    """Total words per document (the last running total)."""
    return chunks.groupBy(*key).agg(F.max("Total_Tokens_in_PDF").alias("doc_total_words"))
