"""Inputs of the registered queries, derived by Spark from the landed tables.

The landed tables stand in for the pipeline's inputs:

* documents: one document per row; ``source`` plays the file name, ``lang``
  the form number, the quality label (when present) the topic, and every
  line of the text is a page.
* conversations: user turns are the questions.
* embeddings: a dense vector index with ``label`` as metadata.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.operators.store import DEFAULT_BROADCAST_BYTES, measured
from docsift.sources.tables import load, spread

# Fixed values of the scenario (job parameters of the pipeline).
BASE_URL = "https://forms.example.org"
DOC_URL_PREFIX = BASE_URL + "/files/doc"
HASH_DIM = 256
TOP_K = 3


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spread(load(spark, sf, "documents").select("doc_id", "text", "lang", "source"))


def form_documents(spark: SparkSession, sf: str) -> DataFrame:
    """Documents with the four link columns of the pipeline.

    Topic comes from the quality label of the document; documents without a
    label have no topic (a natural missing value).  The labels are measured:
    within the broadcast limit no text is shuffled, beyond it none is sorted.
    """
    docs = documents(spark, sf)
    labels, _, nbytes = measured(load(spark, sf, "labels").select("doc_id", "quality"))
    labels = F.broadcast(labels) if nbytes <= DEFAULT_BROADCAST_BYTES else labels.hint("shuffle_hash")
    return docs.join(labels, "doc_id", "left").select(
        "doc_id",
        "text",
        F.col("source").alias("File_Name"),
        F.col("lang").alias("SEC_Number"),
        F.when(F.col("quality").isNotNull(), F.concat(F.lit("quality "), F.col("quality").cast("string")))
         .alias("Topic"),
        F.concat(F.lit(DOC_URL_PREFIX), F.col("doc_id").cast("string"), F.lit(".pdf")).alias("PDF_Link"),
    )


def user_questions(spark: SparkSession, sf: str) -> DataFrame:
    conv = load(spark, sf, "conversations")
    return spread(conv.where(F.col("role") == "user").select("conv_id", "turn", "text"))
