"""Corpus pipeline: the stages of a training-data build, each on the whole
output of the stage before, written as Parquet and read again in between.

1. toxicity: documents graded toxic are rejected;
2. near-dedup: of each group of near copies (five-word shingles, similarity
   of 0.8 or more) the document with the smallest id stays;
3. mixing: Poisson replication of the sources to square-root weights;
4. encoding: byte-level BPE ids of every text.

All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm import bpe, mixing, near_dedup, toxicity
from docsift.llm.common import cut
from docsift.session import checkpoint_root, ship_package
from docsift.sources.tables import load

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
# training and hashing stages have no SQL statement; tests/llm holds them against brute force
ORACLE_SQL = None


def _ready(spark: SparkSession) -> None:
    checkpoint_root(spark)
    ship_package(spark)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity is under one half (whole rows, scored in the
    scan: nothing is shuffled)."""
    _ready(spark)
    model = toxicity.train(docs, load(spark, sf_dir, "labels"))
    return toxicity.keep_clean(docs.select(*COLUMNS), model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-copy group (its smallest id)."""
    _ready(spark)
    return near_dedup.keep_first(docs.select(*COLUMNS), k=5, percent=80)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Copies of the documents, mixed to the target weights and shuffled."""
    _ready(spark)
    return mixing.mix(docs.select(*COLUMNS), power=0.5, epochs=1.0, seed="mix-1").select(*COLUMNS)


def encode_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, n_tokens, ids) per document copy."""
    import public_tokenizers

    _ready(spark)
    coded = bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, keep=["doc_id", "source"])
    return coded.select("doc_id", "source", F.size("ids").cast("long").alias("n_tokens"), "ids")


STAGES = [("toxicity", drop_toxic), ("near_dedup", drop_near_copies), ("mixing", mix_sources), ("bpe", encode_texts)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over ``documents``; each result is written and read again."""
    _ready(spark)
    docs = load(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = cut(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
