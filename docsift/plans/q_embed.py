"""Embedding queries: hashed vectors, the pluggable embedder slot, token
truncation, mean pooling, dimension check, vector text codec."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.text import words
from docsift.functions.vectors import format_vector_text, parse_vector_text
from docsift.operators.chunking import chunk_sections
from docsift.operators.embedding import (
    MAX_TOKENS,
    HashEmbedder,
    embed_chunks,
    hash_weights,
    mean_pool,
    truncate_tokens,
)
from docsift.plans import sqltext as S
from docsift.plans.catalog import register
from docsift.plans.q_chunks import SECTIONS_SQL
from docsift.plans.scenarios import HASH_DIM, documents
from docsift.sources.tables import load, spread

# Fixed value: dimension every vector of the dense index must have.
INDEX_DIM = 64


@register("hash_embeddings", sql=f"""
WITH t AS ({S.term_counts('SELECT doc_id, text FROM documents', 'doc_id', 'text', HASH_DIM)}),
n AS (SELECT doc_id, sum(n * n) AS n2 FROM t GROUP BY doc_id)
SELECT doc_id::BIGINT AS doc_id, dim::BIGINT AS dim, n::BIGINT AS n, round(n / sqrt(n2::DOUBLE), 6) AS w
FROM t JOIN n USING (doc_id)
""")
def hash_embeddings(spark: SparkSession, sf: str) -> DataFrame:
    """Normalised hashed bag-of-words vector of every whole document."""
    hw = hash_weights(documents(spark, sf), ["doc_id"], "text", HASH_DIM)
    return hw.select(F.col("doc_id").cast("long"), F.col("dim").cast("long"), F.col("n").cast("long"),
                     F.round("w", 6).alias("w"))


@register("embed_chunks", sql=f"""
WITH s AS (SELECT doc_id, Chunk_No, Chunk_Content FROM ({SECTIONS_SQL}))
SELECT doc_id::BIGINT AS doc_id, Chunk_No::BIGINT AS Chunk_No, {HASH_DIM}::BIGINT AS Embedding_Dimension,
       dim::BIGINT AS dim, n::BIGINT AS n
FROM ({S.term_counts('SELECT doc_id, Chunk_No, Chunk_Content FROM s', 'doc_id, Chunk_No', 'Chunk_Content',
                     HASH_DIM)})
""")
def embed_chunks_q(spark: SparkSession, sf: str) -> DataFrame:
    """Section chunks through the pluggable batch embedder slot (a Python
    model called once per Arrow batch); nonzero entries in long form."""
    docs = documents(spark, sf).select("doc_id", "text")
    chunks = chunk_sections(docs, "text", keep=["doc_id"], running=False).select("doc_id", "Chunk_No", "Chunk_Content")
    emb = embed_chunks(chunks, embedder=HashEmbedder(HASH_DIM))
    long = emb.select("doc_id", "Chunk_No", "Embedding_Dimension",
                      F.posexplode("Embeddings").alias("dim", "n")).where(F.col("n") > 0)
    return long.select(F.col("doc_id").cast("long"), F.col("Chunk_No").cast("long"),
                       F.col("Embedding_Dimension").cast("long"), F.col("dim").cast("long"),
                       F.col("n").cast("long"))


@register("truncate_tokens", sql=f"""
SELECT doc_id::BIGINT AS doc_id, len(t)::BIGINT AS n_tokens, least(len(t), {MAX_TOKENS})::BIGINT AS n_kept,
       array_to_string(t[1:{MAX_TOKENS}], ' ') AS model_input
FROM (SELECT doc_id, {S.words('text')} AS t FROM documents)
""")
def truncate_tokens_q(spark: SparkSession, sf: str) -> DataFrame:
    """Model input of every document: its first 4,096 tokens (the model's
    input budget); longer documents are cut, as the embedder would."""
    d = documents(spark, sf)
    return d.select(
        F.col("doc_id").cast("long"),
        F.size(words("text")).cast("long").alias("n_tokens"),
        F.least(F.size(words("text")), F.lit(MAX_TOKENS)).cast("long").alias("n_kept"),
        truncate_tokens("text", MAX_TOKENS).alias("model_input"),
    )


@register("mean_pool", sql="""
SELECT label::BIGINT AS label, (d - 1)::BIGINT AS dim, round(avg(x), 6) AS value
FROM (SELECT label, unnest(embedding)::DOUBLE AS x, generate_subscripts(embedding, 1) AS d FROM embeddings)
GROUP BY label, d
""")
def mean_pool_q(spark: SparkSession, sf: str) -> DataFrame:
    """Mean over the sequence axis: vectors of a label pooled per dimension."""
    emb = spread(load(spark, sf, "embeddings"))
    mp = mean_pool(emb, ["label"], "embedding")
    return mp.select(F.col("label").cast("long"), F.col("dim").cast("long"), F.round("value", 6).alias("value"))


@register("dimension_check", sql=f"""
SELECT label::BIGINT AS label, count(*)::BIGINT AS n_vectors, min(len(embedding))::BIGINT AS min_dim,
       max(len(embedding))::BIGINT AS max_dim,
       count(*) FILTER (WHERE embedding IS NULL OR len(embedding) <> {INDEX_DIM})::BIGINT AS n_bad
FROM embeddings GROUP BY label
""")
def dimension_check(spark: SparkSession, sf: str) -> DataFrame:
    """Vectors per metadata label whose dimension differs from the index's."""
    emb = load(spark, sf, "embeddings")
    size = F.size("embedding")
    return emb.groupBy("label").agg(
        F.count(F.lit(1)).cast("long").alias("n_vectors"),
        F.min(size).cast("long").alias("min_dim"),
        F.max(size).cast("long").alias("max_dim"),
        F.sum(F.when(F.col("embedding").isNull() | (size != INDEX_DIM), 1).otherwise(0))
         .cast("long").alias("n_bad"),
    ).select(F.col("label").cast("long"), "n_vectors", "min_dim", "max_dim", "n_bad")


@register("vector_text_codec", sql="""
SELECT vec_id::BIGINT AS vec_id, (d - 1)::BIGINT AS pos, round(x::DOUBLE, 6) AS value
FROM (SELECT vec_id, unnest(embedding) AS x, generate_subscripts(embedding, 1) AS d FROM embeddings)
""")
def vector_text_codec(spark: SparkSession, sf: str) -> DataFrame:
    """Every vector printed as text (``[[ a b ...]]``, 6 decimals), parsed
    back and exploded."""
    emb = spread(load(spark, sf, "embeddings"))
    txt = emb.select("vec_id", format_vector_text("embedding", 6).alias("Embeddings"))
    back = txt.select("vec_id", F.posexplode(parse_vector_text("Embeddings")).alias("pos", "value"))
    return back.select(F.col("vec_id").cast("long"), F.col("pos").cast("long"),
                       F.round("value", 6).alias("value"))
