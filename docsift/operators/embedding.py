"""Embedding operators.

The default embedder is a hashed bag of words: lower-case whitespace tokens,
each hashed to one of ``dim`` buckets, counted.  An Arrow batch hashes
(``md5``) its distinct tokens once and counts with numpy.  Any real model can be plugged in instead through
:func:`embed_chunks` (``embedder(list[str]) -> ndarray``), which runs once
per Arrow batch in ``mapInPandas``; a model naming a ``cache_key`` is loaded
once per Python worker.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.text import words
from docsift.functions.vectors import squared_norm, term_vector
from docsift.operators.slots import worker_instance

DEFAULT_DIM = 256
# Fixed value: the token budget of the embedding model input.
MAX_TOKENS = 4096


def hash_vector(text_col, dim: int = DEFAULT_DIM) -> Column:
    """Hashed term-count vector of a text column (array<float>, length dim)."""
    return term_vector(text_col, dim)


def hash_embed(df: DataFrame, text_col: str = "Chunk_Content", dim: int = DEFAULT_DIM,
               out_col: str = "Embeddings") -> DataFrame:
    return (df.withColumn(out_col, hash_vector(text_col, dim))
              .withColumn("Embedding_Dimension", F.size(out_col).cast("int")))


class HashEmbedder:
    """The same hashed embedder as a plain Python batch callable.

    Serves as the default model for the pluggable path and as a template for
    a real model: ``__call__`` gets a list of texts, returns an (n, dim)
    float32 array.
    """

    def __init__(self, dim: int = DEFAULT_DIM):
        self.dim = dim

    def _bucket(self, tok: str) -> int:
        return int(hashlib.md5(tok.encode("utf-8")).hexdigest()[:4], 16) % self.dim

    def __call__(self, texts: list) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float32)
        for i, t in enumerate(texts):
            if t is None:
                continue
            toks = t.lower().split()
            if toks:
                out[i] = np.bincount([self._bucket(x) for x in toks], minlength=self.dim)
        return out


def hash_embedder(dim: int = DEFAULT_DIM) -> HashEmbedder:
    """The stand-in model as a batch callable for the embedder slot."""
    return HashEmbedder(dim)


def embed_chunks(df: DataFrame, embedder: Callable | None = None, text_col: str = "Chunk_Content",
                 dim: int = DEFAULT_DIM, out_col: str = "Embeddings",
                 max_tokens: int | None = None) -> DataFrame:
    """Append ``Embeddings`` (array<float>) and ``Embedding_Dimension``.

    ``embedder=None`` keeps the whole computation in built-ins.  Otherwise the
    callable is applied once per Arrow batch; only the rows' own columns are
    carried, so select what you need before calling.  An embedder with a
    ``cache_key`` is kept once per Python worker (see ``operators.slots``).
    ``max_tokens`` (e.g. ``MAX_TOKENS``) cuts each text to its first tokens
    in the JVM before it reaches the model; the rows keep their full text.
    """
    if max_tokens is not None:
        model_text = "_model_text"
        cut = df.withColumn(model_text, truncate_tokens(text_col, max_tokens))
        out = embed_chunks(cut, embedder, model_text, dim, out_col)
        return out.drop(model_text)
    if embedder is None:
        return hash_embed(df, text_col, dim, out_col)
    schema = T.StructType(
        list(df.schema.fields)
        + [T.StructField(out_col, T.ArrayType(T.FloatType())),
           T.StructField("Embedding_Dimension", T.IntegerType())]
    )

    def run(batches):
        model = worker_instance(embedder)
        for pdf in batches:
            if pdf.empty:
                continue
            vecs = np.asarray(model(pdf[text_col].tolist()), dtype=np.float32)
            pdf[out_col] = list(vecs)
            pdf["Embedding_Dimension"] = np.int32(vecs.shape[1])
            yield pdf

    return df.mapInPandas(run, schema)


def truncate_tokens(text_col, max_tokens: int = MAX_TOKENS) -> Column:
    """Text cut to its first ``max_tokens`` whitespace tokens (model input)."""
    return F.array_join(F.slice(words(text_col), 1, max_tokens), " ")


def hash_weights(df: DataFrame, key: list[str], text_col: str, dim: int = DEFAULT_DIM) -> DataFrame:
    """Long form (key..., dim, n, w) of the normalised hashed vector.

    w = n / sqrt(sum n^2) over the row's own vector: no shuffle.
    """
    vec = df.select(*key, hash_vector(text_col, dim).alias("_v"))
    vec = vec.withColumn("_n2", squared_norm("_v"))
    long = vec.select(*key, "_n2", F.posexplode("_v").alias("dim", "n")).where(F.col("n") > 0)
    return long.select(
        *key,
        F.col("dim").cast("int").alias("dim"),
        F.col("n").cast("long").alias("n"),
        (F.col("n") / F.sqrt("_n2")).alias("w"),
    )


def mean_pool(df: DataFrame, group_cols: list[str], vec_col: str) -> DataFrame:
    """Mean of the vectors of each group, per dimension, in long form
    (group..., dim, value).  Partial aggregation runs map-side, so a group
    holding a large share of the rows is pre-reduced in every task."""
    long = df.select(*group_cols, F.posexplode(vec_col).alias("dim", "x"))
    return long.groupBy(*group_cols, "dim").agg(F.avg(F.col("x").cast("double")).alias("value"))


def mean_pool_vector(df: DataFrame, group_cols: list[str], vec_col: str) -> DataFrame:
    """Mean-pooled vector per group as an array (bounded by the dimension)."""
    long = mean_pool(df, group_cols, vec_col)
    return long.groupBy(*group_cols).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("dim", "value"))), lambda s: s["value"]).alias(vec_col)
    )
