"""Vector helpers: hashed term dimensions, count vectors, vector text codec."""

from __future__ import annotations

import array
import functools
import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.text import words


COUNT_ROWS = 1024                               # rows counted at once
SUMMARY = ["nnz", "total", "sq_norm", "checksum"]


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def term_dims(text_col, dim: int) -> Column:
    """Hashed dimension of every lower-cased whitespace token.

    dim(token) = int(first 4 hex digits of md5(token)) mod ``dim``.  Runs in
    the JVM; only the resulting int array ever reaches Python.
    """
    toks = words(F.lower(_c(text_col)))
    return F.transform(
        toks,
        lambda t: F.pmod(F.conv(F.substring(F.md5(t), 1, 4), 16, 10).cast("int"), F.lit(dim)),
    )


def _counts(dims: pa.Array, dim: int) -> pa.Array:
    """One count vector per list of dims (null: zeros).  The counts are written
    slice by slice into the buffer that becomes the Arrow array: a batch has no
    Python object per row and no second copy."""
    n = len(dims)
    lens = pc.fill_null(pc.list_value_length(dims), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    flat = dims.flatten().to_numpy(zero_copy_only=False)
    counts = np.empty(n * dim, dtype=np.float32)
    for lo in range(0, n, COUNT_ROWS):
        hi = min(n, lo + COUNT_ROWS)
        own = flat[ends[lo] - lens[lo]:ends[hi - 1]].astype(np.int64)
        rows = np.repeat(np.arange(hi - lo), lens[lo:hi])
        counts[lo * dim:hi * dim] = np.bincount(rows * dim + own, minlength=(hi - lo) * dim)
    return pa.ListArray.from_arrays(pa.array(np.arange(0, (n + 1) * dim, dim, dtype=np.int32)), pa.array(counts))


class _Dims(dict):
    """Dimension of a token, hashed when it is first met."""

    def __init__(self, dim: int):
        self.dim = dim

    def __missing__(self, token: str) -> int:
        self[token] = found = int(hashlib.md5(token.encode("utf-8", "surrogateescape")).hexdigest()[:4], 16) % self.dim
        return found


def _hashed(texts: pa.Array, dim: int) -> pa.Array:
    """The dimensions of every text's whitespace tokens; a batch hashes each
    distinct token once."""
    dims, flat, ends = _Dims(dim), array.array("i"), [0]
    for text in texts.cast(pa.binary()):
        if text.is_valid:
            flat.extend(map(dims.__getitem__, text.as_py().decode("utf-8", "surrogateescape").split()))
        ends.append(len(flat))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(flat, np.int32) if flat else [], pa.int32()))


@functools.lru_cache(maxsize=None)
def _term_vector_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def term_vector(texts: pa.Array) -> pa.Array:
        return _counts(_hashed(texts, dim), dim)

    return term_vector.asNondeterministic()         # as below


def term_vector(text_col, dim: int) -> Column:
    """Count vector of the hashed dimensions (:func:`term_dims`) of a text's
    lower-cased whitespace tokens; null text: zeros."""
    return _term_vector_udf(dim)(F.lower(_c(text_col)))


@functools.lru_cache(maxsize=None)
def _count_vector_udf(dim: int):
    @F.arrow_udf(T.ArrayType(T.FloatType()))
    def count_vector(dims: pa.Array) -> pa.Array:
        return _counts(dims, dim)

    # Nondeterministic on purpose: otherwise the optimizer may copy the call
    # into an inferred filter (e.g. from a later explode) and push that copy
    # below a repartition, running the UDF twice.
    return count_vector.asNondeterministic()


def count_vector(dims_col, dim: int) -> Column:
    """Dense term-count vector (array<float>, length ``dim``) of a dims array.

    A vectorised numpy bincount per slice of an Arrow batch: O(tokens), no shuffle.
    """
    return _count_vector_udf(dim)(_c(dims_col))


@F.arrow_udf(T.StructType([T.StructField(c, T.LongType()) for c in SUMMARY]))
def count_summary(vectors: pa.Array) -> pa.Array:
    """Order-sensitive summary of count vectors: nonzeros, sum, squared norm and
    a position-weighted checksum, all exact integers; null for a null vector."""
    lens = pc.fill_null(pc.list_value_length(vectors), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    ends = np.cumsum(lens)
    flat = vectors.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((4, len(lens)), np.int64)
    for lo in range(0, len(lens), COUNT_ROWS):
        hi = min(len(lens), lo + COUNT_ROWS)
        x = flat[ends[lo] - lens[lo]:ends[hi - 1]].astype(np.int64)
        starts = ends[lo:hi] - lens[lo:hi] - (ends[lo] - lens[lo])
        place = np.arange(1, len(x) + 1) - np.repeat(starts, lens[lo:hi])
        for to, y in zip(out, (x != 0, x, x * x, x * place)):
            sums = np.concatenate([[0], np.cumsum(y, dtype=np.int64)])
            to[lo:hi] = sums[starts + lens[lo:hi]] - sums[starts]
    gone = pc.is_null(vectors)
    return pa.StructArray.from_arrays([pa.array(x) for x in out], list(SUMMARY), mask=gone)


def squared_norm(vec_col) -> Column:
    v = _c(vec_col)
    return F.aggregate(v, F.lit(0.0).cast("double"), lambda acc, x: acc + x.cast("double") * x.cast("double"))


def format_vector_text(vec_col, decimals: int | None = None) -> Column:
    """Print a vector the way a 1 x D array prints: ``[[ a b c]]``.

    Each component is printed in the fewest digits that read back as the same
    number of its type (float or double), whatever its size; with ``decimals``
    it is rounded to that many places instead.  A null component prints as
    ``null`` and reads back as null.
    """
    def show(x: Column) -> Column:
        return x.cast("string") if decimals is None else F.format_string(f"%.{decimals}f", x.cast("double"))

    body = F.array_join(F.transform(_c(vec_col), show), " ", "null")
    return F.concat(F.lit("[[ "), body, F.lit("]]"))


def parse_vector_text(text_col) -> Column:
    """Inverse of :func:`format_vector_text`: drop brackets, split on
    whitespace, cast each piece to double (bad pieces become null)."""
    pieces = F.regexp_extract_all(_c(text_col), F.lit(r"[^\s\[\]]+"), 0)
    return F.transform(pieces, lambda x: x.try_cast("double"))
