"""Mixing sources to target weights by Poisson replication.

Every source ``s`` gets the mean repetition rate ``w_s * total / size_s``
(sizes in characters of text).  A document's number of copies is the inverse
of the Poisson distribution with that mean at a uniform value hashed from the
seed and its id, so a rerun, a retried task or another cluster gives the same
copies and no random state is shared.  The document is exploded by its count
and all copies are shuffled globally: dealt to the partitions by a hash of
seed, id and copy number, and sorted by it inside each.

A mean above ``CHUNK`` is drawn as the sum of equal Poisson parts of at most
``CHUNK`` each (a sum of Poisson draws is Poisson), so ``exp(-mean)`` never
underflows and no count is capped; the work is in proportion to the copies.

Defined results: a null source is a source of its own; null and empty texts
count as size 0; a source of total size 0 gets rate 1; a source without a
given weight gets weight 0 (no copies); a null id is replaced by the text's
digest in the hash; rows that repeat an id draw the same count; an empty table
gives an empty result.  Input columns called ``copy`` or ``shuffle_key`` are
replaced by the operator's.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import small

CHUNK = 16.0
# P(Poisson(16) > 80) < 1e-25, far below the 2^-52 steps of the hashed uniforms
TERMS = 80


def hash52(*parts: Column) -> Column:
    """The first 13 hex digits of an MD5 as a long below 2^52."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, 13), 16, 10).cast("long")


def source_rates(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, epochs: float = 1.0) -> DataFrame:
    """(source, rate, parts, cdf) per source.

    ``weights`` (source, weight) are target shares, normalised over the
    sources that occur; without them the share is ``size ** power`` (a power
    under 1 lifts small sources).  ``epochs`` sets the total to mix, in
    multiples of the input's characters.
    """
    sizes = docs.groupBy(F.col("source").alias("source")).agg(
        F.coalesce(F.sum(F.length("text")), F.lit(0)).cast("double").alias("size"))
    if weights is None:
        sizes = sizes.withColumn("w", F.pow("size", F.lit(float(power))))
    else:
        given = weights.groupBy(F.col("source").alias("ws")).agg(F.sum("weight").cast("double").alias("w"))
        sizes = sizes.join(given, F.col("source").eqNullSafe(F.col("ws")), "left").withColumn("w", F.coalesce("w", F.lit(0.0)))
    total = sizes.agg(F.sum("size").alias("all_size"), F.sum("w").alias("all_w"))
    row = total.first()                                    # two numbers
    all_size, all_w = float(row["all_size"] or 0.0), float(row["all_w"] or 0.0)
    rate = F.when(F.col("size") == 0, F.lit(1.0)).when(F.lit(all_w) == 0, F.lit(0.0)) \
        .otherwise(F.col("w") * F.lit(all_size * epochs) / F.lit(all_w or 1.0) / F.col("size"))
    parts = F.greatest(F.lit(1), F.ceil(F.col("rate") / CHUNK)).cast("long")
    # cumulative probabilities by the recurrence p_k = p_(k-1) * mean / k
    steps = F.aggregate(
        F.sequence(F.lit(1), F.lit(TERMS)),
        F.struct(F.exp(-F.col("mean")).alias("p"), F.array(F.exp(-F.col("mean"))).alias("cdf")),
        lambda acc, k: F.struct((acc["p"] * F.col("mean") / k).alias("p"),
                                F.concat(acc["cdf"], F.array(F.element_at(acc["cdf"], -1) + acc["p"] * F.col("mean") / k)).alias("cdf")),
        lambda acc: acc["cdf"])
    return (sizes.withColumn("rate", rate).withColumn("parts", parts).withColumn("mean", F.col("rate") / F.col("parts"))
            .withColumn("cdf", steps).select("source", "rate", "parts", "cdf"))


def mix(docs: DataFrame, weights: DataFrame | None = None, power: float = 0.5, epochs: float = 1.0, seed: str = "mix-1") -> DataFrame:
    """All columns of ``docs`` plus ``copy`` (from 0) and ``shuffle_key``: one
    row per copy, in globally shuffled order."""
    docs = docs.drop("copy", "shuffle_key")
    rates = source_rates(docs, weights, power, epochs).persist()
    n = rates.count()                                      # one row per source
    rates = rates.select(F.col("source").alias("_s"), F.col("parts").alias("_parts"), F.col("cdf").alias("_cdf"))
    # a rate row holds TERMS doubles: within the row bound over 100, the broadcast stays under 10 MB
    joined = docs.join(small(rates, n * 100), docs["source"].eqNullSafe(rates["_s"]), "inner")
    ident = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce("text", F.lit(""))))

    def draw(i: Column) -> Column:
        u = hash52(F.lit(seed), ident, i.cast("string")) / F.lit(float(1 << 52))
        return F.size(F.filter("_cdf", lambda c: c <= u))

    copies = F.aggregate(F.sequence(F.lit(1).cast("long"), F.col("_parts")), F.lit(0).cast("long"), lambda a, i: a + draw(i))
    out = (joined.withColumn("_n", copies).where("_n > 0")
           .withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))
           .withColumn("shuffle_key", hash52(F.lit(seed), F.lit("order"), ident, F.col("copy").cast("string")))
           .drop("_s", "_parts", "_cdf", "_n"))
    return out.repartition("shuffle_key").sortWithinPartitions("shuffle_key", "doc_id", "copy")
