"""Ranges of a key: numbers by two-level search, one range a task."""

import random
from bisect import bisect_right

import numpy as np
import pytest
from pyspark.sql import functions as F

from docsift.llm.common import dealt, key_bounds, range_number
from docsift.llm.fingerprints import Sketches, difference


@pytest.mark.parametrize("n", [0, 1, 2, 3, 10, 37, 401])
def test_range_number_is_a_search_in_the_bounds(spark, n):
    rng = random.Random(n)
    bounds = sorted(rng.sample(range(-1000, 1000), n))
    keys = [None, -(2**63), 2**63 - 1, *range(-1005, 1005, 3), *bounds]
    rows = spark.createDataFrame([(k,) for k in keys], "k long").select("k", range_number(F.col("k"), bounds).alias("r"))
    for r in rows.collect():
        assert r.r == (0 if r.k is None else max(0, bisect_right(bounds, r.k) - 1))


def test_every_range_is_a_partition_of_its_own(spark):
    df = spark.range(0, 5000, numPartitions=7).union(spark.range(0, 10))
    bounds = key_bounds(df, "id", 24)
    at = dealt(df.withColumn("rng", range_number(F.col("id"), bounds)), "rng", len(bounds)).withColumn("task", F.spark_partition_id())
    got = at.groupBy("rng").agg(F.min("task").alias("a"), F.max("task").alias("b"), F.count("*").alias("n")).collect()
    assert len(got) == len(bounds) and all(r.rng == r.a == r.b for r in got) and max(r.n for r in got) < 2 * 5010 / len(bounds)
    # rows without an id carry negative numbers; an empty table has no ranges
    odd = spark.createDataFrame([(-1,), (-64,), (0,)], "rng int")
    assert dealt(odd, "rng", 5).count() == 3 and dealt(odd.limit(0), "rng", 0).count() == 0


def test_sketches_of_a_guessed_size_give_the_exact_difference():
    rng = random.Random(2)
    word = lambda: "".join(rng.choices("abcdefgh ", k=rng.randint(1, 60)))
    for n in (0, 1, 3, 30, 300, 2000):
        base = [word() for _ in range(n)]
        for m in (0, 1, n // 10, n):
            other = base[m:] + [word() for _ in range(rng.randint(0, m + 2))]
            a, b = Sketches("\n".join(base)), Sketches("\n".join(other))
            left, right = difference(a, b)
            assert sorted(left) == sorted(np.setdiff1d(a.keys, b.keys)) and sorted(right) == sorted(np.setdiff1d(b.keys, a.keys))
