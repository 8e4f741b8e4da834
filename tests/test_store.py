from pyspark.sql import functions as F

from docsift.operators.bucketed import BucketedTable
from docsift.operators.store import (
    STORE_SCHEMA,
    ChunkStore,
    VectorIndex,
    assign_ids,
    dense_rank_within,
    insert_if_absent,
    merge_upsert,
    upsert_vectors,
)
from docsift.session import scratch_path

COLS = ["v"]


def _target(spark, rows):
    return spark.createDataFrame(rows, "ID long, k string, v string")


def _source(spark, rows):
    return spark.createDataFrame(rows, "k string, v string, seq long")


def test_merge_updates_keeps_ids_and_appends(spark):
    t = _target(spark, [(1, "a", "a0"), (2, "b", "b0"), (5, "c", "c0")])
    s = _source(spark, [("b", "b1", 0), ("b", "b2", 1), ("d", "d1", 2), ("e", "e1", 3)])
    out = {r.k: (r.ID, r.v) for r in merge_upsert(t, s, "k", ["seq"], COLS).collect()}
    # duplicate key in the batch: last wins, old id kept; new ids after max
    assert out == {"a": (1, "a0"), "b": (2, "b2"), "c": (5, "c0"), "d": (6, "d1"), "e": (7, "e1")}


def test_merge_is_idempotent(spark):
    t = _target(spark, [(1, "a", "a0")])
    s = _source(spark, [("a", "a1", 0), ("z", "z1", 1)])
    once = merge_upsert(t, s, "k", ["seq"], COLS)
    twice = merge_upsert(once, s, "k", ["seq"], COLS)
    assert sorted(once.collect()) == sorted(twice.collect())


def test_merge_into_empty_target_starts_at_one(spark):
    t = _target(spark, [])
    s = _source(spark, [("x", "1", 5), ("y", "2", 3)])
    out = {r.k: r.ID for r in merge_upsert(t, s, "k", ["seq"], COLS).collect()}
    assert out == {"y": 1, "x": 2}


def test_assign_ids_dense_in_order(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7 % 5000).alias("key"))
    got = assign_ids(df, ["key"], start=100, num_partitions=7).collect()
    assert sorted((r.key, r.ID) for r in got) == [(k, 101 + k) for k in range(5000)]


def test_dense_rank_within_hot_group(spark):
    # one group holds most rows
    df = spark.range(0, 3000).select(F.when(F.col("id") < 2000, 0).otherwise(F.col("id") % 7).alias("g"),
                                     F.col("id").alias("t"))
    got = dense_rank_within(df, ["g"], ["t"]).collect()
    by = {}
    for r in got:
        by.setdefault(r.g, []).append((r.t, r.seq))
    for rows in by.values():
        rows.sort()
        assert [s for _, s in rows] == list(range(len(rows)))


def test_insert_if_absent(spark):
    target = spark.createDataFrame([("ann",)], "username string")
    req = spark.createDataFrame([("ann", 1), ("bob", 2), ("bob", 3), ("cy", 4)], "username string, o long")
    acc, rej = insert_if_absent(target, req, ["username"], ["o"])
    assert sorted((r.username, r.o) for r in acc.collect()) == [("bob", 2), ("cy", 4)]
    assert sorted((r.username, r.o) for r in rej.collect()) == [("ann", 1), ("bob", 3)]


def test_versioned_table_and_chunk_store(spark):
    root = scratch_path(spark, "store-test")
    store = ChunkStore(spark, root)
    assert store.read().count() == 0
    chunks = spark.createDataFrame(
        [("f", "0842", None, "https://x/f.pdf", 1, "one", 0), ("f", "0842", None, "https://x/f.pdf", 2, "two", 0)],
        "File_Name string, SEC_Number string, Topic string, PDF_Link string, Chunk_No int, Chunk_Content string, d long")
    store.upsert(chunks, ["d", "Chunk_No"])
    first = {r.combined_columns: (r.ID, r.SEC_Number) for r in store.read().collect()}
    assert first == {"f0842nanhttps://x/f.pdf1": (1, "0842"), "f0842nanhttps://x/f.pdf2": (2, "0842")}
    store.upsert(chunks.where("Chunk_No = 2").withColumn("Chunk_Content", F.lit("TWO")), ["d", "Chunk_No"])
    second = {r.ID: r.Chunk_Content for r in store.read().collect()}
    assert second == {1: "one", 2: "TWO"}
    store.reset()  # ids restart after a reset
    assert store.read().count() == 0
    store.upsert(chunks.where("Chunk_No = 2"), ["d", "Chunk_No"])
    assert [r.ID for r in store.read().collect()] == [1]
    assert isinstance(store, BucketedTable) and store.read().schema == STORE_SCHEMA


def test_vector_index_upsert_replaces_by_id(spark):
    idx = VectorIndex(spark, scratch_path(spark, "vec-test"), dim=2)
    recs = spark.createDataFrame([("1", [1.0, 0.0], "f", "s"), ("2", [0.0, 1.0], "f", "s")],
                                 "id string, values array<float>, File_Name string, SEC_Number string")
    idx.upsert(recs)
    new = spark.createDataFrame([("2", [1.0, 1.0], "g", "s"), ("3", [1.0, 2.0, 3.0], "g", "s")],
                                "id string, values array<float>, File_Name string, SEC_Number string")
    _, bad = idx.upsert(new)
    assert [r.id for r in bad.collect()] == ["3"]
    got = {r.id: (list(r.values), r.File_Name) for r in idx.read().collect()}
    assert got == {"1": ([1.0, 0.0], "f"), "2": ([1.0, 1.0], "g")}
    assert upsert_vectors(idx.read(), recs.limit(0)).count() == 2


def test_merge_broadcast_and_shuffle_paths_agree(spark):
    t = spark.range(0, 400).select(
        (F.col("id") + 1).alias("ID"), F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"),
        F.lit("old").alias("v"))
    s = spark.range(300, 700).select(
        F.concat(F.lit("k"), (F.col("id") % 550).cast("string")).alias("k"),
        F.concat(F.lit("new"), F.col("id").cast("string")).alias("v"), F.col("id").alias("seq"))
    small = merge_upsert(t, s, "k", ["seq"], COLS)  # default: batch broadcast
    big = merge_upsert(t, s, "k", ["seq"], COLS, broadcast_bytes=0)  # shuffled full outer join
    a, b = sorted(small.collect()), sorted(big.collect())
    assert a == b
    got = {r.k: (r.ID, r.v) for r in a}
    # k = id % 550: ids 550..699 update k0..k149, ids 300..549 update or insert k300..k549
    assert got["k0"] == (1, "new550") and got["k10"] == (11, "new560") and got["k200"] == (201, "old")
    assert got["k320"] == (321, "new320") and got["k400"] == (401, "new400") and got["k549"] == (550, "new549")
    assert sorted(i for i, _ in got.values()) == list(range(1, len(got) + 1))


def test_upsert_latest_paths_agree_and_null_key(spark):
    from docsift.streaming.incremental import upsert_latest

    target = spark.createDataFrame([("a", 1, "x"), ("b", 5, "y"), (None, 2, "n0")], "k string, o long, v string")
    batch = spark.createDataFrame([("a", 3, "x2"), ("b", 4, "late"), ("c", 1, "z"), (None, 7, "n1"), ("a", 2, "x1")],
                                  "k string, o long, v string")
    small = sorted(upsert_latest(target, batch, ["k"], ["o"]).collect(), key=str)
    big = sorted(upsert_latest(target, batch, ["k"], ["o"], broadcast_bytes=0).collect(), key=str)
    assert small == big
    assert {(r.k, r.o, r.v) for r in small} == {("a", 3, "x2"), ("b", 5, "y"), ("c", 1, "z"), (None, 7, "n1")}
    # equal order value: the later arrival wins, on both paths
    tie = spark.createDataFrame([("b", 5, "b-new")], "k string, o long, v string")
    for limit in (None, 0):
        kw = {} if limit is None else {"broadcast_bytes": limit}
        got = {r.k: r.v for r in upsert_latest(target, tie, ["k"], ["o"], **kw).collect()}
        assert got["b"] == "b-new" and got["a"] == "x"


def test_incremental_upsert_touches_its_buckets_and_skips_replays(spark):
    import os

    from docsift.operators.bucketed import BucketedTable
    from docsift.streaming.incremental import incremental_upsert

    root, shape = scratch_path(spark, "latest-test"), "k string, o long, v string"
    schema = spark.createDataFrame([], shape).schema
    table = BucketedTable(spark, f"{root}/table", schema, ["k"], "latest", buckets=8)
    run = lambda checkpoint="c": incremental_upsert(spark, f"{root}/landing", schema, ["o"], table, f"{root}/{checkpoint}")
    land = lambda rows: spark.createDataFrame(rows, shape).write.mode("append").parquet(f"{root}/landing")
    state = lambda: {r.k: (r.o, r.v) for r in table.read().collect()}
    land([(f"k{i}", 1, "a") for i in range(60)] + [(None, 1, "a"), ("k1", 2, "later"), ("k2", 0, "earlier")])
    run()
    assert len(state()) == 61 and state()["k1"] == (2, "later") and state()["k2"] == (1, "a") and table.read().count() == 61
    first = table.log.head()["tables"]["latest"]["buckets"]
    land([("k1", 1, "late"), (None, 5, "null"), ("new", 1, "n")])
    run()
    run()                                                    # nothing new: no commit
    second = table.log.head()
    assert state() | {"k1": (2, "later"), None: (5, "null"), "new": (1, "n")} == state() and len(state()) == 62
    assert second["number"] == 2 and 0 < sum(first.get(b) != v for b, v in second["tables"]["latest"]["buckets"].items()) <= 3
    # a stream that died after its commit and before its own record runs the epoch again
    died = [n for n in os.listdir(f"{root}/c/commits") if n.strip(".").split(".")[0] == "1"]
    assert died
    for name in died:
        os.remove(f"{root}/c/commits/{name}")
    run()
    assert table.log.head() == second
    assert table.read().count() == 62


def test_assign_ids_with_null_keys_and_many_ranges(spark):
    rows = [(None, i) for i in range(5)] + [(k % 13, k) for k in range(300)]
    df = spark.createDataFrame(rows, "a long, b long")
    got = sorted((r.ID, r.a, r.b) for r in assign_ids(df, ["a", "b"], num_partitions=9).collect())
    want = sorted(rows, key=lambda t: (t[0] is not None, t[0] if t[0] is not None else 0, t[1]))
    assert [(i, a, b) for i, a, b in got] == [(i + 1, a, b) for i, (a, b) in enumerate(want)]


def test_vector_index_checks_metric_and_dimension(spark):
    import pytest

    root = scratch_path(spark, "vec-metric")
    assert VectorIndex(spark, root, dim=4).metric == "cosine"
    with pytest.raises(ValueError):
        VectorIndex(spark, root, dim=4, metric="dotproduct")
    with pytest.raises(ValueError):
        VectorIndex(spark, root, dim=0)


def test_keys_are_sorted_by_their_hash_first_and_nulls_still_meet(spark):
    """Keys of long texts that begin alike: both the grouping and the merge join
    sort by one long; nulls, mixed types and zeros of both signs group as before."""
    from docsift.operators.store import _null_safe, attach_vectors, last_per_key

    def plan(df):
        return df._jdf.queryExecution().executedPlan().toString()

    rows = [("same start " * 5 + str(i % 3), None if i % 2 else "t", i) for i in range(12)] + [(None, None, 100), (None, None, 101)]
    df = spark.createDataFrame(rows, "k string, l string, o int").withColumn("v", F.col("o").cast("string"))
    last = last_per_key(df, ["k", "l"], ["o"])
    assert "xxhash64" in plan(last) and last.columns == ["k", "l", "o", "v"]
    want = {}
    for k, l, o in rows:
        want[k, l] = o
    assert {(r["k"], r["l"]): r["o"] for r in last.collect()} == want
    zeros = spark.createDataFrame([(0.0, 1), (-0.0, 2)], "k double, o int")
    assert [r["o"] for r in last_per_key(zeros, ["k"], ["o"]).collect()] == [2]
    left, right = last.hint("merge"), last.select(F.col("k").alias("k2"), F.col("l").alias("l2"))
    met = left.join(right, _null_safe(left, right, [("k", "k2"), ("l", "l2")]))
    assert "xxhash64" in plan(met) and met.count() == len(want)
    narrow, wide = spark.createDataFrame([(1,), (None,)], "a int"), spark.createDataFrame([(1,), (None,)], "b long")
    assert narrow.join(wide, _null_safe(narrow, wide, [("a", "b")])).count() == 2
    store = spark.createDataFrame([(1, "x", "f", "s"), (2, None, "f", "s")], "ID long, combined_columns string, File_Name string, SEC_Number string")
    vecs = spark.createDataFrame([("x", [1.0]), (None, [2.0])], "combined_columns string, Embeddings array<float>")
    for limit in (None, 0, 1 << 20):                        # as before: a null key attaches nothing
        assert [r["id"] for r in attach_vectors(store, vecs, broadcast_bytes=limit).collect()] == ["1"]


def test_a_load_without_running_totals_counts_no_words(spark):
    from docsift.operators.chunking import chunk_pages, chunk_sections

    docs = spark.createDataFrame([(1, "**a** x y\nz\n\n**b** {w}"), (2, None), (3, "")], "doc_id int, text string")
    for chunk in (chunk_pages, chunk_sections):
        cols = ["doc_id", "Chunk_No", "Chunk_Content", "Number_of_Words"]
        assert chunk(docs, "text", running=False).select(cols).collect() == chunk(docs, "text").select(cols).collect()
        bare = chunk(docs, "text", running=False).select("doc_id", "Chunk_No", "Chunk_Content")
        assert "array_remove" not in bare._jdf.queryExecution().executedPlan().toString()
