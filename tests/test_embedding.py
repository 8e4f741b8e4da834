"""Embedder slot: model once per worker, token budget before the model."""


def test_model_slot_loads_once_per_worker(spark, tmp_path):
    from docsift.operators.embedding import embed_chunks

    class LazyModel:  # defined here so it is shipped by value
        """Loads on first call and records each load in a file."""

        cache_key = "test-lazy-model"

        def __init__(self, log):
            self.log, self.weights = log, None

        def __call__(self, texts):
            import numpy as np

            if self.weights is None:
                with open(self.log, "a") as f:
                    f.write("load\n")
                self.weights = np.ones(4, dtype=np.float32)
            return np.stack([self.weights * len(t) for t in texts])

    log = str(tmp_path / "loads.txt")
    df = spark.range(0, 400, numPartitions=16).selectExpr("id", "repeat('x', cast(id % 7 as int)) AS t")
    out = embed_chunks(df, LazyModel(log), "t", out_col="v").collect()
    assert len(out) == 400 and all(list(r.v) == [float(len(r.t))] * 4 for r in out)
    loads = open(log).read().count("load")
    assert 1 <= loads < 16  # 16 tasks, far fewer loads: one per Python worker


def test_embedder_input_is_cut_to_max_tokens(spark):
    from docsift.operators.embedding import embed_chunks

    class Seen:  # returns the number of tokens the model received
        def __call__(self, texts):
            import numpy as np

            return np.array([[float(len(t.split()))] for t in texts], dtype=np.float32)

    df = spark.createDataFrame([(1, " ".join(["w"] * 10)), (2, "a  b")], "id long, t string")
    got = {r.id: (r.v[0], r.t) for r in embed_chunks(df, Seen(), "t", out_col="v", max_tokens=4).collect()}
    assert got[1] == (4.0, " ".join(["w"] * 10)) and got[2] == (2.0, "a  b")  # rows keep their text


def test_a_batch_is_counted_in_slices_without_a_second_copy():
    import tracemalloc

    import numpy as np
    import pyarrow as pa

    from docsift.functions.vectors import _count_vector_udf

    rng = np.random.default_rng(5)
    rows = [None if i % 50 == 7 else rng.integers(0, 256, size=i % 90).tolist() for i in range(8000)]
    dims = pa.array([[0], *rows], type=pa.list_(pa.int32())).slice(1)
    tracemalloc.start()
    got = _count_vector_udf(256).func(dims)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    want = np.stack([np.bincount(np.asarray(r or [], dtype=np.int64), minlength=256) for r in rows])
    assert np.array_equal(got.values.to_numpy().reshape(-1, 256), want) and len(got) == 8000 and got.null_count == 0
    assert peak < 2 * 8000 * 256 * 4  # the batch's own vectors; counts of 8 bytes and their copy made three times as many
    assert len(_count_vector_udf(256).func(dims.slice(0, 0))) == 0


def test_tokens_are_split_and_hashed_in_the_batch_like_the_plain_embedder(spark):
    from pyspark.sql import functions as F

    from docsift.operators.embedding import HashEmbedder, hash_vector

    texts = ["", " \n\t ", "One one ONE", "a\u00a0b\u3000c\x1cd", "É\u0085x 漢字 🙂", "w " * 5000, None, *(f"t{i} t{i % 7}" for i in range(50))]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    vectors = df.select("i", "t", hash_vector("t", 32).alias("v"))
    got = {r["i"]: r["v"] for r in vectors.collect()}
    want = HashEmbedder(32)([t.lower() if t is not None else None for t in texts])
    assert [got[i] for i in range(len(texts))] == want.tolist()
    # strings of the JVM never reach the plan as token arrays
    plan = vectors.select(F.sum(F.size("v")))._jdf.queryExecution().executedPlan().toString()
    assert "array_remove" not in plan and "md5" not in plan


def test_count_summary_is_exact_and_evaluated_once(spark):
    from docsift.plans.q_store import vector_stats

    rows = [(1, [0.0, 3.0, 0.0, 5000.0]), (2, []), (3, None), (4, [0.0] * 4), (5, [1.0, 2.0])]
    df = spark.createDataFrame(rows, "i int, values array<float>").repartition(1)
    out = df.select("i", *vector_stats())
    got = {r[0]: tuple(r[1:]) for r in out.collect()}
    assert got == {1: (2, 5003, 25_000_009, 20_006), 2: (0, 0, 0, 0), 3: (None,) * 4, 4: (0, 0, 0, 0), 5: (2, 3, 5, 5)}
    assert out._jdf.queryExecution().executedPlan().toString().count("count_summary(") <= 2     # one call, shown with its result
