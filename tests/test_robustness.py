"""Inputs that the landed tables never hold: odd dimensions and norms, null
keys, padded texts, untidy listing markup."""

import numpy as np

from docsift.operators.listing import ListingParser
from docsift.operators.retrieval import similarity_topk
from docsift.operators.store import dense_rank_within, insert_if_absent
from docsift.sources.files import read_chunks_csv, write_chunks_csv


def _index(spark):
    rows = [(i, [float(j == i) for j in range(4)], None if i == 3 else i, None if i == 3 else f"t{i}") for i in range(4)]
    return spark.createDataFrame(rows, "id long, vec array<double>, n int, name string")


def _asked(df):
    return sorted((r["qid"], r["id"]) for r in df.collect())


def test_one_long_question_leaves_the_others_alone(spark):
    q = spark.createDataFrame([(1, [1.0, 0.0, 0.0, 0.0]), (2, [0.0, 1.0, 0.0, 0.0]), (3, [1.0] * 5)], "qid int, vec array<double>")
    assert _asked(similarity_topk(q, _index(spark), k=1, dim=4)) == [(1, 0), (2, 1)]


def test_tiny_and_huge_vectors_rank_by_angle(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(50, 8))
    rows = [(i, (v * 10.0 ** (-200 if i % 2 else 150)).tolist()) for i, v in enumerate(base)]
    index = spark.createDataFrame(rows, "id long, vec array<double>")
    q = spark.createDataFrame([(1, (base[7] * 1e-180).tolist()), (2, (base[8] * 1e120).tolist())], "qid int, vec array<double>")
    got = {r["qid"]: (r["id"], r["score"]) for r in similarity_topk(q, index, k=1, dim=8).collect()}
    assert got == {1: (7, 1.0), 2: (8, 1.0)}


def test_filters_are_typed_and_null_never_matches(spark):
    q = spark.createDataFrame([(1, [1.0] * 4, [1], []), (2, [1.0] * 4, [], ["None", "t2"])],
                              "qid int, vec array<double>, ns array<int>, names array<string>")
    got = similarity_topk(q, _index(spark), k=4, filters=[("ns", "n"), ("names", "name")], dim=4)
    assert _asked(got) == [(1, 1), (2, 2)]


def test_dense_rank_keeps_null_groups(spark):
    df = spark.createDataFrame([("a", 1), (None, 1), (None, 2)], "g string, o int")
    got = sorted((r["g"] or "", r["o"], r["seq"]) for r in dense_rank_within(df, ["g"], ["o"]).collect())
    assert got == [("", 1, 0), ("", 2, 1), ("a", 1, 0)]


def test_null_key_is_inserted_or_rejected_not_both(spark):
    target = spark.createDataFrame([("a",)], "k string")
    source = spark.createDataFrame([("a", 1), (None, 2), (None, 3), ("b", 4)], "k string, o int")
    new, rejected = insert_if_absent(target, source, ["k"], ["o"])
    assert sorted(r["o"] for r in new.collect()) == [2, 4]
    assert sorted(r["o"] for r in rejected.collect()) == [1, 3]


def test_csv_keeps_padding_blank_and_missing(spark, tmp_path):
    texts = ["  lead and trail  ", " Topic", "head\n", "", None, 'say "x", y', "a\n\nb"]
    rows = [(f"f{i}", "0842", t, "l", i, t, 1, 2) for i, t in enumerate(texts)]
    from docsift.sources.files import CHUNK_CSV_SCHEMA

    df = spark.createDataFrame(rows, CHUNK_CSV_SCHEMA)
    write_chunks_csv(df, str(tmp_path / "c"))
    assert sorted(read_chunks_csv(spark, str(tmp_path / "c")).collect()) == sorted(df.collect()) or \
        {tuple(r) for r in read_chunks_csv(spark, str(tmp_path / "c")).collect()} == {tuple(r) for r in df.collect()}


def test_listing_classes_comments_and_scripts():
    p = ListingParser(sec_class="c sec", topic_class="c topic")
    p.feed('<table><tbody><tr><td class="c  sec "><p>A <!-- x --> B</p></td>'
           '<td class=" c topic"><script>var z=1;</script>T</td></tr></tbody></table>')
    p.close()
    row = p.rows[0]
    assert "".join(row.sec_p.parts) == "AB"
    assert "".join(row.topic.parts) == "T"
