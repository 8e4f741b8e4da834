import hashlib
import hmac

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from docsift.functions.text import (
    absolutize_url,
    concat_key,
    file_stem,
    keyed_hash,
    py_strip,
    strip_label,
    word_count,
)
from docsift.functions.vectors import format_vector_text, parse_vector_text

WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0        　"


@settings(max_examples=1, deadline=None)
@given(st.lists(st.text(alphabet=st.sampled_from(list("abé") + list(WS_CHARS)), max_size=12),
                min_size=40, max_size=40))
def test_word_count_and_strip_match_python(spark, texts):
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    got = rows.select("i", word_count("t").alias("n"), py_strip("t").alias("s")).collect()
    for r in got:
        assert r.n == len(texts[r.i].split())
        assert r.s == texts[r.i].strip()


def test_links_stems_labels(spark):
    df = spark.createDataFrame(
        [("/files/a.pdf",), ("https://h/a.pdf",), ("a.pdf",), (None,), ("/x.pdf.y.pdf",)], "l string")
    out = df.select(absolutize_url("l", "https://base").alias("abs"), file_stem("l").alias("stem")).collect()
    assert [r.abs for r in out] == ["https://base/files/a.pdf", "https://h/a.pdf", "a.pdf", None,
                                    "https://base/x.pdf.y.pdf"]
    assert [r.stem for r in out] == ["a", "a", "a", None, "x.y"]
    lab = spark.createDataFrame([("Topic(s): X",)], "c string").select(strip_label("c", "Topic(s):").alias("t"))
    assert lab.first().t == " X"  # the space is kept


def test_concat_key_missing_is_nan(spark):
    df = spark.createDataFrame([("f", None, 1), ("f1", "", 1), ("f", "1", 1)], "a string, b string, n int")
    keys = [r.k for r in df.select(concat_key("a", "b", "n").alias("k")).collect()]
    assert keys == ["fnan1", "f11", "f11"]  # no separator: collisions are possible, as in the source


def test_keyed_hash_equals_stdlib_hmac(spark):
    key = "clé-secrète-ü"
    msgs = ["password", "héllo wörld", "", "ß" * 100]
    df = spark.createDataFrame([(m,) for m in msgs], "m string")
    got = [r.h for r in df.select(keyed_hash("m", key).alias("h")).collect()]
    want = [hmac.new(key.encode(), m.encode(), hashlib.sha256).hexdigest() for m in msgs]
    assert got == want
    long_key = "k" * 100  # longer than the block: hashed first
    got = df.select(keyed_hash("m", long_key).alias("h")).first().h
    assert got == hmac.new(long_key.encode(), msgs[0].encode(), hashlib.sha256).hexdigest()


def test_vector_text_codec(spark):
    df = spark.createDataFrame([("[[ 1.0e+00 -2.5\n 3]]",)], "t string")
    assert df.select(parse_vector_text("t").alias("v")).first().v == [1.0, -2.5, 3.0]
    vec = spark.createDataFrame([([0.125, -1.5, 2.0],)], "v array<float>")
    txt = vec.select(format_vector_text("v", 6).alias("t"))
    assert txt.first().t == "[[ 0.125000 -1.500000 2.000000]]"
    assert txt.select(parse_vector_text("t").alias("v")).first().v == [0.125, -1.5, 2.0]
