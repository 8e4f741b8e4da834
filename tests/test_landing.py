"""Whole texts landed as one file per document."""

import os

from docsift.plans.q_io import _land_texts
from docsift.sources.files import read_document_bytes, read_markdown


def test_documents_land_as_files_without_a_folder_each(spark, tmp_path):
    rows = [(i, f"text {i}\nñ") for i in range(60)] + [(7, "text 7\nñ"), (60, None), (61, "")]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    path = _land_texts(spark, str(tmp_path))
    folders = {folder for folder, _, files in os.walk(path) if any(f.endswith(".txt") for f in files)}
    assert 0 < len(folders) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = {r.file_name: r.text for r in read_markdown(spark, path).collect()}
    assert len(texts) == 62 and texts["doc_id=3.txt"] == "text 3\nñ\n"
    assert texts["doc_id=7.txt"] == "text 7\nñ\n" * 2 and texts["doc_id=60.txt"] == texts["doc_id=61.txt"] == "\n"
    sizes = {r.file_name: r.length for r in read_document_bytes(spark, path, glob="*.txt").collect()}
    assert sizes == {name: len(text.encode()) for name, text in texts.items()}


def test_files_are_listed_and_read_by_tasks(spark, tmp_path, monkeypatch):
    """As Spark's readers see a folder, but none of them lists it on the driver."""
    from docsift.sources import files

    top = tmp_path / "in"
    for name, content in {"a b/n%20m.txt": b"x\n", "a b/\u00e9 \u00fc.txt": b"\xff\n", "a b/empty.txt": b"", "a b/_h.txt": b"h", "_hid/x/z.txt": b"z", "_k=1/deep/er/q.txt": b"q",
                          ".dot/z.txt": b"z", "top.md": b"md", ".y.txt": b"y"}.items():
        (top / name).parent.mkdir(parents=True, exist_ok=True)
        (top / name).write_bytes(content)

    def whole(glob=None, at=top):
        reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
        return sorted((r.path, r.length, bytes(r.content)) for r in (reader.option("pathGlobFilter", glob) if glob else reader).load(str(at)).select("path", "length", "content").collect())

    def texts(at=top):
        return sorted(spark.read.option("recursiveFileLookup", "true").text(str(at), wholetext=True).selectExpr("_metadata.file_path", "cast(value as binary)").collect())

    cases = [None, "*.txt", "{n,t}*.[tm]*"]
    want, want_texts = [whole(g) for g in cases] + [whole(at=top / "*/*.txt")], texts()
    one = whole(at=top / "top.md")
    assert len(want[0]) == 4 and len(want[2]) == 2
    monkeypatch.setattr(type(spark.read), "load", lambda *a, **b: 1 / 0)
    monkeypatch.setattr(type(spark.read), "text", lambda *a, **b: 1 / 0)
    monkeypatch.setattr(files, "LISTED_ROWS", 1)
    got = [read_document_bytes(spark, str(top), g) for g in cases] + [read_document_bytes(spark, str(top / "*/*.txt"))]
    assert [sorted((r.path, r.length, bytes(r.content)) for r in df.collect()) for df in got] == want
    assert sorted(read_markdown(spark, str(top)).selectExpr("path", "cast(text as binary)").collect()) == want_texts
    assert [(r.path, r.length, bytes(r.content)) for r in read_document_bytes(spark, str(top / "top.md")).collect()] == one
    assert read_markdown(spark, str(top), ".md").collect()[0].file_name == "top.md"
    (tmp_path / "none").mkdir()
    assert read_document_bytes(spark, str(tmp_path / "none")).count() == 0


def test_folders_stay_small_and_only_texts_of_repeated_keys_are_moved(spark, tmp_path, monkeypatch):
    from docsift.sources import files

    monkeypatch.setattr(files, "FOLDER_FILES", 10)
    sorts, keep = [], type(spark.range(0)).sortWithinPartitions
    monkeypatch.setattr(type(spark.range(0)), "sortWithinPartitions", lambda df, *a, **b: sorts.append(df.count()) or keep(df, *a, **b))
    rows = [(i, f"t{i}") for i in range(100)]
    files.write_texts(spark.createDataFrame(rows, "k long, t string"), str(tmp_path / "once"), "k", "t")
    assert not sorts
    files.write_texts(spark.createDataFrame(rows + [(3, "t3"), (None, "x"), (None, "x")], "k long, t string"), str(tmp_path / "twice"), "k", "t")
    assert sorts == [4]
    for at, n in (("once", 100), ("twice", 101)):
        assert len(os.listdir(tmp_path / at)) == -(-n // 10)
        got = {r.file_name: r.text for r in read_markdown(spark, str(tmp_path / at)).collect()}
        assert len(got) == n and got["k=7.txt"] == "t7\n"
    assert got["k=3.txt"] == "t3\nt3\n" and got["k=__HIVE_DEFAULT_PARTITION__.txt"] == "x\nx\n"
