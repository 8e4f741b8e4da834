from docsift.operators.chunking import chunk_documents, chunk_pages, chunk_sections, split_valid


def _docs(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


def _rows(df):
    return [(r.doc_id, r.Chunk_No, r.Chunk_Content, r.Number_of_Words, r.Total_Tokens_in_PDF)
            for r in df.orderBy("doc_id", "Chunk_No").collect()]


def test_plain_sections_drop_preamble(spark):
    out = chunk_sections(_docs(spark, ["pre **A** x {y} **B**"]), "text")
    assert _rows(out) == [(0, 1, "A\nx y", 2, 2), (0, 2, "B\n", 0, 2)]


def test_empty_null_and_no_heading_give_no_rows(spark):
    out = chunk_sections(_docs(spark, ["", None, "just text"]), "text")
    assert out.count() == 0


def test_standalone_hash_heading_is_quarantined(spark):
    docs = _docs(spark, ["## x ## t **A** b", "**C** ok"])
    good, bad = split_valid(docs, "text")
    assert [r.doc_id for r in bad.collect()] == [0]
    assert _rows(chunk_sections(good, "text")) == [(1, 1, "C\nok", 1, 1)]


def test_swallowed_heading(spark):
    out = chunk_sections(_docs(spark, ["## a **b** ## tail"]), "text")
    assert _rows(out) == [(0, 1, "## a b ##\n## tail", 2, 2)]


def test_blank_page_running_words(spark):
    out = chunk_pages(_docs(spark, ["a b\n\nc"]), "text")
    assert _rows(out) == [(0, 1, "a b", 2, 2), (0, 2, "", 0, 2), (0, 3, "c", 1, 3)]


def test_strategy_switch_validates(spark):
    import pytest

    docs = _docs(spark, ["**A** b"])
    with pytest.raises(ValueError):
        chunk_documents(docs, "Pages")  # names match exactly, case included
    chunks, bad = chunk_documents(docs, "sections")
    assert chunks.count() == 1 and bad.count() == 0


def test_running_total_equals_document_words(spark):
    texts = ["one two\nthree\n\nfour five six", "x", "\n\n"]
    out = chunk_pages(_docs(spark, texts), "text")
    last = {r.doc_id: r.Total_Tokens_in_PDF for r in out.collect() if r.Chunk_No == len(texts[r.doc_id].split("\n"))}
    assert last == {i: len(t.split()) for i, t in enumerate(texts)}


def test_sections_guard_and_single_pattern_evaluation(spark):
    docs = _docs(spark, ["## x ## no body marks", "**C**\nok"])
    out = chunk_sections(docs, "text", running=False)
    assert [r.Chunk_Content for r in out.collect()] == ["C\nok"]
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_extract_all") == 1 and "ArrowEvalPython" not in plan
