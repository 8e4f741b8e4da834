"""Encoding and decoding in one step."""

import public_tokenizers

from docsift.llm import bpe
from docsift.llm import queries as llm

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN


def test_ids_and_their_bytes_come_from_one_worker_a_core(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(bpe, "BLOCK_CHARS", 40)
    rows = [(i, t) for i, t in enumerate(["plain words", "", None, "ñandú 你好 🙂 <|endoftext|>", "a\n\n  b\t1234567 don't" * 9, "x" * 300])] + [(None, "no id"), (1, "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    whole = bpe.encode(docs, PATH, PATTERN, keep=["doc_id", "text"], decoded=True).collect()
    assert [(r.doc_id, r.text) for r in whole] == rows
    assert [bytes(r.decoded) for r in whole] == [(r.text or "").encode() for r in whole]
    alone = bpe.encode(docs, PATH, PATTERN, keep=["doc_id", "text"])
    assert [(r.text, r.ids) for r in alone.collect()] == [(r.text, r.ids) for r in whole]
    assert [bytes(r.decoded) for r in bpe.decode(alone, PATH, PATTERN).collect()] == [bytes(r.decoded) for r in whole]
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    plan = llm.queries()["op9_byte_bpe"](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow") == 1
