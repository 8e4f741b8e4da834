"""Chat formatting with offset-aligned loss masks.

A conversation's turns (ordered by turn, then role and text) are rendered with
the template ``<turn>role\\ntext</turn>\\n``.  A backslash and the template's
own marks inside roles and texts (and line ends inside roles) get a backslash
in front, which :func:`parse` undoes exactly.  The whole rendering is encoded
once with character offsets; the sorted spans of the assistant's texts are
intersected with the token spans by binary search.  A token that straddles a
span's edge is in the mask with the part inside the span only, so the text
under the mask is exactly the assistant's.

One conversation is one output row, so its text has to fit a worker; rows are
streamed in sorted order and only one conversation is held at a time.

Defined results: null texts and roles are empty; rows that repeat a turn are
all rendered; a null turn comes first; each row with a null conversation id is
a conversation of its own; an empty table gives an empty result; further
columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

OPEN, CLOSE = "<turn>", "</turn>"
_MARKS = re.compile(r"\\|</?turn>")
_ROLE_MARKS = re.compile(r"\\|</?turn>|\n")
_ESCAPED = re.compile(r"\\(.)", re.S)
_TURN = re.compile(r"<turn>((?:[^\\\n<]|\\.|<(?!/?turn>))*)\n((?:[^\\<]+|\\.|<(?!/?turn>))*)</turn>\n", re.S)
SCHEMA = ("conv_id long, formatted string, input_ids array<int>, token_start array<int>, token_end array<int>, "
          "loss_mask array<boolean>, loss_start array<int>, loss_end array<int>")


def render(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """The formatted text and the spans of the assistant's (escaped) texts."""
    out, at, spans = [], 0, []
    for role, text in turns:
        head = OPEN + _ROLE_MARKS.sub(lambda m: "\\" + m[0], role) + "\n"
        body = _MARKS.sub(lambda m: "\\" + m[0], text)
        out += [head, body, CLOSE + "\n"]
        if role == "assistant":
            spans.append((at + len(head), at + len(head) + len(body)))
        at += len(head) + len(body) + len(CLOSE) + 1
    return "".join(out), spans


def unescape(s: str) -> str:
    return _ESCAPED.sub(r"\1", s)


def parse(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted text."""
    turns, at = [], 0
    while at < len(formatted):
        m = _TURN.match(formatted, at)
        if m is None:
            raise ValueError(f"no turn at {at}")
        turns.append((unescape(m[1]), unescape(m[2])))
        at = m.end()
    return turns


def align(spans: list[tuple[int, int]], start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per token: whether it meets a span, and the part inside it.  Token
    starts and ends and the spans are sorted."""
    mask, lo, hi = np.zeros(len(start), bool), np.zeros(len(start), np.int32), np.zeros(len(start), np.int32)
    begin, stop = (np.array(x, np.int32) for x in (zip(*spans) if spans else ((), ())))
    firsts, lasts = np.searchsorted(end, begin, "right"), np.searchsorted(start, stop, "left")
    for s, e, first, last in zip(begin, stop, firsts.tolist(), lasts.tolist()):
        if s < e and first < last:
            part = slice(first, last)
            mask[part] = True
            lo[part], hi[part] = np.maximum(start[part], s), np.minimum(end[part], e)
    return mask, lo, hi


def masked_text(formatted: str, lo: np.ndarray, hi: np.ndarray) -> str:
    """Unescaped text under the mask: overlapping and touching parts (tokens of
    one character, neighbours) are merged before the escapes are undone."""
    some = lo < hi
    lo, hi = lo[some], hi[some]
    if not len(lo):
        return ""
    reach = np.maximum.accumulate(hi)
    new = np.flatnonzero(lo[1:] > reach[:-1]) + 1
    begins, stops = lo[np.append(0, new)], reach[np.append(new - 1, len(hi) - 1)]
    return "".join([unescape(formatted[s:e]) for s, e in zip(begins.tolist(), stops.tolist())])


@lru_cache(maxsize=2)
def _tokenizer(path: str):
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer, processors

    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True                   # their strings in a text are ordinary text
    t.post_processor = processors.ByteLevel(trim_offsets=False)
    t.no_truncation()
    t.no_padding()
    return t


def format_conversations(rows: DataFrame, tokenizer: str) -> DataFrame:
    """``rows`` (conv_id, turn, role, text) -> one row per conversation."""
    lists = ("input_ids", "token_start", "token_end", "loss_mask", "loss_start", "loss_end")

    def run(batches):
        t = _tokenizer(tokenizer)
        ids, texts, parts, size, last, turns = [], [], [], 0, None, []

        def done(conv):
            text, spans = render(turns)
            code = t.encode(text, add_special_tokens=False)
            tokens = code.ids
            off = np.fromiter(chain.from_iterable(code.offsets), np.int32, 2 * len(tokens)).reshape(-1, 2)
            ids.append(conv), texts.append(text)
            parts.append((np.array(tokens, np.int32), off[:, 0], off[:, 1], *align(spans, off[:, 0], off[:, 1])))
            turns.clear()
            return len(text)

        def drain():
            edges = pa.array(np.cumsum([0, *(len(p[0]) for p in parts)]), pa.int32())
            flat = [pa.ListArray.from_arrays(edges, pa.array(np.concatenate(column))) for column in zip(*parts)]
            out = pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), *flat], names=["conv_id", "formatted", *lists])
            ids.clear(), texts.clear(), parts.clear()
            return out

        for b in batches:
            for conv, role, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
                if turns and (conv is None or conv != last):
                    size += done(last)
                    if size > 1_000_000:
                        yield drain()
                        size = 0
                turns.append((role or "", text or ""))
                last = conv
        if turns:
            done(last)
        if ids:
            yield drain()

    narrow = rows.select(F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text")
    salt = F.when(F.col("conv_id").isNull(), F.xxhash64("turn", "role", "text"))
    dealt = narrow.withColumn("_salt", salt).repartition("conv_id", "_salt").sortWithinPartitions("conv_id", "turn", "role", "text")
    return dealt.select("conv_id", "role", "text").mapInArrow(run, SCHEMA)


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests of what a formatted row holds, from the row alone."""
    import hashlib

    def run(batches):
        for b in batches:
            out = []
            mask, lo, hi = (b.column(c) for c in ("loss_mask", "loss_start", "loss_end"))
            for i, (conv, text) in enumerate(zip(b.column("conv_id").to_pylist(), b.column("formatted"))):
                text = text.as_py()
                under = mask[i].values.to_numpy(zero_copy_only=False)
                turns = parse(text)
                loss = masked_text(text, lo[i].values.to_numpy()[under], hi[i].values.to_numpy()[under])
                whole = "".join(f"{role}\n{said}\n" for role, said in turns)
                out.append((conv, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                            hashlib.sha256(loss.encode()).hexdigest(), len(text), len(under)))
            cols = list(zip(*out)) if out else [[]] * 7
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds)],
                                             names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars", "n_tokens"])

    return formatted.mapInArrow(run, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long, n_tokens long")
