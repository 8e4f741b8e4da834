"""Importance resampling of documents towards a target distribution.

Features are all runs of one to three words, hashed by CRC-32 into ``BUCKETS``
buckets.  The gain of a bucket compares its share of the target texts with its
share of the documents; a document's weight is the sum over its features, its
score the weight plus Gumbel noise seeded by its id, and the highest scores are
drawn: a sample without replacement by importance.

Feature hashing runs over whole Arrow buffers in numpy: the CRC of a run of
words follows from the CRCs of its parts (CRC is linear), so no string is ever
built.  The final order comes from a distributed least-significant-digit radix
sort (:func:`radix_sort`): one stable counting-sort pass per digit of the
composite key (score descending, id ascending).
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import cut, shuffle_width

BUCKETS = 10_000
MIN_WORDS = 20
PERCENT = 5
SEED = "42"
# bytes of text hashed at a time; one word may exceed it
SEGMENT = 1 << 21
# words above this many bytes are hashed one by one
LONG_WORD = 40
# bits of a radix digit: a pass counts at most 2^14 digit values
DIGIT_BITS = 14
# rows of a block of the sort, the unit that one call holds in memory
BLOCK_ROWS = 1 << 16
SIGN = -(1 << 63)

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.zeros(256, dtype=bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True


def _byte_table() -> np.ndarray:
    """The CRC-32 register after one byte, from its polynomial."""
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> 1) ^ np.uint32(0xEDB88320), c >> 1).astype(np.uint32)
    return c


_BYTE = _byte_table()


def _shift_tables(longest: int) -> np.ndarray:
    """``[n, k, b]``: the register that holds byte b in place k, after n zero bytes."""
    out = np.empty((longest + 1, 4, 256), dtype=np.uint32)
    out[0] = np.arange(256, dtype=np.uint32)[None, :] << (8 * np.arange(4, dtype=np.uint32))[:, None]
    for n in range(longest):
        out[n + 1] = (out[n] >> 8) ^ _BYTE[out[n] & 255]
    return out


_SHIFT = _shift_tables(LONG_WORD + 1)
_SPACE = np.uint32(zlib.crc32(b" "))


def _shifted(crc: np.ndarray, n: np.ndarray) -> np.ndarray:
    """CRCs followed by n zero bytes each: ``crc(a + b) = shifted(crc(a), len(b)) ^ crc(b)``."""
    return (_SHIFT[n, 0, crc & 255] ^ _SHIFT[n, 1, (crc >> 8) & 255]
            ^ _SHIFT[n, 2, (crc >> 16) & 255] ^ _SHIFT[n, 3, crc >> 24])


def _segments(is_word: np.ndarray, first: np.ndarray) -> Iterator[tuple[int, int]]:
    """Byte ranges of about SEGMENT bytes that end between words."""
    start, size = 0, len(is_word)
    while start < size:
        end = min(start + SEGMENT, size)
        while end < size:
            free = np.flatnonzero(~is_word[start:end] | first[start + 1 : end + 1])
            if len(free):
                end = start + int(free[-1]) + 1
                break
            end = min(start + 2 * (end - start), size)
        yield start, end
        start = end


def hashed_runs(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[np.ndarray, list[np.ndarray]]]:
    """Texts as bytes with their offsets: for some words at a time, the number of
    each word's text and, per run length, (CRCs, words they end at).

    A run ends at its word, so a segment needs of the words before it only the
    last one's CRCs, which are carried over.
    """
    is_word = _IS_WORD[data]
    first = np.zeros(len(data) + 1, dtype=bool)
    first[offsets] = True
    last_doc, last_one, last_two, has_two = -1, np.uint32(0), np.uint32(0), False
    for start, end in _segments(is_word, first):
        here = is_word[start:end]
        before = np.empty_like(here)
        before[0], before[1:] = False, here[:-1]
        after = np.empty_like(here)
        after[-1], after[:-1] = False, here[1:]
        begin = np.flatnonzero(here & (~before | first[start:end]))
        if not len(begin):
            continue
        length = np.flatnonzero(here & (~after | first[start + 1 : end + 1])) + 1 - begin
        doc = np.searchsorted(offsets, begin + start, side="right") - 1
        low = _LOWER[data[start:end]]
        one = np.full(len(begin), 0xFFFFFFFF, dtype=np.uint32)
        shrinking = -np.minimum(length, LONG_WORD + 1).astype(np.int16)
        order = np.argsort(shrinking, kind="stable")
        at, shrinking, register = begin[order], shrinking[order], one[order]
        n_long = int(np.searchsorted(shrinking, -LONG_WORD, side="left"))
        for j in range(min(-int(shrinking[0]), LONG_WORD)):
            live = int(np.searchsorted(shrinking, -j, side="left"))  # words longer than j
            part = register[n_long:live]
            register[n_long:live] = _BYTE[(part ^ low[at[n_long:live] + j]) & 255] ^ (part >> 8)
        one[order] = register ^ np.uint32(0xFFFFFFFF)
        long = order[:n_long]
        for i in long:
            one[i] = zlib.crc32(low[begin[i] : begin[i] + length[i]])
        short = np.minimum(length, LONG_WORD)
        spaced = _shifted(np.full(len(one), _SPACE), short) ^ one  # " " and the word

        def longer(runs: np.ndarray) -> np.ndarray:
            """The runs, each followed by a space and its word."""
            out = _shifted(runs, short + 1) ^ spaced
            for i in long:
                out[i] = zlib.crc32(b" " + low[begin[i] : begin[i] + length[i]].tobytes(), int(runs[i]))
            return out

        same = np.empty(len(doc), dtype=bool)
        same[0], same[1:] = doc[0] == last_doc, doc[1:] == doc[:-1]
        two = longer(np.concatenate([[last_one], one[:-1]]).astype(np.uint32))
        third = same.copy()
        third[0] &= has_two
        third[1:] &= same[:-1]
        three = longer(np.concatenate([[last_two], two[:-1]]).astype(np.uint32))
        last_doc, last_one, last_two, has_two = doc[-1], one[-1], two[-1], bool(same[-1])
        yield doc, [(one, slice(None)), (two, same), (three, third)]


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string array (null: empty)."""
    texts = texts.fill_null("").cast(pa.large_string())
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def bucket_counts(texts: DataFrame, column: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features in every bucket over all rows: one array per task, summed by
    bucket, so at most ``buckets`` rows reach the driver."""

    def run(batches):
        counts = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for _, runs in hashed_runs(*_buffers(batch.column(0))):
                for crc, ends in runs:
                    counts += np.bincount(crc[ends] % buckets, minlength=buckets)
        some = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(counts[some])], names=["bucket", "n"])

    rows = texts.select(F.col(column)).mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect()
    out = np.zeros(buckets, dtype=np.int64)
    for bucket, n in rows:
        out[bucket] = n
    return out


def bucket_gains(raw: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln((t+1)(S+B) / ((s+1)(T+B)))) of every bucket, in doubles."""
    buckets, raw_all, target_all = len(raw), float(raw.sum()), float(target.sum())
    return np.array([math.floor(1000 * math.log((t + 1.0) * (raw_all + buckets) / ((s + 1.0) * (target_all + buckets))))
                     for s, t in zip(raw.tolist(), target.tolist())], dtype=np.int64)


def noise(doc_id: int | None, seed: str = SEED) -> int:
    """Gumbel noise of an id, in thousandths (a null id counts as the text ``null``)."""
    name = "null" if doc_id is None else str(doc_id)
    h = int(hashlib.sha256(f"{seed}:{name}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def weigh(docs: DataFrame, gains: np.ndarray, seed: str = SEED) -> DataFrame:
    """(task, slot, doc_id, n_words, n_features, weight, score) per row; task
    and slot number the rows."""
    schema = pa.schema([("task", pa.int64()), ("slot", pa.int64()), ("doc_id", pa.int64()), ("n_words", pa.int64()),
                        ("n_features", pa.int64()), ("weight", pa.int64()), ("score", pa.int64())])

    def run(batches):
        task, done = TaskContext.get().partitionId(), 0
        for batch in batches:
            ids, rows = batch.column(0), batch.num_rows
            words, weight = np.zeros(rows, dtype=np.int64), np.zeros(rows, dtype=np.int64)
            for doc, runs in hashed_runs(*_buffers(batch.column(1))):
                words += np.bincount(doc, minlength=rows)
                for crc, ends in runs:
                    np.add.at(weight, doc[ends], gains[crc[ends] % len(gains)])
            score = weight + np.array([noise(i, seed) for i in ids.to_pylist()], dtype=np.int64)
            features = words + np.maximum(words - 1, 0) + np.maximum(words - 2, 0)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(rows, task)), pa.array(np.arange(done, done + rows)), ids,
                                              *map(pa.array, (words, features, weight, score))], schema=schema)
            done += rows

    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "task long, slot long, doc_id long, n_words long, n_features long, weight long, score long")


def _digit(key: str, shift: int):
    return F.shiftrightunsigned(F.col(key), shift).bitwiseAND(F.lit((1 << DIGIT_BITS) - 1)).cast("int")


def _scatter(key: str, shift: int, block_rows: int, columns: list[str]):
    """One block of a pass: a stable counting sort by the digit, then every row
    to its destination, the digit's offset for this block plus the row's place
    among the block's equal digits."""

    def run(rows: pa.Table, starts: pa.Table) -> pa.Table:
        rows = rows.take(np.argsort(rows["slot"].to_numpy(), kind="stable"))
        digit = ((rows[key].to_numpy().view(np.uint64) >> np.uint64(shift)) & np.uint64((1 << DIGIT_BITS) - 1)).astype(np.uint16)
        order = np.argsort(digit, kind="stable")
        first = np.zeros(1 << DIGIT_BITS, dtype=np.int64)
        first[starts["digit"].to_numpy()] = starts["start"].to_numpy()
        count = np.bincount(digit, minlength=1 << DIGIT_BITS)
        local = np.arange(len(order)) - (np.cumsum(count) - count)[digit[order]]
        to = first[digit[order]] + local
        moved = rows.take(order)
        return pa.table([pa.array(to // block_rows), pa.array(to % block_rows), *(moved[c] for c in columns)], names=["block", "slot", *columns])

    return run


def radix_sort(rows: DataFrame, keys: list[str], count: int, name: str) -> DataFrame:
    """Rows (``block`` and ``slot`` long: unique numbers; further long columns)
    with ``position`` (from 0) in ascending order of the keys as *unsigned* 64-bit
    numbers, the first key leading.  Equal keys keep the order of block and slot.

    Digits are served from the last key's lowest to the first key's highest;
    digits in which all rows agree need no pass.  A pass counts each block's
    digits (map-side combined), turns the counts into destinations by two prefix
    sums (over digits, and over the blocks of a digit) and moves every row once.
    Blocks have equal sizes, so no pass is skewed however the keys are; each
    pass is written, so a lost executor repeats one block of one pass.
    """
    columns = [c for c in rows.columns if c not in ("block", "slot")]
    blocks = max(shuffle_width(rows.sparkSession), -(-count // BLOCK_ROWS))
    block_rows = max(1, -(-count // blocks))
    agree = rows.agg(*[F.bit_or(k).bitwiseXOR(F.bit_and(k)).alias(k) for k in keys]).first()
    mask = (1 << DIGIT_BITS) - 1
    passes = [(key, shift) for key in reversed(keys) for shift in range(0, 64, DIGIT_BITS) if ((agree[key] or 0) >> shift) & mask]
    for key, shift in passes or [(keys[-1], 0)]:  # rows that all agree are still numbered
        counts = rows.groupBy("block", _digit(key, shift).alias("digit")).agg(F.count("*").alias("n"))
        below = Window.orderBy("digit").rowsBetween(Window.unboundedPreceding, -1)  # at most 2^14 rows
        totals = counts.groupBy("digit").agg(F.sum("n").alias("n")).select("digit", F.coalesce(F.sum("n").over(below), F.lit(0)).alias("base"))
        before = Window.partitionBy("digit").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
        within = counts.withColumn("within", F.coalesce(F.sum("n").over(before), F.lit(0)))
        starts = within.join(F.broadcast(totals), "digit").select(
            F.col("block").alias("of_block"), "digit", (F.col("base") + F.col("within")).alias("start"))
        moved = rows.groupBy("block").cogroup(starts.groupBy("of_block")).applyInArrow(_scatter(key, shift, block_rows, columns), rows.schema)
        rows = cut(moved, f"{name}-{key}-{shift}")
    return rows.select((F.col("block") * block_rows + F.col("slot")).alias("position"), *columns)


def resample(docs: DataFrame, target: DataFrame, percent: int = PERCENT, min_words: int = MIN_WORDS, seed: str = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) per document row.

    Of the N rows with at least ``min_words`` words, floor(percent * N / 100)
    are drawn; ``rank`` counts them from the highest score, ties to the smaller
    id; undrawn rows have a null rank.  Null or empty texts have no features, a
    weight of 0 and are never drawn.  A null id ranks behind all others of its
    score.  Rows that repeat an id are weighed each by its own text; if their
    scores agree too, they follow each other in the order of the scan.  Without
    a target or documents the gains come from the add-one counts alone; an empty
    table gives an empty result.  Extra columns of any name are ignored.
    """
    gains = bucket_gains(bucket_counts(docs), bucket_counts(target))
    weighed = cut(weigh(docs, gains, seed), "resample-weights")
    able = weighed.where(F.col("n_words") >= min_words)
    count, top = able.agg(F.count("*"), F.max("score")).first()
    draws = percent * count // 100
    keyed = able.select(F.col("task").alias("block"), "slot", (F.lit(top) - F.col("score")).cast("long").alias("high"),
                        F.coalesce(F.col("doc_id").bitwiseXOR(F.lit(SIGN)), F.lit(-1).cast("long")).alias("low"),
                        F.col("task").alias("_task"), F.col("slot").alias("_slot"))
    # the first pass takes the scan's tasks as blocks, the later ones blocks of equal size
    ordered = radix_sort(keyed, ["high", "low"], count, "resample")
    drawn = ordered.where(F.col("position") < draws).select("_task", "_slot", (F.col("position") + 1).alias("rank"))
    return weighed.join(drawn, (weighed["task"] == drawn["_task"]) & (weighed["slot"] == drawn["_slot"]), "left").select(
        "doc_id", "n_features", "weight", "score", "rank")
