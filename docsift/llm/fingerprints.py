"""Document fingerprints: invertible Bloom lookup sketches of pieces.

A text is cut by its content: after every code point where a rolling hash of
the last ``WINDOW`` code points has its top bits 0 (one of ``1 << CUT_BITS``),
so that a cut depends on the text around it only, and wherever a piece would
exceed ``LONGEST`` code points.  Language, spaces and line ends play no part.
The pieces give 64-bit digests, numbered when they repeat.  A sketch has three rows of cells;
each digest goes into one cell of every row, which holds a count, the XOR of
its digests and of their checks.  Two versions' sketches are subtracted cell by
cell: what both hold cancels out, and peeling cells with one digest left gives
the differing digests.  If cells remain, both sides are sketched four times
larger and peeled again, until all are recovered.

``likeness`` is 1 minus the differing digests' share of both texts' digests.

Neighbours: every document is also compared with the next one by ascending id
and with an edited version, whose last quarter is replaced by the start of the
next document.  Documents are dealt to ranges of ids and streamed in order;
the first document of each range goes to the range before as well (the very
first to the last range), so no text meets more than its neighbour.

Defined results: null and empty texts have no digests, and two of them are
alike (1.0); rows that repeat an id follow each other ordered by text; a row
with a null id has no next document: the next text is empty; a single document
is followed by itself; an empty table gives an empty result; further columns
are ignored, whatever their names.
"""

from __future__ import annotations

import base64
import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import dealt, key_bounds, range_number, shuffle_width

WINDOW, CUT_BITS, LONGEST = 8, 5, 96       # code points; pieces have some 30 on average
CELLS = 8                                  # cells in each of the three rows of a fingerprint
_C = [np.uint64(c) for c in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93)]
_ROWS = np.array(_C[:3], np.uint64)[:, None]
SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def piece_ends(codes: np.ndarray) -> np.ndarray:
    """Where the pieces of a text's code points (uint32) end."""
    h = (codes + np.uint32(1)) * np.uint32(0x9E3779B1)
    h ^= h >> np.uint32(15)
    width, base = 1, 0x85EBCA6B
    while width < WINDOW and len(h) > width:             # hashes of twice as many code points
        h = h[:-width] * np.uint32(base) + h[width:]
        width, base = 2 * width, base * base & 0xFFFFFFFF
    found = np.flatnonzero((h * np.uint32(0xC2B2AE35)) >> np.uint32(32 - CUT_BITS) == 0) + WINDOW if width == WINDOW else np.zeros(0, np.int64)
    ends = np.append(found, len(codes)) if len(codes) and (not len(found) or found[-1] < len(codes)) else found
    size = np.diff(ends, prepend=0)
    more = (size - 1) // LONGEST
    if not more.any():
        return ends
    nth = np.arange(more.sum()) - np.repeat(np.cumsum(more) - more, more) + 1
    return np.sort(np.append(ends, np.repeat(ends - size, more) + nth * LONGEST))


class Sketches:
    """A text's digests and its sketches of any size."""

    def __init__(self, text: str):
        raw, begin = text.encode("utf-32-le"), 0
        times: dict[bytes, int] = {}
        keys = []
        for end in (4 * piece_ends(np.frombuffer(raw, "<u4"))).tolist():
            p = raw[begin:end]
            n = times[p] = times.get(p, 0) + 1
            keys.append(xxhash.xxh3_64_intdigest(p, n))
            begin = end
        # distinct, or two equal digests would never peel
        self.keys = np.unique(np.array(keys, np.uint64))
        self.made: dict[int, tuple] = {}

    def of(self, cells: int) -> tuple:
        if cells not in self.made:
            count, key, check = np.zeros(3 * cells, np.int64), np.zeros(3 * cells, np.uint64), np.zeros(3 * cells, np.uint64)
            _put(count, key, check, self.keys, np.ones(len(self.keys), np.int64), cells)
            self.made[cells] = (count, key, check)
        return self.made[cells]

    def fingerprint(self) -> str:
        count, key, check = self.of(CELLS)
        return base64.b64encode(count.astype("<i4").tobytes() + key.astype("<u8").tobytes() + (check >> np.uint64(32)).astype("<u4").tobytes()).decode()


def _check(keys: np.ndarray) -> np.ndarray:
    x = keys * _C[3]
    return (x ^ (x >> np.uint64(31))) * _C[1]


def _put(count, key, check, keys, sign, cells: int) -> None:
    mixed = keys ^ (keys >> np.uint64(29))
    at = ((((mixed * _ROWS) >> np.uint64(33)) % np.uint64(cells)).astype(np.int64) + np.arange(0, 3 * cells, cells)[:, None]).reshape(-1)
    checks = _check(keys)
    np.add.at(count, at, np.concatenate((sign, sign, sign)))
    np.bitwise_xor.at(key, at, np.concatenate((keys, keys, keys)))
    np.bitwise_xor.at(check, at, np.concatenate((checks, checks, checks)))


def peel(a: tuple, b: tuple, cells: int) -> tuple[np.ndarray, np.ndarray] | None:
    """Digests only in ``a`` and only in ``b``; None if they don't all come out."""
    count, key, check = a[0] - b[0], a[1] ^ b[1], a[2] ^ b[2]
    only = ([], [])
    while True:
        pure = np.flatnonzero((np.abs(count) == 1) & (check == _check(key)))
        if not len(pure):
            break
        keys, first = np.unique(key[pure], return_index=True)
        sign = count[pure[first]]
        only[0].append(keys[sign > 0]), only[1].append(keys[sign < 0])
        _put(count, key, check, keys, -sign, cells)
    if count.any() or key.any() or check.any():
        return None
    return tuple(np.concatenate(x) if x else np.zeros(0, np.uint64) for x in only)


def difference(a: Sketches, b: Sketches) -> tuple[np.ndarray, np.ndarray]:
    """The differing digests, from sketches that grow until they peel.  The
    first size comes from the smallest sketches' counts: what both texts hold
    cancels out, and each other digest adds 1 to the expected sum of squares of
    a row (besides the share of the texts' difference in number).  Too low a
    guess is one more retry."""
    count, surplus = a.of(CELLS)[0] - b.of(CELLS)[0], len(a.keys) - len(b.keys)
    guess = float(count @ count) / 3 - surplus * surplus / CELLS
    cells = CELLS
    while 3 * cells < 1.2 * guess:
        cells *= 4
    while True:
        got = peel(a.of(cells), b.of(cells), cells)
        if got is not None:
            return got
        cells *= 4


def likeness(a: Sketches, b: Sketches) -> float:
    n = len(a.keys) + len(b.keys)
    left, right = difference(a, b)
    return 1.0 - (len(left) + len(right)) / n if n else 1.0


def compare_versions(df: DataFrame, old: str, new: str) -> DataFrame:
    """``df``'s rows as (old_fingerprint, new_fingerprint, only_old, only_new,
    likeness): the digests (as signed longs) that tell two versions apart."""

    def run(batches):
        for b in batches:
            out = []
            for x, y in zip(b.column(0), b.column(1)):
                s, t = Sketches(x.as_py() or ""), Sketches(y.as_py() or "")
                left, right = difference(s, t)
                out.append({"old_fingerprint": s.fingerprint(), "new_fingerprint": t.fingerprint(), "only_old": np.sort(left.view(np.int64)).tolist(),
                            "only_new": np.sort(right.view(np.int64)).tolist(), "likeness": likeness(s, t)})
            yield pa.RecordBatch.from_pylist(out, schema=pa.schema([
                ("old_fingerprint", pa.string()), ("new_fingerprint", pa.string()), ("only_old", pa.list_(pa.int64())),
                ("only_new", pa.list_(pa.int64())), ("likeness", pa.float64())]))

    return df.select(F.col(old).alias("o"), F.col(new).alias("n")).mapInArrow(
        run, "old_fingerprint string, new_fingerprint string, only_old array<long>, only_new array<long>, likeness double")


def fingerprint_neighbours(docs: DataFrame) -> DataFrame:
    """Fingerprints of every document and its edited version, and their
    likeness to each other and to the next document's."""
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text"))
    bounds = key_bounds(rows, "id", 2 * shuffle_width(docs.sparkSession))
    at = range_number(F.col("id"), bounds)
    first = F.get(F.array(*[F.lit(b) for b in bounds]), at) == F.col("id") if bounds else F.lit(False)
    own = F.struct(at.alias("rng"), F.lit(0).alias("ahead"))
    before = F.when(at > 0, at - 1).otherwise(F.lit(len(bounds) - 1)).cast("int")
    head = F.struct(before.alias("rng"), F.lit(1).alias("ahead"))
    # no id, so no order: such rows are dealt by their text
    loose = F.struct((-1 - F.pmod(F.xxhash64("text"), F.lit(64))).cast("int").alias("rng"), F.lit(0).alias("ahead"))
    to = F.when(F.col("id").isNull(), F.array(loose)).when(first, F.array(own, head)).otherwise(F.array(own))
    rows = rows.withColumn("to", F.explode(to)).select("to.rng", "to.ahead", "id", "text")

    def run(batches):
        out = []

        def one(doc_id, text, sketch, after, after_sketch):
            quarter = len(text) // 4
            edited = text[:len(text) - quarter] + after[:quarter]
            e = sketch if edited == text else Sketches(edited)
            out.append((doc_id, len(text), hashlib.sha256(edited.encode()).hexdigest(), sketch.fingerprint(), e.fingerprint(),
                        likeness(sketch, e), likeness(sketch, after_sketch)))

        def drain():
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            r = pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*out), kinds)],
                                           names=["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"])
            out.clear()
            return r

        held, rng = None, None                     # the document that waits for its next one
        for b in batches:
            for k, ahead, doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), b.column(3)):
                text = text.as_py() or ""
                if doc_id is None:
                    one(None, text, Sketches(text), "", Sketches(""))
                    continue
                if ahead and held is None:
                    continue                       # a repeated head
                s = Sketches(text)
                if held is not None:
                    if k != rng:
                        raise RuntimeError("a range has no next document")
                    one(*held, text, s)
                held, rng = (None, k) if ahead else ((doc_id, text, s), k)
                if len(out) >= 500:
                    yield drain()
        if held is not None:
            raise RuntimeError("a range has no next document")
        if out:
            yield drain()

    return dealt(rows, "rng", len(bounds)).sortWithinPartitions("rng", "ahead", "id", "text").mapInArrow(run, SCHEMA)
