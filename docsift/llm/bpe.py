"""Byte-level BPE encoding and decoding by merge replay over a corpus.

A text is cut by the tokenizer's pattern; the distinct pieces of a block of
whole texts form a corpus of byte sequences.  An inverted index lists the
positions where a pair of neighbouring tokens merges, grouped by bands of the
merge's rank.  Bands are served in rank order over the whole corpus at once;
within a band a wave applies, in every piece, the pending merge of the lowest
rank (then leftmost).  Pieces do not touch each other, so this is the merge
sequence of a piece-by-piece encoder.  A merge touches only its two
neighbours, whose new pairs enter the index: those of the band at hand, or of
a lower rank, come up in the next wave.  Pieces over ``LONG`` bytes, which
would need a wave for each of their merges, are replayed rank by rank.

Each Python worker keeps the ids of known pieces in a bounded store; a full
store is emptied, which costs time only.  Blocks are bounded by characters, so memory
follows the block (or the longest single text).

Defined results: a null text is an empty one (no ids, empty bytes); special
tokens are ordinary text; a null id list decodes to empty bytes; repeated rows
and null document ids are encoded row by row; other columns are kept as they
are, except that ``ids`` (``decoded``) is replaced.
"""

from __future__ import annotations

import base64
import heapq
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from docsift.llm.common import packed

BLOCK_CHARS = 500_000
CACHE = 400_000
LONG = 250                                       # bytes; offsets in a piece fit eight bits
NONE = 1 << 30                                   # rank of a pair that never merges


class _Numbers(dict):
    """piece -> number, in order of appearance."""

    def __missing__(self, piece: str) -> int:
        n = self[piece] = len(self)
        return n


class Vocabulary:
    """Ranks of a ``.tiktoken`` file: bytes -> id and id -> bytes."""

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}
        self.bytes_of = {b: a for a, b in self.ranks.items()}
        self.byte = [self.ranks[bytes([i])] for i in range(256)]
        known = [self.bytes_of.get(i, b"") for i in range(max(self.bytes_of) + 1)]
        self.lengths = np.array([len(x) for x in known], np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(known), np.uint8)
        self.pattern = regex.compile(pattern)
        self.pairs: dict[tuple[int, int], int] = {}
        self.clear()
        merges = []
        for word, rank in self.ranks.items():
            for i in range(1, len(word)):
                a, b = self.ranks.get(word[:i]), self.ranks.get(word[i:])
                if a is not None and b is not None:
                    merges.append((a << 32 | b, rank))
        merges.sort()
        self.merge_keys = np.array([k for k, _ in merges], np.int64)
        self.merge_ranks = np.array([r for _, r in merges], np.int64)
        # bands of the index hold about as many possible merges each
        self.bands = np.unique(np.quantile(np.sort(self.merge_ranks), np.linspace(0, 1, 65)[1:-1] ** 2).astype(np.int64))

    def clear(self) -> None:
        """Forget the pieces seen: number of each piece, and their ids."""
        self.known = _Numbers()
        self.ids = np.zeros(0, np.int32)
        self.sizes = np.zeros(0, np.int64)
        self.begins = np.zeros(0, np.int64)

    def merge_rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Ranks of merged pairs of token ids; ``NONE`` where nothing merges."""
        key = a << 32 | b
        at = np.minimum(np.searchsorted(self.merge_keys, key), len(self.merge_keys) - 1)
        return np.where(self.merge_keys[at] == key, self.merge_ranks[at], NONE)

    def pair_rank(self, a: int, b: int) -> int:
        """Rank of the merged pair, or -1."""
        got = self.pairs.get((a, b))
        if got is None:
            if len(self.pairs) > 1_000_000:
                self.pairs.clear()
            got = self.pairs[a, b] = self.ranks.get(self.bytes_of[a] + self.bytes_of[b], -1)
        return got


@lru_cache(maxsize=4)
def vocabulary(path: str, pattern: str) -> Vocabulary:
    return Vocabulary(path, pattern)


def replay_long(pieces: list[bytes], vocab: Vocabulary) -> list[list[int]]:
    """Token ids of long byte strings: the index lists positions rank by rank."""
    out: list = []
    tok: list[int] = []
    start, byte = [], vocab.byte
    for p in pieces:
        start.append(len(tok))
        tok.extend(byte[c] for c in p)
        tok.append(-1)                           # wall between pieces
    n = len(tok)
    right, left = list(range(1, n + 1)), list(range(-1, n - 1))
    rank_of, ready, index = vocab.pair_rank, vocab.pairs.get, {}
    for pos, pair in enumerate(zip(tok, tok[1:])):
        r = ready(pair)
        if r is None:
            r = rank_of(*pair) if pair[0] >= 0 and pair[1] >= 0 else -1
        if r >= 0:
            if r in index:
                index[r].append(pos)
            else:
                index[r] = [pos]
    heap = list(index)
    heapq.heapify(heap)
    while heap:
        rank = heapq.heappop(heap)
        todo = index.pop(rank, None)
        if todo is None:
            continue
        todo.sort()
        for j, pos in enumerate(todo):
            a = tok[pos]
            if a < 0:
                continue
            nxt = right[pos]
            b = tok[nxt] if nxt < n else -1
            if b < 0:
                continue
            r = ready((a, b))
            if (rank_of(a, b) if r is None else r) != rank:
                continue                         # an earlier merge took one of the two
            tok[pos] = rank
            tok[nxt] = -2
            after = right[nxt]
            right[pos] = after
            if after < n:
                left[after] = pos
            before, first = left[pos], rank + 1
            if before >= 0 and tok[before] >= 0:
                r = ready((tok[before], rank))
                if r is None:
                    r = rank_of(tok[before], rank)
                if r >= 0:
                    if r not in index:
                        index[r] = []
                        heapq.heappush(heap, r)
                    index[r].append(before)
                    first = min(first, r)
            if after < n and tok[after] >= 0:
                r = ready((rank, tok[after]))
                if r is None:
                    r = rank_of(rank, tok[after])
                if r >= 0:
                    if r not in index:
                        index[r] = []
                        heapq.heappush(heap, r)
                    index[r].append(pos)
                    first = min(first, r)
            if first <= rank:                    # serve the new pair before the rest
                if rank not in index:
                    index[rank] = []
                    heapq.heappush(heap, rank)
                index[rank].extend(todo[j + 1:])
                break
    for pos in start:
        ids = []
        while tok[pos] != -1:
            ids.append(tok[pos])
            pos = right[pos]
        out.append(ids)
    return out


def replay_waves(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """Token ids of byte strings of at most ``LONG`` bytes: all ids in order,
    and the number of ids of each string."""
    if not pieces:
        return np.zeros(0, np.int32), np.zeros(0, np.int64)
    size = np.fromiter(map(len, pieces), np.int64, len(pieces))
    start = np.cumsum(size) - size
    n = int(size.sum())
    word = np.repeat(np.arange(len(pieces)), size)
    tok = np.array(vocab.byte, np.int64)[np.frombuffer(b"".join(pieces), np.uint8)]
    right, left = np.arange(1, n + 1), np.arange(-1, n - 1)
    right[start + size - 1] = -1
    left[start] = -1
    alive = np.ones(n, bool)
    rank = np.full(n, NONE, np.int64)            # of the pair that begins here
    inner = np.flatnonzero(right >= 0)
    rank[inner] = vocab.merge_rank(tok[inner], tok[inner + 1])

    index: list[list[np.ndarray]] = [[] for _ in range(len(vocab.bands) + 1)]

    def enter(positions: np.ndarray) -> None:
        band = np.searchsorted(vocab.bands, rank[positions], "right")
        order = np.argsort(band, kind="stable")
        cuts = np.flatnonzero(np.diff(band[order])) + 1
        for part in np.split(positions[order], cuts):
            if len(part):
                index[int(np.searchsorted(vocab.bands, rank[part[0]], "right"))].append(part)

    enter(inner[rank[inner] < NONE])
    for number in range(len(index)):
        limit = vocab.bands[number] if number < len(vocab.bands) else NONE
        pending = np.concatenate(index[number]) if index[number] else np.zeros(0, np.int64)
        index[number] = []
        while len(pending):
            pending = pending[rank[pending] < limit]      # the rest lost a token to another merge
            w = word[pending]
            key = np.sort(w << 40 | rank[pending] << 8 | (pending - start[w]))
            w = key >> 40
            new = np.ones(len(key), bool)
            new[1:] = w[1:] != w[:-1]                     # lowest rank, then leftmost, of each piece
            at = start[w] + (key & 255)
            pos, pending = at[new], at[~new & (key != np.roll(key, 1))]
            gone = right[pos]
            after, before = right[gone], left[pos]
            tok[pos] = rank[pos]
            right[pos] = after
            alive[gone] = False
            rank[gone] = rank[pos] = NONE
            more = after >= 0
            left[after[more]] = pos[more]
            rank[pos[more]] = vocab.merge_rank(tok[pos[more]], tok[after[more]])
            back = before >= 0
            rank[before[back]] = vocab.merge_rank(tok[before[back]], tok[pos[back]])
            touched = np.concatenate([pos[more], before[back]])
            now = rank[touched] < limit
            later = touched[~now]
            enter(later[rank[later] < NONE])
            pending = np.concatenate([pending, touched[now]])
    return tok[alive].astype(np.int32), np.bincount(word[alive], minlength=len(pieces))


def replay_flat(pieces: list[bytes], vocab: Vocabulary) -> tuple[np.ndarray, np.ndarray]:
    """All token ids of a corpus of distinct byte strings, in order, and the
    number of ids of each string."""
    got = [vocab.ranks.get(p, -1) for p in pieces]        # a piece may be a token itself
    short = [i for i, (p, g) in enumerate(zip(pieces, got)) if g < 0 and 0 < len(p) <= LONG]
    long = [i for i, (p, g) in enumerate(zip(pieces, got)) if g < 0 and len(p) > LONG]
    sizes = (np.array(got, np.int64) >= 0).astype(np.int64)
    ids, count = replay_waves([pieces[i] for i in short], vocab)
    sizes[short] = count
    slow = replay_long([pieces[i] for i in long], vocab)
    sizes[long] = [len(x) for x in slow]
    begin = np.cumsum(sizes) - sizes
    out = np.empty(int(sizes.sum()), np.int32)
    whole = np.flatnonzero(np.array(got, np.int64) >= 0)
    out[begin[whole]] = np.array(got, np.int64)[whole]
    ends = np.cumsum(count)
    out[np.repeat(begin[short] - ends + count, count) + np.arange(len(ids))] = ids
    for i, x in zip(long, slow):
        out[begin[i]:begin[i] + len(x)] = x
    return out, sizes


def replay(pieces: list[bytes], vocab: Vocabulary) -> list[tuple]:
    """Token ids of every piece of a corpus of distinct byte strings."""
    ids, sizes = replay_flat(pieces, vocab)
    ends = np.cumsum(sizes)
    return [tuple(ids[e - n:e].tolist()) for e, n in zip(ends, sizes)]


def encode_texts(texts: list[str], vocab: Vocabulary) -> list[np.ndarray]:
    """Ids of whole texts, as one corpus."""
    if len(vocab.known) > CACHE or len(vocab.known) != len(vocab.sizes):
        vocab.clear()
    known = vocab.known
    seen = len(known)
    rows = []
    for text in texts:
        found = (m.group() for m in vocab.pattern.finditer(text)) if len(text) > 4 * BLOCK_CHARS else vocab.pattern.findall(text)
        rows.append(np.fromiter(map(known.__getitem__, found), np.int64))
    fresh = [t.encode("utf-8") for t in islice(known, seen, None)]
    if fresh:
        ids, sizes = replay_flat(fresh, vocab)
        vocab.ids = np.concatenate([vocab.ids, ids])
        vocab.sizes = np.concatenate([vocab.sizes, sizes])
        vocab.begins = np.cumsum(vocab.sizes) - vocab.sizes
    out = []
    for r in rows:
        s = vocab.sizes[r]
        ends = np.cumsum(s)
        total = int(ends[-1]) if len(ends) else 0
        out.append(vocab.ids[np.repeat(vocab.begins[r] - ends + s, s) + np.arange(total)])
    return out


def decode_lists(lists: pa.ListArray, vocab: Vocabulary) -> pa.Array:
    """Bytes of every id list, gathered from the vocabulary's bytes at once."""
    ids = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
    size = vocab.lengths[ids]
    ends = np.cumsum(size)
    total = int(ends[-1]) if len(ends) else 0
    flat = vocab.flat[np.repeat(vocab.starts[ids] - ends + size, size) + np.arange(total)].tobytes()
    per = np.array([0 if x is None else x for x in lists.value_lengths().to_pylist()], np.int64)
    edge = np.concatenate([[0], ends])[np.concatenate([[0], np.cumsum(per)])]
    return pa.array([flat[a:b] for a, b in zip(edge[:-1], edge[1:])], pa.binary())


def _blocks(sizes: np.ndarray) -> list[tuple[int, int]]:
    """Ranges of rows whose texts come to about ``BLOCK_CHARS`` bytes, or hold one longer text."""
    cuts, begin, held = [], 0, 0
    for i, n in enumerate(sizes.tolist()):
        held += n
        if held >= BLOCK_CHARS:
            cuts.append((begin, i + 1))
            begin, held = i + 1, 0
    if begin < len(sizes):
        cuts.append((begin, len(sizes)))
    return cuts


def _with(df: DataFrame, name: str, kind: T.DataType) -> T.StructType:
    return T.StructType([f for f in df.schema.fields if f.name != name] + [T.StructField(name, kind)])


def encode(df: DataFrame, path: str, pattern: str, text_col: str = "text", keep: list[str] | None = None, decoded: bool = False) -> DataFrame:
    """``df`` (its ``keep`` columns; all when None) plus ``ids`` array<int>;
    with ``decoded`` also the bytes that :func:`decode` reads back from the
    ids, in the same step, so that a core runs one Python worker, not two."""
    kept = [c for c in (df.columns if keep is None else keep) if c not in ("ids", *(["decoded"] if decoded else []))]
    source = df.select(*kept, df[text_col].alias("_text"))
    schema = _with(df.select(*kept), "ids", T.ArrayType(T.IntegerType()))
    if decoded:
        schema = schema.add("decoded", T.BinaryType())

    def run(batches):
        vocab, arrow = vocabulary(path, pattern), packed(schema)
        for b in batches:
            column = b.column(len(kept))
            for lo, hi in _blocks(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)):
                # one block of texts at a time is held as Python strings
                rows = encode_texts([x or "" for x in column.slice(lo, hi - lo).to_pylist()], vocab)
                off = np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int32)
                ids = pa.ListArray.from_arrays(pa.array(off), pa.array(np.concatenate(rows).astype(np.int32)))
                part = [b.column(i).slice(lo, hi - lo).cast(arrow.field(i).type) for i in range(len(kept))]
                back = [decode_lists(ids, vocab)] if decoded else []
                yield pa.RecordBatch.from_arrays([*part, ids.cast(arrow.field(len(kept)).type), *back], schema=arrow)

    return source.mapInArrow(run, schema)


def decode(df: DataFrame, path: str, pattern: str, ids_col: str = "ids", keep: list[str] | None = None) -> DataFrame:
    """``df`` (its ``keep`` columns; all when None) plus ``decoded`` binary:
    the bytes of the ids."""
    kept = [c for c in (df.columns if keep is None else keep) if c != "decoded"]
    source = df.select(*kept, df[ids_col].alias("_ids"))
    schema = _with(df.select(*kept), "decoded", T.BinaryType())

    def run(batches):
        vocab, arrow = vocabulary(path, pattern), packed(schema)
        for b in batches:
            for lo in range(0, b.num_rows, 500):
                part = [b.column(i).slice(lo, 500).cast(arrow.field(i).type) for i in range(len(kept))]
                yield pa.RecordBatch.from_arrays([*part, decode_lists(b.column(len(kept)).slice(lo, 500), vocab)], schema=arrow)

    return source.mapInArrow(run, schema)
