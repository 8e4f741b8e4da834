"""Katz backoff model of any order over the words of a corpus, and scores of texts.

Tokens are the words of the whole text (A-Z lower-cased, split at \\x20 and
\\x09-\\x0D) and one end token.  The probability of a token is evaluated
recursively: an n-gram seen in training has its Good-Turing discounted share of
its history; any other token gets the history's backoff weight times its
probability after the history without the oldest word, down to the Good-Turing
discounted unigram share; a word unknown to the training texts gets the
unigrams' left-over mass.  Backoff weights are
normalised exactly: over all known words and the unknown one, every history's
probabilities add up to 1.

Histories: the start of a text, every training word and every longer run of
training words below the order (a run that reaches the start begins with it).
No model table is broadcast: words are partitioned by their hash, n-grams of
every length by the last word of their history.  An n-gram, its history and all
shorter ones of both end or go on there alike, so one bucket holds what the
recursion needs and one round serves every order.

:func:`score_corpus` learns and scores in one go; :func:`train` leaves the
tables (``Model``) at a path, :func:`open_model` reads them in any later
session and :func:`score_texts` scores any texts from them.

Execution: texts become blocks of at most ``BLOCK_TOKENS`` tokens plus one
text, written once.  A block sends its words to their buckets, which count and
number them, frequent words first, and answer.  A block then sends its distinct
n-grams of the full order, as sorted word numbers, to the buckets of their
histories; a bucket adds them up, counts the shorter ones as their prefixes and
answers in request order with the n-grams' counts and the sums of their
histories (of texts it has not learned from, those of every length).  A block's
tokens are scored from the answers.  Stored tables have the form of requests:
texts that come later are counted, with zeros, among them.

A word that would fill more than one bucket as a history is dealt out by the
word before it too.  Its bigrams are counted beside the words they predict, and
that list goes to each of the word's buckets.  Each n-gram crosses the network
once per block, so a frequent word, history or n-gram makes no hot task.

Words are told apart by 64-bit hashes.  Defined results: a null or empty text
is the end token alone; a null id counts as the empty string in the split;
repeated rows are scored (and learned) row by row; without training texts
every probability is 1 (score 0); a discount that Good-Turing leaves undefined
(an empty count class, a ratio outside (0, 1]) is ``(r - 0.5) / r``; a history
without any discounted mass gives up one count for its backoff.  Other columns
are ignored, whatever their names.
"""

from __future__ import annotations

import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.llm.common import cut, shuffle_width
from docsift.session import scratch_path, spent_shuffles

BLOCK_TOKENS = 1_500_000
KATZ = 5                                   # counts above are not discounted
END = xxhash.xxh3_64_intdigest(b"", seed=1)
# numbers of no known word: before the start of a text, the start, any word without a count
BEFORE, START, UNKNOWN, FIRST = 0, 1, 2, 3


def _pack(a: np.ndarray) -> bytes:
    """Numbers from 0 by byte planes, compressed: most are small."""
    a = np.ascontiguousarray(a, np.uint64)
    width = (max(1, int(a.max()).bit_length()) + 7) // 8 if len(a) else 0
    return bytes([width]) + zstandard.compress(a.view(np.uint8).reshape(len(a), 8)[:, :width].T.tobytes(), 1)


def _unpack(b: bytes | None) -> np.ndarray:
    if b is None or not b[0]:
        return np.zeros(0, np.int64)
    planes = np.frombuffer(zstandard.decompress(b[1:]), np.uint8).reshape(b[0], -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, :b[0]] = planes.T
    return out.reshape(-1).view(np.int64)


def _pack_sorted(a: np.ndarray) -> bytes:
    """Ascending hashes by their distances, which need fewer bytes."""
    return _pack(np.diff(a, prepend=np.uint64(0)))


def _unpack_sorted(b: bytes | None) -> np.ndarray:
    return np.cumsum(_unpack(b).view(np.uint64), dtype=np.uint64)


def _pack_rows(cols: list[np.ndarray]) -> bytes:
    """Columns of rows in ascending order: a value by its distance from the row before, where what stands left of it is the same."""
    new, parts = np.zeros(len(cols[0]), bool), []
    new[:1] = True
    for c in cols:
        d = np.diff(c, prepend=0)
        parts.append(_pack(np.where(new, c, d)))
        new = new | (d != 0)
    return b"".join(len(p).to_bytes(4, "little") + p for p in parts)


def _unpack_rows(b: bytes) -> list[np.ndarray]:
    cols, at, new = [], 0, None
    while at < len(b):
        size = int.from_bytes(b[at:at + 4], "little")
        c = _unpack(b[at + 4:at + 4 + size]).copy()
        if new is None:
            new = np.zeros(len(c), bool)
            new[:1] = True
        starts = np.flatnonzero(new)
        run = np.cumsum(c)
        c = run - np.repeat(run[starts] - c[starts], np.diff(starts, append=len(c)))
        new = new | (np.diff(c, prepend=0) != 0)
        cols.append(c)
        at += 4 + size
    return cols


def held_out(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


def _blocks(docs: DataFrame) -> DataFrame:
    """block, doc_ids, held, lens, words (hashes, the block's most frequent first), counts, tokens (places among the words)."""

    def run(batches):
        import uuid

        number: dict[bytes, int] = {}
        ids, held, lens, tokens = [], [], [], []

        def flush():
            hashes = np.fromiter((END if w == b"" else xxhash.xxh3_64_intdigest(w) for w in number), np.uint64, len(number))
            flat = np.concatenate(tokens)
            counts = np.bincount(flat, minlength=len(number))
            order = np.argsort(-counts, kind="stable")
            place = np.empty(len(order), np.int64)
            place[order] = np.arange(len(order))
            row = pa.RecordBatch.from_arrays(
                [pa.array([uuid.uuid4().int & ((1 << 63) - 1)], pa.int64()), pa.array([ids], pa.list_(pa.int64())),
                 pa.array([held], pa.list_(pa.bool_())), pa.array([lens], pa.list_(pa.int32())),
                 *(pa.array([x], pa.binary()) for x in (hashes[order].tobytes(), _pack(counts[order]), _pack(place[flat])))],
                names=["block", "doc_ids", "held", "lens", "words", "counts", "tokens"])
            number.clear(), ids.clear(), held.clear(), lens.clear(), tokens.clear()
            return row

        size = 0
        for b in batches:
            for i, text in zip(b.column(0).to_pylist(), b.column(1)):
                words = (text.as_py() or "").encode("utf-8").lower().split()
                words.append(b"")                                   # the end token; no word is empty
                row = np.array([number.setdefault(w, len(number)) for w in words], np.uint32)
                ids.append(i), held.append(held_out(i)), lens.append(len(row)), tokens.append(row)
                size += len(row)
                if size >= BLOCK_TOKENS:
                    yield flush()
                    size = 0
        if ids:
            yield flush()

    return docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").alias("text")).mapInArrow(
        run, "block long, doc_ids array<long>, held array<boolean>, lens array<int>, words binary, counts binary, tokens binary")


def _bucket(words: np.ndarray, buckets: int) -> np.ndarray:
    """Ranges of the hashes, so that a bucket's sorted hashes lie close."""
    return (((words >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)).astype(np.int64)


def _places(of: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of ``x`` in the ascending ``of``, and which are there."""
    at = np.minimum(np.searchsorted(of, x), len(of) - 1)
    return at, of[at] == x


def _mixed(x: np.ndarray) -> np.ndarray:
    x = x.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    for by in (0xD6E8FEB86659FD93, 0xC2B2AE3D27D4EB4F):
        x = (x ^ (x >> np.uint64(32))) * np.uint64(by)
    return x ^ (x >> np.uint64(29))


def _frequent(blocks: DataFrame, buckets: int) -> tuple[list[int], list[int]]:
    """Hashes of the words that would fill more than a bucket, and how many each: at most one word a bucket.  Adding up
    the blocks in which a word has a bucket's share finds every word that has two buckets' share of all tokens."""

    def run(batches):
        for b in batches:
            for r in b.to_pylist():
                counts = _unpack(r["counts"])
                often = np.flatnonzero(counts * buckets > counts.sum())
                words = np.frombuffer(r["words"], np.int64)[often]
                yield pa.RecordBatch.from_arrays([pa.array([None, *words.tolist()], pa.int64()), pa.array([int(counts.sum()), *counts[often].tolist()], pa.int64())],
                                                 names=["word", "c"])

    found = blocks.select("words", "counts").mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))
    all_tokens = found.where("word IS NULL").select(F.col("c").alias("tokens"))
    rows = found.where("word IS NOT NULL").crossJoin(F.broadcast(all_tokens)).where(F.col("c") * buckets > F.col("tokens")).orderBy(F.desc("c"), "word").collect()
    return [r["word"] for r in rows], [min(buckets, -(-r["c"] * buckets // r["tokens"])) for r in rows]


# kind 0: a block's request or answer about words, 1: a bucket's numbers (and table), 2: a frequent word's followers,
# 3: a block's request or answer about n-grams
_ROW = "kind int, bucket int, block long, a binary, b binary, c binary, d binary, e binary, f binary, n array<long>"
_SCHEMA = pa.schema([("kind", pa.int32()), ("bucket", pa.int32()), ("block", pa.int64()), *((c, pa.binary()) for c in "abcdef"), ("n", pa.list_(pa.int64()))])


def _own(r: dict, learn: bool) -> np.ndarray:
    """Which tokens the model learns from."""
    return np.repeat(~np.array(r["held"], bool) & learn, np.array(r["lens"]))


def _starts(lens: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(lens)[:-1]])


def _words_asked(blocks: DataFrame, model: Model, learn: bool) -> DataFrame:
    """A block's words to their buckets: hashes (a), the block's places of them (b), counts in training (c), and
    the pairs that follow a frequent word: word (d, places in a), frequent word (e), count (f)."""
    buckets, hot = model.buckets, np.array(model.hot, np.int64).view(np.uint64)

    def run(batches):
        for batch in batches:
            for r in batch.to_pylist():
                words, tokens, own = np.frombuffer(r["words"], np.uint64), _unpack(r["tokens"]), _own(r, learn)
                order = np.argsort(words, kind="stable")
                counts = np.bincount(tokens[own], minlength=len(words))[order]
                place = np.empty(len(words), np.int64)
                place[order] = np.arange(len(words))
                which = np.full(len(words), -1)
                at, there = _places(words[order], hot)
                which[order[at[there]]] = np.flatnonzero(there)
                before = np.full(len(tokens), -1)
                before[1:] = which[tokens[:-1]]
                before[_starts(np.array(r["lens"]))] = -1
                pairs = np.flatnonzero(own & (before >= 0))
                pair, often = np.unique(place[tokens[pairs]] * max(1, len(hot)) + before[pairs], return_counts=True)
                word, after = pair // max(1, len(hot)), pair % max(1, len(hot))
                words = words[order]
                edge = np.searchsorted(_bucket(words, buckets), np.arange(buckets + 1))
                cuts = np.searchsorted(word, edge)
                out = []
                for k in np.flatnonzero(np.diff(edge)).tolist():
                    w, p = slice(edge[k], edge[k + 1]), slice(cuts[k], cuts[k + 1])
                    out.append({"kind": 0, "bucket": k, "block": r["block"], "a": _pack_sorted(words[w]), "b": _pack(order[w]), "c": _pack(counts[w]),
                                "d": _pack(word[p] - edge[k]), "e": _pack(after[p]), "f": _pack(often[p])})
                yield from pa.Table.from_pylist(out, schema=_SCHEMA).to_batches()

    return blocks.select("block", "held", "lens", "words", "tokens").mapInArrow(run, _ROW)


def _numbered(asked: DataFrame, model: Model, keep: bool) -> DataFrame:
    """Per word bucket: to every block its places (a) with the words' numbers (b) and counts (c); the numbers of
    tokens, words and words with counts 1..6 (with ``keep``, the words too, as a request); and the followers of the
    frequent words: ``n`` names the word, a the followers' numbers, b their counts, c the pairs' counts."""
    buckets, hot = model.buckets, np.array(model.hot, np.int64).view(np.uint64)

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        words = [_unpack_sorted(r["a"]) for r in rows]
        names, at = np.unique(np.concatenate(words), return_inverse=True)
        counts = np.bincount(at, weights=np.concatenate([_unpack(r["c"]) for r in rows]), minlength=len(names)).astype(np.int64)
        edge = np.cumsum([0, *map(len, words)])
        bucket = rows[0]["bucket"]
        order = np.lexsort((names, -counts))[:np.count_nonzero(counts)]
        number = np.full(len(names), UNKNOWN, np.int64)
        number[order] = FIRST + len(hot) + np.arange(len(order)) * buckets + bucket
        at_hot, there = _places(names, hot)
        there &= counts[at_hot] > 0
        number[at_hot[there]] = FIRST + np.flatnonzero(there)
        out = [{"kind": 0, "bucket": bucket, "block": r["block"], "a": r["b"], "b": _pack(number[at[lo:hi]]), "c": _pack(counts[at[lo:hi]])}
               for r, lo, hi in zip(rows, edge, edge[1:]) if r["block"] is not None]
        word = np.concatenate([at[lo + _unpack(r["d"])] for r, lo in zip(rows, edge)])
        pair, back = np.unique(np.concatenate([_unpack(r["e"]) for r in rows]) * len(names) + word, return_inverse=True)
        often = np.bincount(back, weights=np.concatenate([_unpack(r["f"]) for r in rows]), minlength=len(pair)).astype(np.int64)
        after, word = pair // len(names), pair % len(names)
        cuts = np.searchsorted(after, np.arange(len(hot) + 1))
        for j in np.flatnonzero(np.diff(cuts)).tolist():
            p = slice(cuts[j], cuts[j + 1])
            out.append({"kind": 2, "bucket": bucket, "n": [j], "a": _pack(number[word[p]]), "b": _pack(counts[word[p]]), "c": _pack(often[p])})
        seen = np.flatnonzero(counts)
        place = np.cumsum(counts > 0) - 1
        stored = {"a": _pack_sorted(names[seen]), "c": _pack(counts[seen]), "d": _pack(place[word]), "e": _pack(after), "f": _pack(often)} if keep and len(seen) else {}
        kinds = np.bincount(np.minimum(counts, KATZ + 2), minlength=KATZ + 2)[1:KATZ + 2]
        out.append({"kind": 1, "bucket": bucket, "n": [int(counts.sum()), len(seen), *kinds.tolist()], **stored})
        return pa.Table.from_pylist(out, schema=_SCHEMA)

    return asked.groupBy("bucket").applyInArrow(run, _ROW)


def _homes(cols: list[np.ndarray], model: Model) -> np.ndarray:
    """Buckets of n-grams: the hash of the history's last word and, where that is dealt out, of the word before."""
    last, buckets = cols[0], np.uint64(model.buckets)
    parts = np.ones(len(last), np.uint64)
    parts[last == UNKNOWN] = buckets                            # nothing follows these in training: any bucket will do
    often = (last >= FIRST) & (last < FIRST + len(model.hot))
    parts[often] = np.array(model.parts, np.uint64)[last[often] - FIRST]
    part = _mixed(cols[1]) % parts if len(cols) > 2 else np.uint64(0)
    return ((_mixed(last) % buckets + part) % buckets).astype(np.int64)


def _followers(words: DataFrame, model: Model) -> DataFrame:
    """The frequent words' followers, one list each, to each of their buckets."""

    def run(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: r["bucket"])
        (j,) = rows[0]["n"]
        home = int(_mixed(np.array([FIRST + j]))[0] % np.uint64(model.buckets))
        whole = {c: _pack(np.concatenate([_unpack(r[c]) for r in rows])) for c in "abc"}
        return pa.Table.from_pylist([{"kind": 2, "bucket": (home + k) % model.buckets, "n": [j], **whole} for k in range(model.parts[j])], schema=_SCHEMA)

    return words.where("kind = 2").groupBy(F.col("n")[0]).applyInArrow(run, _ROW)


def _runs(cols: list[np.ndarray]) -> np.ndarray:
    """Of sorted rows: the number of each row's run of equal rows."""
    if not len(cols[0]):
        return np.zeros(0, np.int64)
    new = np.zeros(len(cols[0]), bool)
    for c in cols:
        new[1:] |= c[1:] != c[:-1]
    return np.cumsum(new)


class Grams(NamedTuple):
    """A block's distinct n-grams of the full order, by bucket, then history (last word first) and word."""

    cols: list[np.ndarray]                  # word numbers: the history's words from the last on, the word
    bucket: np.ndarray
    number: np.ndarray                      # of every token's n-gram
    own: np.ndarray                         # their tokens in training
    asked: np.ndarray                       # which occur in texts not learned from
    word: np.ndarray                        # training counts of their words
    known: np.ndarray                       # and of the tokens


def _grams(r: dict, answer: list[dict], model: Model, learn: bool) -> Grams:
    lens, tokens, own = np.array(r["lens"]), _unpack(r["tokens"]), _own(r, learn)
    answer = [x for x in answer if x["kind"] == 0]
    place, numbers, counts = (np.concatenate([_unpack(x[c]) for x in answer]) for c in "abc")
    if len(place) != tokens.max() + 1:
        raise RuntimeError("a block's answers are not complete")
    number, count = np.empty(len(place), np.int64), np.empty(len(place), np.int64)
    number[place], count[place] = numbers, counts
    local, rank = np.unique(np.concatenate([[BEFORE, START], number]), return_inverse=True)
    word, wide = rank[2:].astype(np.int32)[tokens], len(local)
    offset = np.arange(len(tokens), dtype=np.int32) - np.repeat(_starts(lens).astype(np.int32), lens)

    def column(k: int, at: np.ndarray) -> np.ndarray:
        """The words ``k`` before the tokens ``at``."""
        c = word[np.maximum(at - k, 0)]
        c[offset[at] < k] = BEFORE
        c[offset[at] == k - 1] = START
        return c

    every, back = np.arange(len(tokens), dtype=np.int32), [*range(1, model.order), 0]
    key, size = column(1, every).astype(np.int64), wide
    for k in back[1:]:
        if size * wide >= 1 << 62:
            key = np.unique(key, return_inverse=True)[1]
            size = int(key.max()) + 1
        key *= wide
        key += column(k, every)
        size *= wide
    order = np.argsort(key, kind="stable").astype(np.int32)
    key = key[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = order[new]
    del key, every
    rows = [local[column(k, first)] for k in back]
    bucket = _homes(rows, model)
    moved = np.argsort(bucket, kind="stable")
    place = np.empty(len(moved), np.int32)
    place[moved] = np.arange(len(moved), dtype=np.int32)
    at = np.empty(len(order), np.int32)
    at[order] = place[np.cumsum(new, dtype=np.int32) - 1]
    asked = np.zeros(len(moved), bool)
    asked[at[~own]] = True
    known = count[tokens]
    return Grams([x[moved] for x in rows], bucket[moved], at, np.bincount(at[own], minlength=len(moved)), asked, known[first[moved]], known)


def _grams_asked(blocks: DataFrame, words: DataFrame, model: Model, learn: bool) -> DataFrame:
    """A block's n-grams to their buckets: rows (a), counts in training (b), which are asked for by other texts (c), and
    the counts of the distinct words that training n-grams end with (d)."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, answer = [], right.to_pylist()
        for r in left.to_pylist():
            grams = _grams(r, answer, model, learn)
            edge = np.searchsorted(grams.bucket, np.arange(model.buckets + 1))
            for k in np.flatnonzero(np.diff(edge)).tolist():
                p = slice(edge[k], edge[k + 1])
                out.append({"kind": 3, "bucket": k, "block": r["block"], "a": _pack_rows([c[p] for c in grams.cols]), "b": _pack(grams.own[p]),
                            "c": _pack(grams.asked[p]), "d": _word_counts(grams.cols[-1][p], grams.own[p], grams.word[p])})
        return pa.Table.from_pylist(out, schema=_SCHEMA)

    return blocks.select("block", "held", "lens", "tokens").groupBy("block").cogroup(words.groupBy("block")).applyInArrow(run, _ROW)


def _word_counts(words: np.ndarray, counts: np.ndarray, known: np.ndarray) -> bytes:
    seen = np.flatnonzero(counts)
    return _pack(known[seen[np.unique(words[seen], return_index=True)[1]]])


def _counted(asked: DataFrame, model: Model, keep: bool) -> DataFrame:
    """Per history bucket: the answers, and for each order the numbers of n-grams with counts 1..6 (with ``keep``, the
    n-grams too, as a request).  An answer has the n-grams' counts (a) and, of their histories, the training tokens (b)
    and which small counts follow (c); of the n-grams that other texts ask for, the counts of the shorter ones (d) and of
    each length of history the sums (e): training tokens, followers with counts 1..5, and the followers' mass one order
    below, as counts by class or (f) as unigram probability."""
    top, share = model.order - 1, model.share

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        bucket = rows[0]["bucket"]
        asks, often = [r for r in rows if r["kind"] != 2], [r for r in rows if r["kind"] == 2]
        parts = [_unpack_rows(r["a"]) for r in asks]
        cols = [np.concatenate([np.zeros(0, np.int64), *(p[k] for p in parts)]) for k in range(model.order)]
        counts = np.concatenate([np.zeros(0, np.int64), *(_unpack(r["b"]) for r in asks)])
        edge = np.cumsum([0, *(len(p[0]) for p in parts)])
        parts = [[c[lo:hi] for c in cols] for lo, hi in zip(edge, edge[1:])]
        extra = [_unpack(r["a"]) for r in often]
        names, word = np.unique(np.concatenate([cols[-1], *extra]), return_inverse=True)
        wide, size = max(1, len(names)), len(cols[0])
        known = np.zeros(wide, np.int64)
        for r, p, lo, hi in zip(asks, parts, edge, edge[1:]):
            known[np.searchsorted(names, np.unique(p[-1][counts[lo:hi] > 0]))] = _unpack(r["d"])
        for r, w in zip(often, extra):
            known[np.searchsorted(names, w)] = _unpack(r["b"])
        # the shortest histories; those dealt out have their followers' counts from the list
        last = np.concatenate([cols[0], *(np.full(len(w), FIRST + r["n"][0]) for r, w in zip(often, extra))])
        dealt = (cols[0] >= FIRST) & (cols[0] < FIRST + len(model.hot)) if top > 1 else np.zeros(size, bool)
        weights = np.concatenate([np.where(dealt, 0, counts), *(_unpack(r["c"]) for r in often)])
        hists, history = np.unique(last, return_inverse=True)
        levels, numbers, lower = [], [], None
        for k in range(1, top + 1):
            if k > 1:
                _, of = np.unique(cols[k - 1], return_inverse=True)
                _, history = np.unique(history[:size] * (int(of.max(initial=0)) + 1) + of, return_inverse=True)
                weights = counts
            pair, gram = np.unique(history * wide + word[:len(history)], return_inverse=True)
            total = np.bincount(gram, weights=weights, minlength=len(pair)).astype(np.int64)
            n_hists = int(history.max(initial=-1)) + 1
            seen = total > 0
            h, t = pair[seen] // wide, total[seen]
            sums = np.bincount(h, weights=t, minlength=n_hists).astype(np.int64)
            n = np.stack([np.bincount(h[t == i], minlength=n_hists) for i in range(1, KATZ + 1)])
            if k == 1:
                mass = np.bincount(h, weights=share.of(known[pair[seen] % wide]), minlength=n_hists)
                # a word dealt out is counted in the first of its buckets
                once = t[(_mixed(hists[h]) % np.uint64(model.buckets)).astype(np.int64) == bucket] if top > 1 else t
            else:
                below = np.zeros(len(pair), np.int64)
                below[gram] = lower
                c, once = below[seen], t
                kind = np.minimum(c, KATZ + 1)
                mass = np.stack([np.bincount(h[kind == i], weights=c[kind == i], minlength=n_hists).astype(np.int64) for i in range(1, KATZ + 2)])
            numbers += np.bincount(np.minimum(once, KATZ + 2), minlength=KATZ + 2)[1:KATZ + 2].tolist()
            lower = total[gram[:size]]
            levels.append((history[:size].astype(np.int32), lower, sums, n, mass))
            del pair, gram, total, seen, h, t, once
        out = []
        for r, p, lo, hi in zip(asks, parts, edge, edge[1:]):
            if r["block"] is None:
                continue
            history, total, sums, n, _ = levels[-1]
            own = history[lo:hi][np.flatnonzero(np.diff(_runs(p[:top]), prepend=-1))]
            kinds = ((n[:, own] > 0) << np.arange(1, KATZ + 1)[:, None]).sum(axis=0)
            others = np.flatnonzero(_unpack(r["c"]))
            shorter, stats, shares = [], [], []
            for k, (history, total_k, sums_k, n_k, mass) in enumerate(levels, 1):
                mine = history[lo:hi][others[np.flatnonzero(np.diff(_runs([c[others] for c in p[:k]]), prepend=-1))]]
                shorter.append(total_k[lo:hi][others] if k < top else np.zeros(0, np.int64))
                stats += [sums_k[mine], n_k[:, mine].reshape(-1)]
                if k == 1:
                    shares = mass[mine]
                else:
                    stats.append(mass[:, mine].reshape(-1))
            out.append({"kind": 3, "bucket": bucket, "block": r["block"], "a": _pack(total[lo:hi]), "b": _pack(sums[own]), "c": _pack(kinds),
                        "d": _pack(np.concatenate(shorter)), "e": _pack(np.concatenate(stats)), "f": np.asarray(shares, np.float64).tobytes()})
        stored = _stored(cols, counts, word[:size], known) if keep and size else {}
        out.append({"kind": 1, "bucket": bucket, "n": numbers, **stored})
        return pa.Table.from_pylist(out, schema=_SCHEMA)

    return asked.groupBy("bucket").applyInArrow(run, _ROW)


def _stored(cols: list[np.ndarray], counts: np.ndarray, word: np.ndarray, known: np.ndarray) -> dict:
    """A bucket's n-grams with their counts, as a request."""
    order = np.lexsort(cols[::-1])
    order = order[counts[order] > 0]
    cols, run = [c[order] for c in cols], _runs([c[order] for c in cols])
    first = np.flatnonzero(np.diff(run, prepend=-1))
    cols, total = [c[first] for c in cols], np.bincount(run, weights=counts[order]).astype(np.int64)
    return {"a": _pack_rows(cols), "b": _pack(total), "c": _pack(np.zeros(len(first))), "d": _word_counts(cols[-1], total, known[word[order[first]]])} if len(first) else {}


def discounts(n: list[float]) -> np.ndarray:
    """Katz's discount ratios of the counts 1..5 from the numbers of types
    with counts 1..6 (index 0: 1, for unseen)."""
    out = np.ones(KATZ + 1)
    last = (KATZ + 1) * n[KATZ] / n[0] if n[0] else 1.0
    for r in range(1, KATZ + 1):
        d = 0.0
        if n[r - 1] and last < 1:
            d = ((r + 1) * n[r] / n[r - 1] / r - last) / (1 - last)
        out[r] = d if 0 < d <= 1 else (r - 0.5) / r
    return out


class Unigram:
    """Discounted shares of the words; ``unknown`` is what they leave."""

    def __init__(self, total: int, n: list[float]):
        self.total, self.d = total, discounts(n)
        left = sum((1 - self.d[r]) * r * n[r - 1] for r in range(1, KATZ + 1))
        self.base = total if left > 0 else total + 1
        self.unknown = (left if left > 0 else 1) / self.base

    def of(self, c: np.ndarray) -> np.ndarray:
        """Probability of a word with training count ``c`` (0: the unknown word)."""
        return np.where(c > 0, _discounted(self.d, c) / self.base, self.unknown)


def _discounted(d: np.ndarray, c: np.ndarray) -> np.ndarray:
    return d[np.minimum(c, KATZ) * (c <= KATZ)] * c


def _sums(x: np.ndarray, lens: np.ndarray) -> np.ndarray:
    return np.add.reduceat(x, _starts(lens))


def _logs(grams: Grams, answer: list[dict], model: Model) -> np.ndarray:
    """log10 of the probabilities of a block's n-grams."""
    answer = sorted((x for x in answer if x["kind"] == 3), key=lambda x: x["bucket"])
    count, total, kinds = (np.concatenate([_unpack(x[c]) for x in answer]) for c in "abc")
    top, d = model.order - 1, model.d[-1]
    history = _runs([grams.bucket, *grams.cols[:top]])
    if len(count) != len(history) or not len(total) == len(kinds) == history[-1] + 1:
        raise RuntimeError("a block's answers are not complete")
    # a history gives up mass if a count that is discounted occurs after it, else one count
    gives = (kinds & sum(1 << r for r in range(1, KATZ + 1) if d[r] < 1)) > 0
    log = np.log10(_discounted(d, np.maximum(count, 1)) / np.where(gives, total, total + 1)[history])
    others = np.flatnonzero(grams.asked)
    if not len(others):
        return log
    cols, bucket = [c[others] for c in grams.cols], grams.bucket[others]
    edge = np.searchsorted(bucket, [x["bucket"] for x in answer] + [model.buckets])
    runs = [_runs([bucket, *cols[:k]]) for k in range(1, top + 1)]
    counts, stats = [[] for _ in range(top)], [[] for _ in range(top)]
    for x, lo, hi in zip(answer, edge, edge[1:]):
        if lo == hi:
            continue
        shorter, sums, at = _unpack(x["d"]).reshape(top - 1, hi - lo), _unpack(x["e"]), 0
        for k in range(top):
            if k < top - 1:
                counts[k].append(shorter[k])
            wide, rows = runs[k][hi - 1] - runs[k][lo] + 1, 1 + KATZ + (KATZ + 1 if k else 0)
            stats[k].append(sums[at:at + wide * rows].reshape(rows, wide))
            at += wide * rows
    mass = np.concatenate([np.frombuffer(x["f"], np.float64) for x in answer])
    out, shorter = np.log10(model.share.of(grams.word[others])), None
    for k, d in enumerate(model.d):
        c = np.concatenate(counts[k]) if k < top - 1 else count[others]
        s, at = np.concatenate(stats[k], axis=1), runs[k]
        left = ((1 - d[1:])[:, None] * np.arange(1, KATZ + 1)[:, None] * s[1:KATZ + 1]).sum(axis=0)
        base = np.where(left > 0, s[0], s[0] + 1)
        left = np.where(left > 0, left, 1) / base
        if k:
            first = np.flatnonzero(np.diff(at, prepend=-1))
            mass = (s[KATZ + 1:-1] * model.d[k - 1][1:, None]).sum(axis=0) + s[-1]
            mass = mass / np.maximum(shorter[runs[k - 1][first]], 1)
        # nothing seen after a history: its backoff weight is 1
        backoff = np.where(s[0] > 0, left / np.maximum(1 - mass, 1e-300), 1.0)
        out = np.where(c > 0, np.log10(_discounted(d, np.maximum(c, 1)) / base[at]), out + np.log10(backoff)[at])
        shorter = base
    log[others] = out
    return log


def _scored(blocks: DataFrame, words: DataFrame, grams: DataFrame, model: Model, learn: bool) -> DataFrame:
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        out, answer = [], right.to_pylist()
        for r in left.to_pylist():
            lens, found = np.array(r["lens"]), _grams(r, answer, model, learn)
            known = found.known
            out.append(pa.table({
                "doc_id": pa.array(r["doc_ids"], pa.int64()), "held_out": pa.array(r["held"], pa.bool_()), "n_tokens": pa.array(lens.astype(np.int64)),
                "n_known": _sums((known > 0).astype(np.int64), lens), "train_tokens": np.full(len(lens), model.n, np.int64),
                "base_score": _sums(np.log10((known + 1) / (model.n + model.types + 1)), lens), "score": _sums(_logs(found, answer, model)[found.number], lens)}))
        return pa.concat_tables(out)

    answers = words.unionByName(grams.where("kind = 3").select("kind", "block", "bucket", *"abcdef"), allowMissingColumns=True)
    return blocks.select("block", "doc_ids", "held", "lens", "tokens").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def _written(df: DataFrame, path: str) -> DataFrame:
    with spent_shuffles(df.sparkSession):
        df.write.partitionBy("kind").parquet(path)
    return _tables(df.sparkSession, path)


def _tables(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(_ROW).parquet(path).select(*_SCHEMA.names)


def _numbers_of(tables: DataFrame, size: int) -> list[int]:
    row = tables.where("kind = 1").agg(*(F.sum(F.col("n")[i]) for i in range(size))).first()
    return [int(x or 0) for x in row]


def _own_answers(words: DataFrame) -> DataFrame:
    return words.where("kind = 0").select("kind", "block", "bucket", "a", "b", "c")


def _learned(blocks: DataFrame, path: str, keep: bool, order: int) -> Model:
    """The model of the blocks' training texts, its tables (and the blocks' own answers) at ``path``;
    without ``keep`` no words and n-grams, which the blocks' own scores do not read."""
    spark = blocks.sparkSession
    if order < 2:
        raise ValueError("the order must be 2 or more")
    buckets = 3 * shuffle_width(spark)
    hot, parts = _frequent(blocks, buckets) if order > 2 else ([], [])
    model = _model(path, buckets, hot, parts, [0] * (KATZ + 3), [[0] * (KATZ + 1)] * (order - 1))
    words = _written(_numbered(_words_asked(blocks, model, True), model, keep), f"{path}/words")
    unigrams = _numbers_of(words, KATZ + 3)
    model = _model(path, buckets, hot, parts, unigrams, [[0] * (KATZ + 1)] * (order - 1))
    asked = _grams_asked(blocks, _own_answers(words), model, True).unionByName(_followers(words, model))
    grams = _written(_counted(asked, model, keep), f"{path}/grams")
    kinds = np.array(_numbers_of(grams, (KATZ + 1) * (order - 1))).reshape(order - 1, -1).tolist()
    spark.createDataFrame([(buckets, hot, parts, unigrams, kinds)], _NUMBERS).coalesce(1).write.parquet(f"{path}/numbers")
    return open_model(spark, path)


_NUMBERS = "buckets int, hot array<long>, parts array<int>, words array<long>, grams array<array<long>>"


class Model(NamedTuple):
    """A stored model: where its tables are, and the few numbers all tokens share."""

    path: str
    buckets: int
    hot: list[int]                          # frequent words, at most one a bucket
    parts: list[int]                        # and how many buckets they are dealt to
    n: int                                  # training tokens
    types: int
    share: Unigram
    d: list[np.ndarray]                     # discounts of bigrams and longer n-grams

    @property
    def order(self) -> int:
        return 1 + len(self.d)


def _model(path: str, buckets: int, hot: list[int], parts: list[int], words: list[int], grams: list[list[int]]) -> Model:
    return Model(path, buckets, hot, parts, words[0], words[1], Unigram(words[0], words[2:]), [discounts(g) for g in grams])


def open_model(spark: SparkSession, path: str) -> Model:
    """The model that :func:`train` left at ``path``."""
    row = spark.read.schema(_NUMBERS).parquet(f"{path}/numbers").first()
    return _model(path, row["buckets"], row["hot"], row["parts"], row["words"], row["grams"])


def train(docs: DataFrame, path: str, order: int = 2) -> Model:
    """Learn from the training part of ``docs``; ``path`` must be new and shared."""
    return _learned(cut(_blocks(docs), "lm-blocks"), path, True, order)


def score_corpus(docs: DataFrame, order: int = 2) -> DataFrame:
    """Learn from the training part of ``docs`` and score every text."""
    spark = docs.sparkSession
    blocks = cut(_blocks(docs), "lm-blocks")
    model = _learned(blocks, scratch_path(spark, "lm-model"), False, order)
    return _scored(blocks, _own_answers(_tables(spark, f"{model.path}/words")), _tables(spark, f"{model.path}/grams"), model, True)


def score_texts(docs: DataFrame, model: Model) -> DataFrame:
    """Scores of any texts, the columns of :func:`score_corpus`, from a stored model.
    (``held_out`` is the rule's answer for the id, whatever the model learned from.)"""
    spark = docs.sparkSession
    blocks, path = cut(_blocks(docs), "lm-blocks"), scratch_path(spark, "lm-answers")

    def stored(name: str) -> DataFrame:
        return _tables(spark, f"{model.path}/{name}").where("kind = 1 AND a IS NOT NULL").withColumn("block", F.lit(None).cast("long"))

    words = _written(_numbered(_words_asked(blocks, model, False).unionByName(stored("words")), model, False), f"{path}/words")
    asked = _grams_asked(blocks, _own_answers(words), model, False).unionByName(_followers(words, model)).unionByName(stored("grams"))
    grams = _written(_counted(asked, model, False), f"{path}/grams")
    return _scored(blocks, _own_answers(words), grams, model, False)
