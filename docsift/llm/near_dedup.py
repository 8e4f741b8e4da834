"""Near-duplicate groups by MinHash bands, sequential Bayesian pruning and an
exact check of the survivors.

1. Every whole text gives its set of distinct ``k``-word shingles (64-bit
   hashes of the words' bytes; A-Z lower-cased), a MinHash signature of
   ``BANDS * ROWS`` values and one key per band.  Documents with the same set
   collapse to the one with the smallest id first, so exact copies cost no
   pairs.
2. Documents sharing a band key are candidates.  No bucket is ever expanded
   into all pairs.  Every document is first tested against the most central
   one (with the most candidates) it shares a bucket with.  Buckets that still
   hold several components are then compared as tiles of signatures, members
   of different components only: first each member's two likeliest partners
   are verified, then, between what is still apart, every pair that the
   comparison keeps, so no link between components is missed.
3. A candidate pair's signatures are compared in batches of 32.  With ``m``
   of ``n`` values equal and a uniform prior, the similarity's posterior is
   Beta(m+1, n-m+1); the pair goes as soon as its probability of reaching the
   threshold falls under ``MISS``.
4. Survivors are verified on the full sets of both texts:
   ``100 * |A & B| >= percent * |A | B|``.

At similarity 0.8, 32 bands of 5 miss a pair with probability
``(1 - 0.8^5)^32 < 4e-6``; the pruning adds about ``MISS`` per batch.  Two
shingles or two sets are taken as equal when their 64- and 128-bit hashes are.

Defined results: a null or empty text (or one of white space) has an empty
set, is linked with nothing and kept; fewer than ``k`` words make one shingle
of the whole sequence; a null id takes no part in links, its component is
null and the row is kept; rows that repeat an id and a text share one result
each; rows that repeat an id with another text are decided by their own text; an empty table gives an empty result.  Only the id and text columns are
read, so other columns may have any name.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docsift.llm.common import cut, shuffle_width, small
from docsift.llm.components import components

BANDS, ROWS, BATCH, MISS = 32, 5, 32, 1e-6
TILE = 2048
CLASSES = 2048
SIZE = BANDS * ROWS
_rng = np.random.default_rng(20240711)
_A = (_rng.integers(0, 1 << 32, SIZE, dtype=np.uint64) | 1).astype(np.uint32)[:, None]
_B = _rng.integers(0, 1 << 32, SIZE, dtype=np.uint64).astype(np.uint32)[:, None]
_P = _rng.integers(0, 1 << 63, (BANDS, ROWS), dtype=np.uint64) | np.uint64(1)
_C1, _C2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)


class _WordHash(dict):
    """word -> 64-bit hash; forgets everything at a bounded size (some 6 MB a
    Python worker)."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 40_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(29))) * _C2
    return x ^ (x >> np.uint64(32))


def shingle_set(text: str | None, k: int, cache: dict) -> np.ndarray:
    """Sorted hashes of the distinct ``k``-word shingles of a whole text."""
    words = (text or "").encode("utf-8").lower().split()    # bytes.lower: A-Z only; split: \x20, \x09-\x0D
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    width = min(k, len(words))
    acc = h[:len(h) - width + 1].copy()
    for j in range(1, width):
        acc = acc * _C1 + h[j:len(h) - width + 1 + j]
    return np.unique(mixed(acc + np.uint64(width)))


def signature(shingles: np.ndarray) -> np.ndarray:
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    best = None
    for i in range(0, len(x), 4096):
        low = (_A * x[None, i:i + 4096] + _B).min(axis=1)
        best = low if best is None else np.minimum(best, low)
    return best


def band_keys(sig: np.ndarray) -> np.ndarray:
    at = np.arange(1, BANDS + 1, dtype=np.uint64) * _C1
    return mixed((sig.reshape(BANDS, ROWS).astype(np.uint64) * _P).sum(axis=1, dtype=np.uint64) + at).view(np.int64)


def bitmap(shingles: np.ndarray) -> bytes:
    """Which of ``CLASSES`` hash classes a set occupies."""
    held = np.zeros(CLASSES, bool)
    held[(shingles >> np.uint64(17)) & np.uint64(CLASSES - 1)] = True
    return np.packbits(held).tobytes()


def can_link(n: np.ndarray, bits: np.ndarray, x: np.ndarray, y: np.ndarray, percent: int) -> np.ndarray:
    """Whether pairs can still reach the threshold.  Every class that only one
    side occupies holds an element the other lacks, so this bounds the common
    elements from above and never rejects a link."""
    a, b = bits[x], bits[y]
    both = np.minimum(n[x] - np.bitwise_count(a & ~b).sum(axis=1, dtype=np.int64), n[y] - np.bitwise_count(b & ~a).sum(axis=1, dtype=np.int64))
    return 100 * both >= percent * (n[x] + n[y] - both)


def least_matches(threshold: float, miss: float = MISS) -> list[int]:
    """For 32, 64, ... compared values: the fewest equal ones with which the
    posterior probability of ``similarity >= threshold`` still reaches
    ``miss`` (P(Beta(m+1, n-m+1) >= t) = P(Binomial(n+1, t) <= m))."""
    out = []
    for n in range(BATCH, SIZE + 1, BATCH):
        total, m = 0.0, -1
        while total < miss and m < n:
            m += 1
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return out


def _sign(docs: DataFrame, k: int) -> DataFrame:
    def run(batches):
        cache = _WordHash()
        for b in batches:
            n, digest, sig, keys, bits = [], [], [], [], []
            for text in b.column(1):
                s = shingle_set(text.as_py(), k, cache)
                n.append(len(s))
                if len(s):
                    full = signature(s)
                    digest.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                    sig.append((full & np.uint32(0xFFFF)).astype(np.uint16).tobytes())
                    keys.append(band_keys(full))
                    bits.append(bitmap(s))
                else:
                    digest.append(None), sig.append(None), keys.append(None), bits.append(None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), b.column(2), pa.array(n, pa.int64()), pa.array(digest, pa.binary()),
                 pa.array(sig, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(bits, pa.binary())],
                names=["id", "t", "n", "digest", "sig", "keys", "bits"])

    # t tells the texts of one id apart
    rows = docs.select(F.col("doc_id").alias("id"), F.col("text").alias("text"), F.xxhash64("text").alias("t"))
    return rows.mapInArrow(run, "id long, t long, n long, digest binary, sig binary, keys array<long>, bits binary")


def _sided(pairs: DataFrame, side: DataFrame, value: str) -> DataFrame:
    left = side.select(F.col("node").alias("a"), F.col(value).alias("va"))
    right = side.select(F.col("node").alias("b"), F.col(value).alias("vb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "va", "vb")


def _confirmed(pairs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) that the full shingle sets of both texts confirm."""

    def verify(batches):
        cache, last = _WordHash(), (None, None)
        for b in batches:
            good = []
            for i, (a, ta, tb) in enumerate(zip(b.column(0).to_pylist(), b.column(2), b.column(3))):
                if last[0] != (a, ta := ta.as_py()):
                    last = ((a, ta), shingle_set(ta, k, cache))
                s, t = last[1], shingle_set(tb.as_py(), k, cache)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= percent * (len(s) + len(t) - both):
                    good.append(i)
            yield b.select(["a", "b"]).take(pa.array(good, pa.int64()))

    return _sided(pairs, texts, "text").mapInArrow(verify, "a long, b long")


def _verified(pairs: DataFrame, sigs: DataFrame, texts: DataFrame, k: int, percent: int) -> DataFrame:
    """Pairs (a, b) that the Bayesian comparison keeps and the full sets confirm."""
    need = least_matches(percent / 100)

    def prune(batches):
        for b in batches:
            if not b.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(b.column(c).to_pylist()), np.uint16).reshape(-1, SIZE) for c in (2, 3))
            at, same = np.arange(b.num_rows), np.zeros(b.num_rows, np.int64)
            for j, least in enumerate(need):
                part = slice(j * BATCH, (j + 1) * BATCH)
                same[at] += (x[at, part] == y[at, part]).sum(axis=1)
                at = at[same[at] >= least]
            yield b.select(["a", "b"]).take(pa.array(at))

    return _confirmed(_sided(pairs, sigs, "sig").mapInArrow(prune, "a long, b long"), texts, k, percent)


def _likely_pairs(rows: DataFrame, percent: int, best: int | None) -> DataFrame:
    """Pairs of different components inside the open buckets that the Bayesian
    comparison keeps: (a, b), once per bucket at most.

    ``rows``: bucket, i, j, side, node, label, sig, n, bits; a group (bucket, i, j) is
    one tile of at most ``2 * TILE`` members, so memory is bounded.  Tiles are
    compared as matrices: only surviving pairs become rows, and with ``best``
    only each member's most similar ones.  Members of the most frequent
    component are compared with the others only.  What a comparison of the
    sets' hash classes rules out (:func:`can_link`, without error) goes as
    well: a large group's stragglers, too far from every member, stay few rows.
    """
    need = least_matches(percent / 100)

    def tile(side, node, label, sig, n, bits, cross):
        names, which, size = np.unique(label, return_inverse=True, return_counts=True)
        if len(names) < 2:
            return
        minor = np.flatnonzero(which != size.argmax())
        for lo in range(0, len(minor), 256):
            x = minor[lo:lo + 256]
            ok = which[x][:, None] != which[None, :]
            ok &= (which[None, :] == size.argmax()) | (x[:, None] < np.arange(len(node))[None, :])
            if cross:
                ok &= side[x][:, None] != side[None, :]
            r, c = np.nonzero(ok)
            same = np.zeros(len(r), np.int64)
            for step, least in enumerate(need):
                part = slice(step * BATCH, (step + 1) * BATCH)
                for at in range(0, len(r), 1 << 16):
                    same[at:at + (1 << 16)] += (sig[x[r[at:at + (1 << 16)]], part] == sig[c[at:at + (1 << 16)], part]).sum(axis=1)
                good = same >= least
                r, c, same = r[good], c[good], same[good]
            good = np.concatenate([can_link(n, bits, x[r[at:at + (1 << 15)]], c[at:at + (1 << 15)], percent)
                                   for at in range(0, len(r), 1 << 15)]) if len(r) else np.zeros(0, bool)
            r, c, same = r[good], c[good], same[good]
            if best is not None:
                order = np.lexsort((node[c], -same, r))
                r, c = r[order], c[order]
                first = np.concatenate([[0], np.flatnonzero(np.diff(r)) + 1]) if len(r) else np.zeros(0, np.int64)
                nth = np.arange(len(r)) - np.repeat(first, np.diff(np.append(first, len(r))))
                r, c = r[nth < best], c[nth < best]
            u, v = node[x[r]], node[c]
            yield np.minimum(u, v), np.maximum(u, v)

    def run(batches):
        held: list[pa.RecordBatch] = []

        def flush():
            t = pa.Table.from_batches(held).combine_chunks()
            side, node, label, n = (t[c].to_numpy() for c in ("side", "node", "label", "n"))
            sig = np.frombuffer(b"".join(t["sig"].to_pylist()), np.uint16).reshape(-1, SIZE)
            bits = np.frombuffer(b"".join(t["bits"].to_pylist()), np.uint64).reshape(-1, CLASSES // 64)
            yield from tile(side, node, label, sig, n, bits, t["i"][0].as_py() != t["j"][0].as_py())

        def out(found):
            for u, v in found:
                if len(u):
                    yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["a", "b"])

        last = None
        for b in batches:
            if not b.num_rows:
                continue
            key = [b.column(c).to_numpy() for c in ("bucket", "i", "j")]
            new = np.flatnonzero(np.any([k[1:] != k[:-1] for k in key], axis=0)) + 1
            edges = [0, *new.tolist(), b.num_rows]
            for lo, hi in zip(edges[:-1], edges[1:]):
                this = tuple(int(k[lo]) for k in key)
                if held and this != last:
                    yield from out(flush())
                    held.clear()
                held.append(b.slice(lo, hi - lo))
                last = this
        if held:
            yield from out(flush())

    return (rows.repartition(shuffle_width(rows.sparkSession), "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j", "node")
            .mapInArrow(run, "a long, b long").distinct())


def _tiles(state: DataFrame, sigs: DataFrame) -> DataFrame:
    """The open buckets' members dealt to tiles: a bucket of more than ``TILE``
    members is cut by a hash into chunks, and every two chunks make a tile."""
    chunks = F.ceil(F.col("size") / TILE).cast("long")
    at = F.pmod(F.xxhash64("node"), F.col("chunks"))
    to = F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1))
    return (state.join(sigs, "node").withColumn("chunks", chunks).withColumn("side", at).withColumn("to", to)
            .select("bucket", F.least("side", "to").alias("i"), F.greatest("side", "to").alias("j"), "side", "node", "label", "sig", "n", "bits"))


def _nodes(usable: DataFrame) -> tuple[DataFrame, bool]:
    """digest, id, t, node of every distinct set: the smallest id with it (and
    its text) and its node, which is that id; of an id that is the smallest of
    several sets all but one get numbers above the ids.  Whether there are such."""
    first = usable.groupBy("digest").agg(F.min(F.struct("id", "t")).alias("r")).select("digest", "r.id", "r.t")
    shared = first.groupBy("id").agg(F.count("*").alias("c"), F.min("digest").alias("d")).where("c > 1").select("id", "d")
    more = cut(first.join(shared, "id").where("digest <> d").select("digest", F.monotonically_increasing_id().alias("nth")), "dedup-more")
    ends = more.agg(F.max("nth")).first()[0]
    if ends is None:
        return first.withColumn("node", F.col("id")), False
    above = usable.agg(F.max("id")).first()[0] + 1
    if above + ends >= 1 << 63:
        raise ValueError("no numbers are left above the ids")
    return first.join(more, "digest", "left").select("digest", "id", "t", F.coalesce(F.col("nth") + above, "id").alias("node")), True


def _decided(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """id, t, n, comp (smallest id reachable over links), part (the component's
    node, null for an empty set) of every row."""
    signed = cut(_sign(docs, k), "dedup-signed")
    usable = signed.where("id is not null and n > 0")
    first, several = _nodes(usable)
    reps = usable.select("id", "t", "digest", "keys").join(first.select("digest", F.col("id").alias("i"), F.col("t").alias("u"), "node"), "digest").where("id = i and t = u")
    bands = reps.select("node", F.explode("keys").alias("bucket"))
    shared = bands.groupBy("bucket").agg(F.min("node").alias("p"), F.max("node").alias("q"), F.count("*").alias("size")).where("p < q")
    active = cut(bands.join(shared.select("bucket", "size"), "bucket").select("bucket", "node", "size").distinct(), "dedup-active")
    # how many candidates a document has: a group's centre has the most
    nodes = cut(active.groupBy("node").agg((-F.sum("size")).alias("rank")), "dedup-nodes")
    n_nodes = nodes.count()
    label = None
    if n_nodes:
        near = small(nodes, n_nodes)
        # a node is one text of an id
        own = small(cut(first.join(near.select("node"), "node").select("id", "t", "node"), "dedup-own"), n_nodes)
        sigs = cut(usable.select("id", "t", "sig", "n", "bits").join(own, ["id", "t"]).drop("id", "t").dropDuplicates(["node"]), "dedup-sigs")
        texts = cut(docs.select(F.col("doc_id").alias("id"), F.xxhash64("text").alias("t"), "text").where("text is not null").join(own, ["id", "t"])
                    .select("node", "text"), "dedup-texts")
        # first every document against the most central one it shares a bucket with
        ranked = active.join(near, "node")
        pivot = ranked.groupBy("bucket").agg(F.min(F.struct("rank", "node")).alias("p"))
        star = (active.join(pivot, "bucket").where("node <> p.node").groupBy("node").agg(F.min("p").alias("p"))
                .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct())
        links = cut(_verified(star, sigs, texts, k, percent), "dedup-links")
        # then whatever is not connected inside a bucket: the likeliest partners, and at last all that may be similar
        for best in (2, None):
            label = components(links)
            known = active.join(label, "node", "left").select("bucket", "node", "size", F.coalesce("label", "node").alias("label"))
            open_ = known.groupBy("bucket").agg(F.min("label").alias("lo"), F.max("label").alias("hi")).where("lo < hi")
            state = known.join(open_.select("bucket"), "bucket")
            pairs = _likely_pairs(_tiles(state, sigs), percent, best)
            links = cut(_confirmed(pairs, texts, k, percent), "dedup-links").unionByName(
                label.where("node <> label").select(F.col("node").alias("a"), F.col("label").alias("b")))
        label = components(links)
    known = first.select("digest", F.col("id").alias("low"), "node")
    known = known.join(label, "node", "left") if label is not None else known.withColumn("label", F.lit(None).cast("long"))
    if several and label is not None:
        # a label may be a number above the ids, or not the smallest id's
        known = cut(known, "dedup-known")
        lows = known.where("label is not null").groupBy("label").agg(F.min("low").alias("least"))
        known = known.join(lows, "label", "left")
    else:
        known = known.withColumn("least", F.col("label"))
    known = known.select("digest", F.coalesce("least", "low").alias("found"), F.coalesce("label", "node").alias("part"))
    linked = F.col("id").isNotNull()
    return signed.select("id", "t", "n", "digest").join(known, "digest", "left").select(
        "id", "t", "n", F.when(linked, F.coalesce("found", "id")).alias("comp"), F.when(linked, F.col("part")).alias("part"))


def near_duplicates(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id (smallest id reachable over links),
    kept (the id is its component's): one row per input row."""
    return _decided(docs, k, percent).select(F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("comp").alias("component_id"),
                                             F.col("id").eqNullSafe(F.col("comp")).alias("kept"))


def keep_first(docs: DataFrame, k: int = 5, percent: int = 80) -> DataFrame:
    """The rows of ``docs`` (all columns) that stay: one per near-copy group.

    A row goes only if its own text has a kept partner.  Rows that repeat an
    id stay once for each group they are in (the first by text), except null
    ids, which are all kept.
    """
    found = cut(_decided(docs, k, percent), "dedup-found")
    key = F.xxhash64("text")
    gone = cut(found.where("id <> comp").select(F.col("id").alias("_gone"), F.col("t").alias("_t")).distinct(), "dedup-gone")
    again = cut(docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("_again")).count().where("count > 1").select("_again"), "dedup-again")
    n_gone, n_again = gone.count(), again.count()
    kept = docs.join(small(gone, n_gone), (docs["doc_id"] == gone["_gone"]) & (key == gone["_t"]), "left_anti")
    if not n_again:
        return kept
    repeated = small(again, n_again)
    single = kept.join(repeated, kept["doc_id"] == again["_again"], "left_anti")
    multi = kept.join(repeated, kept["doc_id"] == again["_again"], "left_semi")
    parts = found.join(repeated, found["id"] == again["_again"], "left_semi").select(F.col("id").alias("_id"), F.col("t").alias("_t"), F.col("part").alias("_part")).distinct()
    multi = multi.withColumn("_key", key).join(parts, (F.col("doc_id") == F.col("_id")) & (F.col("_key") == F.col("_t")))
    # partial aggregate: one row per id and group, whatever the number of repeats
    one = multi.groupBy("doc_id", "_part").agg(F.min(F.struct("text", *[c for c in docs.columns if c not in ("doc_id", "text")])).alias("_r"))
    return single.unionByName(one.select(*[F.col("doc_id") if c == "doc_id" else F.col(f"_r.{c}").alias(c) for c in docs.columns]))
