"""Audit of how far the sources of a language diverge in their use of terms.

Terms are runs of letters (A-Z and everything above ASCII; only A-Z is
lower-cased).  A language keeps the terms that occur in enough of its documents.
Every source gets a smoothed share of each kept term in whole billionths; two
sources differ by the sum of ``f = floor((p-q)^2 / (p+q))`` over all kept terms,
and the terms that a source uses more than its language are listed.

Three steps: Arrow kernels turn texts into partial counts inside the scan's
tasks; the counts are merged by (language, term); shards of some kept terms each
are laid out as a matrix of counts and give partial sums for every pair of
sources and their ten best terms.  No step sees a whole language, source or
vocabulary, and all arithmetic is on whole numbers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from docsift.llm.common import cut, small

MIN_DOCUMENTS = 10
BEST = 10
NOT_TERM = r"[\x00-\x40\x5B-\x60\x7B-\x7F]+"
BILLION = 1_000_000_000
# characters of text that one round of kernels works on; one document may exceed it
ROUND_CHARS = 1 << 22
# partial counts that a task holds before it merges them, and hands them on
MERGE_ROWS = 1 << 20
# counts of a shard, and cells of the matrix that is laid out at a time
SHARD_ROWS = 50_000
MATRIX_CELLS = 1 << 21

_PARTIAL = pa.schema([("lang", pa.string()), ("source", pa.string()), ("term", pa.string()), ("n", pa.int64()), ("docs", pa.int64())])
_FOUND = pa.schema([("lang", pa.string()), ("source", pa.string()), ("part", pa.string()), ("item", pa.string()), ("value", pa.int64())])


def _rounds(batch: pa.RecordBatch, chars: pa.Array):
    """Slices of a batch of about ROUND_CHARS characters."""
    total = np.cumsum(chars.to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        before = total[start - 1] if start else 0
        end = max(start + 1, int(np.searchsorted(total, before + ROUND_CHARS, side="right")))
        yield batch.slice(start, end - start)
        start = end


def _merged(tables: list[pa.Table]) -> pa.Table:
    table = pa.concat_tables(tables).combine_chunks()
    out = table.group_by(["lang", "source", "term"]).aggregate([("n", "sum"), ("docs", "sum")])
    return out.rename_columns({"n_sum": "n", "docs_sum": "docs"}).select(_PARTIAL.names).cast(_PARTIAL)


def _count(batches):
    """Per task: occurrences and documents of every (lang, source, term)."""
    held, rows = [], 0
    for batch in batches:
        for part in _rounds(batch, pc.utf8_length(batch["text"])):
            words = pc.split_pattern_regex(pc.ascii_lower(part["text"]), NOT_TERM)
            flat, parent = words.flatten(), pc.list_parent_indices(words)
            real = pc.not_equal(flat, "")
            term = flat.filter(real).dictionary_encode()
            table = pa.table({"doc": parent.filter(real), "term": term.indices})
            per_doc = table.group_by(["doc", "term"]).aggregate([([], "count_all")])
            lang, source = part["lang"].dictionary_encode(), part["source"].dictionary_encode()
            doc = per_doc["doc"].combine_chunks()
            grouped = pa.table({"lang": lang.indices.take(doc), "source": source.indices.take(doc), "term": per_doc["term"], "n": per_doc["count_all"]}).group_by(
                ["lang", "source", "term"]).aggregate([("n", "sum"), ("n", "count")])
            held.append(pa.table([lang.dictionary.take(grouped["lang"].combine_chunks()), source.dictionary.take(grouped["source"].combine_chunks()),
                                  term.dictionary.take(grouped["term"].combine_chunks()), grouped["n_sum"], grouped["n_count"]], schema=_PARTIAL))
            rows += len(grouped)
            if rows >= MERGE_ROWS:
                held = [_merged(held)]
                rows = len(held[0])
                if rows >= MERGE_ROWS // 2:  # still as many: they go on as they are
                    yield from held.pop().to_batches(max_chunksize=1 << 16)
                    rows = 0
    if held:
        yield from _merged(held).to_batches(max_chunksize=1 << 16)


def _share(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """1 + floor(10^9 (count + 2) / (total + 2 terms)) by long division in steps
    of a thousand, exact for totals up to 9 * 10^15."""
    below = total + 2 * terms
    out, rest = np.zeros(np.broadcast(count, total).shape, dtype=np.int64), count + 2
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def _differ(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    apart = p - q
    return apart * apart // (p + q)


def _shard(counts: pa.Table, sources: pa.Table) -> pa.Table:
    """One shard of a language's terms: partial sums of every pair of sources
    and each source's best terms within the shard."""
    if not len(counts) or not len(sources):
        return _FOUND.empty_table()
    lang, terms = sources["lang"][0], sources["terms"][0].as_py()
    names = sources["source"].combine_chunks()
    total = sources["total"].to_numpy()
    order = pc.sort_indices(counts["term"])  # by UTF-8 bytes
    counts = counts.take(order)
    encoded = counts["term"].combine_chunks().dictionary_encode()
    row = encoded.indices.to_numpy()
    column = pc.index_in(counts["source"].combine_chunks(), names).to_numpy()
    n = counts["n"].to_numpy()
    s = len(names)
    sums = np.zeros((s, s), dtype=np.int64)
    step = max(1, MATRIX_CELLS // s)
    best: list[list[tuple[int, int]]] = [[] for _ in range(s)]
    for low in range(0, len(encoded.dictionary), step):
        a, b = np.searchsorted(row, [low, low + step])
        high = min(low + step, len(encoded.dictionary))
        matrix = np.zeros((s, high - low), dtype=np.int64)
        matrix[column[a:b], row[a:b] - low] = n[a:b]
        p = _share(matrix, total[:, None], terms)
        q = _share(matrix.sum(axis=0), np.int64(total.sum()), terms)
        for i in range(s):
            if i + 1 < s:
                sums[i, i + 1 :] += _differ(p[i], p[i + 1 :]).sum(axis=1)
            above = np.flatnonzero((matrix[i] > 0) & (p[i] > q))
            value = _differ(p[i, above], q[above])
            first = np.argsort(-value, kind="stable")[:BEST]
            best[i] = sorted(best[i] + [(-int(value[k]), low + int(above[k])) for k in first])[:BEST]
    sums += sums.T  # f is the same either way
    at, other = np.nonzero(~np.eye(s, dtype=bool))
    who = [i for i in range(s) for _ in best[i]]
    found = [x for per in best for x in per]
    source = pa.concat_arrays([names.take(pa.array(at)), names.take(pa.array(who, pa.int64()))])
    item = pa.concat_arrays([names.take(pa.array(other)), encoded.dictionary.take(pa.array([k for _, k in found], pa.int64()))])
    value = pa.array(np.concatenate([sums[at, other], np.array([-v for v, _ in found], dtype=np.int64)]))
    part = pa.array(["pair"] * len(at) + ["term"] * len(found), pa.string())
    return pa.table([pa.array([lang.as_py()] * len(value), pa.string()), source, part, item, value], schema=_FOUND)


def audit(docs: DataFrame, min_documents: int = MIN_DOCUMENTS) -> DataFrame:
    """(lang, source, part, item, value, rank): all pairs of a language's
    sources (part ``pair``) and each source's ten most overused terms (``term``).

    Null text, lang and source count as ''.  Every (lang, source) that occurs is
    a group, also without kept terms; a language without kept terms has pairs of
    value 0.  Rows that repeat an id are documents of their own.  Ties rank by
    the item's UTF-8 bytes.  An empty table gives an empty result; extra columns
    of any name are ignored.

    Counts that meet at one term are at most one per source and task, the terms
    of a hot language are dealt to as many shards as its counts ask for, and a
    term list of a hot source is cut to ten in every shard: no task grows with
    the largest language or source.
    """
    spark = docs.sparkSession
    plain = docs.select(*[F.coalesce(F.col(c), F.lit("")).alias(c) for c in ("lang", "source", "text")])
    partial = plain.mapInArrow(_count, "lang string, source string, term string, n long, docs long")
    # dealt by (lang, term): the sum per source and the documents per term need no further shuffle
    merged = partial.repartition("lang", "term").groupBy("lang", "term", "source").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    spread = merged.withColumn("docs", F.sum("docs").over(Window.partitionBy("lang", "term")))
    kept = cut(spread.where(F.col("docs") >= min_documents).select("lang", "term", "source", "n"), "audit-terms")
    groups = plain.select("lang", "source").distinct()
    totals = kept.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    sources = cut(groups.join(totals, ["lang", "source"], "left").select("lang", "source", F.coalesce("total", F.lit(0)).alias("total")), "audit-sources")
    # a term is counted once, at its smallest source
    langs = kept.groupBy("lang", "term").agg(F.count("*").alias("rows")).groupBy("lang").agg(
        F.count("*").alias("terms"), F.ceil(F.sum("rows") / SHARD_ROWS).cast("int").alias("shards"))
    langs = cut(langs, "audit-langs")
    known = small(langs, langs.count())
    dealt = kept.join(known, "lang").select("lang", F.pmod(F.xxhash64("term"), F.col("shards")).cast("int").alias("shard"), "term", "source", "n")
    copies = sources.join(known, "lang").select("lang", "source", "total", "terms", F.explode(F.sequence(F.lit(0), F.col("shards") - 1)).alias("shard"))
    found = dealt.groupBy("lang", "shard").cogroup(copies.groupBy("lang", "shard")).applyInArrow(
        lambda counts, some: _shard(counts, some), "lang string, source string, part string, item string, value long")
    # a term stands in one shard, so summing changes nothing there; pairs without kept terms start at 0
    other = sources.select("lang", F.col("source").alias("item"))
    pairs = sources.join(other, "lang").where("source != item").select("lang", "source", F.lit("pair").alias("part"), "item", F.lit(0).cast("long").alias("value"))
    summed = found.unionByName(pairs).groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.col("value").desc(), "item")
    ranked = summed.withColumn("rank", F.row_number().over(order))
    return ranked.where((F.col("part") == "pair") | (F.col("rank") <= BEST)).select("lang", "source", "part", "item", "value", "rank")
