"""Keyed stores: chunk table and vector index.

Set-based re-statements of the row-at-a-time database work:

* :func:`merge_upsert` is one MERGE for a whole batch: the batch is reduced
  to its last row per key (partial aggregation, so a hot key is pre-reduced
  in every task), then one full outer join on the key decides update vs
  insert.  Existing rows keep their id; new rows get the next ids in batch
  order.
* :func:`assign_ids` numbers rows densely and stably without putting all
  rows in one partition: range partitioning by the order key, a position
  inside each partition, and an offset per partition from a tiny count
  table (one row per partition) that is broadcast back.
* :func:`insert_if_absent` is a semi/anti join pair.
* Vector index upserts replace by id (anti join + union).

:class:`ChunkStore` and :class:`VectorIndex` write only the hash buckets that a
batch touches and change in one commit (see ``operators.bucketed``).
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from docsift.functions.text import concat_key
from docsift.operators.bucketed import DEFAULT_BUCKETS, BucketedTable, CommitLog
from docsift.session import checkpoint_root, cut, spent_cuts

KEY_COLUMNS = ["File_Name", "SEC_Number", "Topic", "PDF_Link", "Chunk_No"]
UPDATE_COLUMNS = ["File_Name", "SEC_Number", "Topic", "PDF_Link", "Chunk_Content", "Chunk_No"]
STORE_COLUMNS = ["ID", "File_Name", "SEC_Number", "Topic", "PDF_Link", "Chunk_Content",
                 "combined_columns", "Chunk_No"]


def chunk_key(df: DataFrame, cols: list[str] = KEY_COLUMNS) -> Column:
    """Display key: the five columns as text, no separator, missing -> nan."""
    return concat_key(*cols)


def store_rows(chunks: DataFrame, order: list[str], extra: list[str] = ()) -> tuple[DataFrame, list[str]]:
    """Chunk rows in the chunk-table layout (all text columns, display key
    added) with their order columns under fresh names, and those names."""
    ords = [f"_ord{i}" for i in range(len(order))]
    return chunks.select(
        *[F.col(c).alias(o) for c, o in zip(order, ords)],
        "File_Name", "SEC_Number", "Topic", "PDF_Link", "Chunk_Content",
        chunk_key(chunks).alias("combined_columns"),
        F.col("Chunk_No").cast("string").alias("Chunk_No"), *extra,
    ), ords


def _null_safe(left: DataFrame, right: DataFrame, pairs: list[tuple[str, str]]) -> Column:
    """Equality of the pairs of columns in which a null equals a null.  Where
    both sides have the same types the keys' hash comes first: a merge join
    sorts by it, and long texts that begin alike are hardly compared."""
    same = [left[a].eqNullSafe(right[b]) for a, b in pairs]
    if all(left.schema[a].dataType == right.schema[b].dataType for a, b in pairs):
        same.insert(0, F.xxhash64(*[left[a] for a, _ in pairs]) == F.xxhash64(*[right[b] for _, b in pairs]))
    return reduce(and_, same)


def last_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The last row (by ``order``) of every key.  ``max_by`` is a partial
    aggregate, so each task reduces its share of a hot key before the
    shuffle.  It sorts the rows: by the hash of the key first, which tells keys
    apart that begin with the same text."""
    others = [c for c in df.columns if c not in key]
    agg = df.groupBy(F.xxhash64(*key).alias("_key_hash"), *key).agg(F.max_by(F.struct(*others), F.struct(*order)).alias("_last"))
    return agg.select(*key, *[F.col(f"_last.{c}").alias(c) for c in others])


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    others = [c for c in df.columns if c not in key]
    agg = df.groupBy(*key).agg(F.min_by(F.struct(*others), F.struct(*order)).alias("_first"))
    return agg.select(*key, *[F.col(f"_first.{c}").alias(c) for c in others])


def assign_ids(df: DataFrame, order: list[str], start: int = 0, id_col: str = "ID",
               num_partitions: int | None = None) -> DataFrame:
    """Dense ids ``start+1, start+2, ...`` in ``order`` (which must be a
    unique key, so the numbering is deterministic and survives retries).

    No single-partition window: rows are range-partitioned by the order
    key into a fixed number of partitions (a user-set count, which adaptive
    execution leaves unchanged), numbered inside each partition, and shifted
    by the row count of all earlier partitions.
    """
    spark = df.sparkSession
    n = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(n, *order).sortWithinPartitions(*order)
    tagged = (ranged.withColumn("_pid", F.spark_partition_id())
                    .withColumn("_local", F.monotonically_increasing_id()
                                - F.shiftleft(F.spark_partition_id().cast("long"), 33)))
    # Range bounds come from sampling, and row order after an upstream
    # shuffle is not fixed, so two evaluations could cut differently.  A
    # table in the shared folder pins partition and position once; the count
    # table and the numbered rows are read from the same data.
    tagged = cut(tagged, "numbered")
    counts = tagged.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition: the window and the broadcast are bounded by n
    before = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_pid", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    out = tagged.join(F.broadcast(offsets), "_pid")
    return out.withColumn(id_col, (F.lit(start) + F.col("_off") + F.col("_local") + 1).cast("long")) \
              .drop("_pid", "_local", "_off")


def dense_rank_within(df: DataFrame, group: list[str], order: list[str], out_col: str = "seq") -> DataFrame:
    """0-based position of every row inside its group, in ``order``
    (``group + order`` must be unique).  Skew-safe: a global dense index
    minus the first index of the group (a partial-aggregated min), instead of
    a window that would sort a hot group in a single task."""
    idx = assign_ids(df, group + order, id_col="_g")
    first = idx.groupBy(*[F.col(c).alias(f"_k_{c}") for c in group]).agg(F.min("_g").alias("_g0"))
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_k_{c}")) for c in group])   # null is a group too
    return idx.join(first, same).drop(*[f"_k_{c}" for c in group]).withColumn(out_col, (F.col("_g") - F.col("_g0")).cast("long")) \
              .drop("_g", "_g0")


def max_id(df: DataFrame, id_col: str = "ID") -> int:
    """Largest id of a table (0 when empty): one scalar to the driver."""
    v = df.agg(F.max(id_col)).first()[0]
    return int(v or 0)


# Largest reduced batch (estimated bytes) that a merge ships to every task
# instead of shuffling the store.
DEFAULT_BROADCAST_BYTES = 64 << 20


def value_bytes(field: T.StructField) -> Column:
    c, dt = F.col(field.name), field.dataType
    if isinstance(dt, (T.StringType, T.BinaryType)):
        size = F.octet_length(c)
    elif isinstance(dt, T.ArrayType) and not isinstance(dt.elementType, (T.StringType, T.BinaryType)):
        size = F.size(c) * 8
    elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
        size = F.octet_length(F.to_json(c))
    else:
        size = F.lit(8)
    return F.coalesce(size.cast("long"), F.lit(0).cast("long")) + F.lit(16)


def row_bytes(df: DataFrame) -> Column:
    """Estimated in-memory bytes of a row: UTF-8 size of text, 8 bytes per
    number or array element, plus a fixed per-value overhead."""
    sizes = [value_bytes(f) for f in df.schema.fields]
    total = sizes[0]
    for s in sizes[1:]:
        total = total + s
    return total


def measured(df: DataFrame, wide: bool = False) -> tuple[DataFrame, int, int]:
    """Cut ``df`` with a reliable checkpoint (shared folder; ``wide`` rows of
    text or vectors as a compressed table) and return it with its row count and
    estimated bytes.

    A batch that feeds several branches is then computed once, and whether
    it may be broadcast is decided on its measured size, not on a guess.
    """
    checkpoint_root(df.sparkSession)
    ck = cut(df, "batch") if wide else df.checkpoint(eager=True)
    st = ck.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(ck)).alias("b")).first()
    return ck, int(st["n"]), int(st["b"] or 0)


def last_rows(rows: DataFrame, key: list[str], order: list[str]) -> tuple[DataFrame, int]:
    """:func:`last_per_key` of a batch, cut once, and its estimated bytes (of
    all its rows).  The rows are cut as they come; hashes of their keys tell
    which keys come several times, and only their rows meet each other."""
    batch, _, nbytes = measured(rows, wide=True)
    own = F.xxhash64(*key).alias("_key_hash")
    several, n, size = measured(batch.groupBy(own).count().where("count > 1").select("_key_hash"))
    if n == 0:
        return batch, nbytes
    if size > DEFAULT_BROADCAST_BYTES:
        return cut(last_per_key(batch, key, order), "batch"), nbytes
    hashed, near = batch.select("*", own), F.broadcast(several)
    once = hashed.join(near, "_key_hash", "left_anti").drop("_key_hash")
    met = hashed.join(near, "_key_hash", "left_semi").drop("_key_hash")
    return once.unionByName(cut(last_per_key(met, key, order), "batch")), nbytes


def merge_upsert(target: DataFrame, source: DataFrame, key: str | list[str], order: list[str],
                 update_cols: list[str], id_col: str = "ID",
                 broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, start: int | None = None) -> DataFrame:
    """MERGE ``source`` into ``target`` on ``key`` (one column or several; null
    keys are equal).

    Matched keys take the source values (the last source row per key wins)
    and keep their id; unmatched source keys are inserted with ids after
    ``start`` (default: the target's largest), in ``order``; target rows absent
    from the source stay.  ``order`` columns are only used for ordering and are
    not written.

    The batch is first reduced to one row per key (partial aggregation) and
    measured.  A batch under ``broadcast_bytes`` (the usual incremental
    load) is broadcast: the store streams past it in a map-only hash join
    and is never shuffled, and only the store keys that match the batch
    (at most one per batch row) meet it again to find the inserts.  A larger
    batch (a full rebuild) takes one shuffled full outer join instead.
    """
    keys = [key] if isinstance(key, str) else list(key)
    src, _, nbytes = measured(last_per_key(source.select(*keys, *update_cols, *order), keys, order), wide=True)
    return merge_reduced(target, src, nbytes, keys, order, update_cols, id_col, broadcast_bytes, start)


def merge_reduced(target: DataFrame, src: DataFrame, nbytes: int, keys: list[str], order: list[str],
                  update_cols: list[str], id_col: str = "ID",
                  broadcast_bytes: int = DEFAULT_BROADCAST_BYTES, start: int | None = None,
                  empty: bool = False) -> DataFrame:
    """:func:`merge_upsert` of a batch that is cut already, one row per key;
    ``empty`` says that the target has no rows, so there is nothing to join."""
    s = src.select(*[F.col(c).alias(f"_s_{c}") for c in dict.fromkeys(keys + update_cols + order)], F.lit(True).alias("_in_s"))
    t = target.select(id_col, *keys, *update_cols)
    vals = [F.when(F.col("_in_s").isNotNull(), F.col(f"_s_{c}")).otherwise(F.col(c)).alias(c)
            for c in update_cols]
    same = _null_safe(t, s, [(k, f"_s_{k}") for k in keys])
    taken = [F.col(f"_s_{c}").alias(c) for c in keys + update_cols] + [F.col(f"_s_{c}").alias(f"_o_{c}") for c in order]
    if empty:
        existing, inserts = t, s.select(*taken)
    elif nbytes <= broadcast_bytes:
        existing = t.join(F.broadcast(s), same, "left").select(id_col, *keys, *vals)
        names = s.select(*[f"_s_{k}" for k in keys])
        matched = t.select(*keys).join(F.broadcast(names), _null_safe(t, names, [(k, f"_s_{k}") for k in keys]), "left_semi")
        matched = matched.select(*[F.col(k).alias(f"_m_{k}") for k in keys])
        inserts = s.join(matched, _null_safe(s, matched, [(f"_s_{k}", f"_m_{k}") for k in keys]), "left_anti").select(*taken)
    else:
        j = t.withColumn("_in_t", F.lit(True)).join(s, same, "full_outer")
        existing = j.where(F.col("_in_t").isNotNull()).select(id_col, *keys, *vals)
        # inserts take every value from the batch, so this branch reads only
        # the key of the store (id assignment samples its input once more)
        inserts = j.where(F.col("_in_t").isNull()).select(*taken)
    first = max_id(target, id_col) if start is None else start
    new = assign_ids(inserts, [f"_o_{c}" for c in order], start=first, id_col=id_col)
    return existing.unionByName(new.select(id_col, *keys, *update_cols))


def insert_if_absent(target: DataFrame, source: DataFrame, key: list[str],
                     order: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows to insert (first request per new key) and rejected requests
    (key already present, or a later duplicate in the same batch)."""
    first = first_per_key(source, key, order)
    def known(cols, names):
        return reduce(and_, [F.col(c).eqNullSafe(F.col(n)) for c, n in zip(cols, names)])

    taken = [f"_t_{c}" for c in key]
    accepted = first.join(target.select(*[F.col(c).alias(n) for c, n in zip(key, taken)]), known(key, taken), "left_anti")
    both = list(dict.fromkeys(key + list(order)))
    kept = [f"_a_{c}" for c in both]
    rejected = source.join(accepted.select(*[F.col(c).alias(n) for c, n in zip(both, kept)]), known(both, kept), "left_anti")
    return accepted.select(*source.columns), rejected


def lookup(df: DataFrame, col: str, value, cols: list[str]) -> DataFrame:
    """Point lookup by equality with projection (pushed into the scan)."""
    return df.where(F.col(col) == F.lit(value)).select(*cols)


# ---------------------------------------------------------------- vectors

VECTOR_SCHEMA = T.StructType([
    T.StructField("id", T.StringType()),
    T.StructField("values", T.ArrayType(T.FloatType())),
    T.StructField("File_Name", T.StringType()),
    T.StructField("SEC_Number", T.StringType()),
])


def attach_vectors(store: DataFrame, embedded: DataFrame, key: str = "combined_columns",
                   vec_col: str = "Embeddings", id_col: str = "ID",
                   broadcast_bytes: int | None = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Index records for every stored chunk whose key has a vector.

    ``embedded`` holds one vector per key (reduce a batch with
    :func:`last_per_key` first).  Rows without a vector, with an empty one or
    an all-zero one (a blank chunk: cosine is undefined) are skipped.  The
    vector batch is measured (and so embedded exactly once): under
    ``broadcast_bytes`` it is broadcast and the store streams past it without
    a shuffle.  ``None`` is for a known full load: nothing is measured and
    the join is left to adaptive execution.
    """
    v = F.col(vec_col)
    vecs = embedded.select(key, vec_col).where(v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0))
    near = False
    if broadcast_bytes is not None:
        vecs, _, nbytes = measured(vecs, wide=True)
        near = nbytes <= broadcast_bytes
    vecs = vecs.select(F.col(key).alias("_v_key"), F.col(vec_col).alias("_v"))
    rows = store.select(id_col, key, "File_Name", "SEC_Number")
    joined = rows.join(F.broadcast(vecs) if near else vecs, _null_safe(rows, vecs, [(key, "_v_key")]) & F.col(key).isNotNull())
    return joined.select(F.col(id_col).cast("string").alias("id"),
                         F.col("_v").cast("array<float>").alias("values"), "File_Name", "SEC_Number")


def upsert_vectors(index: DataFrame, records: DataFrame,
                   broadcast_bytes: int = DEFAULT_BROADCAST_BYTES) -> DataFrame:
    """Overwrite-or-insert by id; ids not in the batch are kept.

    The batch is measured once (it feeds both the id filter and the
    union); when its ids fit under ``broadcast_bytes`` the index streams
    past them in a map-only anti join instead of being shuffled.
    """
    recs, _, nbytes = measured(records.select(*index.columns), wide=True)
    ids = recs.select("id")
    # the ids are a part of the measured batch; size them only when the
    # whole batch is over the limit
    if nbytes <= broadcast_bytes or (
            (ids.agg(F.sum(F.octet_length("id") + F.lit(16))).first()[0] or 0) <= broadcast_bytes):
        ids = F.broadcast(ids)
    kept = index.join(ids, on="id", how="left_anti")
    return kept.unionByName(recs)


def dimension_violations(index: DataFrame, dim: int) -> DataFrame:
    """Records whose vector length differs from the index dimension."""
    return index.where(F.col("values").isNull() | (F.size("values") != dim))


STORE_SCHEMA = T.StructType(
    [T.StructField("ID", T.LongType())]
    + [T.StructField(c, T.StringType()) for c in STORE_COLUMNS[1:]]
)


class ChunkStore(BucketedTable):
    """The chunk table: dealt to buckets and merged by the five key columns."""

    def __init__(self, spark: SparkSession, root: str, log: CommitLog | None = None, buckets: int = DEFAULT_BUCKETS):
        super().__init__(spark, root, STORE_SCHEMA, KEY_COLUMNS, "chunks", log, buckets)

    def stage_batch(self, rows: DataFrame, nbytes: int, order: list[str], head: dict) -> tuple[dict, DataFrame]:
        """MERGE a batch (:func:`store_rows`, one row per key) into the buckets
        that its keys fall in.  Only those are read, only those are written."""
        touched = self.touched(rows, head=head)
        with spent_cuts(self.spark):
            merged = merge_reduced(self.read(head, touched), rows, nbytes, KEY_COLUMNS, order, ["Chunk_Content", "combined_columns"],
                                   start=self.max_id(head), empty=not self.holds(head, touched))
            return self.stage(merged, touched, head, "ID", nbytes)

    def upsert(self, chunks: DataFrame, order: list[str]) -> dict:
        """MERGE chunk rows and commit; ``order`` (a unique key of the batch,
        e.g. document and chunk number) decides which duplicate wins and the
        order of new ids."""
        head = self.log.head()
        rows, ords = store_rows(chunks, order)
        src, nbytes = last_rows(rows, KEY_COLUMNS, ords)
        change, _ = self.stage_batch(src, nbytes, ords, head)
        return self._commit(head, change)


# Similarity metrics the retrieval operator implements.
METRICS = ("cosine",)


class VectorIndex(BucketedTable):
    """Vector records (id, values, metadata) with a fixed dimension and
    metric; created empty on first use, like a create-if-absent index."""

    def __init__(self, spark: SparkSession, root: str, dim: int, metric: str = "cosine", log: CommitLog | None = None,
                 buckets: int = DEFAULT_BUCKETS):
        if metric not in METRICS:
            raise ValueError(f"unsupported metric {metric!r}; expected one of {METRICS}")
        if dim <= 0:
            raise ValueError("the index dimension must be positive")
        super().__init__(spark, root, VECTOR_SCHEMA, ["id"], "vectors", log, buckets)
        self.dim, self.metric = dim, metric

    def stage_batch(self, records: DataFrame, removed: DataFrame | None, nbytes: int, head: dict) -> dict:
        """Records that replace or join those of their ids, and ids that leave,
        in one write of the buckets they fall in.  ``records`` and ``removed``
        are cut already; ``nbytes`` bounds both."""
        good = records.where(F.col("values").isNotNull() & (F.size("values") == self.dim)).select(*VECTOR_SCHEMA.fieldNames())
        ids = good.select("id") if removed is None else good.select("id").unionByName(removed.select("id"))
        touched = self.touched(ids, head=head)
        ids = F.broadcast(ids) if nbytes <= DEFAULT_BROADCAST_BYTES else ids
        rows = self.read(head, touched).join(ids, on="id", how="left_anti").unionByName(good)
        return self.stage(rows, touched, head, nbytes=nbytes)[0]

    def upsert(self, records: DataFrame, removed: DataFrame | None = None) -> tuple[dict, DataFrame]:
        """Commit the index with ``records`` upserted and the ids of ``removed``
        taken out; records whose dimension differs from the index's are left
        out and returned for quarantine."""
        head = self.log.head()
        recs, _, nbytes = measured(records, wide=True)
        if removed is not None:
            removed, _, more = measured(removed.select("id"))
            nbytes += more
        return self._commit(head, self.stage_batch(recs, removed, nbytes, head)), dimension_violations(recs, self.dim)


def open_stores(spark: SparkSession, root: str, dim: int, buckets: int = DEFAULT_BUCKETS) -> tuple[ChunkStore, VectorIndex]:
    """A chunk table and a vector index that change together: both read one
    commit log, whose records name the versions of both."""
    log = CommitLog(spark, f"{root.rstrip('/')}/commits")
    return ChunkStore(spark, f"{root}/chunks", log, buckets), VectorIndex(spark, f"{root}/vectors", dim, log=log, buckets=buckets)


def commit_both(store: ChunkStore, index: VectorIndex, heads: tuple[dict, dict], changes: tuple[dict, dict],
                epoch: tuple[str, int] | None = None) -> None:
    """Commit the staged parts of both tables: one record if they share a log
    (see :func:`open_stores`), else the chunk table's before the index's."""
    if store.log.root == index.log.root:
        store.log.commit(heads[0], {store.name: changes[0], index.name: changes[1]}, epoch)
        store.log.expire([store, index])
        return
    for table, head, change in zip((store, index), heads, changes):
        table.log.commit(head, {table.name: change}, epoch)
        table.log.expire([table])


def reset_store(store: ChunkStore, index: VectorIndex) -> None:
    """Reset the chunk table and the vector index together (ids restart at
    1 and no old vector can alias a new id)."""
    commit_both(store, index, (store.log.head(), index.log.head()), (store.empty(), index.empty()))


def attach_ids(stored: DataFrame, batch: DataFrame, nbytes: int, vec_col: str = "Embeddings") -> DataFrame:
    """(id, values, File_Name, SEC_Number) of every batch row from the stored
    rows of its five-column key, cut once; ``values`` is null for a chunk whose
    vector is missing, empty or all zero (cosine is undefined), which is the
    sign to take its id out of the index."""
    v = F.col(vec_col)
    live = F.when(v.isNotNull() & (F.size(v) > 0) & F.exists(v, lambda x: x != 0), v.cast("array<float>"))
    b = batch.select(*[F.col(k).alias(f"_b_{k}") for k in KEY_COLUMNS], live.alias("values"))
    t = stored.select("ID", *KEY_COLUMNS)
    joined = t.join(F.broadcast(b) if nbytes <= DEFAULT_BROADCAST_BYTES else b, _null_safe(t, b, [(k, f"_b_{k}") for k in KEY_COLUMNS]))
    return cut(joined.select(F.col("ID").cast("string").alias("id"), "values", "File_Name", "SEC_Number"), "records", keep=True)


def upsert_stats(records: DataFrame, by: list[str] = ("File_Name",)) -> DataFrame:
    """Number of upserted index records per group (a partial aggregate)."""
    return records.groupBy(*by).agg(F.count(F.lit(1)).cast("long").alias("n_upserted"))
