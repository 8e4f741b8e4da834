"""Store queries: composite key, last-per-key, id assignment, MERGE upsert,
vector attach/upsert/count, insert-if-absent, keyed hash, point lookup.

Scenario: the chunk table is first loaded with the page chunks of every
document (ids 1..n in document/chunk order); then the pipeline is re-run
with the section strategy and that batch is merged in: section chunks whose
key matches a page chunk update it in place, the rest are inserted.  The
vector index follows the same two steps.
"""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.functions.text import keyed_hash
from docsift.functions.vectors import SUMMARY, count_summary
from docsift.jobs import run_index
from docsift.operators.chunking import chunk_pages, chunk_sections
from docsift.operators.embedding import hash_embed, hash_vector
from docsift.operators.store import (
    UPDATE_COLUMNS,
    ChunkStore,
    VectorIndex,
    assign_ids,
    attach_vectors,
    chunk_key,
    insert_if_absent,
    last_per_key,
    lookup,
    merge_upsert,
    open_stores,
    upsert_stats,
    upsert_vectors,
)
from docsift.plans import sqltext as S
from docsift.plans.catalog import register
from docsift.plans.q_chunks import PAGES_SQL, SECTIONS_SQL
from docsift.plans.scenarios import HASH_DIM, form_documents
from docsift.session import scratch_path
from docsift.sources.tables import load

# The service's secret key (a job parameter) and the user
# looked up by name.
SECRET_KEY = "clé-secrète-demo"
LOOKUP_USER = "Customer#000000042"

_KEY_SQL = ("coalesce(File_Name, 'nan') || coalesce(SEC_Number, 'nan') || coalesce(Topic, 'nan') || "
            "coalesce(PDF_Link, 'nan') || Chunk_No::VARCHAR")


def _rows(chunks: DataFrame) -> DataFrame:
    """Chunk rows in store layout plus their order key (doc_id, cno)."""
    return chunks.select(
        "doc_id", F.col("Chunk_No").alias("cno"), "File_Name", "SEC_Number", "Topic", "PDF_Link",
        "Chunk_Content", chunk_key(chunks).alias("combined_columns"),
        F.col("Chunk_No").cast("string").alias("Chunk_No"),
    )


class _Scenario:
    """The two-step load of one query build; each piece is planned once (the
    id assignments checkpoint their input, so rebuilding them would repeat
    that work)."""

    def __init__(self, spark: SparkSession, sf: str):
        self.spark, self.sf = spark, sf

    @cached_property
    def page_rows(self) -> DataFrame:
        return _rows(chunk_pages(form_documents(self.spark, self.sf), "text", running=False))

    @cached_property
    def section_rows(self) -> DataFrame:
        # the batch feeds both the MERGE and the embedding: chunk it once
        docs = form_documents(self.spark, self.sf)
        return _rows(chunk_sections(docs, "text", running=False)).checkpoint(eager=True)

    @cached_property
    def store_v1(self) -> DataFrame:
        return assign_ids(self.page_rows, ["doc_id", "cno"])

    @cached_property
    def store_v2(self) -> DataFrame:
        return merge_upsert(self.store_v1, self.section_rows, "combined_columns", ["doc_id", "cno"],
                            UPDATE_COLUMNS)

    @cached_property
    def index_v1(self) -> DataFrame:
        # the first load embeds the chunk rows just stored (read back from
        # the store's checkpoint instead of chunking the documents again);
        # a full load, so no size check: the join is a shuffled one
        return attach_vectors(self.store_v1, _vectors(self.store_v1), broadcast_bytes=None)

    @cached_property
    def index_batch(self) -> DataFrame:
        return attach_vectors(self.store_v2, _vectors(self.section_rows))


def _vectors(rows: DataFrame) -> DataFrame:
    return rows.select("combined_columns", hash_vector("Chunk_Content", HASH_DIM).alias("Embeddings"))


def vector_stats(col: str = "values") -> list:
    """Order-sensitive summary of a count vector: nonzeros, sum, squared
    norm and a position-weighted checksum (all exact integers)."""
    v = count_summary(F.col(col))                # one call: the four columns share it
    return [v[name].alias(name) for name in SUMMARY]


def _vector_summary(index: DataFrame) -> DataFrame:
    return index.select("id", "File_Name", "SEC_Number", *vector_stats("values"))


_STORE_SQL = f"""
t AS (SELECT row_number() OVER (ORDER BY doc_id, Chunk_No) AS ID, {_KEY_SQL} AS combined_columns,
             File_Name, SEC_Number, Topic, PDF_Link, Chunk_Content, Chunk_No::VARCHAR AS Chunk_No
      FROM ({PAGES_SQL})),
src AS (SELECT {_KEY_SQL} AS combined_columns, File_Name, SEC_Number, Topic, PDF_Link, Chunk_Content,
               Chunk_No::VARCHAR AS Chunk_No, doc_id, Chunk_No AS cno
        FROM ({SECTIONS_SQL})
        QUALIFY row_number() OVER (PARTITION BY combined_columns ORDER BY doc_id DESC, cno DESC) = 1),
upd AS (SELECT t.ID, combined_columns,
               CASE WHEN src.doc_id IS NULL THEN t.File_Name ELSE src.File_Name END AS File_Name,
               CASE WHEN src.doc_id IS NULL THEN t.SEC_Number ELSE src.SEC_Number END AS SEC_Number,
               CASE WHEN src.doc_id IS NULL THEN t.Topic ELSE src.Topic END AS Topic,
               CASE WHEN src.doc_id IS NULL THEN t.PDF_Link ELSE src.PDF_Link END AS PDF_Link,
               CASE WHEN src.doc_id IS NULL THEN t.Chunk_Content ELSE src.Chunk_Content END AS Chunk_Content,
               CASE WHEN src.doc_id IS NULL THEN t.Chunk_No ELSE src.Chunk_No END AS Chunk_No
        FROM t LEFT JOIN src USING (combined_columns)),
ins AS (SELECT (SELECT max(ID) FROM t) + row_number() OVER (ORDER BY doc_id, cno) AS ID, combined_columns,
               File_Name, SEC_Number, Topic, PDF_Link, Chunk_Content, Chunk_No
        FROM src WHERE NOT EXISTS (SELECT 1 FROM t WHERE t.combined_columns = src.combined_columns)),
merged AS (SELECT * FROM upd UNION ALL SELECT * FROM ins)
"""


@register("chunk_key", sql=f"""
SELECT doc_id::BIGINT AS doc_id, Chunk_No::BIGINT AS Chunk_No, {_KEY_SQL} AS combined_columns
FROM ({PAGES_SQL})
""")
def chunk_key_q(spark: SparkSession, sf: str) -> DataFrame:
    """Composite chunk key of every page chunk (missing topic -> nan)."""
    r = _Scenario(spark, sf).page_rows
    return r.select(F.col("doc_id").cast("long"), F.col("cno").cast("long").alias("Chunk_No"),
                    "combined_columns")


@register("last_per_key", sql="""
SELECT source, max(doc_id)::BIGINT AS doc_id, arg_max(lang, doc_id) AS lang,
       arg_max(n_chars, doc_id)::BIGINT AS n_chars
FROM documents GROUP BY source
""")
def last_per_key_q(spark: SparkSession, sf: str) -> DataFrame:
    """Last document (highest id) of every source: last row per key wins."""
    d = load(spark, sf, "documents").select("source", "doc_id", "lang", "n_chars")
    out = last_per_key(d.withColumn("_o", F.col("doc_id")), ["source"], ["_o"])
    return out.select("source", F.col("doc_id").cast("long"), "lang", F.col("n_chars").cast("long"))


@register("assign_ids", sql=f"""
SELECT doc_id::BIGINT AS doc_id, Chunk_No::BIGINT AS Chunk_No,
       row_number() OVER (ORDER BY doc_id, Chunk_No)::BIGINT AS ID
FROM ({PAGES_SQL})
""")
def assign_ids_q(spark: SparkSession, sf: str) -> DataFrame:
    """Identity column over all page chunks in (document, chunk) order."""
    s = _Scenario(spark, sf).store_v1
    return s.select(F.col("doc_id").cast("long"), F.col("cno").cast("long").alias("Chunk_No"),
                    F.col("ID").cast("long"))


@register("chunk_upsert", sql=f"""
WITH {_STORE_SQL}
SELECT ID::BIGINT AS ID, combined_columns, File_Name, SEC_Number, Topic, PDF_Link, Chunk_Content, Chunk_No
FROM merged
""")
def chunk_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """MERGE of the section-strategy batch into the page-chunk table."""
    m = _Scenario(spark, sf).store_v2
    return m.select(F.col("ID").cast("long"), "combined_columns", "File_Name", "SEC_Number", "Topic",
                    "PDF_Link", "Chunk_Content", "Chunk_No")


def _vec_sql(rel: str) -> str:
    """Hashed term counts per combined key of a chunk relation."""
    return S.term_counts(f"SELECT {_KEY_SQL} AS combined_columns, Chunk_Content FROM ({rel})",
                         "combined_columns", "Chunk_Content", HASH_DIM)


def _summary_sql(records: str) -> str:
    return f"""
SELECT id, File_Name, SEC_Number, count(*)::BIGINT AS nnz, sum(n)::BIGINT AS total,
       sum(n * n)::BIGINT AS sq_norm, sum(n * (dim + 1))::BIGINT AS checksum
FROM ({records}) GROUP BY id, File_Name, SEC_Number
"""


_BATCH_RECORDS_SQL = f"""
SELECT merged.ID::VARCHAR AS id, merged.File_Name, merged.SEC_Number, v.dim, v.n
FROM merged JOIN ({_vec_sql(SECTIONS_SQL)}) v USING (combined_columns)
"""

_V1_RECORDS_SQL = f"""
SELECT t.ID::VARCHAR AS id, t.File_Name, t.SEC_Number, v.dim, v.n
FROM t JOIN ({_vec_sql(PAGES_SQL)}) v USING (combined_columns)
"""


@register("attach_vectors", sql=f"WITH {_STORE_SQL} {_summary_sql(_BATCH_RECORDS_SQL)}")
def attach_vectors_q(spark: SparkSession, sf: str) -> DataFrame:
    """Index records (id from the chunk table, vector, metadata) for every
    section chunk of the merged batch."""
    return _vector_summary(_Scenario(spark, sf).index_batch)


@register("vector_upsert", sql=f"""
WITH {_STORE_SQL},
b AS ({_BATCH_RECORDS_SQL}),
v1 AS ({_V1_RECORDS_SQL})
{_summary_sql("SELECT * FROM b UNION ALL SELECT * FROM v1 WHERE id NOT IN (SELECT id FROM b)")}
""")
def vector_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Index after upserting the batch records into the page-chunk index
    (replace by id, keep the rest)."""
    sc = _Scenario(spark, sf)
    return _vector_summary(upsert_vectors(sc.index_v1, sc.index_batch))


def _loaded(spark: SparkSession, sf: str, chunks: DataFrame, stores: tuple[ChunkStore, VectorIndex] | None = None) -> tuple[ChunkStore, VectorIndex]:
    """The index job over a batch of chunks, into new stores or given ones."""
    stores = stores or open_stores(spark, scratch_path(spark, "stores"), HASH_DIM)
    run_index("upsert", *stores, hash_embed(chunks, "Chunk_Content", HASH_DIM), ["doc_id", "Chunk_No"])
    return stores


def _indexed_sql(chunks: str, where: str = "true") -> str:
    """Ids 1..n in document and chunk order, and the index records of the rows
    that pass ``where`` and have a word."""
    return f"""
t AS (SELECT row_number() OVER (ORDER BY doc_id, Chunk_No) AS ID, * FROM ({chunks})),
v AS (SELECT ID, count(*) AS nnz, sum(n) AS total, sum(n * n) AS sq_norm, sum(n * (dim + 1)) AS checksum
      FROM ({S.term_counts(f"SELECT ID, Chunk_Content FROM t WHERE {where}", "ID", "Chunk_Content", HASH_DIM)}) GROUP BY ID)
"""


@register("store_reset_reload", sql=f"""
WITH {_indexed_sql(SECTIONS_SQL)}
SELECT ID::BIGINT AS ID, t.File_Name, t.SEC_Number, t.Topic, t.PDF_Link, t.Chunk_Content, t.Chunk_No::VARCHAR AS Chunk_No,
       v.nnz::BIGINT AS nnz, v.total::BIGINT AS total, v.sq_norm::BIGINT AS sq_norm, v.checksum::BIGINT AS checksum
FROM t LEFT JOIN v USING (ID)
""")
def store_reset_reload(spark: SparkSession, sf: str) -> DataFrame:
    """Page chunks loaded, both tables reset in one commit, then the section
    chunks loaded: ids start at 1 again and no page vector is left."""
    docs = form_documents(spark, sf)
    stores = _loaded(spark, sf, chunk_pages(docs, "text", running=False))
    run_index("delete", *stores)
    store, index = _loaded(spark, sf, chunk_sections(docs, "text", running=False), stores)
    vectors = index.read().select(F.col("id").cast("long").alias("ID"), *vector_stats("values"))
    rows = store.read().join(vectors, "ID", "full_outer")
    return rows.select("ID", "File_Name", "SEC_Number", "Topic", "PDF_Link", "Chunk_Content", "Chunk_No",
                       "nnz", "total", "sq_norm", "checksum")


@register("blank_chunks_leave", sql=f"""
WITH {_indexed_sql(PAGES_SQL, "Topic IS DISTINCT FROM 'quality 0'")}
SELECT ID::VARCHAR AS id, t.File_Name, t.SEC_Number, v.nnz::BIGINT AS nnz, v.total::BIGINT AS total,
       v.sq_norm::BIGINT AS sq_norm, v.checksum::BIGINT AS checksum
FROM t JOIN v USING (ID)
""")
def blank_chunks_leave(spark: SparkSession, sf: str) -> DataFrame:
    """All page chunks loaded, then those of low-quality documents loaded again
    without text: their rows stay under their ids, their vectors leave."""
    pages = chunk_pages(form_documents(spark, sf), "text", running=False)
    stores = _loaded(spark, sf, pages)
    withdrawn = pages.where("Topic = 'quality 0'").withColumn("Chunk_Content", F.lit(""))
    _, index = _loaded(spark, sf, withdrawn, stores)
    return _vector_summary(index.read())


@register("upsert_count", sql=f"""
WITH {_STORE_SQL}
SELECT File_Name, count(DISTINCT id)::BIGINT AS n_upserted FROM ({_BATCH_RECORDS_SQL}) GROUP BY File_Name
""")
def upsert_count(spark: SparkSession, sf: str) -> DataFrame:
    """Number of upserted index records per file."""
    return upsert_stats(_Scenario(spark, sf).index_batch)


# ---------------------------------------------------------------- users

def _ipad_opad_sql(msg: str) -> str:
    from docsift.functions.text import hmac_pad_hex
    ipad, opad = hmac_pad_hex(SECRET_KEY)
    return f"sha256(unhex('{opad}') || unhex(sha256(unhex('{ipad}') || encode({msg}))))"


def _requests(spark, sf) -> DataFrame:
    """Sign-up requests: one per customer."""
    c = load(spark, sf, "customer").select("c_custkey", "c_name", "c_mktsegment")
    return c.select(
        F.col("c_name").alias("username"),
        keyed_hash(F.concat(F.lower("c_mktsegment"), F.lit("-"), F.col("c_custkey").cast("string")),
                   SECRET_KEY).alias("password"),
        F.concat(F.lower(F.replace("c_name", F.lit("#"), F.lit("."))), F.lit("@example.org")).alias("emailid"),
        F.lit("True").alias("active"),
        F.col("c_name").alias("Fullname"),
        F.col("c_custkey").alias("_o"),
    )


def _existing_users(spark, sf) -> DataFrame:
    """Users already registered: the owners of conversations."""
    conv = load(spark, sf, "conversations").select(F.col("conv_id").alias("c_custkey")).distinct()
    owners = load(spark, sf, "customer").join(conv, "c_custkey", "left_semi")
    return owners.select(F.col("c_name").alias("username"))


_USERS_SQL = f"""
req AS (SELECT c_name AS username,
               {_ipad_opad_sql("lower(c_mktsegment) || '-' || c_custkey::VARCHAR")} AS password,
               lower(replace(c_name, '#', '.')) || '@example.org' AS emailid, 'True' AS active,
               c_name AS Fullname, c_custkey AS o
        FROM customer),
ex AS (SELECT c_name AS username FROM customer
       WHERE c_custkey IN (SELECT conv_id FROM conversations)),
firsts AS (SELECT * FROM req QUALIFY row_number() OVER (PARTITION BY username ORDER BY o) = 1),
acc AS (SELECT * FROM firsts f WHERE NOT EXISTS (SELECT 1 FROM ex WHERE ex.username = f.username))
"""


@register("insert_if_absent", sql=f"""
WITH {_USERS_SQL}
SELECT username, password, emailid, active, Fullname FROM acc
""")
def insert_if_absent_q(spark: SparkSession, sf: str) -> DataFrame:
    """Registrations of all customers against the users that already
    exist: the rows that get inserted (password stored as keyed hash)."""
    acc, _ = insert_if_absent(_existing_users(spark, sf), _requests(spark, sf), ["username"], ["_o"])
    return acc.select("username", "password", "emailid", "active", "Fullname")


@register("insert_rejects", sql=f"""
WITH {_USERS_SQL}
SELECT username, 'Username already exists' AS reason FROM req r
WHERE NOT EXISTS (SELECT 1 FROM acc WHERE acc.username = r.username AND acc.o = r.o)
""")
def insert_rejects(spark: SparkSession, sf: str) -> DataFrame:
    """Registrations refused because the username exists."""
    _, rej = insert_if_absent(_existing_users(spark, sf), _requests(spark, sf), ["username"], ["_o"])
    return rej.select("username", F.lit("Username already exists").alias("reason"))


@register("keyed_hash", sql=f"""
SELECT c_custkey::BIGINT AS c_custkey, {_ipad_opad_sql('c_name')} AS name_hash FROM customer
""")
def keyed_hash_q(spark: SparkSession, sf: str) -> DataFrame:
    """HMAC-SHA256 (hex) of every customer name under the service key."""
    c = load(spark, sf, "customer")
    return c.select(F.col("c_custkey").cast("long"), keyed_hash("c_name", SECRET_KEY).alias("name_hash"))


@register("point_lookup", sql=f"""
SELECT c_custkey::BIGINT AS c_custkey, c_name, c_mktsegment FROM customer WHERE c_name = '{LOOKUP_USER}'
""")
def point_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Fetch one user's row by name (equality pushed into the Parquet scan)."""
    c = load(spark, sf, "customer")
    out = lookup(c, "c_name", LOOKUP_USER, ["c_custkey", "c_name", "c_mktsegment"])
    return out.select(F.col("c_custkey").cast("long"), "c_name", "c_mktsegment")
