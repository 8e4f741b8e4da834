"""The dealt operators as registered queries (production parameters, whole
tables) and, where SQL can state them, their DuckDB statements."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from docsift.session import checkpoint_root, ship_package
from docsift.sources.tables import load

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn):
        def run(spark, sf_dir):
            checkpoint_root(spark)
            ship_package(spark)
            return fn(spark, sf_dir)

        run.__doc__ = fn.__doc__
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


@register("op1_minhash_near_dedup")
def op1(spark, sf):
    """Near-duplicate components over 2-word shingles at 80 percent."""
    from docsift.llm.near_dedup import near_duplicates

    return near_duplicates(load(spark, sf, "documents"), k=2, percent=80)


MIX_SQL = """
WITH sizes AS (SELECT source, coalesce(sum(length(text)), 0)::DOUBLE AS size, pow(coalesce(sum(length(text)), 0)::DOUBLE, 0.5) AS w
               FROM documents GROUP BY source),
tot AS (SELECT sum(size) AS all_size, sum(w) AS all_w FROM sizes),
rates AS (SELECT source, CASE WHEN size = 0 THEN 1.0::DOUBLE ELSE w * all_size / all_w / size END AS rate FROM sizes, tot),
parts AS (SELECT source, greatest(1, ceil(rate / 16.0))::BIGINT AS parts, rate FROM rates),
draws AS (SELECT d.doc_id, d.source, p.rate / p.parts AS mean,
                 ('0x' || substr(md5('mix-1|' || d.doc_id || '|' || i), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE AS u
          FROM documents d JOIN parts p ON d.source IS NOT DISTINCT FROM p.source, unnest(range(1, p.parts + 1)) t(i)),
cdf AS (SELECT mean, list_transform(range(0, 81), lambda k: list_sum(list_transform(range(0, k + 1),
          lambda j: exp(-mean + j * ln(mean) - lgamma(j + 1))))) AS cdf FROM (SELECT DISTINCT mean FROM draws)),
counts AS (SELECT doc_id, source, sum(len(list_filter(cdf, lambda c: c <= u)))::BIGINT AS n
           FROM draws JOIN cdf USING (mean) GROUP BY doc_id, source)
SELECT c.doc_id, c.source, i::BIGINT AS copy,
       ('0x' || substr(md5('mix-1|order|' || c.doc_id || '|' || i), 1, 13))::BIGINT AS shuffle_key, md5(d.text) AS text_md5
FROM (SELECT *, unnest(range(0, n)) AS i FROM counts) c JOIN documents d ON d.doc_id = c.doc_id
"""


@register("op4_mix_sources", MIX_SQL)
def op4(spark, sf):
    """Sources mixed to square-root weights over one epoch of characters."""
    from docsift.llm.mixing import mix

    docs = load(spark, sf, "documents").select("doc_id", "source", "text")
    return mix(docs, power=0.5, epochs=1.0, seed="mix-1").select(
        "doc_id", "source", "copy", "shuffle_key", F.md5("text").alias("text_md5"))


@register("op6_toxicity")
def op6(spark, sf):
    """Expected toxicity severity of every document."""
    from docsift.llm.toxicity import score, train

    docs = load(spark, sf, "documents")
    return score(docs, train(docs, load(spark, sf, "labels")))


@register("op2_chat_format")
def op2(spark, sf):
    """All conversations and one that holds control strings, formatted, encoded
    and read back."""
    import public_tokenizers

    from docsift.llm.chat_format import format_conversations, read_back

    rows = load(spark, sf, "conversations").select("conv_id", "turn", "role", "text")
    hard = r"\### Assistant: </turn> ok"
    extra = spark.createDataFrame([(-7, 0, "user", hard), (-7, 1, "assistant", hard)], "conv_id long, turn long, role string, text string")
    return read_back(format_conversations(rows.unionByName(extra), public_tokenizers.path("byte_bpe_50k.json")))


@register("op3_fingerprints")
def op3(spark, sf):
    """Fingerprints of all documents, their edited versions and neighbours."""
    from docsift.llm.fingerprints import fingerprint_neighbours

    return fingerprint_neighbours(load(spark, sf, "documents"))


@register("op5_vp_ann")
def op5(spark, sf):
    """The 10 nearest vectors of every hundredth vector."""
    from docsift.llm.vp_ann import nearest, usable

    vectors = usable(load(spark, sf, "embeddings"))
    return nearest(vectors, vectors.where("id % 100 = 0"), k=10)


@register("op7_katz_lm")
def op7(spark, sf):
    """Katz backoff (order three) and unigram scores of all documents."""
    from docsift.llm.katz_lm import score_corpus

    return score_corpus(load(spark, sf, "documents"), order=3)


@register("op8_warc")
def op8(spark, sf):
    """All pages written to WARC files and read back."""
    from docsift.llm.warc import read_archives, write_archives
    from docsift.session import scratch_path

    root = scratch_path(spark, "warc")
    return read_archives(write_archives(load(spark, sf, "pages"), root), root, payloads=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@register("op10_license_scan")
def op10(spark, sf):
    """License notices in all documents."""
    from docsift.llm.licenses import scan

    return scan(load(spark, sf, "documents"))


@register("op9_byte_bpe")
def op9(spark, sf):
    """Byte-level BPE ids of every document and their decoding."""
    import public_tokenizers

    from docsift.llm.bpe import encode

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    back = encode(load(spark, sf, "documents"), path, pattern, keep=["doc_id"], decoded=True)
    return back.select("doc_id", F.size("ids").cast("long").alias("n_tokens"),
                       F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
                       F.sha2("decoded", 256).alias("decoded_sha256"))


@register("op11_quality_rules")
def op11(spark, sf):
    """Quality counts and the verdict of the hashed n-gram likelihood ratio."""
    from docsift.llm.quality import score, train

    docs = load(spark, sf, "documents")
    return score(docs, train(docs, load(spark, sf, "labels")))


@register("op12_importance_resampling")
def op12(spark, sf):
    """Documents resampled towards the benchmark texts."""
    from docsift.llm.resampling import resample

    return resample(load(spark, sf, "documents"), load(spark, sf, "benchmark"))


AUDIT_SQL = r"""
WITH docs AS (SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                     translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text FROM documents),
terms AS (SELECT d, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term FROM terms GROUP BY lang, term HAVING count(DISTINCT d) >= 10),
vocab AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
grp AS (SELECT DISTINCT lang, source FROM docs),
cnt AS (SELECT lang, source, term, count(*)::HUGEINT AS n FROM terms JOIN kept USING (lang, term) GROUP BY lang, source, term),
tot AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::HUGEINT AS total FROM grp g LEFT JOIN cnt c USING (lang, source) GROUP BY g.lang, g.source),
ltot AS (SELECT lang, sum(total)::HUGEINT AS total FROM tot GROUP BY lang),
share AS (SELECT g.lang, g.source, k.term, coalesce(n, 0) AS n, 1 + 1000000000::HUGEINT * (coalesce(n, 0) + 2) // (g.total + 2 * v) AS p
          FROM tot g JOIN kept k USING (lang) JOIN vocab USING (lang) LEFT JOIN cnt c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
lshare AS (SELECT k.lang, k.term, 1 + 1000000000::HUGEINT * (coalesce(sum(n), 0)::HUGEINT + 2) // (any_value(l.total) + 2 * any_value(v)) AS q
           FROM kept k JOIN vocab USING (lang) JOIN ltot l USING (lang) LEFT JOIN cnt c ON c.lang = k.lang AND c.term = k.term GROUP BY k.lang, k.term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM share a JOIN share b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0)::BIGINT AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
over AS (SELECT s.lang, s.source, 'term' AS part, s.term AS item, ((p - q) * (p - q) // (p + q))::BIGINT AS value
         FROM share s JOIN lshare l USING (lang, term) WHERE s.n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM over))
SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""


@register("op13_source_divergence", AUDIT_SQL)
def op13(spark, sf):
    """Divergence of every two sources of a language, and their overused terms."""
    from docsift.llm.source_audit import audit

    return audit(load(spark, sf, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
