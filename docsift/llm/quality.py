"""Quality rules: plain counts and a hashed n-gram log-likelihood ratio.

Words are runs of characters other than space and U+0009..U+000D.  The base
rules count a document's words, symbols, repeated lines and words in repeated
8-word windows.  The verdict compares two multinomials over ``BUCKETS`` hashed
word unigrams and bigrams, one of the trusted documents (labelled quality 1)
and one of all documents:

    gain[b] = floor(10^6 * ln((t*S + k*T) / ((s + k) * T)))

with s, S the raw and t, T the trusted counts: the ratio of the two shares, each
bucket first given ``k`` more raw n-grams of which the trusted share is trusted,
so that rare buckets say little and small corpora are not judged by noise.  A
document's score is the sum of its n-grams' gains, in whole millionths of a
nat, so it does not depend on the order of a sum; it is kept if the sum is at
least ``threshold`` per n-gram.  Every document meets the same threshold: there
is no random draw.

Everything is a JVM expression.  Counting is one pass with a map-side combine
into at most ``BUCKETS`` rows a task; scoring is one pass without any shuffle,
with the gains as one constant array.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# the two multinomials have this many buckets: the model is a constant of as
# many longs whatever the size of the corpus
BUCKETS = 1 << 16
# raw n-grams added to every bucket, split like the corpus
PRIOR = 20
# millionths of a nat per n-gram.  On a table of 50,000 documents clean ones score above
# -57,000 and those of shouted, symbol-ridden or table words below -107,000
THRESHOLD = -80_000
# at most about this many labelled documents make the trusted multinomial
MAX_TRUSTED = 200_000
SCALE = 1_000_000

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
SYMBOLS = "#*$%&|<>"
SPACES = r"[\x20\x09-\x0D]+"


def _text(docs: DataFrame) -> Column:
    return F.coalesce(docs["text"], F.lit(""))


def _mod(x: Column, buckets: int) -> Column:
    return F.pmod(x, F.lit(buckets))


def _hashed(text: Column) -> tuple[Column, Column]:
    """The words of a text and their hashes."""
    words = F.array_remove(F.split(text, SPACES), "")
    return words, F.transform(words, lambda w: F.xxhash64(w))


def _joined(hashes: Column, apart: int) -> Column:
    """Hash of each element with the one ``apart`` behind it: from words come
    2-word windows, from those 4-word windows and so on."""
    return F.transform(F.slice(hashes, F.lit(1), F.greatest(F.size(hashes) - apart, F.lit(0))),
                       lambda x, i: F.xxhash64(x, F.get(hashes, i + apart)))


def trusted_ids(labels: DataFrame, max_trusted: int = MAX_TRUSTED) -> DataFrame:
    """Ids of the trusted documents (some label row says quality 1), by a hash
    of the id thinned to about ``max_trusted``: at most that many (give or take
    their binomial spread) ever reach a broadcast.  Below the bound all stay."""
    ids = labels.where("quality = 1 AND doc_id IS NOT NULL").select(F.col("doc_id").alias("_trusted")).distinct()
    share = min(1.0, max_trusted / max(1, ids.count()))
    return ids if share == 1.0 else ids.where(F.pmod(F.xxhash64("_trusted"), F.lit(1 << 30)) < int(share * (1 << 30)))


def train(docs: DataFrame, labels: DataFrame, buckets: int = BUCKETS, max_trusted: int = MAX_TRUSTED) -> list[int]:
    """Gain of every bucket.  Raw counts cover all documents.

    Without a trusted document every gain is 0 and the verdict rejects nothing.
    A document that occurs twice counts twice.
    """
    trusted = F.broadcast(trusted_ids(labels, max_trusted))
    texts = docs.select(docs["doc_id"].alias("_id"), _text(docs).alias("_text"))
    flagged = texts.join(trusted, F.col("_id") == F.col("_trusted"), "left").select("_text", F.col("_trusted").isNotNull().cast("long").alias("_t"))
    hashed = flagged.select("_t", _hashed(F.col("_text"))[1].alias("_h"))
    grams = hashed.select("_t", F.explode(F.concat("_h", _joined(F.col("_h"), 1))).alias("_g"))
    rows = grams.groupBy(_mod(F.col("_g"), buckets).alias("b")).agg(F.count("*").alias("s"), F.sum("_t").alias("t")).collect()  # at most `buckets` rows
    s, t = [0] * buckets, [0] * buckets
    for b, raw, ours in rows:
        s[b], t[b] = raw, ours
    raw_all, ours_all = sum(s), sum(t)
    if not ours_all:
        return [0] * buckets
    return [math.floor(SCALE * math.log((y * raw_all + PRIOR * ours_all) / ((x + PRIOR) * ours_all))) for x, y in zip(s, t)]


def _repeated(starts: Column, size: int) -> Column:
    """Words covered by the windows that start at these ascending positions."""
    covered = F.transform(starts, lambda p, i: F.least(F.lit(size), F.coalesce(F.get(starts, i + 1) - p, F.lit(size))))
    return F.aggregate(covered, F.lit(0).cast("long"), lambda a, x: a + x)


def score(docs: DataFrame, gains: list[int], threshold: int = THRESHOLD) -> DataFrame:
    """One row per document row: counts, ``base_failed``, ``llr`` (millionths
    of a nat, the sum over ``n_ngrams`` unigrams and bigrams) and ``kept``.

    Null and empty texts have no words, score 0 and fail the base rules.  Rows
    that repeat an id are scored each by its own text.  Extra columns of any
    name are ignored.  Two windows or lines are equal if their words or
    characters are; windows are compared by 64-bit hashes, which tell any two
    windows of a text of n words apart with a probability of 1 - n^2 / 2^65.
    """
    buckets = len(gains)
    gain = F.split(F.lit(",".join(map(str, gains))), ",").cast("array<bigint>")  # folded into one constant

    def total(hashes: str) -> Column:
        return F.aggregate(hashes, F.lit(0).cast("long"), lambda a, x: a + F.get(gain, _mod(x, buckets).cast("int")))

    # every step names an array that the next one reads more than once, so
    # Catalyst keeps the steps apart and computes each array once per row
    texts = docs.select("doc_id", _text(docs).alias("_text"))
    lines = F.filter(F.split("_text", "\n"), lambda x: F.regexp_replace(x, SPACES, "") != "")
    split = texts.select("doc_id", "_text", _hashed(F.col("_text"))[0].alias("_words"), lines.alias("_lines"))
    words = split.select(
        "doc_id", F.size("_words").cast("long").alias("n_words"), F.length(F.array_join("_words", "")).cast("long").alias("word_chars"),
        (F.length("_text") - F.length(F.translate("_text", SYMBOLS, ""))).cast("long").alias("n_symbols"),
        (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("long").alias("n_dup_lines"),
        F.transform("_words", lambda w: F.xxhash64(w)).alias("_h"))
    counted = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines"]
    pairs = words.select(*counted, "_h", _joined(F.col("_h"), 1).alias("_h2"))
    fours = pairs.select(*counted, (total("_h") + total("_h2")).alias("llr"), (F.size("_h") + F.size("_h2")).cast("long").alias("n_ngrams"),
                         _joined(F.col("_h2"), 2).alias("_h4"))
    counted += ["llr", "n_ngrams"]
    eights = fours.select(*counted, _joined(F.col("_h4"), 4).alias("_h8"))
    placed = F.sort_array(F.transform("_h8", lambda x, i: F.struct(x.alias("h"), i.alias("i"))))
    repeats = F.size(F.array_distinct("_h8")) < F.size("_h8")
    windows = eights.select(*counted, F.when(repeats, placed).alias("_at"))
    twice = F.transform("_at", lambda e, k: F.when((e["h"] == F.get("_at", k - 1)["h"]) | (e["h"] == F.get("_at", k + 1)["h"]), e["i"]))
    starts = windows.select(*counted, F.sort_array(F.array_compact(twice)).alias("_starts"))
    done = starts.select(*counted, F.when(F.col("_starts").isNull(), F.lit(0)).otherwise(_repeated(F.col("_starts"), WINDOW)).cast("long").alias("n_repeat_words"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    judged = done.withColumn("base_failed", failed)
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
                         (~F.col("base_failed") & (F.col("llr") >= threshold * F.col("n_ngrams"))).alias("kept"), "n_ngrams", "llr")
