"""Toxicity grades by cumulative-link (proportional odds) ordinal regression.

One weight vector over sparse binary text features is shared by all ordered
thresholds: ``P(grade >= j) = sigmoid(w.x - theta_j)`` with
``theta_1 < theta_2``.  Reported are the expected severity (the sum of these
probabilities, 0 to 2), the probability of any toxicity and the grade.

Features are the distinct lower-cased words of the *whole* text without
leading and trailing punctuation, and their first 4, 5 and 6 letters (insults
are inflected), hashed to 2^20.  The labels know only toxic 0/1, so the grade
of a labelled row is 0 for clean rows and, for toxic rows, 1 or 2 by the number
of their features which the sample shows (almost) only in toxic rows: those
above the median are grade 2.

The model is fitted on a bounded sample of labelled rows (``max_train``, half
of it toxic where there are enough), chosen by the hash of the id; of an id
with several texts the one with the smallest feature list is learned, so the
model does not depend on the order of rows.  Scoring covers every row.

Defined results: a null or empty text has no features and gets the model's
base rate (far below the cut in any sample with a clean majority or balance
of featureless rows); null ids and repeated rows are scored row by row; an
empty table gives an empty result; with no labels, or labels of one class
only, nothing is toxic (probability 0).  Columns other than the id and the
text are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 20
PREFIXES = (4, 5, 6)
GRADES = 3
MAX_TRAIN = 8_000
MIN_ROWS = 5            # a feature must occur in this many sampled rows
SCREEN = 6.0
_EDGE = re.compile(r"^\W+|\W+$")
SCHEMA = "doc_id long, p_toxic double, expected_severity double, severity int, toxic boolean"


class _Features(dict):
    """word -> hashed features; forgets everything at a bounded size (some 10 MB
    a Python worker)."""

    def __missing__(self, word: str) -> tuple:
        if len(self) > 30_000:
            self.clear()
        core = _EDGE.sub("", word)
        found = ()
        if core:
            mask = (1 << BITS) - 1
            found = (xxhash.xxh3_64_intdigest("w" + core) & mask,
                     *(xxhash.xxh3_64_intdigest(f"p{n}{core[:n]}") & mask for n in PREFIXES if len(core) >= n))
        self[word] = found
        return found


def text_features(text: str | None, cache: _Features) -> np.ndarray:
    words = set((text or "").lower().split())
    found: set[int] = set()
    for w in words:
        found.update(cache[w])
    out = np.fromiter(found, dtype=np.int64, count=len(found))
    out.sort()
    return out


def fit_ordinal(flat: np.ndarray, lens: np.ndarray, grade: np.ndarray, classes: int, l2: float = 1e-4,
                steps: int = 300, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """Weights (dense over the hashed features) and thresholds of the
    proportional-odds model, by full-batch Adam on the penalised mean
    log-likelihood.  ``flat`` holds the rows' features one after the other,
    ``lens`` how many each row has.  Features of fewer than ``MIN_ROWS`` rows,
    or whose rates in toxic and clean rows differ by under ``SCREEN`` standard
    errors, get no weight."""
    rows = np.arange(len(lens))
    # screening: features whose rates among toxic and clean rows differ clearly
    toxic, of_toxic = (grade > 0).sum(), np.repeat(grade > 0, lens)
    has = [np.bincount(flat[of_toxic == y], minlength=1 << BITS) for y in (True, False)]
    size = (max(1, toxic), max(1, len(lens) - toxic))
    both = (has[0] + has[1]) / len(lens)
    gap = has[0] / size[0] - has[1] / size[1]
    often = (has[0] + has[1] >= MIN_ROWS) & (np.abs(gap) >= SCREEN * np.sqrt(np.maximum(both * (1 - both), 1e-9) * (1 / size[0] + 1 / size[1])))
    used = np.flatnonzero(often)
    keep = often[flat]
    owner = np.repeat(rows.astype(np.int32), lens)[keep]
    flat = (np.cumsum(often, dtype=np.int32) - 1)[flat[keep]]
    n = max(1, len(rows))
    # a feature counts by its log-odds between toxic and clean rows, so telling ones move first
    value = np.abs(np.log((has[0][used] + 0.5) / (size[0] + 1)) - np.log((has[1][used] + 0.5) / (size[1] + 1)))
    w, theta = np.zeros(len(used)), np.linspace(0.5, 1.5, classes - 1)
    m1, v1 = np.zeros(len(used) + classes - 1), np.zeros(len(used) + classes - 1)
    for t in range(1, steps + 1):
        s = np.bincount(owner, weights=(w * value)[flat], minlength=len(rows))
        above = np.hstack([np.ones((len(rows), 1)), _sigmoid(s[:, None] - theta), np.zeros((len(rows), 1))])
        hi, lo = above[rows, grade], above[rows, grade + 1]
        p = np.maximum(hi - lo, 1e-12)
        ds = -(1 - hi - lo) / n
        dw = np.bincount(flat, weights=ds[owner], minlength=len(used)) * value + l2 * w
        dt = np.zeros(classes - 1)
        for j in range(classes - 1):
            slope = above[:, j + 1] * (1 - above[:, j + 1]) / p
            dt[j] = (slope[grade == j + 1].sum() - slope[grade == j].sum()) / n
        g = np.concatenate([dw, dt])
        m1, v1 = 0.9 * m1 + 0.1 * g, 0.999 * v1 + 0.001 * g * g
        step = rate * (m1 / (1 - 0.9 ** t)) / (np.sqrt(v1 / (1 - 0.999 ** t)) + 1e-8)
        w, theta = w - step[:len(used)], theta - step[len(used):]
        for j in range(1, classes - 1):                      # the thresholds stay ordered
            theta[j] = max(theta[j], theta[j - 1] + 1e-3)
    dense = np.zeros(1 << BITS, dtype=np.float32)
    dense[used] = w * value
    return dense, theta


def _sigmoid(x):
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


def grades_of(flat: np.ndarray, lens: np.ndarray, toxic: np.ndarray) -> np.ndarray:
    """0 for clean rows; toxic rows 1 or 2 by their number of marker features
    (log-odds of at least 3 between toxic and clean rows of the sample)."""
    of_toxic = np.repeat(toxic == 1, lens)
    count = [np.bincount(flat[of_toxic == y], minlength=1 << BITS) for y in (False, True)]
    size = [max(1, int((toxic == y).sum())) for y in (0, 1)]
    odds = np.log((count[1] + 0.5) / (size[1] + 1)) - np.log((count[0] + 0.5) / (size[0] + 1))
    marker = (odds >= 3) & (count[1] >= MIN_ROWS)
    ends = np.cumsum(lens)
    hits = np.concatenate([[0], np.cumsum(marker[flat], dtype=np.int64)])
    marks = hits[ends] - hits[ends - lens]
    grade = toxic.astype(np.int64)
    if (toxic == 1).any():
        grade[(toxic == 1) & (marks > np.median(marks[toxic == 1]))] = 2
    return grade


def train(docs: DataFrame, labels: DataFrame, max_train: int = MAX_TRAIN):
    """(weights, thresholds), or None without both classes."""
    ids = labels.select(F.col("doc_id").alias("_id"), F.col("toxic").alias("_toxic")).where("_id is not null and _toxic in (0, 1)")
    # one label per id: the larger one if rows disagree
    ids = ids.groupBy("_id").agg(F.max("_toxic").alias("_toxic"))
    half = [ids.where(F.col("_toxic") == y).orderBy(F.xxhash64("_id"), "_id").limit(max_train // 2) for y in (0, 1)]
    sample = half[0].unionByName(half[1])              # at most max_train narrow rows: a proven bound
    rows = (docs.select(F.col("doc_id").alias("_id"), F.col("text").alias("_text"))
            .join(F.broadcast(sample), "_id").select("_id", "_toxic", "_text"))

    def features(batches):
        cache = _Features()
        for b in batches:
            found = [text_features(x, cache) for x in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1).cast(pa.int32()), pa.array([f.astype(np.int32) for f in found], pa.list_(pa.int32()))],
                                             names=["_id", "_toxic", "f"])

    # of an id with several texts the one whose feature list is the smallest; at most ``max_train`` rows reach the driver
    one = rows.mapInArrow(features, "_id long, _toxic int, f array<int>").groupBy("_id").agg(F.min(F.struct("_toxic", "f")).alias("r"))
    got = one.select("_id", "r.*").toArrow().sort_by("_id").combine_chunks()
    toxic = got["_toxic"].to_numpy().astype(np.int64)
    if len(toxic) == 0 or toxic.min() == toxic.max():
        return None
    lists = got["f"].combine_chunks()
    lens, flat = np.diff(lists.offsets.to_numpy()).astype(np.int64), lists.flatten().to_numpy()
    return fit_ordinal(flat, lens, grades_of(flat, lens, toxic), GRADES)


def _above(texts: pa.Array, model, cache: _Features) -> np.ndarray:
    """P(grade >= 1), P(grade >= 2), ... per text."""
    if model is None or not len(texts):
        return np.zeros((len(texts), GRADES - 1))
    w, theta = model
    s = np.array([float(w[text_features(x.as_py(), cache)].sum(dtype=np.float64)) for x in texts])
    return _sigmoid(s[:, None] - theta)


def score(docs: DataFrame, model, cut_at: float = 0.5) -> DataFrame:
    """One row per input row: id, probabilities, severity and decision."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        cache = _Features()
        for b in batches:
            above = _above(b.column(1), held.value, cache)
            p = np.hstack([1 - above[:, :1], above[:, :-1] - above[:, 1:], above[:, -1:]])
            yield pa.RecordBatch.from_arrays(
                [b.column(0).cast(pa.int64()), pa.array(above[:, 0]), pa.array(above.sum(axis=1)),
                 pa.array(p.argmax(axis=1).astype(np.int32)), pa.array(above[:, 0] >= cut_at)],
                names=["doc_id", "p_toxic", "expected_severity", "severity", "toxic"])

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_clean(docs: DataFrame, model, cut_at: float = 0.5) -> DataFrame:
    """The rows of ``docs`` (all columns) that are not toxic.  Only the text goes
    to Python and only the decision comes back."""
    held = docs.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("boolean")
    def clean(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        cache = _Features()
        for t in texts:
            yield pa.array(_above(t, held.value, cache)[:, 0] < cut_at)

    return docs.where(clean(docs["text"]))
