"""Quality rules, importance resampling and the source audit against brute
force, and the defined results of odd inputs."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash

from docsift.llm import quality, resampling, source_audit

LONG = "long word " * 30_000
DOCS = "doc_id long, text string, lang string, source string, n_chars long, n_words long, rank string, b string, docs long, term string"
ODD = [(None, None), (None, "a b c"), (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "same text here now ok"), (5, "same text here now ok"),
       (6, "same text here now ok"), (7, LONG), (8, "w" * 100_000 + " end"), (9, "É\u0085x \x00 </turn> \\ ünï <|endoftext|> 漢字 🙂 Ab12")]


def docs(spark, rows):
    return spark.createDataFrame([(i, t, None if k % 4 == 0 else "en", None if k % 5 == 0 else f"s{k % 3}", 0, -1, "x", "y", 0, "z")
                                  for k, (i, t) in enumerate(rows)], DOCS)


def corpus(seed=5, n=400):
    rng = random.Random(seed)
    usual = ["the", "of", "And", "to", "ünï", "a1", "b-2", "w" * 45]
    word = lambda: rng.choice(usual) if rng.random() < 0.6 else "".join(rng.choices("abcdeÉx9,", k=rng.randint(1, 9)))
    out = []
    for i in range(n):
        words = [word() for _ in range(rng.randint(0, 90))]
        if i % 7 == 0:
            words = [w + rng.choice(["***", "$$$", "|"]) for w in words]
        if i % 11 == 0 and words:
            words += words[: rng.randint(1, len(words))]
        if i % 13 == 0:
            words += words[:5] * 4
        out.append(" ".join(w + rng.choice(["", "", "\n", "\t"]) for w in words))
    return list(enumerate(out)) + [(10_000, out[3]), (10_001, None)]


# --- quality rules


def brute_quality(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    often = Counter(windows)
    covered = {j for i, w in enumerate(windows) if often[w] > 1 for j in range(i, i + 8)}
    failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered), failed


def grams(text, buckets):
    words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
    one = [xxhash.xxh64_intdigest(w.encode(), 42) for w in words]
    pairs = [xxhash.xxh64_intdigest(b.to_bytes(8, "little"), xxhash.xxh64_intdigest(a.to_bytes(8, "little"), 42)) for a, b in zip(one, one[1:])]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return [signed(x) % buckets for x in one + pairs]


@pytest.mark.parametrize("buckets", [64, 1 << 16])
def test_quality_matches_brute_force(spark, buckets):
    rows = corpus()
    labels = spark.createDataFrame([(i, int(i % 7 != 0), 0, "x") for i in range(0, 400, 2)] + [(None, 1, 0, "x"), (2, 1, 0, "x")],
                                   "doc_id long, quality int, toxic int, text string")
    gains = quality.train(docs(spark, rows), labels, buckets)
    raw, trusted = Counter(), Counter()
    for i, t in rows:
        raw.update(grams(t, buckets))
        if i < 400 and i % 2 == 0 and i % 7:
            trusted.update(grams(t, buckets))
    s, t = sum(raw.values()), sum(trusted.values())
    expected = [math.floor(1e6 * math.log((trusted[b] * s + 20 * t) / ((raw[b] + 20) * t))) for b in range(buckets)]
    assert gains == expected
    got = {r["doc_id"]: r for r in quality.score(docs(spark, rows), gains).collect()}
    assert len(got) == len(rows)
    for i, text in rows:
        r, g = got[i], grams(text, buckets)
        llr = sum(expected[b] for b in g)
        base = brute_quality(text)
        assert tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")) == base
        assert (r["llr"], r["n_ngrams"]) == (llr, len(g))
        assert r["kept"] == (not base[-1] and llr >= -80_000 * len(g))
    assert any(r["kept"] for r in got.values()) and any(not r["kept"] and not r["base_failed"] for r in got.values())


def test_quality_odd_rows(spark):
    rows = docs(spark, ODD)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    gains = quality.train(rows, labels)
    assert not any(gains)  # nothing trusted: the verdict rejects nothing
    got = quality.score(rows, gains).collect()
    assert sorted((r["doc_id"] is None, r["doc_id"] or 0, r["n_words"]) for r in got) == sorted(
        (i is None, i or 0, brute_quality(t)[0]) for i, t in ODD)
    assert all(r["kept"] != r["base_failed"] for r in got)
    by = {r["doc_id"]: r for r in got}
    assert by[7]["n_repeat_words"] == by[7]["n_words"] == 60_000 and by[8]["n_words"] == 2
    empty = docs(spark, ODD[:1]).limit(0)
    assert quality.score(empty, quality.train(empty, labels)).collect() == []


def test_quality_trusted_bound(spark):
    labels = spark.createDataFrame([(i, 1, 0) for i in range(5000)], "doc_id long, quality int, toxic int")
    assert quality.trusted_ids(labels, 5000).count() == 5000
    some = quality.trusted_ids(labels, 1000).count()
    assert 850 < some < 1150 and some == quality.trusted_ids(labels, 1000).count()


def test_quality_runs_no_python(spark):
    rows = docs(spark, ODD)
    plan = quality.score(rows.select("doc_id", "text"), [0] * 8)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan and "Arrow" not in plan


# --- importance resampling


def brute_features(text):
    lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
    words = re.findall(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").encode().translate(lower))
    return len(words), [zlib.crc32(b" ".join(words[i : i + k])) % 10_000 for k in (1, 2, 3) for i in range(len(words) - k + 1)]


def brute_resample(rows, target):
    raw, want = Counter(), Counter()
    features = [brute_features(t) for _, t in rows]
    for _, f in features:
        raw.update(f)
    for t in target:
        want.update(brute_features(t)[1])
    s, t = float(sum(raw.values())), float(sum(want.values()))
    out = []
    for (i, _), (n, f) in zip(rows, features):
        weight = sum(math.floor(1000 * math.log((want[b] + 1) * (t * 0 + s + 10_000) / ((raw[b] + 1) * (t + 10_000)))) for b in f)
        h = int(hashlib.sha256(f"42:{'null' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    able = sorted((r for r in out if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for k, r in enumerate(able[: 5 * len(able) // 100]):
        r[4] = k + 1
    return Counter(tuple(r[:5]) for r in out)


@pytest.mark.parametrize("rows", [corpus(), [(-i, t) for i, t in corpus(9)], ODD, ODD[:1], [(5, "one two " * 20)] * 41 + [(None, "one two " * 20)] * 40],
                         ids=["corpus", "negative ids", "odd", "one", "repeated"])
def test_resampling_matches_brute_force(spark, rows):
    target = ["The of x", None, "ünï ünï a1 the", ""]
    got = resampling.resample(docs(spark, rows), spark.createDataFrame([(t,) for t in target], "text string"))
    assert Counter(map(tuple, got.collect())) == brute_resample(rows, target)


def test_resampling_empty(spark):
    none = docs(spark, ODD[:1]).limit(0)
    assert resampling.resample(none, none.select("text")).collect() == []
    got = resampling.resample(docs(spark, corpus()), none.select("text")).collect()
    assert sum(r["rank"] is not None for r in got) == 5 * sum(brute_features(t)[0] >= 20 for _, t in corpus()) // 100


@pytest.mark.parametrize("segment", [1, 50, 1 << 21])
def test_runs_across_segments(monkeypatch, segment):
    monkeypatch.setattr(resampling, "SEGMENT", segment)
    texts = [t or "" for _, t in corpus()[:60]] + ["", "w" * 3000, "x y"]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    found = [[] for _ in texts]
    for doc, runs in resampling.hashed_runs(np.frombuffer(b"".join(raw), np.uint8), offsets):
        for crc, ends in runs:
            for d, c in zip(doc[ends].tolist(), crc[ends].tolist()):
                found[d].append(c % 10_000)
    assert [sorted(f) for f in found] == [sorted(brute_features(t)[1]) for t in texts]


@pytest.mark.parametrize("rows", [0, 1, 7, 500])
def test_radix_sort(spark, rows):
    rng = random.Random(rows)
    data = [(rng.randrange(3), i, rng.choice([0, 1, 5, 1 << 40, -1, -(1 << 63), (1 << 63) - 1]), rng.randrange(100), i) for i in range(rows)]
    df = spark.createDataFrame(data, "block long, slot long, a long, b long, payload long")
    got = sorted((r["position"], r["payload"]) for r in resampling.radix_sort(df, ["a", "b"], rows, "test").collect())
    order = sorted(data, key=lambda r: (r[2] % (1 << 64), r[3], r[0], r[1]))
    assert got == [(k, r[4]) for k, r in enumerate(order)]


# --- source audit


def brute_audit(rows, min_documents):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, often = defaultdict(Counter), defaultdict(Counter)
    for text, lang, source in rows:
        lang, source = lang or "", source or ""
        terms = re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(lower))
        counts[lang, source].update(terms)
        often[lang].update(set(terms))
    out = Counter()
    for lang, df in often.items():
        kept = [t for t, n in df.items() if n >= min_documents]
        own = {s: Counter({t: c[t] for t in kept}) for (g, s), c in counts.items() if g == lang}
        everyone = sum(own.values(), Counter())
        p = lambda c, t: 1 + 10**9 * (c[t] + 2) // (sum(c.values()) + 2 * len(kept))
        f = lambda x, y: (x - y) ** 2 // (x + y)
        for s, c in own.items():
            pairs = [(sum(f(p(c, t), p(d, t)) for t in kept), o) for o, d in own.items() if o != s]
            over = [(f(p(c, t), p(everyone, t)), t) for t in kept if c[t] and p(c, t) > p(everyone, t)]
            for part, found in (("pair", pairs), ("term", over)):
                found.sort(key=lambda x: (-x[0], x[1].encode()))
                for k, (value, item) in enumerate(found if part == "pair" else found[:10]):
                    out[lang, s, part, item, value, k + 1] += 1
    return out


@pytest.mark.parametrize("least", [1, 3, 10, 10_000])
def test_audit_matches_brute_force(spark, monkeypatch, least):
    monkeypatch.setattr(source_audit, "SHARD_ROWS", 7)
    monkeypatch.setattr(source_audit, "MATRIX_CELLS", 20)
    table = docs(spark, corpus(n=150) + ODD[:-5])
    rows = [(r["text"], r["lang"], r["source"]) for r in table.collect()]
    assert Counter(map(tuple, source_audit.audit(table, least).collect())) == brute_audit(rows, least)


def test_audit_odd_rows(spark):
    table = docs(spark, ODD)
    got = source_audit.audit(table, 1).collect()
    assert Counter(map(tuple, got)) == brute_audit([(r["text"], r["lang"], r["source"]) for r in table.collect()], 1)
    assert source_audit.audit(table.limit(0)).collect() == []


def test_audit_merges_and_long_totals(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(source_audit, "MERGE_ROWS", 3)
    monkeypatch.setattr(source_audit, "ROUND_CHARS", 4)
    batch = pa.record_batch({"lang": ["a", "a", "b"], "source": ["s", "s", ""], "text": ["x y x", "y z, Y", ""]})
    total = Counter()
    for out in source_audit._count([batch, batch]):
        for r in out.to_pylist():
            total[r["term"], "n"] += r["n"]
            total[r["term"], "docs"] += r["docs"]
    assert total == {("x", "n"): 4, ("x", "docs"): 2, ("y", "n"): 6, ("y", "docs"): 4, ("z", "n"): 2, ("z", "docs"): 2}
    n = np.array([0, 5, 3 * 10**14])
    assert source_audit._share(n, np.int64(4 * 10**15), 7).tolist() == [1 + 10**9 * (int(c) + 2) // (4 * 10**15 + 14) for c in n]
