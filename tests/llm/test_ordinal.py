"""The ordinal fit and its scores against plain loops."""

import math
import random

import numpy as np

from docsift.llm import toxicity


def grade_shares(total, theta):
    above = [1.0, *(1 / (1 + math.exp(t - total)) for t in theta), 0.0]
    return [a - b for a, b in zip(above, above[1:])]


def mean_loss(rows, grades, w, theta):
    return -sum(math.log(max(grade_shares(sum(w[f] for f in r), theta)[g], 1e-300)) for r, g in zip(rows, grades)) / len(rows)


def plain_fit(rows, grades, features):
    """Descent along numeric slopes, the step halved until the loss falls."""
    x = [0.0] * len(features) + [0.5, 1.5]

    def loss(x):
        return mean_loss(rows, grades, dict(zip(features, x)), x[-2:]) if x[-2] < x[-1] else math.inf

    best, step = loss(x), 8.0
    for _ in range(400):
        slope = [(loss([v + 1e-5 * (i == j) for j, v in enumerate(x)]) - best) / 1e-5 for i in range(len(x))]
        while step > 1e-6 and (new := loss(moved := [v - step * s for v, s in zip(x, slope)])) >= best:
            step /= 2
        if step <= 1e-6 or best - new < 1e-7:
            break
        x, best, step = moved, new, 2 * step
    return best


def test_fit_reaches_a_plain_optimum_and_shares_its_weights():
    rng = random.Random(4)
    features, true, theta = [3, 70, 500, 900], [3.0, 2.5, -2.5, -3.0], [0.4, 1.8]
    rows, grades = [], []
    for _ in range(1000):
        r = [f for f in features if rng.random() < 0.5]
        share = grade_shares(sum(true[features.index(f)] for f in r), theta)
        rows.append(r), grades.append(rng.choices(range(3), share)[0])
    flat, lens = np.array([f for r in rows for f in r], np.int64), np.array([len(r) for r in rows])
    dense, got = toxicity.fit_ordinal(flat, lens, np.array(grades), 3)
    assert set(np.flatnonzero(dense)) == set(features) and got[0] < got[1]
    fitted, optimum = mean_loss(rows, grades, dense, list(got)), plain_fit(rows, grades, features)
    assert abs(fitted - optimum) < 0.005, (fitted, optimum)
    assert fitted < mean_loss(rows, grades, np.zeros(1000), [0.5, 1.5]) - 0.1


def test_scores_are_plain_sums(spark):
    rng = np.random.default_rng(6)
    w, theta = np.zeros(1 << toxicity.BITS, np.float32), np.array([0.3, 1.1])
    texts = [None, "", "  ", "You fool", "a quiet walk by the sea", "fool fool FOOL " * 3000, "ünï \x00 漢字"]
    for t in texts:
        for f in toxicity.text_features(t, toxicity._Features()):
            w[f] = rng.normal()
    rows = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, severity string")
    got = {r["doc_id"]: r for r in toxicity.score(rows, (w, theta)).collect()}
    for i, t in enumerate(texts):
        share = grade_shares(sum(float(w[f]) for f in toxicity.text_features(t, toxicity._Features())), theta)
        assert abs(got[i]["p_toxic"] - (1 - share[0])) < 1e-9 and abs(got[i]["expected_severity"] - (share[1] + 2 * share[2])) < 1e-9
        assert got[i]["severity"] == max(range(3), key=lambda g: share[g]) and got[i]["toxic"] == (1 - share[0] >= 0.5)


def test_the_learned_text_of_a_repeated_id_does_not_depend_on_the_order(spark):
    rng = random.Random(8)
    say = lambda toxic: " ".join(rng.choices(["river", "house", "tree", "walk"], k=6) + rng.choices(["fool", "idiot", "trash"], k=3) * toxic)
    rows = [(i, say(i % 2)) for i in range(80)] + [(i, say(1 - i % 2)) for i in range(0, 80, 3)] + [(0, None), (1, "")]
    labels = spark.createDataFrame([(i, i % 2) for i in range(80)], "doc_id long, toxic int")
    fits = []
    for order in (rows, rows[::-1], rng.sample(rows, len(rows))):
        docs = spark.createDataFrame(order, "doc_id long, text string").repartition(1 + len(fits) * 3)
        fits.append(toxicity.train(docs, labels))
    for w, theta in fits[1:]:
        assert np.array_equal(w, fits[0][0]) and np.array_equal(theta, fits[0][1])
