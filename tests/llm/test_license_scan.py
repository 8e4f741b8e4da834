"""License scan against a brute force that tries every span, and its odd cases."""
import random
import re

import pytest

from docsift.llm import licenses


def said(text):
    """Words that count, with their places among all words; written apart from the operator."""
    out = []
    for i, w in enumerate(re.findall(r"[^\W_]+(?:\.\d+)*", text.lower())):
        while re.search(r"\d\.0$", w):
            w = w[:-2]
        if re.match(r"v\d", w):
            w = w[1:]
        if w not in {"a", "an", "the", "terms", "of", "version", "v"}:
            out.append((w, i))
    return out


def grams(words, k):
    return [tuple(words[i:i + k]) for i in range(len(words) - k + 1)]


def brute(text, templates, containment=0.8):
    """Every span of at most n / containment words, without bands or windows."""
    doc, spans = said(text), {}
    words = [w for w, _ in doc]
    for name, template, keys in templates:
        own = [w for w, _ in said(template)]
        n = len(own)
        if not n:
            continue
        k = 5 if n >= 5 and 5 <= (n - 4) * (1 - containment) + 1e-9 else min(n, 2)
        want = set(grams(own, k))
        size = -int(-(n / containment) // 1) if n / containment % 1 > 1e-9 else round(n / containment)
        have = grams(words, k)
        for b in range(len(have)):
            if have[b] not in want:
                continue
            inside = [j for j in range(b, min(b + size - k + 1, len(have))) if have[j] in want]
            share = len({have[j] for j in inside}) / len(want)
            end = inside[-1] + k
            key_words = [[w for w, _ in said(key)] for key in keys]
            if share >= containment - 1e-9 and all(key in [words[i:i + len(key)] for i in range(b, end - len(key) + 1)] for key in key_words):
                spans.setdefault(name, []).append((b, end, share))
    out = set()
    for name, found in spans.items():
        merged = []
        for b, e, share in sorted(found):
            if merged and b <= merged[-1][1]:
                merged[-1] = (merged[-1][0], max(merged[-1][1], e), max(merged[-1][2], share))
            else:
                merged.append((b, e, share))
        out |= {(name, round(share, 9), doc[b][1], doc[e - 1][1]) for b, e, share in merged}
    return out


def noisy(rng, text, rate):
    """Words changed, dropped, doubled or preceded by another at the given rate."""
    out = []
    for w in text.split():
        x = rng.random()
        if x < rate / 4:
            continue
        if x < rate / 2:
            out.append("other")
        elif x < rate * 3 / 4:
            out += ["more", w]
        else:
            out += [w, w] if x < rate else [w]
    return " ".join(out)


def test_matches_are_those_of_every_span():
    rng = random.Random(5)
    library = [r for r in licenses.library() if len(r[1].split()) < 250]
    vocabulary = ["under", "the", "license", "public", "general", "gnu", "version", "2", "3", "4.0", "creative", "commons", "software", "is", "free", "and", "river", "house"]
    found = licenses.Templates(library, 0.8)
    cache, matches = licenses._Words(), 0
    for i in range(150):
        fill = lambda: " ".join(rng.choices(vocabulary, k=rng.choice([0, 1, 30, 200])))
        parts = [fill()]
        for _ in range(rng.randint(0, 4)):
            parts += [noisy(rng, rng.choice(library)[1], rng.choice([0, 0, 0.02, 0.05, 0.15])), fill()]
        text = " ".join(parts)
        got = {(name, round(share, 9), lo, hi) for name, share, lo, hi in found.find(text, cache)}
        assert got == brute(text, library), text
        matches += len(got)
    assert matches > 200


@pytest.mark.parametrize("containment", [0.6, 0.8, 1.0])
def test_other_containments(containment):
    rng = random.Random(7)
    library = [r for r in licenses.library() if len(r[1].split()) < 60]
    found, cache = licenses.Templates(library, containment), licenses._Words()
    for i in range(40):
        text = " ".join(noisy(rng, rng.choice(library)[1], 0.1 * (i % 3)) + " apart from that " for _ in range(3))
        assert {(name, round(share, 9), lo, hi) for name, share, lo, hi in found.find(text, cache)} == brute(text, library, containment)


def test_band_bound_of_every_template():
    cache = licenses._Words()
    for name, text, _ in licenses.library():
        h, _ = licenses.words_of(text, cache)
        m = len(set(licenses.shingles(h, licenses.width(len(h), 0.8)).tolist()))
        assert (1 - licenses.least_similarity(len(h), m, 0.8)) ** licenses.BANDS < 0.0005, name


def test_one_row_meets_the_usual_spellings():
    found, cache = licenses.Templates(licenses.library(), 0.8), licenses._Words()
    for lead in ("Licensed under", "Offered under the terms of the", "You may use it under a", "under the"):
        for name, license in (("GNU General Public License, version 2.0", "GPL-2.0"), ("GNU General Public License v3", "GPL-3.0"), ("GPL-3.0", "GPL-3.0"), ("MIT license", "MIT"),
                              ("Apache 2.0 license", "Apache-2.0"), ("Creative Commons Attribution-ShareAlike 4.0 International License", "CC-BY-SA-4.0"), ("CC-BY-NC-4.0", "CC-BY-NC-4.0")):
            assert [m[0] for m in found.find(f"It rained. {lead} {name}. It rained.", cache)] == [license], (lead, name)
    assert found.find("A MIT student took the general public under the bridge; license 2 of 3, version 4.0", cache) == []


def test_long_texts_and_chunk_edges():
    """Copies in a text of many blocks, two of them across a block's edge."""
    notice, body = "Released under the MIT License.", next(t for n, t, _ in licenses.library() if n == "MPL-2.0-text")
    fill = "river " * (licenses.CHUNK - 2)
    templates, cache = licenses.Templates(licenses.library(), 0.8), licenses._Words()
    alone = [m[:2] for m in templates.find(body, cache)]
    assert ("MPL-2.0-text", 1.0) in alone
    found = templates.find(f"{fill}{notice} {fill}{body} {fill}{notice}", cache)
    assert sorted(m[:2] for m in found) == sorted(alone + [("MIT", 1.0)] * 2)
