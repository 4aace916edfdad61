"""Floors of what the operators reach on cases that weren't taken from the fixtures."""

import held_out
import numpy as np
import pyarrow as pa
import pytest

from kaghamar.llm import abuse, langid, pairs, personal, quality


def shares(found, truth):
    """(share of the true cases found, share of the found ones that are true)."""
    both = sum(len(set(f) & set(t)) for f, t in zip(found, truth))
    return both / max(1, sum(len(set(t)) for t in truth)), both / max(1, sum(len(set(f)) for f in found))


@pytest.mark.parametrize(("cases", "least"), [(held_out.ABUSE, 0.9), (held_out.ABUSE_AFTER, 0.6)])
def test_abuse(cases, least):
    scores = abuse.scores(pa.array([t for t, _ in cases]))
    recall, precision = shares([["x"] * bool(s >= abuse.THRESHOLD) for s in scores], [["x"] * c for _, c in cases])
    assert recall >= least and precision >= 0.9


def test_languages():
    texts, truth = zip(*held_out.LANGUAGES)
    found = langid.Identified(langid.fit([]), pa.array(texts), np.array(["prose"] * len(texts), object))
    got = [found.languages(i) for i in range(len(texts))]
    recall, precision = shares(got, truth)
    assert recall >= 0.9 and precision >= 0.9
    assert not any(g for g, t in zip(got, truth) if not t)  # no language that isn't one of the corpus


def test_pairs():
    recall, precision = shares([pairs.defects(a, b) for a, b, _ in held_out.PAIRS], [d for _, _, d in held_out.PAIRS])
    assert recall >= 0.9 and precision >= 0.9


def test_forms():
    kinds = quality.kinds_of(pa.array([t for t, _ in held_out.FORMS]))
    assert np.mean([k == t for k, (_, t) in zip(kinds, held_out.FORMS)]) >= 0.9


@pytest.mark.parametrize("cases", [held_out.PERSONAL, held_out.PERSONAL_AFTER])
def test_personal(cases):
    tagger = personal.Tagger(personal.trained())
    found = []
    for text, _ in cases:
        tokens = personal.TOKEN.findall(text)
        found.append([k for _, _, k in personal.spans(tokens, tagger.states(tokens))])
    recall, precision = shares(found, [t for _, t in cases])
    assert recall >= 0.9 and precision >= 0.9


def brute(folded, hits):
    best = 0.0
    for at, _, w in hits:
        near = {n: x for p, n, x in hits if abs(p - at) <= abuse.STRETCH}.values()
        if w > 0:
            best = max(best, sum(x for x in near if x >= abuse.THRESHOLD) + max(0.0, sum(x for x in near if x < abuse.THRESHOLD)))
    return best


def test_the_sliding_window_is_the_best_stretch():
    r = np.random.default_rng(4)
    words = ["you", "idiot", "kill", "the dictionary", "drop dead", "i will", "neutral", "several words of no weight", "jews", "should be", "filthy"]
    texts = [" ".join(r.choice(words, 60)) for _ in range(40)]
    for text, score in zip(texts, abuse.scores(pa.array(texts))):
        folded = abuse.Folded(*abuse.flatten(pa.array([text])))
        hits = [(end - n, k, w) for end, (k, w, n) in abuse.automaton().iter(folded.text())]
        assert abs(score - brute(folded, hits)) < 1e-6


def test_a_long_text_takes_time_in_proportion():
    import time

    begin = time.time()
    assert abuse.scores(pa.array(["you know this word " * 60_000]))[0] < abuse.THRESHOLD
    assert time.time() - begin < 30
