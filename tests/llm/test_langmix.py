from __future__ import annotations

import random

import numpy as np

from tidemark.llm import langmix

WORDS = {
    "en": "the of and to in that with from this was for".split(),
    "fr": "le les des une qui dans pour avec être était élève".split(),
    "de": "der und das nicht sich über schön groß mit auf dem".split(),
}


def _text(lang, n, seed):
    r = random.Random(f"{lang}{seed}")
    return " ".join(r.choice(WORDS[lang]) for _ in range(n))


def _model(spark, documents):
    return langmix.fit(documents([(k, _text(l, 60, k), l, "s") for l in WORDS for k in range(10)]))


def test_held_out_accuracy_and_mixtures(spark, documents):
    model = _model(spark, documents)
    rows = [(k, _text(l, n, 100 + k), l, "s") for l in WORDS for k in range(20) for n in (8, 80)]
    out = langmix.predict(documents(rows), model, ("doc_id", "lang")).collect()
    assert sum(r["lang"] == r["lang_pred"] for r in out) >= 0.95 * len(out)
    share = langmix.infer(_text("en", 300, 7) + " " + _text("fr", 100, 7), model)
    en, fr = model.languages.index("en"), model.languages.index("fr")
    assert 0.6 < share[en] < 0.85 and 0.15 < share[fr] < 0.4 and abs(share.sum() - 1) < 1e-6


def test_gradient_bound_agrees_with_the_search(spark, documents):
    """Documents decided in one pass are those for which the whole search finds one language."""
    model = _model(spark, documents)
    for seed in range(30):
        text = _text("en", 40, seed) + " " + _text("de", seed % 5, seed)
        grams = np.concatenate(list(langmix.trigrams(text)))
        best = int(np.argmax(model.logs[:, grams].sum(axis=1, dtype=float)))
        assert np.allclose(langmix.infer(text, model), langmix._mixture(grams, best, model, 4.0))


def test_defined_cases(spark, documents):
    model = _model(spark, documents)
    rows = [(1, None, "en", None), (2, "", "en", None), (3, "12 !?", "en", None), (None, "the and of", None, None),
            (5, "the the", "en", None), (5, "the the", "en", None)]
    out = langmix.predict(documents(rows).withColumnRenamed("source", "score"), model, ("doc_id", "score")).collect()
    assert len(out) == 6 and out[0].asDict().keys() == {"doc_id", "lang_pred", "score", "mixture"}
    by_id = {r["doc_id"]: r for r in out}
    assert [by_id[k]["lang_pred"] for k in (1, 2, 3)] == ["und"] * 3 and by_id[2]["score"] == 0
    assert by_id[None]["lang_pred"] == "en" and 0 < by_id[5]["score"] <= 1
    empty = langmix.fit(documents([]))
    assert langmix.predict(documents([(1, "the")]), empty).first()["lang_pred"] == "und"
    assert langmix.predict(documents([]), model).count() == 0


def test_pieces_make_the_whole(monkeypatch):
    text = "Der  schöne\nTag, 12 Äpfel!" * 50
    whole = np.concatenate(list(langmix.trigrams(text)))
    monkeypatch.setattr(langmix, "PIECE", 7)
    assert (np.concatenate(list(langmix.trigrams(text))) == whole).all()
