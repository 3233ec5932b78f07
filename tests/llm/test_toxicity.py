from __future__ import annotations

import math
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm.langid import in_fold
from keelson.llm.toxicity import LEXICON, Voters, fit_label_model, fit_linear, fit_toxicity, score_toxicity
from keelson.llm.textops import text_runs


def features(texts, stems=LEXICON):
    import pyarrow as pa

    v = Voters(stems)
    return np.concatenate([v.features(d, o) for _, _, d, o in text_runs(pa.array(texts, pa.string()), 64)])


def test_held_out_quality(spark, small):
    docs, labels = (spark.read.parquet(f"{small}/{t}.parquet") for t in ("documents", "labels"))
    held = in_fold("doc_id", 4, 2)
    got = score_toxicity(docs, fit_toxicity(docs, labels.where(~held))).join(labels, "doc_id").where(held)
    rows = got.select("toxic", "predicted", "score").collect()
    caught = sum(r.predicted for r in rows if r.toxic) / sum(r.toxic for r in rows)
    wrong = sum(r.predicted for r in rows if not r.toxic) / sum(1 - r.toxic for r in rows)
    assert caught >= 0.6 and wrong <= 0.03 and all(0 <= r.score <= 1 for r in rows)


def test_votes_match_plain_reading():
    import re

    texts = ["You IDIOT, you clown!!", "idiotic moronS ... Scum", "pidiot", "", None, "Crétin! CRÉTIN", "é" * 50, "word " * 100 + "trash"]
    got = features(texts)
    for t, row in zip(texts, got):
        words = re.findall(r"[^\W\d_]+", (t or "").lower())
        assert [s for s, v in zip(LEXICON, row) if v] == [s for s in LEXICON if any(w.startswith(s) for w in words)]
    assert got[0, len(LEXICON)] == 1 and got[0, len(LEXICON) + 1] == 0


def plain_score(model, text):
    """The score of one text from the fitted weights, word by word."""
    text = text or ""
    low = "".join(c.lower() if c.isascii() or "À" <= c <= "Þ" and c != "×" else c for c in text)
    words = re.findall(r"[a-z\u0080-\U0010ffff]+", low)
    hits = [sum(w.startswith(s) for w in words) for s in model.stems]
    kinds, letters = sum(h > 0 for h in hits), sum(len(c.encode()) for c in low if "a" <= c <= "z" or c >= "\u0080")
    upper, bangs = sum("A" <= c <= "Z" for c in text), sum(a == b == "!" for a, b in zip(text, text[1:]))
    votes = [h > 0 for h in hits] + [kinds >= 2, kinds >= 3, kinds > 0 and sum(hits) * 150 >= len(words), letters >= 20 and 2 * upper > letters, bangs >= 3]
    z = sum(float(w) for w, v in zip(model.weights, votes) if v) + float(model.weights[-1])
    return 1 / (1 + math.exp(-max(-30.0, min(30.0, z))))


def test_scores_match_a_plain_scorer(spark, tiny, odd):
    docs, labels = (spark.read.parquet(f"{tiny}/{t}.parquet") for t in ("documents", "labels"))
    model = fit_toxicity(docs, labels)
    more = ["YOU ARE A CLOWN AND A FOOL, SIR!!!!", "Crétin CRÉTIN ÉTÉ", "!!! !! !!!", "×idiot Þidiot"]
    extra = spark.createDataFrame([(1000 + i, t) for i, t in enumerate(more)], "doc_id long, text string")
    rows = [f for frame in (docs, odd, extra) for f in score_toxicity(frame.select("doc_id", "text"), model).collect()]
    for r in rows:
        want = plain_score(model, r.text)
        assert r.score == pytest.approx(want, abs=1e-9) and r.predicted == int(want >= 0.3), r.doc_id


def test_label_model_learns_accuracies():
    rng = np.random.Generator(np.random.PCG64(4))
    y = rng.random(4000) < 0.15
    good = [np.where(y, rng.random(4000) < 0.7, rng.random(4000) < 0.02) for _ in range(5)]
    bad = rng.random(4000) < 0.2
    votes = np.stack([*good, bad, bad], axis=1).astype(np.uint8)
    label = np.where(rng.random(4000) < 0.05, ~y, y).astype(float)
    model, p = fit_label_model(votes, label)
    assert ((p > 0.5) == y).mean() > 0.97
    assert model.correlation[5, 6] > 0.9 and model.trust[5] < 0.7 < model.trust[0]
    w = fit_linear(votes, p)
    assert (w[:5] > 1).all() and abs(w[5]) < 1


def test_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, 0), (3, 1), (4, None), (None, 1), (8, 0)], "doc_id long, toxic int")
    for model in (fit_toxicity(odd, labels), fit_toxicity(odd, labels.limit(0)), fit_toxicity(none, labels)):
        got = score_toxicity(odd, model)
        assert set(got.columns) == {*odd.columns, "predicted"} and got.count() == odd.count()
        assert got.where(F.col("score").isNull() | ~F.col("score").between(0, 1)).count() == 0
        assert score_toxicity(none, model).count() == 0
