from __future__ import annotations

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from keelson.llm.langid import TRIGRAMS, codewords, fit_languages, identify_languages, in_fold


def test_held_out_accuracy(spark, small):
    docs = spark.read.parquet(f"{small}/documents.parquet")
    held = in_fold("doc_id", 3, 1)
    got = identify_languages(docs, fit_languages(docs.where(~held))).where(held)
    right, n, low = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double")), F.count("*"), F.min("score")).first()
    assert n > 250 and right > 0.98 and 0 <= low <= 1


def test_codewords_are_far_apart():
    for n in (2, 3, 4, 7, 8, 30):
        code = codewords(n)
        apart = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(apart) >= max(1, code.shape[1] // 5) and set(np.unique(code)) <= {-1.0, 1.0}


def plain_score(model, text):
    """Language and score of one text, byte by byte from the fitted weights."""
    def kind(byte):
        return byte if byte >= 128 or chr(byte).isalpha() else 32

    c = [kind(b) for b in (text or "").translate({i: i + 32 for i in range(65, 91)}).encode()]
    found, low = [], 0xFFFFFFFF
    for i in range(len(c) - 2):
        if c[i] != 32 or c[i + 1] != 32:
            x = (c[i] * 0x9E3779B1 & low) ^ (c[i + 1] * 0x85EBCA77 & low) ^ (c[i + 2] * 0xC2B2AE3D & low)
            found.append((x * 0x27D4EB2F & low) >> 17)
    for i in range(len(c) - 1):
        if c[i] != 32 or c[i + 1] != 32:
            found.append((((c[i] * 0x9E3779B1 & low) ^ (c[i + 1] * 0x85EBCA77 & low)) >> 18) + TRIGRAMS)
    if not any(x.isalpha() for x in text or ""):
        return "und", 0.0
    losses = []
    for row in model.code:
        loss = 0.0
        for b, bit in enumerate(row):
            margin = sum(float(model.weights[f, b]) for f in found) / max(len(found), 1)
            loss += math.log1p(math.exp(-max(-30, min(30, margin * model.scale[b])) * bit)) * model.bit_weight[b]
        losses.append(loss)
    best = min(range(len(losses)), key=losses.__getitem__)
    return model.languages[best], 1 / sum(math.exp(losses[best] - x) for x in losses)


def test_predictions_match_a_plain_scorer(spark, tiny, odd):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang").limit(60)
    model = fit_languages(spark.read.parquet(f"{tiny}/documents.parquet"))
    for r in identify_languages(docs, model).collect() + identify_languages(odd.where("doc_id <> 8 AND doc_id <> 12"), model).collect():
        name, score = plain_score(model, r.text)
        assert r.lang_pred == name and r.score == pytest.approx(score, abs=1e-6), r.doc_id


def test_odd_rows(spark, odd, none):
    model = fit_languages(odd)
    assert model.languages == ["de", "en", "fr"]
    got = identify_languages(odd, model)
    assert set(got.columns) == {*odd.columns, "lang_pred", "ambiguous"} and got.count() == odd.count()
    rows = {r.doc_id: r for r in got.collect()}
    assert all(rows[i].lang_pred == "und" and rows[i].score == 0 for i in (3, 4, 5))
    assert all(rows[i].lang_pred in model.languages and 0 <= rows[i].score <= 1 for i in (1, 8, 9, 11, 12, None))
    assert identify_languages(none, model).count() == 0
    empty = fit_languages(none)
    assert {r.lang_pred for r in identify_languages(odd, empty).collect()} == {"und"}
    one = fit_languages(odd.where("lang = 'en'"))
    assert {r.lang_pred for r in identify_languages(odd, one).collect()} == {"en", "und"}


def test_fold_is_crc32_of_the_id_as_text(spark):
    import zlib

    got = spark.range(50).select("id", in_fold("id", 3, 1).alias("f")).collect()
    assert all(r.f == (zlib.crc32(str(r.id).encode()) % 3 == 1) for r in got)
