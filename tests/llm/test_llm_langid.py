import math
import unicodedata
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import langid

SF = "/root/testdata/sf0.01"
SCHEMA = "doc_id long, text string, lang string, lang_pred string, score string"


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = langid.identify(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    held = [r for r in got if r.held_out and r.lang]
    assert np.mean([r.lang == r.lang_pred for r in held]) > 0.97
    assert all(0 <= r.score <= 1 for r in got)


def data():
    en = [(i, f"the thing with the other thing number {i}", "en", "x", "y") for i in range(20)]
    de = [(100 + i, f"über die schönen Dinge und das Übrige {i}", "de", "x", "y") for i in range(20)]
    return en + de


def test_nulls_blanks_and_clashing_columns(spark):
    odd = [(500, None, "en", "", ""), (501, "", "de", "", ""), (502, "123 !?", "en", "", ""), (None, "the other thing", None, "", ""), (503, "the " * 50_000, None, "", ""), (1, "the thing with the other thing number 1", "en", "", "")]
    got = langid.identify(spark.createDataFrame(data() + odd, SCHEMA)).collect()
    assert len(got) == 46
    by = {r.doc_id: r for r in got}
    assert all(by[i].lang_pred == "und" and by[i].score == 0 for i in (500, 501, 502))
    assert by[None].lang_pred == "en" and by[503].lang_pred == "en" and by[100].lang_pred == "de"
    assert by[None].held_out == (zlib.crc32(b"") % 4 == 2)


def test_nothing_to_learn_from(spark):
    for rows in ([], [(1, "text", None, "", "")], [(1, "12", "en", "", "")]):
        got = langid.identify(spark.createDataFrame(rows, SCHEMA)).collect()
        assert [(r.lang_pred, r.score) for r in got] == [("und", 0.0)] * len(rows)


def test_long_texts_in_pieces_count_the_same(monkeypatch):
    text = "Ein längerer Text, with everything été " * 50
    whole = langid.counts(text)
    for n in (7, 64, 1000):
        monkeypatch.setattr(langid, "PIECE", n)
        assert (langid.counts(text) == whole).all()
    norm = " " + "".join(c if c.isalpha() else " " for c in text.lower())
    norm = " " + " ".join(norm.split()) + " "
    assert whole.sum() == 3 * len(norm) - 3


def test_counts_are_naive_bayes(spark):
    df = spark.createDataFrame(data(), SCHEMA)
    model = langid.fit(df, F.col("lang"), F.col("text"))
    assert model.languages == ["de", "en"]
    assert np.exp(model.log_prob).sum(axis=0) == pytest.approx([1, 1])
    total = sum(langid.counts(t) for _, t, lang, *_ in data() if lang == "en") + langid.SMOOTHING
    assert model.log_prob[:, 1] == pytest.approx(np.log(total / total.sum()))


def plain_bins(text):
    """Bins of a text by plain integers, one n-gram after another."""
    words = "".join(c if unicodedata.category(c)[0] in "LM" else " " for c in text.lower()).split()
    chars = f" {' '.join(words)} "
    for n in range(1, langid.MAX_N + 1):
        for i in range(len(chars) - n + 1):
            h = 0
            for c in chars[i : i + n]:
                h = h * 0x01000193 % 2**32 ^ ord(c)
            x = (h ^ h >> 15) * (0x2C1B3C6D + 2 * n) % 2**32
            yield (x ^ x >> 13) % 2**32 % langid.FEATURES


def plain_predictions(train, texts):
    """Language and score by dictionaries and the definition of naive Bayes."""
    seen, docs = {}, Counter()
    for lang, t in train:
        if lang is not None and t is not None and any(c.isalpha() for c in t):
            docs[lang] += 1
            seen.setdefault(lang, Counter()).update(plain_bins(t))
    langs = sorted(seen)
    whole = {g: sum(seen[g].values()) + langid.SMOOTHING * langid.FEATURES for g in langs}
    for t in texts:
        if t is None or not any(c.isalpha() for c in t):
            yield "und", 0.0
            continue
        bins = list(plain_bins(t))
        like = []
        for g in langs:
            s = math.fsum(math.log((seen[g][b] + langid.SMOOTHING) / whole[g]) for b in bins)
            like.append(s * min(100, len(bins)) / len(bins) + math.log(docs[g] / sum(docs.values())))
        top = max(like)
        yield langs[like.index(top)], 1 / math.fsum(math.exp(x - top) for x in like)


@pytest.mark.parametrize("products", [1, 3000, langid.PRODUCTS])
def test_predictions_equal_a_plain_version(spark, monkeypatch, products):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("text", "lang").limit(60).collect()
    odd = [None, "", "12 !", "ß", "İ", "a" * 300, "été là-bas", "\u0301", "x\u0301y", "한국어 텍스트", *["the same"] * 3]
    train, texts = [(r.lang, r.text) for r in docs[:40]], [r.text for r in docs] + odd
    frame = spark.createDataFrame(train, "lang string, text string")
    monkeypatch.setattr(langid, "PRODUCTS", products)
    got = list(langid.predict_batch(texts, langid.fit(frame, F.col("lang"), F.col("text"))))
    want = list(plain_predictions(train, texts))
    assert [g[0] for g in got] == [w[0] for w in want]
    assert [g[1] for g in got] == pytest.approx([w[1] for w in want], abs=1e-9)


def test_ties_go_to_the_first_language(spark):
    rows = [(i, "same text", lang, "", "") for i, lang in enumerate(["fr", "de"] * 4)]
    model = langid.fit(spark.createDataFrame(rows, SCHEMA), F.col("lang"), F.col("text"))
    assert langid.predict_one("same text", model) == ("de", 0.5)
