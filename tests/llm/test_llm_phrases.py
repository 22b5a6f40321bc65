import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tessera.llm import phrases


def plain(rows, longest=5, min_count=100, share=100, top=2000):
    """Collocations of ``(lang, text)`` rows, by counting every phrase."""
    f, n = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n-\r]", low):
            words = re.findall("[^ \t]+", piece)
            n[lang] += len(words)
            for k in range(1, longest + 1):
                f.update((lang, tuple(words[i : i + k])) for i in range(len(words) - k + 1))
    frequent = {p: a for p, a in f.items() if len(p[1]) > 1 and a >= min_count}
    kept = dict(frequent)
    for (lang, long), a in frequent.items():
        for size in range(2, len(long)):
            for i in range(len(long) - size + 1):
                inner = (lang, long[i : i + size])
                if 100 * a >= share * f[inner]:
                    kept.pop(inner, None)
    out = {}
    for (lang, p), a in kept.items():
        cuts = [(1000 * a * n[lang] // (f[lang, p[:k]] * f[lang, p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(p).encode(), f[lang, p[:k]], f[lang, p[k:]]))
    return {
        (lang, i + 1, p.decode(), -a, left, right, n[lang], -score)
        for lang, found in out.items()
        for i, (score, a, p, left, right) in enumerate(sorted(found)[:top])
    }


def table(spark, rows):
    return spark.createDataFrame([(lang, text, "x", "y", 1) for lang, text in rows], "lang string, text string, phrase string, w1 string, n int")


def texts(seed, n=120):
    draw = random.Random(seed)
    words = ["The", "of", "and", "é", "日本", "to", "\xa0", "ab'c", "x", "of"]
    out = []
    for _ in range(n):
        parts = [draw.choice(words) + draw.choice([" ", " ", "  ", "\t", ", ", ".", " \n ", " ! "]) for _ in range(draw.randrange(40))]
        out.append((draw.choice(["en", "de", None, "und"]), "".join(parts)))
    return out + [("en", None), ("en", ""), (None, " \t.,"), ("ÿ", "one two")] + out[:10]


@pytest.mark.parametrize("how", [{}, {"share": 60}, {"longest": 2}, {"longest": 3, "top": 4}, {"longest": 7, "min_count": 2, "top": 50}])
def test_equals_counting_every_phrase(spark, how):
    rows = texts(len(how))
    how = {"min_count": 3, **how}
    got = phrases.collocations(table(spark, rows), **how)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert {tuple(r) for r in got.collect()} == plain(rows, **how)


def test_no_rows_no_words_no_phrases(spark):
    for rows in ([], [("en", None), (None, "..")], [("en", "one"), ("de", "two")]):
        df = table(spark, rows) if rows else table(spark, [("en", "a")]).limit(0)
        assert phrases.collocations(df, min_count=1).collect() == []


def test_long_texts_are_cut_between_words_only(spark, monkeypatch):
    draw = random.Random(5)
    text = "".join(draw.choice(["aa", "b", "cc", "é"]) + draw.choice([" ", " ", "\t", "  ", ". ", " ,"]) for _ in range(3000)) + "w" * 500 + " b b"
    rows = [("en", text), ("en", "b cc aa"), ("de", text[:900])]
    want = plain(rows, min_count=2)
    for chunk in (1, 7, 50, 1000):
        # a task reads its words by the module's value
        monkeypatch.setattr(phrases.read_words, "__defaults__", (chunk,))
        batch = pa.RecordBatch.from_pylist([{"lang": a, "text": b} for a, b in rows])
        found = Counter()
        for w in phrases.read_words(iter([batch]), 5):
            names = [x.decode() for x in w.names.to_pylist()]
            for i in np.flatnonzero(w.own):
                run = [names[w.code[j]] for j in range(i, min(i + 5, len(w))) if w.piece[j] == w.piece[i]]
                for k in range(1, len(run) + 1):
                    found[w.langs[w.lang[i]], " ".join(run[:k])] += 1
        counted = {(lang, p): a for lang, _, p, a, *_ in want}
        assert {k: found[k] for k in counted} == counted
        assert sum(v for (lang, p), v in found.items() if lang == "en" and " " not in p) == next(n for lang, *_, n, _ in want if lang == "en")


def test_full_marks_and_small_tallies_change_nothing(spark, monkeypatch):
    rows = texts(3)
    want = plain(rows, min_count=3)
    monkeypatch.setattr(phrases, "MAX_BITS", 1 << 15)
    monkeypatch.setattr(phrases, "HELD_KEYS", 2)
    monkeypatch.setattr(phrases, "longer_keys", lambda k, *_: np.zeros(len(k) - 1, np.uint64))  # all collide
    assert {tuple(r) for r in phrases.collocations(table(spark, rows), min_count=3).collect()} == want


@pytest.mark.parametrize("marked", [1, 2, 5])
def test_what_is_marked_changes_nothing(spark, monkeypatch, marked):
    monkeypatch.setattr(phrases, "MARKED", marked)
    rows = texts(7)
    assert {tuple(r) for r in phrases.collocations(table(spark, rows), min_count=4).collect()} == plain(rows, min_count=4)


def test_products_beyond_64_bits(spark):
    """Counts of a very large corpus, put in as counted."""
    n = 10**14
    counts = spark.createDataFrame(
        [("en", "a", 1, 3 * 10**13), ("en", "b", 1, 2 * 10**13), ("en", "a b", 2, 10**13)], "lang string, phrase string, size int, a long"
    )
    totals = spark.createDataFrame([("en", n)], "lang string, n long")
    kept = phrases.phrase_counts
    try:
        phrases.phrase_counts = lambda *a: (counts, totals)
        row = phrases.collocations(None).first()
    finally:
        phrases.phrase_counts = kept
    assert row["score"] == 1000 * 10**13 * n // (3 * 10**13 * 2 * 10**13)


def test_counts_come_from_rollup_of_padded_windows(spark):
    w = spark.createDataFrame([("en", "a", "b", "c", 2), ("en", "a", "b", None, 3), ("en", "b", None, None, 1)], "lang string, w1 string, w2 string, w3 string, n long")
    got = {tuple(r) for r in phrases.prefix_counts(w, 3, 1).collect()}
    assert got == {("en", "a", 1, 5), ("en", "a b", 2, 5), ("en", "a b c", 3, 2), ("en", "b", 1, 1)}
    plan = phrases.prefix_counts(w, 3, 1)._jdf.queryExecution().toString()
    assert "Expand" in plan
