import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessera.llm import katz
from tessera.llm.queries import op6_katz

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, score string, n_tokens string"


def tokens(text):
    return [*"".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split(), None]


class Brute:
    """The same model with dictionaries."""

    def __init__(self, texts):
        self.c, self.c2, self.follow = Counter(), Counter(), defaultdict(set)
        for t in texts:
            u = "start"
            for v in tokens(t):
                self.c[v] += 1
                self.c2[u, v] += 1
                self.follow[u].add(v)
                u = v
        self.n, self.docs = self.c.total(), len(texts)
        self.d1, self.d2 = (katz.discounts([sum(x == r for x in c.values()) for r in range(1, 7)]) for c in (self.c, self.c2))
        self.unk = 1 - sum(self.lost(x, self.d1) for x in self.c.values()) / self.n

    @staticmethod
    def lost(c, d):
        return c * d[c] if c <= katz.GT_MOST else c - katz.RELIABLE_LOSS

    def p1(self, v):
        return self.lost(self.c[v], self.d1) / self.n if v in self.c else self.unk

    def p(self, v, u):
        cu = self.docs if u == "start" else self.c[u]
        if (u, v) in self.c2:
            return self.lost(self.c2[u, v], self.d2) / cu
        if not cu:
            return self.p1(v)
        s1 = sum(self.lost(self.c2[u, w], self.d2) for w in self.follow[u]) / cu
        return (1 - s1) / (1 - sum(self.p1(w) for w in self.follow[u])) * self.p1(v)

    def rows(self, d, text, held):
        own, score, u = tokens(text), 0.0, "start"
        for v in own:
            score += math.log10(self.p(v, u))
            u = v
        base = sum(math.log10((self.c[v] + 0.5) / (self.n + 0.5 * (len(self.c) + 1))) for v in own)
        return d, held, len(own), sum(v in self.c for v in own), self.n, base, score


def close(got, want):
    key = lambda r: tuple((x is None, x) for x in r[:5]) + (round(r[5], 6),)
    for g, w in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert g[:5] == w[:5]
        assert g[5:] == pytest.approx(w[5:], rel=1e-9)


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    held = lambda d: zlib.crc32(str(d).encode()) % 5 == 1
    model = Brute([r.text for r in docs if not held(r.doc_id)])
    got = [tuple(r) for r in op6_katz(spark, SF).collect()]
    close(got, [model.rows(r.doc_id, r.text, held(r.doc_id)) for r in docs])
    out = [r for r in got if r[1]]
    assert sum(r[6] for r in out) > sum(r[5] for r in out)


def test_small_batches_and_odd_rows(spark):
    r = random.Random(3)
    words = ["a", "b", "C", "the", "é", "x1"] + [f"w{i}" for i in range(60)]
    rows = [(i, " ".join(r.choice(words[: 6 + i % 50]) for _ in range(i % 40)), "", "") for i in range(120)]
    rows += [(500, None, "", ""), (501, "", "", ""), (None, "the a", "", ""), (None, "the a", "", ""), (502, "never seen before", "", ""), (7, "the \t b\n", "", ""), (503, "the " * 30_000, "", "")]
    held = F.coalesce(F.col("doc_id") % 5 == 1, F.lit(True)) | (F.col("doc_id") == 502)
    is_held = lambda d: d is None or d % 5 == 1 or d == 502
    model = Brute([t for d, t, *_ in rows if not is_held(d)])
    want = [model.rows(d, t, is_held(d)) for d, t, *_ in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    for size, per in ((10**6, 10**6), (60, 20)):
        close([tuple(x) for x in katz.scores(df, held, batch_tokens=size, keys_per_partition=per).collect()], want)


def test_probabilities_add_up_to_one():
    r = random.Random(9)
    model = Brute([" ".join(r.choice("abcdefghij") + str(r.choice([1, 1, 1, 2, r.randrange(40)])) for _ in range(60)) for _ in range(40)])
    for u in ["start", *list(model.c)[:40], b"never"]:
        assert sum(model.p(v, u) for v in [*model.c, b"unknown"]) == pytest.approx(1, abs=1e-12)


def test_discounts_are_good_turing():
    d = katz.discounts([1000, 400, 200, 120, 80, 57])
    common = 6 * 57 / 1000
    assert d[1] == pytest.approx((2 * 400 / 1000 - common) / (1 - common))
    assert ((0 < d[1:]) & (d[1:] < 1)).all()
    assert katz.discounts([0] * 6)[1:].tolist() == [0.5, 0.75, 2.5 / 3, 3.5 / 4, 0.9]


def test_nothing_to_learn_from(spark):
    assert katz.scores(spark.createDataFrame([], SCHEMA), F.lit(False)).count() == 0
    (row,) = katz.scores(spark.createDataFrame([(1, "a b", "", "")], SCHEMA), F.lit(True)).collect()
    assert (row.n_tokens, row.n_known, row.train_tokens, row.score) == (3, 0, 0, 0.0)


def test_blocks_round_trip():
    rng = np.random.default_rng(1)
    keys = np.sort(rng.integers(0, 2**64, 1000, dtype=np.uint64))
    assert (katz._open_keys(katz._press_keys(keys)) == keys).all()
    for parts in (1, 3, 16):
        cut = katz._cuts(keys, parts)
        assert cut[0] == 0 and cut[-1] == 1000 and len(cut) == parts + 1 and (np.diff(cut) >= 0).all()
    for a in (np.arange(5, dtype="<u4"), np.empty(0, "<f8"), rng.standard_normal(7)):
        assert (katz._open(katz._press(a), a.dtype.str) == a).all()
