import numpy as np
from pyspark.sql import functions as F

from tessera.llm import mih
from tessera.llm.queries import op3_mih

SCHEMA = "vec_id long, embedding array<float>, rank string, score string"


def brute(ids, x, k=20, every=20):
    out = {}
    for i, q in enumerate(ids):
        if q % every == 0:
            s = (x * x[i]).sum(axis=1)
            order = [j for j in np.lexsort((ids, -s)) if ids[j] != q][:k]
            out[q] = [(int(ids[j]), float(s[j])) for j in order]
    return out


def by_query(rows):
    """The lists by query id, which no two query rows share."""
    out = {}
    for r in sorted(rows, key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({a for a, _ in got[q]} & {a for a, _ in w}) / max(1, len(w)) for q, w in want.items()])


def test_recall_of_the_query(spark):
    sf = "/root/testdata/sf0.1"
    t = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    want = brute(t["vec_id"].to_numpy(), np.array(t["embedding"].tolist(), dtype=np.float64))
    got = by_query(op3_mih(spark, sf).collect())
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.95
    for q, rows in got.items():
        true = dict(want[q])
        assert all(abs(true[v] - s) < 1e-12 for v, s in rows if v in true)
        assert rows == sorted(rows, key=lambda r: (-r[1], r[0]))


def test_recall_outside_the_sample(spark):
    t = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    p = t.toPandas()
    want = brute(p["vec_id"].to_numpy(), np.array(p["embedding"].tolist(), dtype=np.float64))
    got = by_query(mih.nearest(t, F.col("vec_id") % 20 == 0, sample_rows=500).collect())  # a quarter of the rows
    assert set(got) == set(want) and recall(got, want) >= 0.95


def test_many_blocks_and_different_norms(spark, monkeypatch):
    monkeypatch.setattr(mih, "ROW_BLOCK", 300)
    monkeypatch.setattr(mih, "QUERY_BLOCK", 10)
    rng = np.random.default_rng(3)
    x = (rng.standard_normal((1500, 24)) * rng.choice([0.3, 1, 4], (1500, 1))).astype(np.float32)
    x[200:700] = x[200]  # a hot vector
    df = spark.createDataFrame([(i, v.tolist(), "", "") for i, v in enumerate(x)], SCHEMA)
    got = by_query(mih.nearest(df, F.col("vec_id") % 20 == 0).collect())
    want = brute(np.arange(1500), x.astype(np.float64))
    assert recall(got, want) >= 0.9
    assert [v for v, _ in got[400]] == [v for v, _ in want[400]]  # ties to the smaller id


def test_odd_vectors(spark):
    good = [(i, [float(i % 3), 1.0, 0.5], "", "") for i in range(1, 30)] + [(0, [1.0, 0.0, 0.0], "", "")]
    bad = [(40, None, "", ""), (60, [], "", ""), (80, [0.0, 0.0, 0.0], "", ""), (100, [1.0, None, 2.0], "", ""), (120, [float("nan"), 1.0, 1.0], "", ""), (140, [float("inf"), 1.0, 1.0], "", ""), (160, [1.0, 2.0], "", ""), (None, [9.0, 9.0, 9.0], "", ""), (20, [2.0, 1.0, 0.5], "", "")]
    rows = mih.nearest(spark.createDataFrame(good + bad, SCHEMA), F.col("vec_id") % 20 == 0).collect()
    got = by_query(r for r in rows if r.query_id != 20)
    same = [r for r in bad if r[0] == 20]  # an id of two rows: both are candidates
    ids = np.array([i for i, *_ in sorted(good) + same])
    x = np.array([v for _, v, *_ in sorted(good) + same])
    assert got[0] == brute(ids, x)[0]
    assert 160 not in got  # no other vector has its length
    few = mih.nearest(spark.createDataFrame(good[:3] + good[-1:], SCHEMA), F.col("vec_id") % 20 == 0).collect()
    assert sorted(r.vec_id for r in few) == [1, 2, 3]
    assert mih.nearest(spark.createDataFrame([], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0
    assert mih.nearest(spark.createDataFrame(good[:5], SCHEMA), F.col("vec_id") % 20 == 0).count() == 0


def test_every_row_counts(spark):
    """Rows of one id, equal rows, and vectors of different lengths."""
    rng = np.random.default_rng(8)
    rows = [(int(i), rng.standard_normal(d).tolist()) for d in (5, 8) for i in rng.integers(0, 60, 150)]
    rows += rows[:40]
    df = spark.createDataFrame([(i, v, "", "") for i, v in rows], SCHEMA.replace("float", "double"))
    got = {}
    for r in mih.nearest(df, F.col("vec_id") % 20 == 0).collect():
        got.setdefault((r.query_id, r.query_row), []).append((r["rank"], r.vec_id, round(r.score, 9)))
    want = []
    for i, v in rows:
        if i % 20 == 0:
            near = sorted((-sum(a * b for a, b in zip(v, u, strict=True)), j) for j, u in rows if j != i and len(u) == len(v))[:20]
            want.append((i, [(k + 1, j, round(-s, 9)) for k, (s, j) in enumerate(near)]))
    assert sorted((q, sorted(x)) for (q, _), x in got.items()) == sorted(want)


def test_probing_finds_every_code_within_the_radius():
    rng = np.random.default_rng(5)
    rows, queries = (rng.integers(0, 2**16, (n, 4), dtype=np.uint16) for n in (700, 90))
    rows[:50] = queries[:50] ^ (1 << rng.integers(0, 16, (50, 4))).astype(np.uint16)
    true = mih.hamming(queries[:, None], rows[None])
    for radius in (0, 3, 4, 7, 20, 26, 64):
        i, j = mih.probe(queries, rows, radius)
        assert set(zip(i.tolist(), j.tolist(), strict=True)) == set(zip(*(a.tolist() for a in np.nonzero(true <= radius)), strict=True))
        parts = mih.shares(radius, 4)
        assert sum(p + 1 for p in parts) == radius + 1


def test_substrings_are_equal_and_of_real_bits():
    rng = np.random.default_rng(9)
    for d in (24, 64, 300):
        x = rng.standard_normal((400, d))
        codes = mih.fit(x, float(np.sqrt((x * x).sum(axis=1).max())) + 1e-9)
        got = codes.encode(x)
        assert codes.bits == 16 * got.shape[1] >= mih.CODE_BITS
        bits = np.unpackbits(got.view(np.uint8), axis=1)
        assert all(0 < n < 400 for n in bits.sum(axis=0))  # no bit is the same in all codes
