import random

import numpy as np
import xxhash

from tessera.llm import simhash
from tessera.llm.components import components

SCHEMA = "doc_id long, text string, root string, fp string"


def brute_fingerprint(text):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").encode().split()
    grams = [b" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g, 42)
        for i in range(64):
            ones[i] += h >> i & 1
    return sum(1 << i for i in range(64) if 2 * ones[i] > len(grams))


def brute_classes(rows, bits=4):
    fps = [brute_fingerprint(t) for _, t in rows]
    at = list(range(len(rows)))

    def find(i):
        while at[i] != i:
            at[i] = at[at[i]]
            i = at[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= bits:
                at[max(find(i), find(j))] = min(find(i), find(j))
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return fps, [low.get(find(i)) for i in range(len(rows))]


def texts(seed=3):
    r = random.Random(seed)
    words = ["w%d" % i for i in range(400)]
    rows = []
    for d in range(25):
        base = [r.choice(words) for _ in range(r.choice([0, 1, 3, 5, 40, 300]))]
        for _ in range(r.choice([1, 1, 4])):
            own = list(base)
            for _ in range(r.choice([0, 0, 1, 3])):
                if own:
                    own[r.randrange(len(own))] = r.choice(words)
            rows.append((len(rows) + 10, " ".join(own)))
    return rows + [(None, rows[0][1]), (5, None), (6, " \t\n"), (7, "Ünïcode A\x0bB"), (7, "Ünïcode A\x0bB"), (None, "alone in null"), (8, "Ünïcode a b")]


def test_query_rows_equal_brute_force(spark):
    rows = texts()
    df = spark.createDataFrame([(d, t, "x", "y") for d, t in rows], SCHEMA)
    fps, ids = brute_classes(rows)
    got = simhash.near_duplicates(df).select("doc_id", "fp", "component_id").collect()
    key = lambda x: tuple((v is None, v) for v in x)
    want = sorted(((d, f, c) for (d, _), f, c in zip(rows, fps, ids, strict=True)), key=key)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in got), key=key) == want
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns
    out = kept.collect()
    assert len(out) == len({c for c in ids if c is not None}) + 1  # the class of NULL ids only
    assert {r.doc_id for r in out} == set(ids)


def test_long_runs_are_split_and_lose_no_link(spark):
    rng = np.random.default_rng(1)
    ball = np.unique(rng.integers(0, 2**64, dtype=np.uint64) ^ sum(
        (rng.integers(0, 2, 300, dtype=np.uint64) << np.uint64(b) for b in (1, 2, 9, 30, 31, 50, 63)), np.zeros(300, np.uint64)
    ))
    far = rng.integers(0, 2**64, 200, dtype=np.uint64)
    fps = np.concatenate([ball, far])
    df = spark.createDataFrame([(int(x),) for x in fps.view(np.int64)], "fp long")
    for bits, chunk in ((1, 7), (2, 4096), (4, 16)):
        got = components(simhash.links(df, bits, chunk))
        roots = {r.node: r.root for r in got.collect()}
        i, j = np.nonzero(np.bitwise_count(fps[:, None] ^ fps[None, :]) <= bits)
        at = simhash._labels(len(fps), i, j)
        mine = [roots.get(int(x), int(x)) for x in fps.view(np.int64)]
        assert all((mine[a] == mine[b]) == (at[a] == at[b]) for a in range(len(fps)) for b in range(a))


def test_pivots_bound_the_distance():
    rng = np.random.default_rng(2)
    x = rng.integers(0, 2**64, 500, dtype=np.uint64)
    p = simhash.scattered_pivots()
    assert len(set(p.tolist())) == simhash.PIVOTS
    t = simhash.pivot_table(x, p).astype(int)
    low = np.abs(t[:, :, None] - t[:, None, :]).max(axis=0)
    true = np.bitwise_count(x[:, None] ^ x[None, :])
    assert (low <= true).all()
    assert (low[true > 10] > 4).mean() > 0.99


def test_long_text_in_pieces_and_empty_table(spark, monkeypatch):
    text = " ".join(str(i * i) for i in range(5000)).encode()
    whole = simhash.fingerprint(text)
    monkeypatch.setattr(simhash, "HASHES_AT_ONCE", 64)
    assert simhash.fingerprint(text) == whole == brute_fingerprint(text.decode())
    empty = spark.createDataFrame([], SCHEMA)
    assert simhash.near_duplicates(empty).count() == 0
    assert simhash.one_of_each(empty).count() == 0


def test_components_of_a_path_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100), (7, 3), (200, 201), (201, 200)]
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(41)}, 100: 100, 200: 200, 201: 200}
