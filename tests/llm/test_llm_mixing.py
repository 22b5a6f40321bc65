import random

from pyspark.sql import functions as F

from tessera.llm import mixing

SCHEMA = "doc_id long, text string, source string, size string, target string"


def brute_targets(sizes, weights=(3, 1, 2), share=1.5, most=2):
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, out = share * sum(sizes.values()), dict.fromkeys(names, 0.0)
    free = list(names)
    while free:
        scale = (total - sum(out[s] for s in names if s not in free)) / sum(w[s] for s in free)
        over = [s for s in free if scale * w[s] > most * sizes[s]]
        for s in free:
            out[s] = min(scale * w[s], most * sizes[s])
        if not over:
            break
        free = [s for s in free if s not in over]
    return out


def rows():
    r = random.Random(5)
    out = []
    for i in range(600):
        s = r.choice(["a", "a", "a", "b", "ç", "d", None])
        n = r.choice([0, 1, 5, 20, 60])
        out.append((i, " ".join(r.choice(["one", "2", "drei", "été"]) for _ in range(n)), s, "x", "y"))
    return [*out, (3, None, "empty", "x", "y"), (None, "null id", "b", "x", "y"), (None, "null id", "b", "x", "y"), *[(9, "same row", "d", "x", "y")] * 5, (900, "big " * 3000, "e", "x", "y")]


def test_targets_and_epochs(spark):
    data = rows()
    df = spark.createDataFrame(data, SCHEMA)
    got = mixing.mix(df, rows_per_range=3).collect()
    again = mixing.mix(df.repartition(7), rows_per_range=50).collect()
    pick = lambda rs: sorted(((r.doc_id or -1, r.row_key, r.taken) for r in rs))
    assert pick(got) == pick(again) and len(got) == len(data)
    sizes = {}
    for _, t, s, *_ in data:
        sizes[s] = sizes.get(s, 0) + len((t or "").split())
    want = brute_targets(sizes)
    for s, size in sizes.items():
        own = [r for r in got if r.source == s]
        assert {r.source_size for r in own} == {size}
        assert all(abs(r.target - want[s]) < 1e-6 * max(1, want[s]) for r in own)
        assert abs(sum(r.taken for r in own) - want[s]) <= max(r.size for r in own) / 2 + 1e-9
        assert all(0 <= r.taken <= 2 * r.size and r.taken == r.size * r.epochs for r in own)
        epochs = {r.epochs for r in own if r.size}
        assert max(epochs, default=0) - min(epochs, default=0) <= 1  # whole epochs come first


def test_mixed_rows_follow_what_is_taken(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    out = mixing.mixed(df)
    assert out.columns == df.columns
    taken = mixing.mix(df)
    assert out.count() == taken.where("taken > 0").agg({"epochs": "sum"}).first()[0]
    words = sum(len(r.text.split()) for r in out.collect())
    assert words == taken.agg({"taken": "sum"}).first()[0]


def test_better_documents_are_taken_more_often(spark):
    good = [(i, f"clean words number {'x' * (i % 7)} {i}", "s", "", "") for i in range(2000)]
    bad = [(i + 10000, f"## %% 12 {i} 3", "s", "", "") for i in range(2000)]
    got = mixing.mix(spark.createDataFrame(good + bad, SCHEMA), total_share=0.5).collect()
    share = lambda rs: sum(r.taken > 0 for r in rs) / len(rs)
    assert share([r for r in got if r.doc_id < 10000]) > 1.5 * share([r for r in got if r.doc_id >= 10000])


def test_empty_tables(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mixing.mix(empty).count() == 0 and mixing.mixed(empty).count() == 0
    blank = spark.createDataFrame([(1, " ", None, "", ""), (2, None, None, "", "")], SCHEMA)
    assert [r.taken for r in mixing.mix(blank).collect()] == [0, 0]
    assert mixing.mixed(blank).count() == 0


def test_no_range_holds_many_whatever_the_quality(spark):
    for quality in (0.05, 0.3, 1.0):
        keys = spark.range(20_000).select((-F.log((F.col("id") + 0.5) / 20_000) / quality).alias("key"))
        cells = keys.groupBy(mixing.key_cell(F.col("key"), 100).alias("cell")).agg(F.count("*").alias("n"), F.min("key").alias("a"), F.max("key").alias("b"))
        cells = cells.orderBy("cell").collect()
        assert max(c.n for c in cells) <= 210 and len(cells) <= 350
        assert all(x.b < y.a for x, y in zip(cells, cells[1:], strict=False))  # cells ascend with the key
