import numpy as np
import pytest

from tessera.operators import checks as C
from tests.conftest import rows


def test_column_summary_matches_type7_quantiles(spark):
    rng = np.random.default_rng(7)
    a = rng.normal(size=503).round(4)
    b = rng.integers(0, 5, size=503).astype(float)
    data = [(float(x), float(y) if i % 17 else None) for i, (x, y) in enumerate(zip(a, b))]
    df = spark.createDataFrame(data, "a double, b double").repartition(7)
    out = {r.column: r for r in C.column_summary(df, ["a", "b"]).collect()}
    for col, arr in (("a", a), ("b", np.array([d[1] for d in data if d[1] is not None]))):
        r = out[col]
        assert r.n == len(arr)
        assert r.q25 == pytest.approx(np.quantile(arr, 0.25))
        assert r.median == pytest.approx(np.quantile(arr, 0.5))
        assert r.q75 == pytest.approx(np.quantile(arr, 0.75))
        assert r.min == arr.min() and r.max == arr.max()
    assert out["b"].n_null == sum(1 for d in data if d[1] is None)


@pytest.mark.parametrize("few", [1, 3, 50])
def test_quartiles_are_selected_whatever_the_values(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_VALUES", few)
    monkeypatch.setattr(C, "SKETCH", 20)  # a coarse one, so that rounds are needed
    rng = np.random.default_rng(3)
    columns = {
        "spread": np.exp(rng.normal(size=1500) * 40) * rng.choice([-1, 1], 1500),
        "hot": np.where(rng.random(1500) < 0.6, 7.0, rng.normal(size=1500)),
        "few": rng.integers(0, 3, 1500).astype(float),
        "same": np.full(1500, 2.5),
        "none": np.full(1500, np.nan),
    }
    data = [tuple(None if np.isnan(v) else float(v) for v in r) for r in zip(*columns.values())]
    df = spark.createDataFrame(data, ", ".join(f"`{c}` double" for c in columns)).repartition(5)
    out = {r.column: r for r in C.column_summary(df, list(columns)).collect()}
    for c, v in columns.items():
        if c == "none":
            assert (out[c].n, out[c].n_null, out[c].median, out[c].min) == (0, 1500, None, None)
        else:
            got = (out[c].q25, out[c].median, out[c].q75)
            assert got == pytest.approx(tuple(np.quantile(v, [0.25, 0.5, 0.75])), rel=1e-12)
    empty = C.column_summary(df.limit(0), ["hot"]).first()
    assert (empty.n, empty.q25, empty.max) == (0, None, None)


def test_summary_shuffles_no_row_and_reads_its_columns(spark, tmp_dir, monkeypatch):
    """Every pass is an aggregate of the summed columns alone."""
    spark.range(1000).selectExpr("id", "id * 2 AS a", "id AS b", "'x' AS c").write.parquet(f"{tmp_dir}/t")
    plans, whole = [], type(spark.range(1)).agg

    def agg(self, *exprs):
        out = whole(self, *exprs)
        plans.append(out._jdf.queryExecution().executedPlan().toString())
        return out

    monkeypatch.setattr(type(spark.range(1)), "agg", agg)
    monkeypatch.setattr(C, "FEW_VALUES", 50)
    got = C.column_summary(spark.read.parquet(f"{tmp_dir}/t"), ["a"]).first()
    assert (got.q25, got.median, got.q75) == (499.5, 999.0, 1498.5)
    assert len(plans) >= 3
    for p in plans:
        assert "Exchange hashpartitioning" not in p and "rangepartitioning" not in p
        assert "FileScan parquet [a#" in p and "b#" not in p


def test_orientation_conflicts(spark):
    df = spark.createDataFrame([("a", 0), ("a", 0), ("b", 1), ("c", 0), ("c", 1)], "kpi string, inverted int")
    assert rows(C.orientation_conflicts(df)) == [("c", 1, 1)]


def test_catalog_and_category_agreement(spark):
    cat = spark.createDataFrame([("a", "x"), ("b", "y"), ("c", None)], "kpi string, kpi_text string")
    base = spark.createDataFrame([("a", "x"), ("b", "z"), ("d", "w")], "kpi string, kpi_text string")
    ag = C.catalog_agreement(cat, base)
    assert rows(ag) == [("a", "x", "x", 1), ("b", "y", "z", 0), ("d", None, "w", 0)]
    assert C.catalog_agreement_tally(ag).first().n == 1
    c1 = spark.createDataFrame([("A", "T", "P", 1)], "aspect string, theme string, part string, sort_order int")
    c2 = spark.createDataFrame([("A", "T", "P", 1), ("B", "T", "P", 1)], "aspect string, theme string, part string, sort_order int")
    assert rows(C.category_agreement(c1, c2), "aspect") == [("B",)]


def test_unmatched_areas_and_log_losses(spark):
    rows = spark.createDataFrame(
        [(101, "a", "K"), (102, "b", "K"), (0, "Riket", "R")], "area_id int, area_name string, area_type string"
    )
    codes = spark.createDataFrame([("101",)], "Kommun_kod string")
    assert rows_of(C.unmatched_areas(rows, codes, "Kommun_kod")) == [(102, "b", "K")]
    base = spark.createDataFrame(
        [("x", 1, 0.0), ("x", 1, -2.0), ("x", 1, 3.0), ("y", 0, -1.0), ("z", 1, None)], "kpi string, logged int, value double"
    )
    assert rows_of(C.log_losses(base)) == [("x", 2, -2.0)]


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())
