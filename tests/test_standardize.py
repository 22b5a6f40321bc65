import pytest
from pyspark.sql import functions as F

from tessera.operators import standardize as S
from tests.conftest import rows

BASE = ("kpi string, area_id int, area_name string, area_type string, sex string, year int, value double, "
        "inverted int")


def test_select_year_lag_rules(spark):
    # unit frame 4: exact lag year present, only earlier years, only later years
    d = []
    for y in (2010, 2015, 2020):
        d.append(("exact", 1, "a", "L", "T", y, 1.0, 0))
    for y in (2011, 2013, 2020):  # target 2015 absent: latest earlier year 2013
        d.append(("earlier", 1, "a", "L", "T", y, 1.0, 0))
    for y in (2018, 2019, 2020):  # nothing at or before 2015: nearest is 2018
        d.append(("later", 1, "a", "L", "T", y, 1.0, 0))
    df = spark.createDataFrame(d, BASE)
    assert rows(S.select_year(df, "lag", 5)) == [("earlier", 2020, 2013), ("exact", 2020, 2015), ("later", 2020, 2018)]
    assert rows(S.select_year(df, "latest_year")) == [("earlier", 2020, 2020), ("exact", 2020, 2020), ("later", 2020, 2020)]


def test_year_scope_area_type(spark):
    # A type that lags a year disappears unless the scope is per area type
    d = [("x", 1, "a", "L", "T", 2020, 1.0, 0), ("x", 101, "b", "K", "T", 2019, 2.0, 0)]
    df = spark.createDataFrame(d, BASE)
    assert rows(S.selected_rows(df), "area_type") == [("L",)]
    assert rows(S.selected_rows(df, year_scope="area_type"), "area_type") == [("K",), ("L",)]


def _frame(spark):
    # unit frame 6: reference with min = max; group without T; inverted and normal twins
    d = [
        ("n", 1, "a", "L", "T", 2020, 10.0, 0), ("n", 2, "b", "L", "T", 2020, 20.0, 0),
        ("n", 1, "a", "L", "K", 2020, 25.0, 0), ("n", 2, "b", "L", "M", 2020, 5.0, 0),
        ("v", 1, "a", "L", "T", 2020, 10.0, 1), ("v", 2, "b", "L", "T", 2020, 20.0, 1),
        ("flat", 1, "a", "L", "T", 2020, 7.0, 0), ("flat", 2, "b", "L", "T", 2020, 7.0, 0),
        ("noT", 1, "a", "L", "K", 2020, 1.0, 0), ("noT", 2, "b", "L", "K", 2020, 3.0, 0),
        ("n", 1, "a", "L", "T", 2019, 40.0, 0),
    ]
    return spark.createDataFrame(d, BASE)


def _scores(df):
    return {(r.kpi, r.area_id, r.sex): r.standard_value for r in df.collect()}


def test_total_mode(spark):
    s = _scores(S.standardize(_frame(spark), "total"))
    assert s[("n", 1, "T")] == 0.0 and s[("n", 2, "T")] == 100.0
    assert s[("v", 1, "T")] == 100.0 and s[("v", 2, "T")] == 0.0  # inverted twin
    assert s[("n", 1, "K")] == 150.0 and s[("n", 2, "M")] == -50.0  # finding 3: outside 0..100
    assert s[("flat", 1, "T")] == 0.0  # degenerate reference
    assert s[("noT", 1, "K")] == 0.0 and s[("noT", 2, "K")] == 0.0  # no total rows: 0 (G14)


def test_separate_and_pooled_modes(spark):
    sep = _scores(S.standardize(_frame(spark), "separate_bas" if False else "separate"))
    assert sep[("noT", 1, "K")] == 0.0 and sep[("noT", 2, "K")] == 100.0
    pooled = _scores(S.standardize(_frame(spark), "sammantaget_bas"))
    assert pooled[("n", 2, "M")] == 0.0 and pooled[("n", 1, "K")] == 100.0
    assert pooled[("n", 1, "T")] == pytest.approx(25.0)


def test_lag_uses_latest_reference(spark):
    # The lagged year is scored against the latest year's range
    s = _scores(S.standardize(_frame(spark), "total", "lag", 1))
    assert s[("n", 1, "T")] == 300.0


def test_unknown_modes_raise(spark):
    with pytest.raises(ValueError):
        S.standardize(_frame(spark), "both")
    with pytest.raises(ValueError):
        S.standardize(_frame(spark), "total", "earliest")


def test_missing_split(spark):
    out = rows(S.missing_split(_frame(spark)))
    assert ("noT", "L", 2020, "T,M") in out and ("n", "L", 2020, "") not in out


def test_per_year_bounded(spark):
    df = _frame(spark)
    out = S.standardize_per_year(df)
    lo, hi = out.agg(F.min("standard_value"), F.max("standard_value")).first()
    assert lo >= 0.0 and hi <= 100.0


def test_validate_logs_missing_sexes(spark, caplog):
    import logging

    with caplog.at_level(logging.WARNING, logger="tessera.operators.standardize"):
        S.standardize(_frame(spark), "total", validate=True)
    assert any("miss a sex" in r.message for r in caplog.records)
