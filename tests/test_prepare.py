import pytest
from pyspark.sql import functions as F

from tessera.functions.numbering import numbered
from tessera.operators import prepare
from tessera.plans import context as ctx
from tessera.plans import queries as Q
from tests.conftest import SF, rows

OBS = "kpi string, area_id int, area_name string, area_type string, sex string, year int, value double"


def test_span_years_and_split_flag(spark):
    # unit frame 3 (1, 5, 6, 8 distinct years; only nulls) and 5 (sex sets)
    data = []
    for kpi, years in (("A", [2001]), ("B", range(2001, 2006)), ("C", range(2001, 2007)), ("D", range(2001, 2009))):
        for y in years:
            data.append((kpi, 101, "m", "K", "T", y, 1.0))
    data += [("D", 101, "m", "K", "T", 2012, None)]  # a later year without value does not count
    data += [("E", 101, "m", "K", "T", 2001, None)]  # only nulls: dropped
    data += [("B", 101, "m", "K", "K", 2001, 1.0), ("B", 101, "m", "K", "M", 2001, None)]  # K and M: split
    data += [("C", 101, "m", "K", "K", 2001, 1.0)]  # only K: no split
    out = rows(prepare.observation_span(spark.createDataFrame(data, OBS)))
    assert out == [("A", 2001, 2001, 0), ("B", 2001, 2005, 1), ("C", 2001, 2006, 0), ("D", 2003, 2008, 0)]


def test_area_group_rule(spark):
    df = spark.createDataFrame(
        [("X", 114, "Upplands Väsby", "K", "T", 2020, 1.0), ("X", 1, "Region Stockholm", "L", "T", 2020, 1.0),
         ("X", 0, "Riket", "L", "T", 2020, 1.0), ("X", 3, "Uppsala", "L", "T", 2020, 1.0)],
        OBS,
    )
    out = dict((r.area_name, r.area_group) for r in prepare.area_groups(df).collect())
    # unit frame 11: an area code without the region label that is not the nation -> id // 100
    assert out == {"Upplands Väsby": 1, "Region Stockholm": 1, "Riket": 0, "Uppsala": 0}


def _imputation_frame(spark):
    # unit frame 2: nulls for a municipality, a region and the nation; one area without a row
    d = [
        ("X", 101, "Kom A", "K", "T", 2020, 10.0),
        ("X", 102, "Kom B", "K", "T", 2020, None),
        ("X", 103, "Kom C", "K", "T", 2020, 30.0),
        ("X", 1, "Region One", "L", "T", 2020, 50.0),
        ("X", 201, "Kom D", "K", "T", 2020, 40.0),
        ("X", 2, "Region Two", "L", "T", 2020, None),
        ("X", 0, "Riket", "L", "T", 2020, None),
        ("X", 202, "Kom E", "K", "T", 2019, 7.0),  # Kom E has no 2020 row at all
        ("X", 0, "Riket", "L", "T", 2019, 8.0),
    ]
    return prepare.with_span(spark.createDataFrame(d, OBS))


def test_impute_reference(spark):
    out = {(r.area_name, r.year): (r.value, r.value_mean_group) for r in prepare.impute(_imputation_frame(spark)).collect()}
    # nation: mean over all areas of (kpi, year, sex), regions included
    assert out[("Riket", 2020)][0] == pytest.approx((10 + 30 + 50 + 40) / 4)
    # municipality: county group mean, which includes the region's own row
    assert out[("Kom B", 2020)][0] == pytest.approx((10 + 30 + 50) / 3)
    assert out[("Kom A", 2020)] == (10.0, pytest.approx(30.0))
    # region values are never filled; missing cells are not created
    assert ("Region Two", 2020) not in out and ("Kom E", 2020) not in out
    assert out[("Region One", 2020)] == (50.0, None)


def test_impute_documented(spark):
    out = {(r.area_name, r.year): r.value for r in prepare.impute(_imputation_frame(spark), "documented").collect()}
    assert out[("Kom B", 2020)] == pytest.approx(20.0)  # observed municipalities only
    assert out[("Region Two", 2020)] == pytest.approx(40.0)  # region from its municipalities
    assert out[("Riket", 2020)] == pytest.approx((10 + 30 + 40) / 3)  # nation from all municipalities
    assert out[("Kom E", 2020)] == pytest.approx(40.0)  # missing cell created
    assert out[("Riket", 2019)] == 8.0


def test_impute_unknown_mode(spark):
    with pytest.raises(ValueError):
        prepare.impute(_imputation_frame(spark), "bogus")


def test_complete_grid_creates_missing_nation_rows(spark):
    d = [("X", 101, "Kom A", "K", "T", 2020, 1.0), ("X", 0, "Riket", "L", "T", 2019, 2.0),
         ("X", 101, "Kom A", "K", "T", 2018, None)]
    g = prepare.complete_grid(spark.createDataFrame(d, OBS))
    made = [(r.area_name, r.year, r.area_type) for r in g.where("value is null and area_name = 'Riket'").collect()]
    assert made == [("Riket", 2020, "L")]  # 2018 has no value anywhere: nothing to fill


def test_mark_national_and_log(spark):
    d = [("X", 0, "Riket", "L", "T", 2020, 1.0), ("X", 1, None, "L", "T", 2020, 1.0), ("X", 2, "R2", "L", "T", 2020, 1.0)]
    out = rows(prepare.mark_national(spark.createDataFrame(d, OBS)), "area_id", "area_type")
    assert out == [(0, "R"), (1, None), (2, "L")]


def test_impute_null_sex_is_its_own_group(spark):
    d = [
        ("X", 101, "Kom A", "K", None, 2020, 10.0),
        ("X", 102, "Kom B", "K", None, 2020, 30.0),
        ("X", 0, "Riket", "L", None, 2020, None),
        ("X", 101, "Kom A", "K", "T", 2020, 100.0),
        ("X", 0, "Riket", "L", "T", 2020, None),
    ]
    out = {(r.area_name, r.sex): r.value for r in prepare.impute(prepare.with_span(spark.createDataFrame(d, OBS))).collect()}
    assert out[("Riket", None)] == pytest.approx(20.0)
    assert out[("Riket", "T")] == pytest.approx(100.0)


def test_numbers_are_dense(spark):
    df = spark.range(1000).repartition(7).select("id").where("id % 3 = 0")
    out, n = numbered(df, "no")
    got = out.collect()
    assert n == 334 and sorted(r.no for r in got) == list(range(334)) and len({r.id for r in got}) == 334
    assert numbered(df.limit(0), "no")[1] == 0


def test_whole_grid_is_every_cell(spark):
    d = [("X", 101, "Kom A", "K", "T", 2020, 1.0), ("X", 101, "Kom A", "K", "T", 2020, 2.0), ("Y", 1, "Region One", "L", None, 2018, None),
         ("X", 0, "Riket", "L", "T", 2018, 8.0), ("X", 202, None, "K", "K", 2019, 7.0)]
    obs = prepare.with_span(spark.createDataFrame(d, OBS))
    got = prepare.complete_grid(obs, divisor=100, areas="all")
    keys = {("X", "T"), ("X", "K")}  # Y has no value and no span
    areas = {("Kom A", 101), ("Riket", 0), (None, 202)}
    want = {(k, s, y, a, i) for k, s in keys for y in (2018, 2019, 2020) for a, i in areas}
    assert len(want) == 18 and {tuple(r[c] for c in prepare.GRID_KEYS) for r in got.collect()} == want
    assert got.count() == 19  # the observation that is there twice stays
    made = got.where("value is null")
    assert {r.area_type for r in made.where("area_name = 'Riket'").collect()} == {"L"}
    assert made.where("area_name <> 'Riket' and area_type is not null").count() == 0
    empty = prepare.complete_grid(obs.limit(0), areas="all")
    assert empty.count() == 0 and empty.columns == got.columns
    with pytest.raises(ValueError):
        prepare.complete_grid(obs, areas="some")


def test_slices_of_a_county_give_the_whole_grid(spark, monkeypatch):
    areas = spark.createDataFrame([(f"a{i}", i, "K", 1 if i < 50 else i) for i in range(60)], "area_name string, area_id int, area_type string, area_group int")
    cells = spark.createDataFrame([(g, f"k{k}", 1.0) for g in (1, 55, 99) for k in range(4)], "area_group int, kpi string, _fill double")
    want = rows(areas.join(cells, "area_group"), "area_name", "kpi")
    for size in (1, 7, 50, 1000):
        out = prepare._in_slices(areas, cells, size)
        assert rows(out, "area_name", "kpi") == want
    monkeypatch.setattr(prepare, "AREAS_PER_SLICE", 5)
    out = prepare._in_slices(areas, cells)
    # the areas of the hot county meet its cells in slices of about the size asked for
    sizes = [r["count"] for r in out.where("area_group = 1 and kpi = 'k0'").groupBy(F.pmod(F.xxhash64("area_id", "area_name"), F.lit(10))).count().collect()]
    assert sum(sizes) == 50 and max(sizes) <= 15
    assert prepare._in_slices(areas.limit(0), cells).count() == 0


def test_fixture_has_cells_to_create_and_to_fill(spark):
    """The queries of the grid and the nation exercise what they name."""
    obs = ctx.observations(spark, SF)
    grid, nation = Q.REGISTRY["q_grid"](spark, SF), Q.REGISTRY["q_grid_nation"](spark, SF)
    assert grid.count() > nation.count() > obs.count()
    before = obs.where("area_name = 'Riket'")
    filled = Q.REGISTRY["q_impute_national"](spark, SF)
    keys = ["kpi", "sex", "year"]
    there = before.where("value is not null").select(keys)
    new = filled.where("value is not null").select(keys)
    created = new.exceptAll(before.select(keys))
    assert created.count() > 0  # rows that were not there
    assert new.exceptAll(there).count() > created.count()  # and rows without a value
