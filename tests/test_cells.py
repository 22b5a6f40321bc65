"""Cells of the observation fixture, on hand-made tables."""

import datetime as dt
import os
import re

import pytest

from tessera.plans import context as ctx
from tessera.plans import queries as Q
from tessera.sources import fixture
from tests.conftest import SF

LINE = "l_partkey long, l_suppkey long, l_linenumber int, l_extendedprice double, l_discount double, l_returnflag string, l_linestatus string, l_shipdate timestamp"
DAY = dt.datetime(1997, 5, 1)


@pytest.fixture()
def tables(spark, tmp_dir):
    """Brands 11, 21 and 25; supplier 7 is listed twice; one line without a status, one not returned."""
    lines = [
        (1, 7, 1, 10.0, 0.0, "R", "F", DAY),
        (1, 7, 2, 30.0, 0.0, "R", "O", DAY),
        (1, 8, 7, 50.0, 0.0, "R", "F", DAY),
        (1, 8, 1, 70.0, 0.0, "N", "F", DAY),
        (2, 8, 1, 20.0, 0.0, "R", "F", DAY),
        (3, 8, 1, 40.0, 0.0, "R", None, DAY),
    ]
    parts = [(1, "Brand#11", "A"), (2, "Brand#21", "A"), (3, "Brand#25", "B")]
    suppliers = [(7, "S7", 0, 1.0), (7, "S7", 0, 1.0), (8, "S8", 0, -1.0)]
    for name, data, schema in (
        ("lineitem", lines, LINE),
        ("part", parts, "p_partkey long, p_brand string, p_type string"),
        ("supplier", suppliers, "s_suppkey long, s_name string, s_nationkey int, s_acctbal double"),
        ("nation", [(0, "N0")], "n_nationkey int, n_name string"),
    ):
        spark.createDataFrame(data, schema).write.parquet(f"{tmp_dir}/{name}.parquet")
    return tmp_dir


def test_municipalities_leave_the_exchange_as_they_are(spark):
    plan = fixture.raw_observations(spark, SF)._jdf.queryExecution().executedPlan().toString()
    # rows are only copied to the regions and the nation, not for each level and sex
    copies = [len(re.findall(r"\[[^\[\]]*\]", x)) for x in re.findall(r"Expand \[(\[.*?\])\],", plan)]
    assert copies and max(copies) <= 2, copies


def test_cells_of_a_supplier_listed_twice(spark, tables):
    obs = fixture.raw_observations(spark, tables).where("kpi = 'I11'")
    got = {(r.area_id, r.sex): r.value for r in obs.collect()}
    k7, k8 = 1_000_000_007, 1_000_000_008
    assert got[k7, "K"] == 10.0 and got[k7, "M"] == 30.0 and got[k7, "T"] == 20.0
    # the line that was not returned makes a cell without a value
    assert got[k8, None] == 50.0 and got[k8, "K"] is None and got[k8, "T"] == 50.0
    # supplier 7 counts twice in its region
    assert got[1, "T"] == (2 * 10 + 2 * 30 + 50) / 5 and got[1, "K"] == 10.0 and got[1, None] == 50.0
    assert obs.count() == len(got)
    lazy, written = fixture.raw_observations(spark, tables), ctx.observations(spark, tables)
    assert lazy.exceptAll(written).isEmpty() and written.exceptAll(lazy).isEmpty()


def test_base_joins_the_catalog_by_its_real_size(spark, tables):
    base = Q.REGISTRY["q_catalog"](spark, tables)
    plan = base._jdf.queryExecution().optimizedPlan().toString()
    # no distinct rows of the part table, whose size would be taken for the catalog's
    assert "p_brand" not in plan and "p_type" not in plan
    assert {r.kpi_text for r in base.collect()} == {"Brand#11", "Brand#21", "Brand#25"}


def test_all_observations_of_the_nation(spark, tables):
    """Brand 11 has no row of the nation in the observations with gaps, brand 21 no value by sex."""

    def nation(df):
        return {(r.kpi, r.sex): r.value for r in df.where("area_id = 0").collect()}

    gapped, whole = nation(ctx.observations(spark, tables)), nation(Q.REGISTRY["q_obs"](spark, tables))
    assert {k for k, _ in gapped} == {"I21", "I25"} and gapped["I21", "K"] is None
    assert whole == {
        ("I11", "K"): 10.0, ("I11", "M"): 30.0, ("I11", None): 50.0, ("I11", "T"): 26.0,
        ("I21", "K"): 20.0, ("I21", "T"): 20.0, ("I25", None): 40.0, ("I25", "T"): 40.0,
    }
    # not the mean of the areas, but what was observed
    assert nation(Q.REGISTRY["q_catalog"](spark, tables)) == whole
    assert nation(Q.REGISTRY["q_impute_group"](spark, tables))["I11", "T"] == 32.0


def test_landed_files_are_compressed_and_bounded(spark, tables, tmp_dir, monkeypatch):
    monkeypatch.setattr(Q, "LANDED_ROWS", 3)
    obs = ctx.observations(spark, tables)
    for _ in range(2):
        Q._land(obs, f"{tmp_dir}/landed")
    files = os.listdir(f"{tmp_dir}/landed")
    assert all(f.endswith(".json.gz") for f in files if f.startswith("part-"))
    back = spark.read.schema(obs.schema).json(f"{tmp_dir}/landed")
    per_file = back.groupBy("_metadata.file_path").count()
    assert per_file.agg({"count": "max"}).first()[0] <= 3
    twice = obs.unionAll(obs)
    assert back.exceptAll(twice).isEmpty() and twice.exceptAll(back).isEmpty()
    landed = Q.REGISTRY["q_file_relanded"](spark, tables)
    assert landed.exceptAll(Q.rounded(obs)).isEmpty() and landed.count() == obs.count()
