import re

import pytest

from tessera.plans import context as ctx
from tessera.plans import queries as Q
from tests.conftest import SF


@pytest.fixture()
def static(spark):
    """Plans as they stand before any runtime re-planning."""
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    spark.conf.set("spark.sql.adaptive.enabled", "true")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("mode", ["total", "separate", "pooled"])
def test_scoring_joins_do_not_shuffle_the_rows(spark, static, mode):
    ctx.marked_base(spark, SF)
    p = plan(Q.REGISTRY[f"q_std_{mode}_lag"](spark, SF))
    assert "SortMergeJoin" not in p and "Exchange hashpartitioning" not in p


def test_imputation_reads_the_observations_three_times_at_most(spark, static):
    ctx.observations(spark, SF)
    p = plan(Q.REGISTRY["q_impute_group"](spark, SF))
    assert len(re.findall(r"FileScan parquet .*tessera/obs-", p)) <= 3


PLANNED = {"q_final": (0, 2), "q_total_region": (6, 2), "q_theme_region": (6, 2), "q_total_municipal": (8, 2)}  # its code key is a join of its own


@pytest.mark.parametrize("name", sorted(PLANNED))
def test_exchanges_without_broadcasts(spark, static, name):
    ctx.final_cells(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q.REGISTRY[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    exchanges, scans = PLANNED[name]
    assert len(re.findall(r"\bExchange (?:hash|range|Single)", p)) <= exchanges
    assert len(re.findall(r"FileScan parquet .*tessera/", p)) <= scans


@pytest.mark.parametrize("name", ["q_final", "q_check_national"])
def test_finals_are_joined_as_they_lie(spark, static, name):
    ctx.scored_cells(spark, SF), ctx.final_cells(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q.REGISTRY[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in p and "Exchange" not in p and p.count("Bucketed: true") == 2


def test_descriptions_plan_one_reduction(spark, static):
    ctx.level_texts(spark, SF)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        p = plan(Q.REGISTRY["q_descriptions"](spark, SF))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert len(re.findall(r"\bExchange (?:hash|range|Single)", p)) <= 6
    assert len(re.findall(r"FileScan parquet .*tessera/", p)) == 1
