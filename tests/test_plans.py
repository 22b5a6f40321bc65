"""Plan-shape guards for the properties that matter at scale."""

import re

import pytest

from tessera.plans.queries import REGISTRY
from tessera.sources import fixture
from tests.conftest import SF


@pytest.fixture()
def no_broadcast(spark):
    old = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield
    for k, v in old.items():
        spark.conf.set(k, v)


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_observation_build_plan_without_broadcasts(spark, no_broadcast):
    # as on a large cluster, where no dimension fits a broadcast
    plan = _plan(fixture.raw_observations(spark, SF))
    exchanges = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    lineitem_keys = [e for e in exchanges if e.startswith("l_")]
    # lines are shuffled once, by part key; what follows is aggregated first
    assert [e.split("#")[0] for e in lineitem_keys if "l_partkey" in e] == ["l_partkey"], exchanges
    assert len(lineitem_keys) <= 2
    scan = re.search(r"FileScan parquet \[(l_[^\]]*)\]", plan)
    assert scan and len(scan.group(1).split(",")) == 8  # 8 of 11 columns read
    assert "partial_sum" in plan  # map-side combine before the aggregation shuffle
    assert "Expand" in plan  # grouping sets over the aggregated cells only


PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas", "PythonUDF")


# columns each query may read from the driver tables (pruning reaches the scan)
MAX_READ = {"lineitem": 8, "supplier": 4, "nation": 2, "part": 2, "documents": 4}


@pytest.mark.parametrize("name", sorted(REGISTRY))
def test_plan_of_each_query(spark, name):
    """No cross product, no Python, only the needed columns read."""
    spark.conf.set("spark.sql.maxMetadataStringLength", "2000")
    try:
        plan = _plan(REGISTRY[name](spark, SF))
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert not any(node in plan for node in PYTHON_NODES)  # everything stays in the JVM
    for line in plan.splitlines():
        scan = re.search(r"FileScan parquet \[([^\]]*)\].*Location: \w+\(\d+ paths\)\[([^\]]*)\]", line)
        if not scan:
            continue
        table = scan.group(2).rstrip("/").split("/")[-1].removesuffix(".parquet")
        if table in MAX_READ:
            assert len(scan.group(1).split(",")) <= MAX_READ[table], (table, scan.group(1))
