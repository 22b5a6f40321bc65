"""Tables that follow the data: files cut by size, single indicators replaced,
one version of what landed, rejects, and counts taken from the writes."""

import glob
import json
import os
import time

import pytest
from pyspark.sql import functions as F

from tessera import schemas
from tessera.operators import checks
from tessera.plans import annual
from tessera.plans import queries as Q
from tessera.sources import files
from tessera.streaming.landing import land_observations, read_log, refresh_table
from tests.conftest import SF, rows

OBS = "kpi string, area_id long, area_name string, area_type string, sex string, year int, value double"


def _parts(path, kpi):
    return sorted(glob.glob(os.path.join(path, f"kpi={kpi}", "part-*")))


def test_only_the_given_indicators_are_replaced(spark, tmp_dir):
    df = spark.range(300).select(F.concat(F.lit("N"), F.col("id") % 3).alias("kpi"), "id")
    path = os.path.join(tmp_dir, "t")
    files.write_table(df, path)
    before = {k: _parts(path, k) for k in ("N0", "N1", "N2")}
    assert all(before.values())
    files.write_table(df.where("kpi = 'N1'").withColumn("id", F.col("id") + 1000), path, replace="partitions")
    assert _parts(path, "N0") == before["N0"] and _parts(path, "N2") == before["N2"] and _parts(path, "N1") != before["N1"]
    back = files.read_table(spark, path)
    assert back.count() == 300 and back.where("kpi = 'N1' and id < 1000").count() == 0
    files.write_table(df.where("kpi = 'N0'"), path)  # the whole table
    assert files.read_table(spark, path).select("kpi").distinct().count() == 1
    with pytest.raises(ValueError):
        files.write_table(df, path, replace="rows")


def test_writers_follow_the_bytes(spark, tmp_dir):
    """A large indicator is cut into several files, small ones share a task."""
    big = spark.range(200_000).select(F.when(F.col("id") < 190_000, F.lit("big")).otherwise(F.concat(F.lit("s"), F.col("id") % 5)).alias("kpi"), F.rand(1).alias("v"))
    old = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.advisoryPartitionSizeInBytes",)}
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "400k")
    try:
        files.write_table(big.repartition(16), path := os.path.join(tmp_dir, "b"))
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    assert len(_parts(path, "big")) >= 3
    assert all(len(_parts(path, f"s{i}")) <= 2 for i in range(5))
    plan = big.hint("rebalance", F.col("kpi"))._jdf.queryExecution().optimizedPlan().toString()
    assert "RebalancePartitions" in plan


def _land(folder, name, records):
    os.makedirs(folder, exist_ok=True)
    with open(os.path.join(folder, name), "w") as f:
        f.write("\n".join(json.dumps(dict(zip(("kpi", "area_id", "area_name", "area_type", "sex", "year", "value"), r))) for r in records) + "\n")
    time.sleep(0.05)  # landing times are those of the files


def test_landing_again_gives_one_version(spark, tmp_dir):
    source, log, table = (os.path.join(tmp_dir, x) for x in ("in", "log", "table"))
    first = [("N1", 1, "A", "L", "T", 2020, 1.0), ("N1", 2, "B", "L", None, 2020, 5.0), ("N2", 1, "A", "L", "T", 2020, 7.0)]
    _land(source, "a.json", first)
    land_observations(spark, source, log).awaitTermination(120)
    assert refresh_table(spark, log, table) == 2
    files_of_n2 = _parts(table, "N2")
    assert refresh_table(spark, log, table) == 0  # no news, no write
    _land(source, "b.json", [("N1", 1, "A", "L", "T", 2020, 1.5), ("N1", 1, "A", "L", "T", 2021, 9.0)])
    land_observations(spark, source, log).awaitTermination(120)
    assert refresh_table(spark, log, table) == 1
    assert _parts(table, "N2") == files_of_n2
    got = rows(files.read_observations(spark, table), "kpi", "area_id", "year", "value")
    assert got == [("N1", 1, 2020, 1.5), ("N1", 1, 2021, 9.0), ("N1", 2, 2020, 5.0), ("N2", 1, 2020, 7.0)]
    assert read_log(spark, log).count() == 5  # the log keeps all versions


def test_newest_of_files_without_a_stream(spark, tmp_dir):
    source = os.path.join(tmp_dir, "raw")
    _land(source, "a.json", [("N1", 1, "A", "L", "T", 2020, 1.0), ("N1", 1, "A", "L", "T", 2020, 3.0)])
    _land(source, "b.json", [("N1", 1, "A", "L", "T", 2020, 2.0), ("N1", 1, "A", "L", None, 2020, None)])
    with open(os.path.join(source, "c.json"), "w") as f:
        f.write("{broken\n{broken\n")
    obs = files.newest(files.read_observations(spark, source, "json", landed=True))
    good, bad = files.split_rejected(obs)
    assert {tuple(r) for r in good.select("sex", "value").collect()} == {("T", 2.0), (None, None)} and good.count() == 2
    assert bad.count() == 1
    together = spark.createDataFrame([("N", 1, "A", "L", "T", 2020, v) for v in (2.0, None, 1.0)], OBS).withColumn(files.LANDED, F.lit(0).cast("timestamp"))
    assert [r.value for r in files.newest(together).collect()] == [2.0]  # same landing: the last in order
    assert files.newest(together.limit(0)).count() == 0


def test_rejects_of_a_csv(spark, tmp_dir):
    path = os.path.join(tmp_dir, "cat.csv")
    header = ";".join(f.name for f in schemas.INDICATOR_FILE)
    lines = ["N1;Name;A;T;D;0;0;101;2026-03-25T00:00:00Z", "N2;Name;A;T;D;1o1;x;102;NA", 'N3;"open;A;T;D;0;0;1;NA', "N4;Name;A;T;D;0;0;1;NA;more", "N5;short",
             "N6;NA;A;T;D;NA;1;7;NA"]
    with open(path, "w") as f:
        f.write("\n".join([header, *lines]) + "\n")
    found = files.csv_rejects(spark, path, schemas.INDICATOR_FILE)
    assert {(r.line, r.column, r.reason) for r in found.collect()} == {
        (lines[1], "Omvand_skala", "not int"), (lines[1], "Log", "not int"),
        (lines[2], None, files.OTHER_FIELDS), (lines[3], None, files.OTHER_FIELDS), (lines[4], None, files.OTHER_FIELDS),
    }
    assert all(r.file.endswith("cat.csv") for r in found.collect())
    cat = files.read_catalog(spark, path)
    assert rows(cat, "kpi", "sort_order") == [("N1", 101), ("N2", 102), ("N6", 7)]
    assert cat.select("kpi").count() == 3  # whichever columns are read


def test_yearly_run_lists_what_it_does_not_take(spark, tmp_dir, caplog):
    header = ";".join(f.name for f in schemas.INDICATOR_FILE)
    cat = os.path.join(tmp_dir, "cat.csv")
    with open(cat, "w") as f:
        f.write(f"{header}\nN1;Name;A;T;D;0;1;101;NA\nN2;Name;A;T;D;0;0;1o1;NA\n")
    source = os.path.join(tmp_dir, "obs")
    _land(source, "a.json", [("N1", 101, "Kommun", "K", "T", 2020, 4.0), ("N1", 101, "Kommun", "K", "T", 2021, 0.0)])
    _land(source, "b.json", [("N1", 101, "Kommun", "K", "T", 2020, 5.0)])
    with open(os.path.join(source, "c.json"), "w") as f:
        f.write("{broken\n")
    out = os.path.join(tmp_dir, "base")
    with caplog.at_level("INFO", logger="tessera.plans.annual"):
        base = annual.build_base_table(spark, source, cat, out, observations_format="json")
    assert base.count() == 2  # one version of 2020
    rejected = {(r.line, r.column, r.reason) for r in spark.read.parquet(out + "_rejected").collect()}
    assert rejected == {("N2;Name;A;T;D;0;0;1o1;NA", "Sortering", "not int"), ("{broken", None, files.NOT_A_RECORD)}
    said = " ".join(r.getMessage() for r in caplog.records)
    assert "2 records that were not taken over" in said and "'log_losses': 1" in said and "'rows': 2" in said


def test_metrics_come_from_the_write(spark, tmp_dir):
    df = spark.createDataFrame([("N1", "T", 1, None), ("N1", None, 1, 2.0), ("N2", "T", 0, None)], "kpi string, sex string, logged int, value double")
    seen = files.write_table(df, os.path.join(tmp_dir, "m"), metrics=checks.base_metrics())
    assert seen == {"rows": 3, "rows_without_sex": 1, "log_losses": 1}
    assert files.write_table(df.limit(0), os.path.join(tmp_dir, "e"), metrics=checks.base_metrics())["rows"] == 0
    got = {r.metric: r.n for r in Q.REGISTRY["q_observed"](spark, SF).collect()}
    assert got["rows"] == Q.ctx.base(spark, SF).count() and got["zero_scores"] > 0 and got["log_losses"] > 0
