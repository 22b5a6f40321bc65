"""Every registered query against its DuckDB oracle (the driver's gate),
plus the invariants of SURVEY §5 on the fixture."""

import math

import duckdb
import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tessera.plans import queries as Q
from tessera.plans.oracle import oracle_sql
from tests.conftest import SF

TABLES = "region nation customer supplier part orders lineitem documents".split()
SQL = oracle_sql()
SPARK_TO_DUCK = {"IntegerType()": "INTEGER", "LongType()": "BIGINT", "DoubleType()": "DOUBLE",
                 "StringType()": "VARCHAR", "BooleanType()": "BOOLEAN", "DateType()": "DATE"}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _norm(v):
    if v is None:
        return (0, "")
    if isinstance(v, float):
        return (1, "nan") if math.isnan(v) else (2, v)
    return (3, str(v))


@pytest.mark.parametrize("name", sorted(Q.REGISTRY))
def test_query_matches_oracle(spark, con, name):
    df = Q.REGISTRY[name](spark, SF)
    assert name in SQL, "every registered query has an oracle"
    cur = con.execute(SQL[name])
    ocols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(ocols)
    idx = [ocols.index(c) for c in df.columns]
    orows = sorted(tuple(_norm(r[i]) for i in idx) for r in cur.fetchall())
    srows = sorted(tuple(_norm(v) for v in r) for r in df.collect())
    assert srows == orows
    types = {f.name: SPARK_TO_DUCK.get(str(f.dataType), str(f.dataType)) for f in df.schema.fields}
    assert types == {r[0]: r[1] for r in con.execute(f"DESCRIBE {SQL[name]}").fetchall()}


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["Region", "Del", "Kon", "Varde_stand"]
    assert df.count() > 0


def test_invariants(spark):
    base = Q.ctx.marked_base(spark, SF)
    sep = Q.standardize.standardize(base, "separate")
    pooled = Q.standardize.standardize(base, "pooled")
    for df in (sep, pooled):  # bounded in the latest year
        lo, hi = df.agg(F.min("standard_value"), F.max("standard_value")).first()
        assert lo >= -1e-9 and hi <= 100 + 1e-9
    total = Q.scored(spark, SF).where("sex = 'T'")
    # total sex reaches both ends per reference group unless degenerate
    ends = total.where("area_type != 'R'").groupBy("kpi", "area_type").agg(
        F.min("standard_value").alias("lo"), F.max("standard_value").alias("hi"), F.count("*").alias("n"))
    assert ends.where("n > 1 and not (lo = 0 and hi in (0, 100))").count() == 0
    # the nation is alone in its group: 0 under total
    assert Q.scored(spark, SF).where("area_type = 'R' and standard_value != 0").count() == 0


def test_weighting_and_golden_delivery(spark):
    row = {tuple(r[:5]): r.mean_part for r in Q.levels(spark, SF, "row").part.collect()}
    node = {tuple(r[:5]): r.mean_part for r in Q.levels(spark, SF, "node").part.collect()}
    assert sum(1 for k in row if row[k] is not None and abs(row[k] - (node[k] or 0)) > 1e-9) > 0
    # row weighting equals the plain mean over indicators when no score is null
    plain = {tuple(r[:5]): r.m for r in Q.scored(spark, SF).groupBy("area_id", "area_name", "area_type", "sex", "part")
             .agg(F.avg("standard_value").alias("m")).collect()}
    holes = {tuple(r) for r in Q.scored(spark, SF).where("standard_value is null")
             .select("area_id", "area_name", "area_type", "sex", "part").distinct().collect()}
    assert len(holes) < len(row) and all(abs(row[k] - plain[k]) < 1e-9 for k in row if k not in holes)
    d = Q.REGISTRY["q_total_region"](spark, SF)
    got = [tuple(r) for r in d.collect()]
    assert d.columns == ["Region", "Del", "Kon", "Varde_stand"]
    assert len(got) == len({g[:3] for g in got})
    regions = spark.read.parquet(f"{SF}/supplier.parquet").select("s_nationkey").distinct().count()
    assert len({g[0] for g in got}) == regions + 1 and {g[2] for g in got} == {"Kvinnor", "Män", "Totalt", None}
    # the nation is the plain mean of the regions in every (part, sex) cell
    for part in ("D1", "D2"):
        for kon in ("Kvinnor", "Män", "Totalt"):
            regs = [g[3] for g in got if g[1] == part and g[2] == kon and g[0] != "00 Riket"]
            nat = [g[3] for g in got if g[1] == part and g[2] == kon and g[0] == "00 Riket"][0]
            assert nat == pytest.approx(sum(regs) / len(regs), abs=1e-5)


