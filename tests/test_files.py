import glob
import json
import os

import pytest

from tessera.sources import files
from tessera.streaming.landing import land_observations
from tests.conftest import rows

CATALOG_CSV = """Indikator_ID;Indikator_namn;Aspekt;Tema;Del;Omvand_skala;Log;Sortering;Tillagd_datum
N01;"Andel ""nöjda"" svar, (%)";Aspekt ett;T9 - Påhittat tema;Del ett;0;0;102;2026-03-25T00:00:00Z
N02;Antal per tusen;Aspekt två;Annat - Annat;Del två;1;1;203;2026-03-25T00:00:00Z
NA;Utan id;X;Y;Z;0;0;1;NA
"""
REGION_CSV = """Lan_kod;Lan_kod_S;Lan_bokstav;Lan_Namn;SCB_lan_namn;Data_lan_namn
1;01;QA;Påhittade län;01 Påhittade län;Region Påhittad
3;03;Q;Andra län;03 Andra län;Region Andra
"""
VALUES_CSV = """kpi;value;note
N01;12,5;a
N02;NA;b
N03;1,0e3;c
N04;x;d
"""


def _write(tmp_dir, name, text):
    p = os.path.join(tmp_dir, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def test_read_catalog_quotes_and_na(spark, tmp_dir):
    # unit frame 1: quoted names with doubled quotes, NA cells, rows without id dropped
    cat = files.read_catalog(spark, _write(tmp_dir, "cat.csv", CATALOG_CSV))
    got = rows(cat, "kpi", "kpi_text", "inverted", "logged", "sort_order")
    assert got == [("N01", 'Andel "nöjda" svar, (%)', 0, 0, 102), ("N02", "Antal per tusen", 1, 1, 203)]
    assert cat.where("kpi = 'N01'").first().added is not None


def test_codes_stay_text(spark, tmp_dir):
    # G1: "01" must stay "01"
    codes = files.read_region_codes(spark, _write(tmp_dir, "reg.csv", REGION_CSV))
    assert rows(codes, "Lan_kod", "Lan_kod_S") == [("1", "01"), ("3", "03")]


def test_headers_are_read_by_name(spark, tmp_dir):
    swapped = "Lan_kod_S;Lan_kod;More;Lan_bokstav;Lan_Namn;SCB_lan_namn;Own_name\n01;1;x;QA;L;01 L;Region L\n"
    codes = files.read_region_codes(spark, _write(tmp_dir, "swapped.csv", swapped), "Own_name")
    assert rows(codes, "Lan_kod", "Lan_kod_S", "Data_lan_namn") == [("1", "01", "Region L")]
    with pytest.raises(ValueError, match="Data_lan_namn"):
        files.read_region_codes(spark, _write(tmp_dir, "missing.csv", swapped))
    both = os.path.join(tmp_dir, "both")
    os.makedirs(both)
    _write(both, "a.csv", REGION_CSV)
    _write(both, "b.csv", REGION_CSV.replace("Lan_kod;Lan_kod_S", "Lan_kod_S;Lan_kod"))
    with pytest.raises(Exception, match="(?i)header"):
        files.read_region_codes(spark, both).collect()


def test_decimal_comma_and_roundtrip(spark, tmp_dir):
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("kpi", T.StringType()), T.StructField("value", T.DoubleType()),
                           T.StructField("note", T.StringType())])
    df = files.read_semicolon_csv(spark, _write(tmp_dir, "v.csv", VALUES_CSV), schema, decimal_comma=["value"])
    assert rows(df, "kpi", "value") == [("N01", 12.5), ("N02", None), ("N03", 1000.0), ("N04", None)]
    out = os.path.join(tmp_dir, "out")
    files.write_semicolon_csv(df, out, single_file=True)
    parts = glob.glob(os.path.join(out, "part-*.csv"))
    assert len(parts) == 1
    text = open(parts[0], encoding="utf-8").read()
    assert "N01;12,5;a" in text and "N02;NA;b" in text
    back = files.read_semicolon_csv(spark, out, schema, decimal_comma=["value"])
    assert rows(back) == rows(df)


def test_landed_observations_and_handoff(spark, tmp_dir):
    src = os.path.join(tmp_dir, "landed")
    os.makedirs(src)
    recs = [
        {"kpi": "N01", "area_id": 1, "area_name": "Region A", "area_type": "L", "sex": "T", "year": 2020, "value": 1.5},
        {"kpi": "N01", "area_id": 0, "area_name": "Riket", "area_type": "L", "sex": "T", "year": 2020, "value": None},
        {"kpi": "N01", "area_id": 9, "area_name": "Other", "area_type": "X", "sex": "T", "year": 2020, "value": 2.0},
    ]
    with open(os.path.join(src, "n01.json"), "w") as f:
        f.write("\n".join(json.dumps(r) for r in recs) + "\n{broken\n")
    obs = files.read_observations(spark, src, fmt="json")
    good = obs.where("_corrupt_record is null")
    assert rows(good, "area_id", "value") == [(0, None), (1, 1.5)]  # type X filtered out
    bad = obs.where("_corrupt_record is not null").select("kpi", "_corrupt_record").collect()
    assert [r._corrupt_record for r in bad] == ["{broken"]  # S4: bad record kept aside
    out = os.path.join(tmp_dir, "base")
    files.write_table(good.drop("_corrupt_record"), out)
    assert os.path.isdir(os.path.join(out, "kpi=N01"))
    assert files.read_table(spark, out).count() == 2


def test_streaming_landing_of_two_applications(spark, tmp_dir):
    src, sink = os.path.join(tmp_dir, "stream_in"), os.path.join(tmp_dir, "stream_out")
    os.makedirs(src)
    rec = {"kpi": "N01", "area_id": 1, "area_name": "Region A", "area_type": "L", "sex": "T", "year": 2020, "value": 3.0}
    with open(os.path.join(src, "a.json"), "w") as f:
        f.write(json.dumps(rec) + "\n{broken\n")
    land_observations(spark, src, sink).awaitTermination(120)
    with open(os.path.join(src, "b.json"), "w") as f:
        f.write(json.dumps(rec | {"kpi": "N02", "sex": "K", "year": 2021, "value": 4.0}) + "\n")
    # another session with another shared folder goes on where the first stopped
    other = spark.newSession()
    old = spark.sparkContext.getCheckpointDir()
    spark.sparkContext.setCheckpointDir(os.path.join(tmp_dir, "other"))
    try:
        land_observations(other, src, sink).awaitTermination(120)
    finally:
        spark.sparkContext.setCheckpointDir(old)
    good, bad = files.split_rejected(spark.read.parquet(sink))
    assert rows(good, "kpi", "value") == [("N01", 3.0), ("N02", 4.0)]
    assert [r[0] for r in bad.collect()] == ["{broken"]


def test_gzip_csv_exchange(spark, tmp_dir):
    # The base table exchanged as compressed ;-CSV with decimal commas
    from pyspark.sql import types as T

    schema = T.StructType([T.StructField("kpi", T.StringType()), T.StructField("value", T.DoubleType())])
    df = spark.createDataFrame([("N1", 1.25), ("N2", None), ("N3", -3.5)], schema)
    out = os.path.join(tmp_dir, "base_csv")
    files.write_semicolon_csv(df, out, compression="gzip")
    assert glob.glob(os.path.join(out, "*.csv.gz"))
    back = files.read_semicolon_csv(spark, out, schema, decimal_comma=["value"])
    assert rows(back) == rows(df)


def test_municipalities_are_published_in_sorted_parts(spark, tmp_dir, monkeypatch):
    from tessera.plans import queries

    out = os.path.join(tmp_dir, "delivery")
    monkeypatch.setattr(queries, "_file", lambda spark, name: out)
    before = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = queries.q_file_delivery(spark, "/root/testdata/sf0.001").count()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", before)
    parts = [open(p, encoding="utf-8").read().splitlines() for p in sorted(glob.glob(os.path.join(out, "part-*.csv")))]
    assert len(parts) > 1 and len({p[0] for p in parts}) == 1  # the header in each
    assert sum(len(p) - 1 for p in parts) == rows > 0
