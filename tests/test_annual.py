"""The three yearly steps over files, end to end, on hand-made inputs."""

import glob
import os

from tessera.plans import annual

CATALOG = """Indikator_ID;Indikator_namn;Aspekt;Tema;Del;Omvand_skala;Log;Sortering;Tillagd_datum
N1;Valdeltagande;Delaktighet;T1 - Demokrati;Livskvalitet;0;0;101;2026-03-25T00:00:00Z
N2;Brott;Trygghet;T2 - Trygghet;Livskvalitet;1;0;102;2026-03-25T00:00:00Z
N3;Utsläpp;Klimat;Miljö - Miljö;Hållbarhet;1;1;202;2026-03-25T00:00:00Z
"""
MUNICIPALITIES = """Lan_kod_S;Lan_Namn;Kommun_kod;Kommun_kod_S;Kommun_namn
01;Län A;101;0101;Kommun Ett
01;Län A;102;0102;Kommun Två
02;Län B;201;0201;Kommun Tre
"""
REGIONS = """Lan_kod;Lan_kod_S;Lan_bokstav;Lan_Namn;SCB_lan_namn;Data_lan_namn
1;01;A;Län A;01 Län A;Region A
2;02;B;Län B;02 Län B;Region B
"""
AREAS = [(101, "Kommun Ett", "K"), (102, "Kommun Två", "K"), (201, "Kommun Tre", "K"),
         (1, "Region A", "L"), (2, "Region B", "L"), (0, "Riket", "L")]


def _write(d, name, text):
    p = os.path.join(d, name)
    with open(p, "w", encoding="utf-8") as f:
        f.write(text)
    return p


def _inputs(spark, tmp_dir):
    rows = []
    for k, kpi in enumerate(("N1", "N2", "N3")):
        for i, (aid, name, typ) in enumerate(AREAS):
            for s, sex in enumerate(("T", "K", "M")):
                for year in (2019, 2020):
                    value = 10.0 + 3 * i + s + k + (year - 2019)
                    if kpi == "N2" and aid == 102 and year == 2020:
                        value = None  # filled from the county mean
                    rows.append((kpi, aid, name, typ, sex, year, value))
    obs = spark.createDataFrame(rows, "kpi string, area_id int, area_name string, area_type string, sex string, year int, value double")
    obs_path = os.path.join(tmp_dir, "landed")
    obs.write.partitionBy("kpi").parquet(obs_path)
    texts = spark.createDataFrame(
        [("N1", "Valdeltagande, andel", "Andel som röstat.\nKälla: Valmyndigheten."),
         ("N2", "Anmälda brott", "Per 1000 invånare. Källa: BRÅ"),
         ("N3", "Utsläpp per invånare", "Ton. Källa: SCB och Skolverket.")],
        "kpi string, title string, description string",
    )
    texts_path = os.path.join(tmp_dir, "texts")
    texts.write.parquet(texts_path)
    cat = _write(tmp_dir, "cat.csv", CATALOG)
    kom, reg = _write(tmp_dir, "kom.csv", MUNICIPALITIES), _write(tmp_dir, "reg.csv", REGIONS)
    return obs_path, texts_path, cat, kom, reg


def test_yearly_run(spark, tmp_dir):
    obs_path, texts_path, cat, kom, reg = _inputs(spark, tmp_dir)
    base_path, out_dir = os.path.join(tmp_dir, "base"), os.path.join(tmp_dir, "out")

    base = annual.build_base_table(spark, obs_path, cat, base_path, run_date="2026-01-01")
    # county mean of Kommun Ett (12) and the region's own row (21), as the reference does
    assert base.where("kpi = 'N2' and area_id = 102 and year = 2020 and sex = 'T'").first().value == 16.5
    assert base.where("kpi = 'N3'").first().fetched == "2026-01-01"

    tables = annual.publish_index(spark, base_path, kom, reg, out_dir, 2025)
    assert sorted(tables) == ["1.totalindex_kommun2025", "2.temaindex_kommun2025", "3.totalindex_region2025",
                              "4.temaindex_region2025"]
    region_total = [tuple(r) for r in tables["3.totalindex_region2025"].collect()]
    assert len(region_total) == 3 * 2 * 3  # two regions + nation, two parts, three sexes
    assert {r[0] for r in region_total} == {"00 Riket", "01 Län A", "02 Län B"}
    for check, n in (("orientation", 0), ("unmatched_municipality", 0), ("unmatched_region", 0), ("missing_split", 0)):
        assert spark.read.parquet(os.path.join(out_dir, "checks", check)).count() == n
    assert spark.read.parquet(os.path.join(out_dir, "checks", "profile")).count() > 0
    assert spark.read.parquet(base_path + "_empty").count() == 0
    csv = glob.glob(os.path.join(out_dir, "3.totalindex_region2025", "part-*.csv"))
    text = open(csv[0], encoding="utf-8").read()
    assert text.startswith("Region;Del;Kon;Varde_stand\n") and "00 Riket;Hållbarhet;Kvinnor;" in text
    theme = [tuple(r) for r in tables["2.temaindex_kommun2025"].collect()]
    assert {r[3] for r in theme} == {"T1", "T2", "Miljö"}

    desc = annual.publish_descriptions(spark, base_path, texts_path, cat, out_dir, "Hållbarhet")
    got = {r.Tema: r for r in desc.collect()}
    assert sorted(got) == sorted(["T1 - Demokrati", "T2 - Trygghet", "Miljö - Miljö", "Livskvalitet", "Hållbarhet"])
    assert [r.sorting for r in desc.collect()] == [100, 101, 102, 200, 202]
    assert got["Hållbarhet"].Information_regionindex_totalt.startswith("Regionindex Hållbarhet är en sammanvägning")
    assert got["Hållbarhet"].Information_regionindex_totalt.endswith("Källa: Skolverket och SCB.")
    assert got["T1 - Demokrati"].Information_kommunindex_män.startswith(
        "Mäns Kommunindex för tema T1 - Demokrati baseras på indikatorerna Valdeltagande, andel Nyckeltalen")
    assert got["Livskvalitet"].Information_kommunindex_totalt.endswith("Källa: BRÅ, Valmyndigheten.")


def test_command_line(spark, tmp_dir):
    from tessera.__main__ import main

    obs_path, texts_path, cat, kom, reg = _inputs(spark, tmp_dir)
    base, out = os.path.join(tmp_dir, "cli_base"), os.path.join(tmp_dir, "cli_out")
    assert main(["base", "--observations", obs_path, "--catalog", cat, "--out", base, "--run-date", "2026-01-01"]) == 0
    assert main(["index", "--base", base, "--municipality-codes", kom, "--region-codes", reg, "--out", out,
                 "--stamp-year", "2025", "--weighting", "node", "--validate", "--year-scope", "area_type",
                 "--file-prefix", "x_"]) == 0
    assert main(["describe", "--base", base, "--texts", texts_path, "--catalog", cat, "--out", out,
                 "--sustainability-part", "Hållbarhet", "--marker", "Källa"]) == 0
    for name in ("1.x_totalindex_kommun2025", "4.x_temaindex_region2025", "tema_desc"):
        assert glob.glob(os.path.join(out, name, "part-*.csv")), name


def test_rejected_records_and_empty_indicators_are_kept(spark, tmp_dir):
    import json

    _, _, cat, _, _ = _inputs(spark, tmp_dir)
    src = os.path.join(tmp_dir, "json")
    os.makedirs(src)
    rec = {"kpi": "N1", "area_id": 101, "area_name": "Kommun Ett", "area_type": "K", "sex": "T", "year": 2020, "value": 1.0}
    _write(src, "a.json", json.dumps(rec) + "\n{not json\n")
    base = os.path.join(tmp_dir, "base_json")
    assert annual.build_base_table(spark, src, cat, base, observations_format="json").count() == 1
    assert [r.line for r in spark.read.parquet(base + "_rejected").collect()] == ["{not json"]
    assert sorted(r[0] for r in spark.read.parquet(base + "_empty").collect()) == ["N2", "N3"]
