import pytest

from tessera.operators import hierarchy as H
from tests.conftest import rows

SCORED = ("area_id int, area_name string, area_type string, sex string, part string, theme string, aspect string, "
          "standard_value double")


def _scored(spark):
    # unit frame 7: one theme with aspects of 1 and 3 indicators; an aspect of only nulls
    d = [
        (1, "a", "L", "T", "P", "T1", "A1", 90.0),
        (1, "a", "L", "T", "P", "T1", "A2", 30.0),
        (1, "a", "L", "T", "P", "T1", "A2", 30.0),
        (1, "a", "L", "T", "P", "T1", "A2", 30.0),
        (1, "a", "L", "T", "P", "T2", "A3", None),
        (1, "a", "L", "T", "P", "T3", "A4", 10.0),
        (2, "b", "L", "T", "P", "T1", "A1", 50.0),
        (2, "b", "L", "T", "P", "T3", "A4", 70.0),
        (0, "Riket", "R", "T", "P", "T1", "A1", 0.0),
        (101, "k", "K", "T", "P", "T1", "A1", 20.0),
    ]
    return spark.createDataFrame(d, SCORED)


def test_row_vs_node_weighting(spark):
    row = {(r.area_id, r.theme): r.mean_theme for r in H.roll_up(_scored(spark), "row").theme.collect()}
    node = {(r.area_id, r.theme): r.mean_theme for r in H.roll_up(_scored(spark), "node").theme.collect()}
    assert row[(1, "T1")] == pytest.approx((90 + 30 * 3) / 4)  # G10: weighted by rows
    assert node[(1, "T1")] == pytest.approx((90 + 30) / 2)  # documented: equal weight
    assert row[(1, "T2")] is None  # aspect of only nulls
    part_row = {r.area_id: r.mean_part for r in H.roll_up(_scored(spark), "row").part.collect()}
    # theme T2 (null) is skipped; T1 has 4 rows, T3 one: row weighting = plain mean over non-null scores
    assert part_row[1] == pytest.approx((90 + 30 * 3 + 10) / 5)


def test_national_and_final(spark):
    lv = H.roll_up(_scored(spark))
    nat = H.national_means(lv)
    p = {r.sex: (r.nat_region_part, r.nat_municipal_part) for r in nat.get("part").collect()}
    region_means = [r.mean_part for r in lv.part.collect() if r.area_type == "L"]
    assert p["T"][0] == pytest.approx(sum(region_means) / len(region_means))  # nation = mean of regions
    assert p["T"][1] == pytest.approx(20.0)
    fl = {(r.area_id): (r.mean_region_part_final, r.mean_municipal_part_final) for r in H.final_level(lv, nat, "part").collect()}
    assert fl[0] == (pytest.approx(p["T"][0]), pytest.approx(20.0))  # the nation takes the national means
    assert fl[1][0] == fl[1][1]  # other areas keep their own mean in both


def test_handed_over_tables_give_the_same_finals(spark):
    # NULL keys, repeated rows, an area whose name looks like another's key, and no rows at all
    odd = [(3, None, "L", None, None, None, None, 5.0), (3, None, "L", None, "null", "", None, 6.0), (3, None, "L", None, "null", None, "", 7.0),
           (3, None, "L", None, "null", None, "", 7.0), (4, '1","sex":"T', "K", "T", "P", "T1", "A1", 8.0)]
    whole = _scored(spark).unionByName(spark.createDataFrame(odd, SCORED))
    for s in (whole, whole.where("false")):
        lv = H.roll_up(s)
        nat = H.national_means(lv)
        cells, finals = H.hand_over(s, "scored", 3), H.hand_over(H.final_grain(lv, nat), "finals", 3)
        got, want = H.join_finals(cells, finals), H.finalize(s, lv, nat)
        assert sorted(got.columns) == sorted(want.columns)
        assert sorted(map(repr, (tuple(r) for r in got.select(want.columns).collect()))) == sorted(map(repr, (tuple(r) for r in want.collect())))
    assert H.buckets_for(0) == 4 and H.buckets_for(10**7) == 10 and H.buckets_for(10**13) == H.MAX_BUCKETS


def test_deliver_labels_and_theme_cut(spark):
    d = [(1, "a", "L", "T", "P", "T10 - Long name", "A1", 50.0), (7, "b", "L", "K", "P", "T2 - Other", "A1", 40.0),
         (0, "Riket", "R", "M", "P", "T2 - Other", "A1", 0.0)]
    lv = H.roll_up(spark.createDataFrame(d, SCORED))
    codes = spark.createDataFrame([("1", "01", "Län ett")], "Lan_kod string, Lan_kod_S string, Lan_Namn string")
    out = H.deliver(lv, H.national_means(lv), codes, "theme", "region")
    assert out.columns == ["Region", "Del", "Kon", "Tema", "Varde_stand"]
    got = [tuple(r) for r in out.collect()]
    # Only the nation is labelled as the nation; id 7 has no code and keeps its name
    assert got[0][:4] == ("00 Riket", "P", "Män", "T2")
    assert ("b", "P", "Kvinnor", "T2", 40.0) in got
    assert ("01 Län ett", "P", "Totalt", "T10", 50.0) in got
    assert {g[2] for g in got} == {"Kvinnor", "Män", "Totalt"}
    with pytest.raises(ValueError):
        H.deliver(lv, H.national_means(lv), codes, "aspect", "region")


def test_finalize_rows(spark):
    s = _scored(spark)
    lv = H.roll_up(s)
    out = {(r.area_id, r.aspect): r for r in H.finalize(s, lv, H.national_means(lv)).collect()}
    assert out[(0, "A1")].mean_region_aspect_final == pytest.approx((90 + 50) / 2)  # nation: mean of regions
    assert out[(0, "A1")].mean_municipal_aspect_final == pytest.approx(20.0)
    assert out[(1, "A2")].mean_region_theme_final == pytest.approx((90 + 30 * 3) / 4)


def test_null_keys_form_groups_and_match(spark):
    # An indicator missing from the catalog has NULL part/theme/aspect;
    # it forms its own group and its rows still get that group's means
    d = [
        (1, "a", "L", "T", None, None, None, 40.0),
        (1, "a", "L", "T", None, None, None, 60.0),
        (1, "a", "L", "T", "P", "T1", "A1", 10.0),
        (2, "b", "L", "T", None, None, None, 20.0),
    ]
    s = spark.createDataFrame(d, SCORED)
    lv = H.roll_up(s)
    nat = H.national_means(lv)
    out = [r for r in H.finalize(s, lv, nat).collect() if r.part is None]
    assert len(out) == 3
    assert {r.area_id: r.mean_region_part_final for r in out} == {1: 50.0, 2: 20.0}
    nat_null = [r for r in nat.get("part").collect() if r.part is None][0]
    assert nat_null.nat_region_part == pytest.approx(35.0)
