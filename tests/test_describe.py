from pyspark.sql import functions as F

from tessera.operators import describe as D
from tests.conftest import rows


def test_extract_source_cases(spark):
    # unit frame 9: marker with colon, without, doubled, at the end, followed by a newline, absent, null
    texts = [
        ("colon", "Nyckeltal. Källa: SCB.\nMer text"),
        ("nocolon", "Nyckeltal. Källa - Skolverket."),
        ("double", "Källa: Källa: Statistiken"),
        ("end", "Något Källa:"),
        ("newline", "Källa\nSCB"),
        ("absent", "Ingen uppgift"),
        ("null", None),
        ("alias", "Källa: SCB och Skolverket."),
        ("escaped", "Källa: SCB\\nRegion"),
    ]
    df = spark.createDataFrame(texts, "id string, description string")
    out = dict(rows(D.attribution(df), "id", "source"))
    assert out["colon"] == "SCB"
    assert out["nocolon"] == "- Skolverket"  # the separator is part of the look-behind match
    assert out["double"] == "Statistiken"
    assert out["end"] == ""  # the marker with nothing after it: empty, not NULL
    assert out["newline"] == "SCB"
    assert out["absent"] is None and out["null"] is None
    assert out["alias"] == "Skolverket och SCB"
    assert out["escaped"] == "SCB Region"


def test_collapse_null_guard_and_order(spark):
    # unit frame 10: a group with a NULL member, repeated members
    df = spark.createDataFrame(
        [("g1", "b"), ("g1", "a"), ("g1", "b"), ("g2", "x"), ("g2", None)], "g string, t string"
    )
    out = dict(rows(D.collapse_by_group(df, ["g"], "t", "txt")))
    assert out == {"g1": "a, b", "g2": None}


def test_widen_fixed_columns(spark):
    df = spark.createDataFrame([("t", "L", "T", "x"), ("t", "K", "M", "y")], "theme string, area_type string, sex string, v string")
    w = D.widen(df, "theme", "v", "text_")
    assert w.columns == ["theme"] + [f"text_{a}_{s}" for a in ("K", "L") for s in ("T", "K", "M")]
    r = w.first()
    assert r.text_L_T == "x" and r.text_K_M == "y" and r.text_K_T is None


def test_describe_removes_na_and_adds_period(spark):
    cols = {f"text_{a}_{s}": None for a in ("K", "L") for s in ("T", "K", "M")}
    cols.update({f"source_{a}_{s}": None for a in ("K", "L") for s in ("T", "K", "M")})
    cols["text_L_T"] = "Titel A, Titel B"
    cols["source_L_T"] = "SCB"
    data = [dict(Tema="T1 - Tema", **cols), dict(Tema="Hållbarhet", **cols)]
    schema = "Tema string, " + ", ".join(f"{c} string" for c in cols)
    df = spark.createDataFrame([tuple(d[c] for c in ["Tema", *cols]) for d in data], schema)
    out = {r.Tema: r for r in D.describe(df, ["Livskvalitet", "Hållbarhet"], "Hållbarhet").collect()}
    t = out["T1 - Tema"]
    assert t.Information_regionindex_totalt.startswith("Regionindex för tema T1 - Tema baseras på indikatorerna Titel A")
    assert t.Information_regionindex_totalt.endswith("Källa: SCB.")
    # NULL title and source print as NA and are cut out with their spaces
    assert "NA" not in t.Information_kommunindex_kvinnor.replace("NATION", "")
    # " NA " goes with both spaces, gluing the neighbours, as in the reference
    assert t.Information_kommunindex_kvinnor.startswith("Kvinnors Kommunindex för tema T1 - Tema baseras på indikatorernaNyckeltalen")
    assert t.Information_kommunindex_kvinnor.endswith("Källa:.")
    h = out["Hållbarhet"]
    assert h.Information_regionindex_män.startswith("Mäns Regionindex Hållbarhet är en sammanvägning")
    assert "mäter hållbarhet" in h.Information_regionindex_män


def test_coalesce_levels_first_non_null(spark):
    themes = spark.createDataFrame([("A", "t1", None), ("B", "t2", "s2")], "Tema string, text_L_T string, source_L_T string")
    parts = spark.createDataFrame([("A", "p1"), ("P", "p2")], "Tema string, source_L_T string")
    out = {r.Tema: (r.text_L_T, r.source_L_T, r.sorting) for r in D.coalesce_levels(themes, parts, {"P": 100}).collect()}
    assert out == {"A": ("t1", "p1", None), "B": ("t2", "s2", None), "P": (None, "p2", "100")}
    full = D.full_outer_levels(themes, parts)
    assert sorted(full.columns) == sorted(["Tema", "text_L_T", "source_L_T_x", "source_L_T_y"])
    assert full.count() == 3
    assert full.where(F.col("Tema") == "A").first().source_L_T_y == "p1"


def _texts(spark):
    keys = [(k, theme, part, t, s) for k, theme, part in (("I1", "A", "P"), ("I2", "A", "P"), ("I3", "B", "P"), ("I4", "C", "A"), ("I5", None, None))
            for t in ("K", "L") for s in ("T", None)]
    texts = [(f"I{1 + i % 3}", f"title {i % 11}", f"source {i % 4}") for i in range(40)] + [("I3", "x", None), ("I1", "title 0", "source 0"), ("I9", "y", "z")]
    return (spark.createDataFrame(keys, "kpi string, theme string, part string, area_type string, sex string"),
            spark.createDataFrame(texts, "kpi string, title string, source string"), keys, texts)


def _plain_members(keys, texts):
    out = {}
    for kpi, theme, part, t, s in keys:
        own = [x for x in texts if x[0] == kpi] or [(kpi, None, None)]
        for level, tema, kind, at in (("theme", theme, "text", 1), ("theme", theme, "source", 2), ("part", part, "source", 2)):
            if tema is not None:
                out.setdefault((level, tema, kind, t, s), set()).update(x[at] for x in own)
    return out


def test_members_of_all_levels_in_one_reduction(spark):
    keys, texts, k, t = _texts(spark)
    want = _plain_members(k, t)
    got = {}
    for r in D.level_members(keys, texts).collect():
        members = got.setdefault(tuple(r)[:5], set())
        assert r.member not in members
        members.add(r.member)
    assert got == want
    joined = {tuple(r)[:5]: r.text for r in D.joined_members(D.level_members(keys, texts), size=3).collect()}
    assert joined == {g: None if None in m else ", ".join(sorted(m)) for g, m in want.items()}
    assert D.level_members(keys, texts.limit(0)).where("member is not null").count() == 0
    assert D.joined_members(D.level_members(keys.limit(0), texts)).count() == 0


def test_segments_hold_a_bounded_number_in_order(spark):
    n = 5000
    found = spark.range(n).repartition(9).select(
        F.lit("theme").alias("level"), F.lit("A").alias("Tema"), F.lit("text").alias("kind"), F.lit("K").alias("area_type"),
        F.lit(None).cast("string").alias("sex"), F.lpad(F.col("id").cast("string"), 6, "0").alias("member"))
    got = D.segments(found, 64).orderBy("segment").collect()
    assert [r.segment for r in got] == list(range(-(-n // 64))) and [r.n for r in got[:-1]] == [64] * (len(got) - 1)
    assert ", ".join(r.text for r in got) == ", ".join(f"{i:06d}" for i in range(n))


def test_merged_levels_equal_the_stacked_ones(spark):
    keys, texts, *_ = _texts(spark)
    long = D.level_texts(keys, texts)
    both = D.coalesce_levels(D.theme_wide(long), D.part_wide(long), {"P": 100})
    merged = D.merged_levels(long, {"P": 100})
    key = lambda r: r.Tema
    assert sorted(merged.select(both.columns).collect(), key=key) == sorted(both.collect(), key=key)


def test_sort_codes_in_one_aggregate(spark):
    cat = spark.createDataFrame([("T1", "P", 105), ("T1", "P", 103), ("T2", "P", 201), ("P", "Q", 350)], "theme string, part string, sort_order int")
    assert rows(D.sort_table(cat)) == [("P", 100), ("Q", 300), ("T1", 103), ("T2", 201)]
