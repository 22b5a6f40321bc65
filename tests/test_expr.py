import math

from pyspark.sql import functions as F

from tessera.functions import expr as X


def test_if_else_null_condition_gives_null(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a int")
    out = df.select(X.if_else(F.col("a") > 2, F.lit("big"), F.lit("small")).alias("r")).collect()
    assert [r.r for r in out] == ["small", None, "big"]


def test_case_when_null_falls_through(spark):
    df = spark.createDataFrame([(None,), (1,)], "a int")
    out = df.select(X.case_when((F.col("a") == 1, "one"), default="other").alias("r")).collect()
    assert [r.r for r in out] == ["other", "one"]


def test_min_max_score_branches(spark):
    df = spark.createDataFrame(
        [
            (5.0, 0.0, 10.0, 0),  # normal
            (5.0, 0.0, 10.0, 1),  # inverted
            (2.0, 0.0, 10.0, 0),
            (2.0, 0.0, 10.0, 1),
            (3.0, 3.0, 3.0, 0),  # degenerate reference -> 0
            (3.0, None, None, 1),  # missing reference -> 0 (G14)
            (12.0, 0.0, 10.0, 0),  # outside the reference group -> above 100
            (5.0, 0.0, 10.0, None),  # unknown orientation -> 0
        ],
        "v double, lo double, hi double, inv int",
    )
    out = [r.s for r in df.select(X.min_max_score(F.col("v"), F.col("lo"), F.col("hi"), F.col("inv")).alias("s")).collect()]
    assert out[0] == 50.0 and out[1] == 50.0
    assert out[2] + out[3] == 100.0  # inverted and normal twins add up to 100
    assert out[4] == 0.0 and out[5] == 0.0 and out[7] == 0.0
    assert out[6] == 120.0


def test_log_flagged(spark):
    # unit frame 8: logged values 0, -1, 10, null; unflagged kept; null flag -> null
    df = spark.createDataFrame(
        [(0.0, 1), (-1.0, 1), (10.0, 1), (None, 1), (10.0, 0), (10.0, None)], "v double, f int"
    )
    out = [r.r for r in df.select(X.log_flagged(F.col("v"), F.col("f")).alias("r")).collect()]
    assert out[0] is None and out[1] is None and out[3] is None  # G6: NULL instead of -Inf/NaN
    assert math.isclose(out[2], math.log(10.0))
    assert out[4] == 10.0 and out[5] is None


def test_text_helpers(spark):
    df = spark.createDataFrame([("  a \t b\n c  ", "T10 - Utbildning", "x", None)], "s string, t string, e string, n string")
    r = df.select(
        X.squish(F.col("s")).alias("sq"),
        X.cut_after_dash(F.col("t")).alias("cut"),
        X.paste(F.col("e"), F.col("n"), F.lit("y")).alias("p"),
        X.ensure_period(F.col("e")).alias("dot"),
        X.ensure_period(F.col("n")).alias("dot_null"),
        X.recode(F.col("e"), {"x": "X"}).alias("rc"),
        X.recode(F.col("t"), {"x": "X"}).alias("rc_keep"),
    ).first()
    assert r.sq == "a b c"
    assert r.cut == "T10"
    assert r.p == "x NA y"
    assert r.dot == "x." and r.dot_null is None
    assert r.rc == "X" and r.rc_keep == "T10 - Utbildning"


def test_output_rounding_keeps_large_values_and_nan(spark):
    import math

    from tessera.plans.queries import rounded

    df = spark.createDataFrame([(1, 2.5e10), (2, float("nan")), (3, 1.23456789), (4, None), (5, -2.5e10)], "k int, v double")
    got = {r.k: r.v for r in rounded(df).collect()}
    assert got[1] == 2.5e10 and got[5] == -2.5e10 and math.isnan(got[2]) and got[3] == 1.234568 and got[4] is None


DIGESTS = {"QUALITY_OF_LIFE_DESC": "982986251fcb", "SUSTAINABILITY_DESC": "4feae0125f9b", "INDICATOR_DESC": "f228758f62bc"}


def test_fixed_texts():
    """The long texts, held against digests of their values."""
    import hashlib

    from tessera.operators import describe as D

    digest = {n: hashlib.sha256(getattr(D, n).encode()).hexdigest()[:12] for n in ("QUALITY_OF_LIFE_DESC", "SUSTAINABILITY_DESC", "INDICATOR_DESC")}
    assert digest == DIGESTS


def test_squish_takes_every_white_space(spark):
    odd = "".join(map(chr, (0xA0, 0x2003, 0x2028, 0x3000, 0x85, 9, 10, 11, 12, 13)))
    df = spark.createDataFrame([(f"{odd}a{odd}b {odd}",), ("",), (None,), (odd,)], "s string")
    assert [r[0] for r in df.select(X.squish(F.col("s"))).collect()] == ["a b", "", None, ""]
