from pyspark.sql import functions as F

from tessera.functions import columns as C


def test_prefix_helpers(spark):
    df = spark.createDataFrame([("a", " x ", " y ", 1)], "k string, Info_a string, Info_b string, n int")
    out = C.map_prefixed(df, "Info", F.trim)
    assert out.columns == df.columns
    assert tuple(out.first()) == ("a", "x", "y", 1)
    assert C.select_prefixed(out, "Info", keep=["k"]).columns == ["k", "Info_a", "Info_b"]
    assert C.rename_list(df, ["k", "n"], ["key", "num"]).columns == ["key", "Info_a", "Info_b", "num"]
