"""Dense numbers for the rows of a table, without sorting it in one task."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.session import materialize


def numbered(df: DataFrame, out: str, name: str = "numbered") -> tuple[DataFrame, int]:
    """``df`` with the column ``out``, 0 to n - 1 in the order of its
    partitions, and n. The rows are written first, so that they keep their
    numbers; the offsets of the partitions are a window over one row for each."""
    # the upper 31 bits of the id are the partition, the lower 33 the place in it
    rows = materialize(df.withColumn(out, F.monotonically_increasing_id()), name)
    part = F.shiftright(out, 33)
    sizes = rows.groupBy(part.alias("_part")).agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    sizes = materialize(sizes.select("_part", "_n", F.coalesce(before, F.lit(0)).alias("_before")), f"{name}_sizes")
    total = sizes.agg(F.sum("_n")).first()[0] or 0
    place = F.col(out).bitwiseAND(F.lit((1 << 33) - 1))
    joined = rows.withColumns({"_part": part, "_place": place}).join(sizes, "_part")
    return joined.withColumn(out, F.col("_before") + F.col("_place")).drop("_part", "_place", "_n", "_before"), total
