"""Data checks of the reference, as DataFrames instead of printouts."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.joins import join_ns


def orientation_conflicts(scored: DataFrame) -> DataFrame:
    """Indicators scored with both orientations (A12); must be empty.

    Row counts per orientation, pivoted on the fixed values 0 and 1; only
    indicators with rows in both survive.
    """
    wide = scored.groupBy("kpi").pivot("inverted", [0, 1]).count()
    return wide.select("kpi", F.col("0").alias("n_0"), F.col("1").alias("n_1")).na.drop("any")


def score_profile(scored: DataFrame) -> DataFrame:
    """Min/max of score and value per (kpi_text, area_type, sex, year,
    inverted) (A13), with the number of NULL scores (G26: R's min/max would
    turn NULL there, Spark skips it)."""
    return scored.groupBy("kpi_text", "area_type", "sex", "year", "inverted").agg(
        F.min("standard_value").alias("min_score"),
        F.max("standard_value").alias("max_score"),
        F.min("value").alias("min_value"),
        F.max("value").alias("max_value"),
        F.count(F.when(F.col("standard_value").isNull(), 1)).alias("n_null"),
    )


def base_metrics() -> dict[str, Column]:
    """Aggregates of a base table that its write observes (D19): rows, rows
    without a sex, and values lost to the log (imputed rows all have a value)."""
    lost = (F.col("logged") == 1) & F.col("value").isNull()
    return {
        "rows": F.count(F.lit(1)),
        "rows_without_sex": F.count(F.when(F.col("sex").isNull(), 1)),
        "log_losses": F.count(F.when(lost, 1)),
    }


def score_metrics() -> dict[str, Column]:
    """Aggregates of scored rows that their write observes."""
    score = F.col("standard_value")
    return {
        "scores": F.count(F.lit(1)),
        "null_scores": F.count(F.when(score.isNull(), 1)),
        "zero_scores": F.count(F.when(score == 0, 1)),
        "scores_outside": F.count(F.when((score < 0) | (score > 100), 1)),
    }


QUANTILE_NAMES = {0.25: "q25", 0.5: "median", 0.75: "q75"}


#: Values between two bounds that are gathered and sorted.
FEW_VALUES = 10_000
#: Accuracy of the sketches that propose bounds.
SKETCH = 10_000


def column_summary(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """R's ``summary()`` for numeric columns (A14), in long form.

    One row per column: n, n_null, min, q25, median, mean, q75, max. The
    quartiles are exact (linear interpolation between order statistics, R's
    type 7) and found by selection, not by sorting: a sketch proposes bounds
    around each quartile, exact counts of the values below them say where its
    two order statistics are, and the bounds are narrowed until few values lie
    between. Every pass is one aggregate over the needed columns, combined
    map-side; no row is shuffled, and the driver sees counts and bounds.
    """
    values = df.select(*[F.col(f"`{c}`").cast("double").alias(f"v{i}") for i, c in enumerate(columns)])
    stats = values.agg(
        *[
            f(F.col(f"v{i}")).alias(f"{name}{i}")
            for i in range(len(columns))
            for name, f in (("n", F.count), ("min", F.min), ("mean", F.avg), ("max", F.max), ("null", lambda v: F.count(F.when(v.isNull(), 1))))
        ]
    ).first()
    ranks: dict[tuple[int, int], _Ranked] = {}
    places = {i: [(stats[f"n{i}"] - 1) * p for p in QUANTILE_NAMES] for i in range(len(columns)) if stats[f"n{i}"]}
    for i, hs in places.items():
        for rank in {f(h) for h in hs for f in (math.floor, math.ceil)}:
            ranks[i, rank] = _Ranked(f"v{i}", rank, stats[f"n{i}"], stats[f"min{i}"], stats[f"max{i}"])
    while todo := [r for r in ranks.values() if r.value is None]:
        _narrow(values, todo)

    def quantile(i: int, k: int) -> float | None:
        if i not in places:
            return None
        h = places[i][k]
        lo, hi = ranks[i, math.floor(h)].value, ranks[i, math.ceil(h)].value
        return lo + (h - math.floor(h)) * (hi - lo)

    rows = [
        (c, stats[f"n{i}"], stats[f"null{i}"], stats[f"min{i}"], quantile(i, 0), quantile(i, 1), stats[f"mean{i}"], quantile(i, 2), stats[f"max{i}"])
        for i, c in enumerate(columns)
    ]
    schema = "column string, n long, n_null long, min double, q25 double, median double, mean double, q75 double, max double"
    return df.sparkSession.createDataFrame(rows, schema)


class _Ranked:
    """The value at a place among a column's sorted values: bounds that enclose
    it, and how many values are before these and up to them."""

    def __init__(self, column: str, rank: int, n: int, low: float, high: float):
        self.column, self.rank, self.low, self.high, self.before, self.upto = column, rank, low, high, 0, n
        self.without_low = self.without_high = False
        self.margin = 2.0 / SKETCH
        self.value = low if low == high else None

    def between(self) -> Column:
        v = F.col(self.column)
        above = v > self.low if self.without_low else v >= self.low
        return F.when(above & (v < self.high if self.without_high else v <= self.high), v)

    def proposals(self) -> list[float]:
        """Shares of the values between the bounds to ask a sketch for: the
        place itself and one at either side, further out in each round."""
        n, at = self.upto - self.before, self.rank - self.before + 0.5
        out = [max(0.0, at / n - self.margin), at / n, min(1.0, at / n + self.margin)]
        self.margin *= 2
        return out

    def take(self, bound: float, below: int, upto: int) -> None:
        """Narrow by a value with ``below`` smaller ones and ``upto`` up to it:
        it is the value, or it and all beyond it are left out."""
        if below <= self.rank < upto:
            self.value = bound
        elif upto <= self.rank and upto > self.before:
            self.low, self.before, self.without_low = bound, upto, True
        elif below > self.rank and below < self.upto:
            self.high, self.upto, self.without_high = bound, below, True


def _narrow(values: DataFrame, todo: list[_Ranked]) -> None:
    """One round: where few values lie between the bounds they are gathered,
    elsewhere a sketch proposes new bounds and an exact count judges them."""
    few = [r for r in todo if r.upto - r.before <= FEW_VALUES]
    many = [r for r in todo if r.upto - r.before > FEW_VALUES]
    asked = [F.array_sort(F.collect_list(r.between())).alias(f"few{k}") for k, r in enumerate(few)]
    asked += [F.percentile_approx(r.between(), r.proposals(), SKETCH).alias(f"many{k}") for k, r in enumerate(many)]
    got = values.agg(*asked).first()
    for k, r in enumerate(few):
        r.value = got[f"few{k}"][r.rank - r.before]
    bounds = [(r, b) for k, r in enumerate(many) for b in sorted({*got[f"many{k}"]})]
    if bounds:
        counts = values.agg(
            *[F.count(F.when(F.col(r.column) < b, 1)).alias(f"below{k}") for k, (r, b) in enumerate(bounds)],
            *[F.count(F.when(F.col(r.column) <= b, 1)).alias(f"upto{k}") for k, (r, b) in enumerate(bounds)],
        ).first()
        for k, (r, b) in enumerate(bounds):
            r.take(b, counts[f"below{k}"], counts[f"upto{k}"])


def catalog_agreement(catalog: DataFrame, base: DataFrame) -> DataFrame:
    """Catalog texts against the texts in the data, by key (J13 re-aimed).

    The reference binds two sorted lists side by side; here they are joined
    on ``kpi``, so a missing or extra indicator shows up instead of shifting
    every later pair. ``check`` is 1 when both texts are equal.
    """
    cat = catalog.select("kpi", F.col("kpi_text").alias("catalog_text")).where(F.col("catalog_text").isNotNull())
    data = base.select("kpi", F.col("kpi_text").alias("data_text")).distinct()
    j = cat.join(data, "kpi", "full")
    return j.withColumn("check", F.when(F.col("catalog_text") == F.col("data_text"), 1).otherwise(0))


def catalog_agreement_tally(agreement: DataFrame) -> DataFrame:
    """Number of agreeing indicators (A20, ``tally(check)``)."""
    return agreement.agg(F.sum("check").alias("n"))


def part_by_region(final: DataFrame, part: str, sex: str = "T") -> DataFrame:
    """Part index of regions and the nation for one part and sex.

    ``final`` may be the row-level final table or the part-level finals
    (``hierarchy.final_levels(...).part``); both give the same rows.
    """
    return (
        final.where((F.col("part") == part) & (F.col("sex") == sex) & F.col("area_type").isin("L", "R"))
        .select("part", "area_name", "area_type", "sex", "mean_region_part_final")
        .distinct()
    )


def national_rows(final: DataFrame) -> DataFrame:
    """Rows of the nation (``area_type == 'R'``)."""
    return final.where(F.col("area_type") == "R")


def null_split(scored: DataFrame) -> DataFrame:
    """Rows without a sex."""
    return scored.where(F.col("sex").isNull())


def category_agreement(catalog: DataFrame, categories: DataFrame) -> DataFrame:
    """(aspect, theme, part, sort_order) tuples found in only one of the
    catalog and the categorisation file; empty when they agree."""
    keys = ["aspect", "theme", "part", "sort_order"]
    a = catalog.select(*keys).distinct().withColumn("in_catalog", F.lit(1))
    b = categories.select(*keys).distinct().withColumn("in_categories", F.lit(1))
    return join_ns(a, b, keys, "full").where(F.col("in_catalog").isNull() | F.col("in_categories").isNull())


def unmatched_areas(rows: DataFrame, codes: DataFrame, code_col: str, nation_type: str = "R") -> DataFrame:
    """Areas (other than the nation) whose id has no code in ``codes``.

    The delivery labels such areas as the nation, as the reference does;
    this check lists them instead of letting that pass silently.
    """
    key = codes.select(F.col(code_col).alias("_code")).distinct()
    areas = rows.where(F.col("area_type") != nation_type).select("area_id", "area_name", "area_type").distinct()
    return areas.join(key, areas.area_id.cast("string") == key._code, "left_anti")


def log_losses(base_before_log: DataFrame) -> DataFrame:
    """Per indicator, flagged values the natural log turns into NULL (G6):
    zero or negative values (R gives -Inf / NaN there)."""
    lost = (F.col("logged") == 1) & F.col("value").isNotNull() & (F.col("value") <= 0)
    return (
        base_before_log.where(lost)
        .groupBy("kpi")
        .agg(F.count(F.lit(1)).alias("n_lost"), F.min("value").alias("min_value"))
    )
