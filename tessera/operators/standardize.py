"""Year choice and min-max scaling.

Plan shape: the per-indicator year choice and the reference min/max are
small aggregates (one row per indicator, or per indicator × area type ×
orientation × sex) joined back to the rows. They are partially aggregated
map-side and, once AQE sees their real size, broadcast; no window over a
handful of indicator keys ships every row to a few tasks (SURVEY 4.2 #1).
"""

from __future__ import annotations

import logging

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import min_max_score
from tessera.functions.joins import join_back
from tessera.schemas import SEXES

SPLIT_MODES = {
    "total": "total",
    "total_bas": "total",
    "separate": "separate",
    "separat_bas": "separate",
    "pooled": "pooled",
    "sammantaget_bas": "pooled",
}
YEAR_MODES = {
    "latest": "latest",
    "latest_year": "latest",
    "lag": "lag",
    "latest_year_lag": "lag",
}
YEAR_SCOPES = {"kpi": ("kpi",), "area_type": ("kpi", "area_type")}
_log = logging.getLogger(__name__)


def _mode(table: dict, value: str, what: str) -> str:
    try:
        return table[value]
    except KeyError:
        raise ValueError(f"unknown {what}: {value!r}; expected one of {sorted(table)}") from None


def select_year(base: DataFrame, year_mode: str = "latest", lag: int = 5, year_scope: str = "kpi") -> DataFrame:
    """Latest year and selected year per indicator.

    ``lag``: the latest year at or before ``latest - lag``; when no year is
    that old, the nearest one, which is then the earliest year. The latest
    year is taken over all area types unless ``year_scope="area_type"`` (G7).
    """
    mode = _mode(YEAR_MODES, year_mode, "year mode")
    keys = _mode(YEAR_SCOPES, year_scope, "year scope")
    if mode == "latest":
        return base.groupBy(*keys).agg(F.max("year").alias("latest_year")).withColumn(
            "selected_year", F.col("latest_year")
        )
    # distinct years per indicator: bounded by the calendar, combined map-side
    per = base.groupBy(*keys).agg(F.max("year").alias("latest_year"), F.collect_set("year").alias("_years"))
    target = F.col("latest_year") - F.lit(int(lag))
    older = F.array_max(F.filter("_years", lambda y: y <= target))
    return per.select(*keys, "latest_year", F.coalesce(older, F.array_min("_years")).alias("selected_year"))


def _with_years(base: DataFrame, year_mode: str, lag: int, year_scope: str) -> DataFrame:
    keys = list(_mode(YEAR_SCOPES, year_scope, "year scope"))
    return join_back(base, select_year(base, year_mode, lag, year_scope), keys, name="years")


def selected_rows(base: DataFrame, year_mode: str = "latest", lag: int = 5, year_scope: str = "kpi") -> DataFrame:
    """Rows of each indicator's selected year, with ``selected_year``."""
    b = _with_years(base, year_mode, lag, year_scope)
    return b.where(F.col("year") == F.col("selected_year")).drop("latest_year")


def _reference_rows(b: DataFrame, mode: str) -> tuple[DataFrame, list[str]]:
    rows = b.where(F.col("year") == F.col("latest_year"))
    keys = ["kpi", "area_type", "inverted"]
    if mode == "total":
        rows = rows.where(F.col("sex") == "T")
    elif mode == "separate":
        keys.append("sex")
    return rows, keys


def _range(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.min("value").alias("min_ref"), F.max("value").alias("max_ref"))


def reference_range(base: DataFrame, split_mode: str = "total", year_scope: str = "kpi") -> DataFrame:
    """Min and max of the reference group in the latest year.

    total: sex T only, per (kpi, area_type, inverted); separate: per sex too;
    pooled: all sexes together. The reference rows always come from the
    latest year, also when a lagged year is scored (G8).
    """
    mode = _mode(SPLIT_MODES, split_mode, "split mode")
    return _range(*_reference_rows(_with_years(base, "latest", 0, year_scope), mode))


def standardize(
    base: DataFrame,
    split_mode: str = "total",
    year_mode: str = "latest",
    lag: int = 5,
    year_scope: str = "kpi",
    validate: bool = False,
) -> DataFrame:
    """Score the selected year of every indicator on 0..100.

    ``validate=True`` counts the (kpi, area_type, year) groups of the
    selected year that miss a sex and logs a warning, as the reference's
    validation prints them; ``missing_split`` returns the groups themselves.

    Scores leave 0..100 when the scored rows are not part of the reference
    group (men/women under ``total``, lagged years: finding 3). The nation is
    alone in its reference group and scores 0 except under ``pooled`` (G13).

    Plan: one year table per indicator (latest and selected year) is joined
    to the rows once; the scored rows and the reference rows are two filters
    of that same join, and the reference range is a small aggregate joined
    back by its keys.
    """
    mode = _mode(SPLIT_MODES, split_mode, "split mode")
    _mode(YEAR_MODES, year_mode, "year mode")
    if validate:
        n = missing_split(base, year_mode, lag).count()
        if n:
            _log.warning("%d (kpi, area_type, year) groups of the selected year miss a sex", n)
        else:
            _log.info("every sex is present in each indicator's selected year")
    b = _with_years(base, year_mode, lag, year_scope)
    data = b.where(F.col("year") == F.col("selected_year")).drop("latest_year")
    ref = _range(*_reference_rows(b, mode))
    keys = ["kpi", "area_type", "inverted"] + (["sex"] if mode == "separate" else [])
    scored = join_back(data, ref, keys, "left", name="reference_range").withColumn(
        "standard_value",
        min_max_score(F.col("value"), F.col("min_ref"), F.col("max_ref"), F.col("inverted")),
    )
    return scored.drop("min_ref", "max_ref")


def missing_split(base: DataFrame, year_mode: str = "latest", lag: int = 5) -> DataFrame:
    """Sexes missing per (kpi, area_type, year) in the selected year.

    ``missing`` lists them in the order T, K, M, comma-separated.
    """
    data = selected_rows(base, year_mode, lag)
    expected = F.array(*[F.lit(s) for s in SEXES])
    return (
        data.groupBy("kpi", "area_type", "year")
        .agg(F.array_except(expected, F.collect_set("sex")).alias("_missing"))
        .where(F.size("_missing") > 0)
        .select("kpi", "area_type", "year", F.array_join("_missing", ",").alias("missing"))
    )


def standardize_per_year(base: DataFrame) -> DataFrame:
    """The older method (D10/W7): every (kpi, area_type, sex, year) is its own
    reference group, so all years are scored and scores stay in 0..100."""
    keys = ["kpi", "area_type", "sex", "year"]
    ref = base.groupBy(*keys).agg(F.min("value").alias("min_ref"), F.max("value").alias("max_ref"))
    return (
        join_back(base, ref, keys, "left", name="reference_range")
        .withColumn(
            "standard_value",
            min_max_score(F.col("value"), F.col("min_ref"), F.col("max_ref"), F.col("inverted")),
        )
        .drop("min_ref", "max_ref")
    )
