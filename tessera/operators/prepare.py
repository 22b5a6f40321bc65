"""From raw observations to the base table.

All operators are ``DataFrame -> DataFrame``. Group-wise values (the
reference's ``group_by() %>% mutate()``) are computed as an aggregate joined
back on its keys: the aggregate is partially combined map-side, so a hot key
never lands in one task, and the joined-back side has one row per group.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import if_else, log_flagged
from tessera.functions.joins import join_back, join_ns
from tessera.functions.numbering import numbered
from tessera.schemas import COUNTY_DIVISOR, NATION_NAME, REGION_NAME_PATTERN, SPLIT_PATTERN
from tessera.session import materialize

SPAN_COLUMNS = ("first_year", "last_year", "has_split")
BASE_COLUMNS = (
    "kpi",
    "area_id",
    "area_name",
    "area_type",
    "area_group",
    "sex",
    "year",
    "value",
    "value_mean_group",
    "first_year",
    "last_year",
    "has_split",
)
CATALOG_COLUMNS = ("kpi_text", "part", "theme", "aspect", "logged", "inverted")


# ---------------------------------------------------------------- D1 span
def observation_span(obs: DataFrame, window: int = 6) -> DataFrame:
    """Per indicator: last year with a value, first of the last ``window``
    distinct years with a value (the earliest if fewer), and whether both
    split sexes occur (A1–A3).

    Indicators without any value are absent (G18). Only municipality and
    region rows count (F1).
    """
    valued_year = F.when(F.col("value").isNotNull(), F.col("year"))
    split_sex = F.when(F.col("sex").rlike(SPLIT_PATTERN), F.col("sex"))
    per_kpi = (
        obs.where(F.col("area_type").isin("L", "K"))
        .groupBy("kpi")
        .agg(
            F.max(valued_year).alias("last_year"),
            # distinct valued years: bounded by the calendar, combined map-side
            F.array_sort(F.collect_set(valued_year)).alias("_years"),
            # distinct split sexes: at most a few values, one aggregation
            F.size(F.collect_set(split_sex)).alias("_n_split"),
        )
        .where(F.col("last_year").isNotNull())
    )
    return per_kpi.select(
        "kpi",
        F.element_at("_years", F.greatest(F.lit(-window), -F.size("_years"))).alias("first_year"),
        "last_year",
        F.when(F.col("_n_split") == 2, 1).otherwise(0).alias("has_split"),
    )


def with_span(obs: DataFrame) -> DataFrame:
    """Attach the span columns; drops indicators without any value."""
    return obs.where(F.col("area_type").isin("L", "K")).join(observation_span(obs), "kpi")


def empty_indicators(catalog: DataFrame, obs: DataFrame) -> DataFrame:
    """Catalog indicators with no value at all (S4/F7): anti join."""
    have = obs.where(F.col("value").isNotNull()).select("kpi").distinct()  # combined map-side: one row an indicator
    return catalog.select("kpi").distinct().join(have, "kpi", "left_anti")


def complete_indicators(obs: DataFrame) -> DataFrame:
    """Number of indicators with at least one fully non-null row."""
    return with_span(obs).na.drop("any").agg(F.count_distinct("kpi").alias("n_indicators"))


# ------------------------------------------------------------ D2 area group
def area_group_expr(area_id=None, area_name=None, divisor: int = COUNTY_DIVISOR):
    """County number: ``id // divisor``, regions by their own id, 0 for the
    nation. ``divisor`` bounds the municipalities of a county."""
    area_id = F.col("area_id") if area_id is None else area_id
    area_name = F.col("area_name") if area_name is None else area_name
    return if_else(area_name.rlike(REGION_NAME_PATTERN), area_id, F.floor(area_id / divisor)).cast("int")


def area_groups(obs: DataFrame, divisor: int = COUNTY_DIVISOR) -> DataFrame:
    """Distinct (area_name, area_id, area_group) key."""
    return obs.select("area_name", "area_id", area_group_expr(divisor=divisor).alias("area_group")).distinct()


# -------------------------------------------------------- D3/D4 completion
CELL = ["area_group", "kpi", "year", "sex"]
GRID_KEYS = ["kpi", "sex", "year", "area_name", "area_id"]
#: Areas of a county that one slice of the documented grid holds on average.
AREAS_PER_SLICE = 1_000


def _cells(o: DataFrame, nation_name: str) -> DataFrame:
    """Per (area group, kpi, year, sex): sums and counts, of all values and of
    the municipalities' values, and the number of the nation's own rows.

    This is the one pass over the rows; spans, cell means and county means are
    all aggregates of this table. It is handed over as a written table."""
    k = F.when(F.col("area_type") == "K", F.col("value"))
    cells = o.groupBy(*CELL).agg(
        F.sum("value").alias("_sum"),
        F.count("value").alias("_n"),
        F.sum(k).alias("_sum_k"),
        F.count(k).alias("_n_k"),
        F.count(F.when(F.col("area_name") == nation_name, 1)).alias("_n_nation"),
    )
    return materialize(cells, "impute_cells")


def _national(cells: DataFrame) -> DataFrame:
    """Per (kpi, year, sex), from the cells."""
    return cells.groupBy("kpi", "year", "sex").agg(
        (F.sum("_sum") / F.sum("_n")).alias("_mean_all"),
        F.sum("_n").alias("_n_all"),
        (F.sum("_sum_k") / F.sum("_n_k")).alias("_mean_all_k"),
        F.sum("_n_k").alias("_n_all_k"),
        F.sum("_n_nation").alias("_n_nation"),
    )


def _span_of_cells(cells: DataFrame, window: int = 6) -> DataFrame:
    """``observation_span`` from the cells."""
    years = cells.select("kpi", "sex", "year", F.when(F.col("_n") > 0, F.lit(1.0)).alias("value"))
    return observation_span(years.withColumn("area_type", F.lit("L")), window)


def _nation_keys(o: DataFrame, nation_name: str):
    """The nation's (area_id, area_group) pairs, as one array-valued scalar
    subquery: as many as the nation's name has ids, no join."""
    return o.where(F.col("area_name") == nation_name).select(F.collect_set(F.struct("area_id", "area_group"))).scalar()


def _nation_rows(o: DataFrame, groups: DataFrame, nation_name: str, value) -> DataFrame:
    """A nation row for each of ``groups`` (kpi, year, sex) and nation id."""
    made = groups.withColumn("_value", value).withColumn("_key", F.explode(_nation_keys(o, nation_name)))
    return made.select(
        "kpi",
        F.col("_key.area_id").alias("area_id"),
        F.lit(nation_name).alias("area_name"),
        F.lit("L").alias("area_type"),
        F.col("_key.area_group").alias("area_group"),
        "sex",
        "year",
        F.col("_value").alias("value"),
    )


def _grouped(obs: DataFrame, divisor: int) -> DataFrame:
    o = obs.where(F.col("area_type").isin("L", "K"))
    return o.withColumn("area_group", area_group_expr(divisor=divisor))


def grid_cells(obs: DataFrame, nation_name: str = NATION_NAME) -> DataFrame:
    """Every cell (indicator, sex) × year × area of ``obs``, generated instead
    of joined: the distinct keys of the three sides are numbered, a range over
    the product of their sizes is dealt to the tasks, and each number is read
    as digits of mixed radix, which name the three keys. Only the nation's
    cells have an area type.

    ``obs`` holds ``area_group``. NULL sexes are a key like any other."""
    keys, n_keys = numbered(obs.select("kpi", "sex").distinct(), "_key", "grid_keys")
    years, n_years = numbered(obs.select("year").distinct(), "_year", "grid_years")
    areas, n_areas = numbered(obs.select("area_name", "area_id", "area_group").distinct(), "_area", "grid_areas")
    cells = obs.sparkSession.range(n_keys * n_years * n_areas).selectExpr(
        f"id % {max(1, n_keys)} AS _key",
        f"id div {max(1, n_keys)} % {max(1, n_years)} AS _year",
        f"id div {max(1, n_keys * n_years)} AS _area",
    )
    cells = cells.join(keys, "_key").join(years, "_year").join(areas, "_area").drop("_key", "_year", "_area")
    return cells.withColumn("area_type", F.when(F.col("area_name") == nation_name, F.lit("L")))


def complete_grid(
    obs: DataFrame, nation_name: str = NATION_NAME, divisor: int = COUNTY_DIVISOR, areas: str = "nation"
) -> DataFrame:
    """Observed rows plus cells without an observation (U2, J1); created rows
    have ``value`` NULL and no span columns.

    ``areas="all"`` is the reference's grid: (indicator, sex) × year × area, with
    the observations joined back. The cells come from ``grid_cells``; those that
    are observed leave by an anti join, so observed rows are kept as they are,
    repeated ones too.

    ``areas="nation"`` is what the reference keeps of it. Every created cell
    except the nation's has a NULL area type and is dropped again by the
    imputation (finding 2), so only the nation cells that can receive a value
    are built: one per nation id and (indicator, year, sex) group that has a
    value but no nation row.
    """
    if areas not in ("nation", "all"):
        raise ValueError(f"unknown areas of the grid: {areas!r}")
    o = _grouped(obs, divisor)
    if areas == "all":
        created = join_ns(grid_cells(o, nation_name), o.select(*GRID_KEYS), GRID_KEYS, "left_anti")
        return o.unionByName(created, allowMissingColumns=True)
    groups = _national(_cells(o, nation_name)).where((F.col("_n_nation") == 0) & (F.col("_n_all") > 0))
    created = _nation_rows(o, groups, nation_name, F.lit(None).cast("double"))
    return o.unionByName(created, allowMissingColumns=True)


def impute(obs: DataFrame, mode: str = "reference", nation_name: str = NATION_NAME, divisor: int = COUNTY_DIVISOR) -> DataFrame:
    """Fill missing values.

    ``mode="reference"`` does what the reference runs: a missing nation value
    is the mean of all values of its (indicator, year, sex); a missing
    municipality value is the mean of its county group (which includes the
    region's own row); region values are never filled; rows still missing
    are dropped (G11).

    ``mode="documented"`` does what the reference's comments describe: every
    area × (indicator, sex, year) cell with observed municipality values in
    its county is present; municipalities and regions take the county mean
    of observed municipality values, the nation the national mean of them.
    Its result is a grid: all areas of a county times all cells of it.

    The span columns (``with_span``) are attached; indicators without any
    value are dropped.
    """
    if mode not in ("reference", "documented"):
        raise ValueError(f"unknown imputation mode: {mode!r}")
    o = _grouped(obs.drop(*SPAN_COLUMNS), divisor)
    cells = _cells(o, nation_name)
    means = cells.join(_span_of_cells(cells), "kpi")
    means = join_ns(means, _national(cells).drop("_n_nation"), ["kpi", "year", "sex"], "left")
    return (_impute_reference if mode == "reference" else _impute_documented)(o, cells, means, nation_name)


def _impute_reference(o: DataFrame, cells: DataFrame, means: DataFrame, nation_name: str) -> DataFrame:
    is_nation, is_k = F.col("area_name") == nation_name, F.col("area_type") == "K"
    existing = join_back(o, means, CELL, name="impute_means")
    county = F.col("_sum") / F.col("_n")
    existing = (
        existing.withColumn("value_mean_group", if_else(is_k, county, F.lit(None).cast("double")))
        # W1, then W2; regions have no group mean and stay as they are
        .withColumn("value", if_else(is_nation & F.col("value").isNull(), F.col("_mean_all"), F.col("value")))
        .withColumn("value", if_else(is_k & F.col("value").isNull(), F.col("value_mean_group"), F.col("value")))
        .where(F.col("value").isNotNull())
    )
    groups = _national(cells).where((F.col("_n_nation") == 0) & (F.col("_n_all") > 0))
    created = _nation_rows(o, groups, nation_name, F.col("_mean_all"))
    return existing.select(*BASE_COLUMNS).unionByName(created, allowMissingColumns=True)


def _in_slices(areas: DataFrame, cells: DataFrame, areas_per_slice: int | None = None) -> DataFrame:
    """All areas of a county times all cells of it, by fragment and replicate:
    a county's areas are dealt into slices by a hash, its cells are copied to
    every slice. A task then makes about ``areas_per_slice`` areas' cells, how
    many areas a county may have. The number of slices is that of the largest
    county."""
    areas = materialize(areas, "grid_areas")
    largest = areas.groupBy("area_group").count().agg(F.max("count")).first()[0] or 0
    slices = max(1, -(-largest // (areas_per_slice or AREAS_PER_SLICE)))
    dealt = areas.withColumn("_slice", F.pmod(F.xxhash64("area_id", "area_name"), F.lit(slices)))
    copies = cells.withColumn("_slice", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(slices - 1).cast("bigint"))))
    return dealt.join(copies, ["area_group", "_slice"]).drop("_slice")


def _impute_documented(o: DataFrame, cells: DataFrame, means: DataFrame, nation_name: str) -> DataFrame:
    local = cells.where(F.col("_n_k") > 0).withColumn("_fill", F.col("_sum_k") / F.col("_n_k")).select(*CELL, "_fill")
    areas = o.select("area_name", "area_id", "area_type", "area_group").distinct()
    local_cells = _in_slices(areas.where(F.col("area_name") != nation_name), local)
    groups = _national(cells).where(F.col("_n_all_k") > 0)
    nation_cells = _nation_rows(o, groups, nation_name, F.col("_mean_all_k")).withColumnRenamed("value", "_fill")
    made = local_cells.unionByName(nation_cells).withColumnsRenamed(
        {"area_id": "_c_id", "area_type": "_c_type", "area_group": "_c_group"}
    )
    spans = means.select("kpi", *SPAN_COLUMNS).distinct()
    joined = join_ns(o.join(spans, "kpi"), made, ["area_name", "kpi", "year", "sex"], "full")
    out = joined.select(
        "kpi",
        F.coalesce("area_id", "_c_id").alias("area_id"),
        "area_name",
        F.coalesce("area_type", "_c_type").alias("area_type"),
        F.coalesce("area_group", "_c_group").alias("area_group"),
        "sex",
        "year",
        F.coalesce("value", "_fill").alias("value"),
        F.when(F.coalesce("area_type", "_c_type") == "K", F.col("_fill")).alias("value_mean_group"),
        *SPAN_COLUMNS,
    )
    return out.where(F.col("value").isNotNull())


# ------------------------------------------------------- D5 catalog and log
def attach_catalog(base: DataFrame, catalog: DataFrame) -> DataFrame:
    """Left join the indicator catalog by ``kpi``.

    The catalog is written first and has its real size, a row per indicator: the
    planner takes distinct rows of a table for as large as the table, and would
    shuffle the base rows by indicator to join them."""
    return base.join(materialize(catalog.select("kpi", *CATALOG_COLUMNS), "catalog"), "kpi", "left")


def log_values(base: DataFrame) -> DataFrame:
    """Natural log of flagged indicators."""
    return base.withColumn("value", log_flagged(F.col("value"), F.col("logged")))


def stamp(base: DataFrame, run_date: _dt.date | str | None = None) -> DataFrame:
    """Add the fetch date (X18); pass the date in for repeatable output."""
    d = F.current_date() if run_date is None else F.to_date(F.lit(str(run_date)))
    return base.withColumn("fetched", F.date_format(d, "yyyy-MM-dd"))


def build_base(
    obs: DataFrame,
    catalog: DataFrame,
    mode: str = "reference",
    nation_name: str = NATION_NAME,
    run_date: _dt.date | str | None = None,
    divisor: int = COUNTY_DIVISOR,
) -> DataFrame:
    """Observations to base table: span, completion and imputation, catalog, log."""
    base = impute(obs, mode, nation_name, divisor)
    out = log_values(attach_catalog(base, catalog))
    return stamp(out, run_date) if run_date is not None else out


# ------------------------------------------------------------ D6 nation
def mark_national(base: DataFrame, nation_name: str = NATION_NAME) -> DataFrame:
    """Give the nation its own area type ``R``."""
    return base.withColumn(
        "area_type", if_else(F.col("area_name") == nation_name, F.lit("R"), F.col("area_type"))
    )
