"""Registered queries: one builder per operator of SURVEY §2.

Each builder takes ``(spark, sf_dir)`` and returns a DataFrame whose column
names equal those of the matching SQL in ``tessera.plans.oracle``. Doubles
are rounded to 6 places at the very end, on both sides.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas
from tessera.operators import checks, describe, export, hierarchy, prepare, standardize
from tessera.plans import context as ctx
from tessera.session import checkpoint_root
from tessera.sources import files, fixture
from tessera.streaming.landing import land_observations, refresh_table

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def deco(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn

    return deco


ROUNDED_BELOW = 9e9


def stable_round(c):
    """Round to 6 places as ``floor(floor(x*1e9+0.5)/1e9*1e6+0.5)/1e6``.

    Output rounding only, for comparing engines: the same IEEE operations
    give the same bits everywhere (built-in ``round`` breaks ties
    differently per engine), and the 9-place step makes values that differ
    only in the last bits of a sum, near a decimal tie, round alike. Values
    from ``ROUNDED_BELOW`` on, where ``floor`` would leave the range of a
    BIGINT, and NaN stay as they are.
    """
    k9, k6, h = F.lit(1e9), F.lit(1e6), F.lit(0.5)
    return F.when(F.abs(c) < ROUNDED_BELOW, F.floor(F.floor(c * k9 + h) / k9 * k6 + h) / k6).otherwise(c)


def _stable_round_sql(name: str) -> str:
    """:func:`stable_round` as one SQL expression (one parse instead of a
    dozen driver-to-JVM calls per column)."""
    c = f"`{name}`"
    r = f"floor(floor({c} * 1e9D + 0.5D) / 1e9D * 1e6D + 0.5D) / 1e6D"
    return f"CASE WHEN abs({c}) < {ROUNDED_BELOW:.0f}D THEN {r} ELSE {c} END AS `{name}`"


def rounded(df: DataFrame) -> DataFrame:
    """Apply :func:`stable_round` to every double column."""
    return df.selectExpr(
        *[
            _stable_round_sql(f.name) if isinstance(f.dataType, T.DoubleType) else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )


OBS_COLS = ["kpi", "area_id", "area_name", "area_type", "sex", "year", "value"]
BASE_COLS = [
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
]
CAT_COLS = ["kpi_text", "part", "theme", "aspect", "logged", "inverted"]
SCORED_COLS = [
    "kpi",
    "area_id",
    "area_name",
    "area_type",
    "sex",
    "year",
    "value",
    "part",
    "theme",
    "aspect",
    "inverted",
    "selected_year",
    "standard_value",
]


# ------------------------------------------------------------- sources / D1–D6
@query("q_obs")
def q_obs(spark, sf):
    """All observations, the nation's without gaps."""
    return rounded(ctx.observations(spark, sf, gaps=False).select(*OBS_COLS))


@query("q_catalog")
def q_catalog(spark, sf):
    """Imputed rows of all observations with the catalog attached (before logs)."""
    imp = ctx.imputed(spark, sf, gaps=False)
    return rounded(prepare.attach_catalog(imp, ctx.catalog(spark, sf)).select(*BASE_COLS, *CAT_COLS))


@query("q_span")
def q_span(spark, sf):
    return prepare.observation_span(ctx.observations(spark, sf))


@query("q_split_flag")
def q_split_flag(spark, sf):
    return prepare.observation_span(ctx.observations(spark, sf)).select("kpi", "has_split")


@query("q_area_group")
def q_area_group(spark, sf):
    return prepare.area_groups(ctx.observations(spark, sf), fixture.COUNTY_DIVISOR)


def _grid(areas: str) -> Query:
    def q(spark, sf):
        g = prepare.complete_grid(prepare.with_span(ctx.observations(spark, sf)), divisor=fixture.COUNTY_DIVISOR, areas=areas)
        return rounded(g.select(*BASE_COLS[:8], *BASE_COLS[9:]))

    return q


# All cells of (indicator, sex) x year x area, and those that the reference keeps
query("q_grid")(_grid("all"))
query("q_grid_nation")(_grid("nation"))


@query("q_impute_national")
def q_impute_national(spark, sf):
    """Nation rows after the reference imputation."""
    imp = ctx.imputed(spark, sf)
    return rounded(imp.where(F.col("area_group") == 0).select(*BASE_COLS))


@query("q_impute_group")
def q_impute_group(spark, sf):
    """All rows after the reference imputation."""
    return rounded(ctx.imputed(spark, sf).select(*BASE_COLS))


@query("q_impute_documented")
def q_impute_documented(spark, sf):
    return rounded(
        ctx.imputed(spark, sf, "documented").select(*BASE_COLS)
    )


@query("q_log")
def q_log(spark, sf):
    return rounded(ctx.base(spark, sf).select(*BASE_COLS, *CAT_COLS))


@query("q_mark_national")
def q_mark_national(spark, sf):
    return rounded(ctx.marked_base(spark, sf).select(*BASE_COLS, *CAT_COLS))


@query("q_empty_indicators")
def q_empty_indicators(spark, sf):
    return prepare.empty_indicators(ctx.catalog(spark, sf), ctx.observations(spark, sf))


@query("q_complete_indicators")
def q_complete_indicators(spark, sf):
    return prepare.complete_indicators(ctx.observations(spark, sf))


# ------------------------------------------------------------------ D7–D10
@query("q_year_latest")
def q_year_latest(spark, sf):
    return standardize.select_year(ctx.marked_base(spark, sf), "latest")


@query("q_year_lag")
def q_year_lag(spark, sf):
    return standardize.select_year(ctx.marked_base(spark, sf), "lag", 5)


def _ref(mode: str) -> Query:
    def q(spark, sf):
        return rounded(standardize.reference_range(ctx.marked_base(spark, sf), mode))

    return q


for _m in ("total", "separate", "pooled"):
    query(f"q_ref_{_m}")(_ref(_m))


def scored(spark, sf) -> DataFrame:
    """Rows scored against the total sex in the latest year, handed over once."""
    return ctx.scored(spark, sf)


def _std(mode: str, year_mode: str) -> Query:
    def q(spark, sf):
        return rounded(standardize.standardize(ctx.marked_base(spark, sf), mode, year_mode, 5).select(*SCORED_COLS))

    return q


for _m in ("total", "separate", "pooled"):
    query(f"q_std_{_m}")(_std(_m, "latest"))
    query(f"q_std_{_m}_lag")(_std(_m, "lag"))


@query("q_missing_split")
def q_missing_split(spark, sf):
    return standardize.missing_split(ctx.marked_base(spark, sf))


@query("q_std_per_year")
def q_std_per_year(spark, sf):
    cols = [c for c in SCORED_COLS if c != "selected_year"]
    return rounded(standardize.standardize_per_year(ctx.base(spark, sf)).select(*cols))


# ----------------------------------------------------------------- D11–D14
def levels(spark, sf, weighting="row") -> hierarchy.Levels:
    return hierarchy.Levels(ctx.grain(spark, sf, weighting))


@query("q_rollup_aspect")
def q_rollup_aspect(spark, sf):
    return rounded(hierarchy.roll_up(scored(spark, sf)).aspect)


@query("q_rollup_theme")
def q_rollup_theme(spark, sf):
    return rounded(hierarchy.roll_up(scored(spark, sf)).theme)


@query("q_rollup_part")
def q_rollup_part(spark, sf):
    return rounded(hierarchy.roll_up(scored(spark, sf)).part)


@query("q_rollup_node")
def q_rollup_node(spark, sf):
    return rounded(hierarchy.roll_up(scored(spark, sf), "node").part)


def _nat(geo: str, level: str) -> Query:
    def q(spark, sf):
        nat = hierarchy.national_means(levels(spark, sf)).get(level)
        n = "n_region" if geo == "region" else "n_municipal"
        return rounded(
            nat.where(F.col(n) > 0).select(*hierarchy.LEVEL_KEYS[level], "sex", f"nat_{geo}_{level}")
        )

    return q


for _g in ("region", "municipal"):
    for _lv in ("aspect", "theme", "part"):
        query(f"q_nat_{_g}_{_lv}")(_nat(_g, _lv))


FINAL_COLS = [f"mean_{g}_{lv}_final" for g in ("region", "municipal") for lv in ("aspect", "theme", "part")]


def final(spark, sf) -> DataFrame:
    return hierarchy.join_finals(ctx.scored_cells(spark, sf), ctx.final_cells(spark, sf))


@query("q_final")
def q_final(spark, sf):
    return rounded(final(spark, sf).select(*SCORED_COLS, *FINAL_COLS))


def _deliver(level: str, geo: str) -> Query:
    def q(spark, sf):
        lv = levels(spark, sf)
        codes = fixture.region_codes(spark, sf) if geo == "region" else fixture.municipality_codes(spark, sf)
        return rounded(hierarchy.deliver(lv, hierarchy.national_means(lv), codes, level, geo))

    return q


query("q_total_region")(_deliver("part", "region"))
query("q_theme_region")(_deliver("theme", "region"))
query("q_total_municipal")(_deliver("part", "municipality"))
query("q_theme_municipal")(_deliver("theme", "municipality"))


# ----------------------------------------------------------- D16–D18 texts
# Fixed values of the fixture's text side: the part labels and their sort codes.
PARTS = ("D1", "D2")
SUSTAINABILITY_PART = "D2"
PART_SORTING = {"D1": 100, "D2": 200}


def texts(spark, sf) -> DataFrame:
    """Distinct (kpi, title, source), handed over once: one scan of the texts."""
    return ctx.text_triples(spark, sf)


def text_keys(spark, sf) -> DataFrame:
    return ctx.index_keys(spark, sf)


@query("q_attribution")
def q_attribution(spark, sf):
    return ctx.attributed(spark, sf).select("doc_id", "kpi", "title", "source")


@query("q_title_members")
def q_title_members(spark, sf):
    """The titles of every theme, area type and sex, one row each."""
    return describe.members(text_keys(spark, sf), texts(spark, sf), "theme", "title")


@query("q_title_segments")
def q_title_segments(spark, sf):
    """The titles in order, three at a time: as many rows as it takes."""
    found = describe.level_members(text_keys(spark, sf), texts(spark, sf), [("theme", "title", "")])
    return describe.segments(found, 3).select(F.col("Tema").alias("theme"), "area_type", "sex", "segment", "n", "text")


@query("q_titles")
def q_titles(spark, sf):
    return describe.theme_titles(text_keys(spark, sf), texts(spark, sf))


@query("q_titles_wide")
def q_titles_wide(spark, sf):
    return describe.widen(describe.theme_titles(text_keys(spark, sf), texts(spark, sf)), "theme", "titles_text", "text_")


@query("q_sources_theme")
def q_sources_theme(spark, sf):
    return describe.theme_sources(text_keys(spark, sf), texts(spark, sf))


@query("q_sources_part")
def q_sources_part(spark, sf):
    return describe.part_sources(text_keys(spark, sf), texts(spark, sf))


@query("q_sources_wide")
def q_sources_wide(spark, sf):
    return describe.part_wide(ctx.level_texts(spark, sf)).unionByName(
        describe.widen(describe.theme_sources(text_keys(spark, sf), texts(spark, sf)), "theme", "source_text", "source_")
        .withColumnRenamed("theme", "Tema")
    )


@query("q_full_outer")
def q_full_outer(spark, sf):
    t = ctx.level_texts(spark, sf)
    return describe.full_outer_levels(describe.theme_wide(t), describe.part_wide(t))


@query("q_coalesce_levels")
def q_coalesce_levels(spark, sf):
    return describe.merged_levels(ctx.level_texts(spark, sf), PART_SORTING)


@query("q_descriptions")
def q_descriptions(spark, sf):
    wide = describe.merged_levels(ctx.level_texts(spark, sf), PART_SORTING)
    return describe.describe(wide, PARTS, SUSTAINABILITY_PART, describe.sort_table(ctx.catalog(spark, sf)))


# ------------------------------------------------------- D15, D19, P1/U1
SUMMARY_COLUMNS = ["area_id", "year", "value", "inverted", "selected_year", "standard_value"]


@query("q_check_orientation")
def q_check_orientation(spark, sf):
    """Rows scored with the catalog, and again with some orientations turned."""
    turned = fixture.other_orientation(ctx.catalog(spark, sf)).select("kpi", "inverted")
    again = standardize.standardize(ctx.marked_base(spark, sf).drop("inverted").join(turned, "kpi", "left"))
    return checks.orientation_conflicts(scored(spark, sf).select("kpi", "inverted").unionByName(again.select("kpi", "inverted")))


@query("q_check_profile")
def q_check_profile(spark, sf):
    return rounded(checks.score_profile(scored(spark, sf)))


@query("q_check_summary")
def q_check_summary(spark, sf):
    return rounded(checks.column_summary(scored(spark, sf), SUMMARY_COLUMNS))


@query("q_check_catalog")
def q_check_catalog(spark, sf):
    return checks.catalog_agreement(ctx.catalog(spark, sf), ctx.base(spark, sf))


@query("q_check_catalog_tally")
def q_check_catalog_tally(spark, sf):
    return checks.catalog_agreement_tally(checks.catalog_agreement(ctx.catalog(spark, sf), ctx.base(spark, sf)))


@query("q_check_part_by_region")
def q_check_part_by_region(spark, sf):
    lv = levels(spark, sf)
    parts = hierarchy.final_level(lv, hierarchy.national_means(lv), "part")
    return rounded(checks.part_by_region(parts, PARTS[0]))


@query("q_check_national")
def q_check_national(spark, sf):
    rows = checks.national_rows(final(spark, sf))
    return rounded(rows.select(*SCORED_COLS, *FINAL_COLS))


@query("q_null_split")
def q_null_split(spark, sf):
    return rounded(checks.null_split(scored(spark, sf)).select(*SCORED_COLS))


@query("q_flat_export")
def q_flat_export(spark, sf):
    return rounded(
        export.flat_export(scored(spark, sf), fixture.region_codes(spark, sf), fixture.municipality_codes(spark, sf))
    )


@query("q_area_labels")
def q_area_labels(spark, sf):
    """Every observation with the text code of its area (U1 key, joined by name)."""
    labels = export.area_labels(fixture.municipality_codes(spark, sf))
    obs = ctx.observations(spark, sf).select("kpi", "area_name", "sex", "year")
    return obs.join(labels, "area_name", "left")


@query("q_region_lan_key")
def q_region_lan_key(spark, sf):
    """Every observation with its county name where it is a region (P1 key)."""
    key = export.region_lan_key(fixture.region_codes(spark, sf))
    obs = ctx.observations(spark, sf).select("kpi", "area_id", "area_name", "sex", "year")
    return obs.join(key, ["area_id", "area_name"], "left")


@query("q_check_unmatched")
def q_check_unmatched(spark, sf):
    """Delivered areas without a code label (municipality key)."""
    rows = ctx.marked_base(spark, sf).where(F.col("area_type").isin("K", "R"))
    return checks.unmatched_areas(rows, fixture.municipality_codes(spark, sf), "Kommun_kod")


@query("q_check_log_losses")
def q_check_log_losses(spark, sf):
    """Flagged values that the log would lose, before the log is taken."""
    imp = prepare.attach_catalog(
        ctx.imputed(spark, sf), ctx.catalog(spark, sf)
    )
    return rounded(checks.log_losses(imp))


@query("q_missing_split_lag")
def q_missing_split_lag(spark, sf):
    return standardize.missing_split(ctx.marked_base(spark, sf), "lag", 5)


@query("q_std_total_by_type")
def q_std_total_by_type(spark, sf):
    """Total mode with the latest year taken per area type (G7 option)."""
    df = standardize.standardize(ctx.marked_base(spark, sf), "total", "latest", year_scope="area_type")
    return rounded(df.select(*SCORED_COLS))


@query("q_total_region_node")
def q_total_region_node(spark, sf):
    """The published total index by region with equal weights per aspect and
    theme (the documented weighting, G10)."""
    lv = levels(spark, sf, "node")
    codes = fixture.region_codes(spark, sf)
    return rounded(hierarchy.deliver(lv, hierarchy.national_means(lv), codes, "part", "region"))


# ------------------------------------------------ files: written and read back
def _file(spark, name: str) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/tessera/files/{name}-{uuid.uuid4().hex}"


CATALOG_FILE = {
    "Sortering": "sort_order", "Indikator_ID": "kpi", "Indikator_namn": "kpi_text", "Aspekt": "aspect", "Tema": "theme", "Del": "part",
    "Omvand_skala": "inverted", "Log": "logged",
}


@query("q_file_catalog")
def q_file_catalog(spark, sf):
    """The catalog as ``;``-CSV, its columns in another order than the schema's."""
    cat = ctx.catalog(spark, sf).select(*[F.col(c).alias(n) for n, c in CATALOG_FILE.items()], F.lit("2026-03-25T00:00:00Z").alias("Tillagd_datum"))
    files.write_semicolon_csv(cat, path := _file(spark, "catalog"))
    return files.read_catalog(spark, path).select(*CATALOG_FILE.values(), F.year("added").alias("added_year"))


@query("q_file_region_codes")
def q_file_region_codes(spark, sf):
    """Codes stay text; the column with the name in the data has a name of its own."""
    codes = fixture.region_codes(spark, sf)
    out = codes.select(*reversed(codes.columns)).withColumnRenamed("Data_lan_namn", "Other_lan_namn")
    files.write_semicolon_csv(out, path := _file(spark, "regions"))
    return files.read_region_codes(spark, path, "Other_lan_namn")


@query("q_file_municipality_codes")
def q_file_municipality_codes(spark, sf):
    files.write_semicolon_csv(fixture.municipality_codes(spark, sf), path := _file(spark, "municipalities"))
    return files.read_municipality_codes(spark, path)


#: Rows of a landed file: compressed files are read whole by one task.
LANDED_ROWS = 500_000


def _land(obs: DataFrame, path: str) -> None:
    """Adds observations to the landed files, as compressed JSON with all fields."""
    writer = obs.write.mode("append").option("ignoreNullFields", "false").option("compression", "gzip")
    writer.option("maxRecordsPerFile", LANDED_ROWS).json(path)


@query("q_file_observations")
def q_file_observations(spark, sf):
    """S3: landed observations, JSON by indicator."""
    _land(ctx.observations(spark, sf), path := _file(spark, "landed"))
    good, _ = files.split_rejected(files.read_observations(spark, path, "json"))
    return rounded(good.select(*OBS_COLS))


@query("q_file_relanded")
def q_file_relanded(spark, sf):
    """S3: observations that landed twice, first with other values. The first
    table holds those; the second landing replaces them."""
    obs, folder = ctx.observations(spark, sf), _file(spark, "relanded")
    source, log, table = f"{folder}/in", f"{folder}/log", f"{folder}/table"
    for landing in (obs.withColumn("value", F.col("value") * 2 + 1), obs):
        _land(landing, source)
        land_observations(spark, source, log).awaitTermination()
        refresh_table(spark, log, table)
    return rounded(files.read_observations(spark, table).select(*OBS_COLS))


@query("q_file_rejects")
def q_file_rejects(spark, sf):
    """A catalog file with faults. Indicators without observations
    have a letter in their sort code, inverted ones a field too many, and logged
    ones a quote that is not closed."""
    cat = ctx.catalog(spark, sf)
    empty, inverted, logged = F.col("kpi").startswith("E"), F.col("inverted") == 1, F.col("logged") == 1
    name = F.when(logged & ~inverted, F.concat(F.lit('"'), "kpi_text")).otherwise(F.col("kpi_text"))
    sort = F.concat("sort_order", F.when(empty, F.lit("o")).otherwise(F.lit("")))
    log = F.coalesce(F.col("logged").cast("string"), F.lit("NA"))
    line = F.concat_ws(";", "kpi", name, "aspect", "theme", "part", "inverted", log, sort, F.lit("NA"), F.when(inverted, F.lit("more")))
    header = spark.createDataFrame([(";".join(f.name for f in schemas.INDICATOR_FILE),)], "value string")
    # a start file is one small file: the header, then a line for each indicator
    lines = header.withColumn("at", F.lit(0)).unionByName(cat.select(line.alias("value"), F.lit(1).alias("at")))
    lines.coalesce(1).sortWithinPartitions("at").select("value").write.text(path := _file(spark, "faults"))
    found = files.csv_rejects(spark, path, schemas.INDICATOR_FILE)
    return found.select("line", "column", "reason").unionByName(
        files.read_catalog(spark, path).select(F.col("kpi").alias("line"), F.lit("taken").alias("column"), F.col("sort_order").cast("string").alias("reason"))
    )


@query("q_observed")
def q_observed(spark, sf):
    """What the writes of the base table and the scores count themselves."""
    seen = files.write_table(ctx.base(spark, sf), _file(spark, "base"), metrics=checks.base_metrics())
    seen |= files.write_table(scored(spark, sf), _file(spark, "scores"), partition_by=(), metrics=checks.score_metrics())
    missing = standardize.missing_split(ctx.marked_base(spark, sf))
    seen |= files.write_table(missing, _file(spark, "missing"), partition_by=(), metrics={"missing_sexes": F.count(F.lit(1))})
    return spark.createDataFrame([(name, int(n)) for name, n in seen.items()], "metric string, n long")


@query("q_file_base")
def q_file_base(spark, sf):
    """The base table by indicator."""
    files.write_table(ctx.base(spark, sf), path := _file(spark, "base"))
    return rounded(files.read_table(spark, path).select(*BASE_COLS, *CAT_COLS))


@query("q_file_exchange")
def q_file_exchange(spark, sf):
    """The base table as compressed ``;``-CSV with decimal commas."""
    base = ctx.base(spark, sf).select(*BASE_COLS, *CAT_COLS)
    files.write_semicolon_csv(base, path := _file(spark, "exchange"), compression="gzip")
    return rounded(files.read_semicolon_csv(spark, path, base.schema, ["value", "value_mean_group"]))


@query("q_file_final")
def q_file_final(spark, sf):
    """The final table."""
    files.write_table(final(spark, sf).select(*SCORED_COLS, *FINAL_COLS), path := _file(spark, "final"), partition_by=())
    return rounded(files.read_table(spark, path))


def _published(spark, table: DataFrame, name: str, single_file: bool) -> DataFrame:
    files.write_semicolon_csv(table, path := _file(spark, name), single_file=single_file)
    doubles = [f.name for f in table.schema.fields if isinstance(f.dataType, T.DoubleType)]
    return rounded(files.read_semicolon_csv(spark, path, table.schema, doubles))


@query("q_file_delivery")
def q_file_delivery(spark, sf):
    """A publication table as sorted ``;``-CSV files, as municipalities grow."""
    lv = levels(spark, sf)
    codes = fixture.municipality_codes(spark, sf)
    return _published(spark, hierarchy.deliver(lv, hierarchy.national_means(lv), codes, "theme", "municipality"), "delivery", False)


@query("q_file_descriptions")
def q_file_descriptions(spark, sf):
    """The descriptions as one ``;``-CSV file."""
    return _published(spark, q_descriptions(spark, sf), "descriptions", True)


@query("q_file_texts")
def q_file_texts(spark, sf):
    """Landed texts, read and attributed."""
    fixture.indicator_texts(spark, sf).select("kpi", "title", "description").write.parquet(path := _file(spark, "texts"))
    return describe.attribution(files.read_texts(spark, path), marker=fixture.SOURCE_MARKER).groupBy("kpi", "title", "source").agg(
        F.count("*").alias("n")
    )


@query("q_stamp")
def q_stamp(spark, sf):
    """The date of the run as text."""
    return prepare.stamp(ctx.base(spark, sf), "2026-01-09").select("kpi", "area_id", "sex", "year", "fetched")


@query("q_check_categories")
def q_check_categories(spark, sf):
    """The catalog's categories against a list that lacks those of the indicators without data."""
    cat = ctx.catalog(spark, sf)
    return checks.category_agreement(cat, cat.where(F.col("kpi").startswith("I")))
