"""The yearly run over files, in the reference's three steps.

1. ``build_base_table``: landed observations + indicator catalog → base
   table (span, completion and imputation, catalog, logs), written as
   Parquet partitioned by indicator.
2. ``publish_index``: base table + code keys → the four publication tables
   (total and theme index, by municipality and by region), written as
   ``;``-CSV with decimal commas; the row-level final table as Parquet.
3. ``publish_descriptions``: base table + indicator texts + catalog → the
   description table, written as ``;``-CSV.

Each step reads what the previous one wrote, so a failed step is re-run
from files, not from the start.
"""

from __future__ import annotations

import datetime as _dt
import logging

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import checks, describe, hierarchy, prepare, standardize
from tessera.schemas import COUNTY_DIVISOR, INDICATOR_FILE, MUNICIPALITY_CODE_FILE, REGION_DATA_NAME
from tessera.session import materialize
from tessera.sources import files

# File names of the publication tables ({year} = stamp year,
# {prefix} = whatever the receiver of the files wants in front of the name).
PUBLICATION_FILES = {
    ("part", "municipality"): "1.{prefix}totalindex_kommun{year}",
    ("theme", "municipality"): "2.{prefix}temaindex_kommun{year}",
    ("part", "region"): "3.{prefix}totalindex_region{year}",
    ("theme", "region"): "4.{prefix}temaindex_region{year}",
}
_log = logging.getLogger(__name__)
DESCRIPTION_FILE = "tema_desc"


def build_base_table(
    spark: SparkSession,
    observations_path: str,
    catalog_path: str,
    out_path: str,
    mode: str = "reference",
    run_date: _dt.date | str | None = None,
    observations_format: str = "parquet",
    county_divisor: int = COUNTY_DIVISOR,
) -> DataFrame:
    """Step 1: observations → base table at ``out_path`` (Parquet by ``kpi``).

    Of an observation that landed more than once the newest version counts.
    Beside the table stand ``<out_path>_empty``, the catalog's indicators without
    any value, and ``<out_path>_rejected``: observation records that did not
    parse, and lines and cells of the catalog that are not taken over. Both are
    counted in the log.
    """
    landed = files.newest(files.read_observations(spark, observations_path, observations_format, landed=True))
    # one version of each, handed over once: the base table and the two reports read it
    landed = materialize(landed.drop(files.LANDED), "landed")
    obs, broken = files.split_rejected(landed)
    catalog = files.read_catalog(spark, catalog_path)
    base = prepare.build_base(obs, catalog, mode, run_date=run_date or _dt.date.today(), divisor=county_divisor)
    seen = files.write_table(base, out_path, metrics=checks.base_metrics())
    _log.info("base table: %s", seen)
    _report(prepare.empty_indicators(catalog, obs), f"{out_path}_empty", "indicators without a value")
    rejected = files.csv_rejects(spark, catalog_path, INDICATOR_FILE)
    if broken is not None:
        lines = broken.select(F.lit(observations_path).alias("file"), F.col(files.CORRUPT).alias("line"))
        rejected = rejected.unionByName(lines.withColumn("reason", F.lit(files.NOT_A_RECORD)), allowMissingColumns=True)
    _report(rejected, f"{out_path}_rejected", "records that were not taken over")
    return files.read_table(spark, out_path)


def _report(rows: DataFrame, path: str, what: str) -> int:
    """Write ``rows``; how many there are, the write itself counts and logs."""
    n = files.write_table(rows, path, partition_by=(), metrics={"rows": F.count("*")})["rows"]
    (_log.warning if n else _log.info)("%d %s, in %s", n, what, path)
    return n


def publish_index(
    spark: SparkSession,
    base_path: str,
    municipality_codes_path: str,
    region_codes_path: str,
    out_dir: str,
    stamp_year: int,
    split_mode: str = "total",
    year_mode: str = "latest",
    lag: int = 5,
    weighting: str = "row",
    year_scope: str = "kpi",
    validate: bool = False,
    file_prefix: str = "",
    region_data_name: str = REGION_DATA_NAME,
) -> dict[str, DataFrame]:
    """Step 2: base table → four publication tables under ``out_dir``.

    Returns the tables by file name; ``final`` (row level) is written as
    Parquet next to them, and the run's checks under ``checks/``: indicators
    scored with both orientations, the score profile, missing sexes, the
    areas of each geography without a code, lines and cells of the code keys that
    are not taken over, and ``observed``: what the writes themselves counted.
    """
    base = prepare.mark_national(files.read_table(spark, base_path))
    # all outputs read the scores: computed once, handed over as a table; the final table joins it as it lies
    buckets = hierarchy.buckets_for(base.count())
    cells = hierarchy.hand_over(standardize.standardize(base, split_mode, year_mode, lag, year_scope, validate), "scored", buckets)
    scored = cells.drop(hierarchy.CELL)
    levels = hierarchy.Levels(materialize(hierarchy.roll_up(scored, weighting).grain, "levels"))
    national = hierarchy.national_means(levels)
    finals = hierarchy.hand_over(hierarchy.final_grain(levels, national), "finals", buckets)
    seen = files.write_table(hierarchy.join_finals(cells, finals), f"{out_dir}/final", partition_by=(), metrics=checks.score_metrics())
    _log.info("final table: %s", seen)
    codes = {
        "municipality": files.read_municipality_codes(spark, municipality_codes_path),
        "region": files.read_region_codes(spark, region_codes_path, region_data_name),
    }
    found = {
        "orientation": checks.orientation_conflicts(scored),
        "missing_split": standardize.missing_split(base, year_mode, lag),
        "unmatched_municipality": checks.unmatched_areas(base.where("area_type = 'K'"), codes["municipality"], "Kommun_kod"),
        "rejected": files.csv_rejects(spark, municipality_codes_path, MUNICIPALITY_CODE_FILE).unionByName(
            files.csv_rejects(spark, region_codes_path, files.region_code_file(region_data_name))
        ),
        "unmatched_region": checks.unmatched_areas(base.where("area_type = 'L'"), codes["region"], "Lan_kod"),
    }
    counts = {f"check_{name}": _report(rows, f"{out_dir}/checks/{name}", f"rows of the check {name}") for name, rows in found.items()}
    # the run's numbers, all taken from the writes above
    numbers = [(name, float(n)) for name, n in {**seen, **counts}.items()]
    files.write_table(spark.createDataFrame(numbers, "metric string, value double"), f"{out_dir}/checks/observed", partition_by=())
    files.write_table(checks.score_profile(scored), f"{out_dir}/checks/profile", partition_by=())
    out = {}
    for (level, geo), name in PUBLICATION_FILES.items():
        table = hierarchy.deliver(levels, national, codes[geo], level, geo)
        fname = name.format(year=stamp_year, prefix=file_prefix)
        # municipalities grow with the data: their sorted table is written in parts, each with the header
        files.write_semicolon_csv(table, f"{out_dir}/{fname}", single_file=geo != "municipality")
        out[fname] = table
    return out


def publish_descriptions(
    spark: SparkSession,
    base_path: str,
    texts_path: str,
    catalog_path: str,
    out_dir: str,
    sustainability_part: str,
    marker: str = describe.MARKER,
    texts_format: str = "parquet",
) -> DataFrame:
    """Step 3: base table + texts → description table under ``out_dir``.

    Parts and their sort codes come from the catalog; ``sustainability_part``
    names the part described with the sustainability text.
    """
    base = files.read_table(spark, base_path)
    catalog = files.read_catalog(spark, catalog_path)
    texts = describe.attribution(files.read_texts(spark, texts_path, texts_format), marker=marker)
    keys = materialize(describe.index_keys(base), "index_keys")
    texts = materialize(describe.text_triples(texts), "text_triples")
    sorting = describe.sort_table(catalog)
    parts = catalog.select(F.col("part").alias("Tema")).distinct()
    part_sorting = sorting.join(parts, "Tema")
    wide = describe.merged_levels(materialize(describe.level_texts(keys, texts), "level_texts"), part_sorting)
    table = describe.describe(wide, parts, sustainability_part, sorting)
    files.write_semicolon_csv(table, f"{out_dir}/{DESCRIPTION_FILE}", single_file=True)
    return table
