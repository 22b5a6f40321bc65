"""Materialized index inputs, built once per session and data folder.

The observation fixture is the only stage that reads the large driver
tables; it is written to the shared folder (``spark.checkpoint.dir``) once,
and so is the imputed base table, which is the reference's own hand-off
between its steps. Downstream queries start from these small tables, so a
lost executor re-reads a file instead of re-running the lineitem joins.
"""

from __future__ import annotations

import threading

from pyspark.sql import DataFrame, SparkSession

from tessera.operators import describe, hierarchy, prepare, standardize
from tessera.session import materialize, materialize_with
from tessera.sources import fixture

_LOCK = threading.Lock()
_CACHE: dict[tuple, DataFrame] = {}


SOURCES = ("lineitem", "part", "supplier", "nation", "documents")


def _stamp(spark: SparkSession, sf_dir: str) -> tuple:
    """Size and time of change of each source table, so that a changed folder
    is built anew."""
    out = []
    for t in SOURCES:
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
        if fs.exists(path):
            out.append((t, fs.getContentSummary(path).getLength(), fs.getFileStatus(path).getModificationTime()))
    return tuple(out)


def _key(spark: SparkSession, sf_dir: str, name: str) -> tuple:
    return (spark.sparkContext.applicationId, sf_dir.rstrip("/"), name, _stamp(spark, sf_dir))


def _cached(spark: SparkSession, sf_dir: str, name: str, build, write=materialize) -> DataFrame:
    k = _key(spark, sf_dir, name)
    with _LOCK:
        df = _CACHE.get(k)
    if df is None:
        df = write(build(), name)
        with _LOCK:
            _CACHE[k] = df
    return df


def clear() -> None:
    with _LOCK:
        _CACHE.clear()


def observations(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """Raw observations of the fixture (of materialized cells): all of them, or
    with the gaps of its nation, which grid and imputation fill."""
    cells = _cached(
        spark,
        sf_dir,
        "obs",
        lambda: fixture.municipality_cells(spark, sf_dir),
        lambda df, name: materialize_with(df, name, fixture.region_cells),
    )
    return fixture.observations_of(cells, gaps)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixture.catalog(spark, sf_dir)


def imputed(spark: SparkSession, sf_dir: str, mode: str = "reference", gaps: bool = True) -> DataFrame:
    """Imputed observations, before catalog and logs (not materialized)."""
    return prepare.impute(observations(spark, sf_dir, gaps), mode, divisor=fixture.COUNTY_DIVISOR)


def base(spark: SparkSession, sf_dir: str, mode: str = "reference") -> DataFrame:
    """Imputed base with catalog and logs; the nation still has type L."""
    return _cached(
        spark,
        sf_dir,
        f"base_{mode}",
        lambda: prepare.build_base(
            observations(spark, sf_dir), catalog(spark, sf_dir), mode, divisor=fixture.COUNTY_DIVISOR
        ),
    )


def marked_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base with the nation marked ``R`` (input of scoring)."""
    return prepare.mark_national(base(spark, sf_dir))


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows scored against the total sex in the latest year (materialized)."""
    return scored_cells(spark, sf_dir).drop(hierarchy.CELL)


def _hand_over(spark: SparkSession, sf_dir: str):
    """Writes a table in buckets; the base's rows, which its files' footers count, bound the scores."""
    return lambda df, name: hierarchy.hand_over(df, name, hierarchy.buckets_for(base(spark, sf_dir).count()))


def scored_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scored rows with their cell, bucketed by it."""
    return _cached(spark, sf_dir, "scored", lambda: standardize.standardize(marked_base(spark, sf_dir)), _hand_over(spark, sf_dir))


def final_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The roll-up with its final means, in the buckets of the scored rows."""

    def build() -> DataFrame:
        levels = hierarchy.Levels(grain(spark, sf_dir))
        return hierarchy.final_grain(levels, hierarchy.national_means(levels))

    return _cached(spark, sf_dir, "finals", build, _hand_over(spark, sf_dir))


def grain(spark: SparkSession, sf_dir: str, weighting: str = "row") -> DataFrame:
    """The roll-up of the scored rows, a row per area, sex and aspect (materialized)."""
    return _cached(spark, sf_dir, f"grain_{weighting}", lambda: hierarchy.roll_up(scored(spark, sf_dir), weighting).grain)


def attributed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator texts with their source."""
    return describe.attribution(fixture.indicator_texts(spark, sf_dir), marker=fixture.SOURCE_MARKER)


def index_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (kpi, theme, part, area_type, sex) of the base table (materialized)."""
    return _cached(spark, sf_dir, "index_keys", lambda: describe.index_keys(base(spark, sf_dir)))


def level_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The joined titles and sources of all themes and parts (materialized)."""
    return _cached(spark, sf_dir, "level_texts", lambda: describe.level_texts(index_keys(spark, sf_dir), text_triples(spark, sf_dir)))


def text_triples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct (kpi, title, source) of the texts (materialized)."""
    return _cached(spark, sf_dir, "text_triples", lambda: describe.text_triples(attributed(spark, sf_dir)))
