"""Roll-up, national means, final values and delivery tables.

The reference attaches group means to every row with windowed ``mutate``;
here rows are first aggregated to one row per area × sex × aspect, with
partial aggregation absorbing hot keys, and the levels are windows over these
few rows. Row-level values are only rebuilt where a row table is the result
(``finalize``).
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.expr import case_when, cut_after_dash, if_else, paste, recode
from tessera.functions.joins import join_ns
from tessera.schemas import NATION_LABEL, SEX_LABELS
from tessera.session import materialize_bucketed

AREA = ["area_id", "area_name", "area_type"]
LEVEL_KEYS = {
    "aspect": ["part", "theme", "aspect"],
    "theme": ["part", "theme"],
    "part": ["part"],
}


@dataclass
class Levels:
    """Means of one roll-up. ``grain`` has a row per area, sex and aspect with
    the means of its aspect, theme and part, and marks one row of each theme
    and part; the three level tables are selections of it."""

    grain: DataFrame

    @property
    def aspect(self) -> DataFrame:
        return self.grain.select(*AREA, "sex", *LEVEL_KEYS["aspect"], "n_rows", "mean_aspect")

    @property
    def theme(self) -> DataFrame:
        rows = self.grain.where("first_of_theme")
        return rows.select(*AREA, "sex", *LEVEL_KEYS["theme"], F.col("n_theme").alias("n_rows"), "mean_theme")

    @property
    def part(self) -> DataFrame:
        rows = self.grain.where("first_of_part")
        return rows.select(*AREA, "sex", *LEVEL_KEYS["part"], F.col("n_part").alias("n_rows"), "mean_part")

    def get(self, level: str) -> DataFrame:
        return {"aspect": self.aspect, "theme": self.theme, "part": self.part}[level]


def _mean_over_rows(n, m, w: Window):
    """Mean over rows when each of ``n`` rows carries mean ``m`` (NULLs skipped)."""
    return F.sum(F.when(m.isNotNull(), n * m)).over(w) / F.sum(F.when(m.isNotNull(), n)).over(w)


def roll_up(scored: DataFrame, weighting: str = "row") -> Levels:
    """Aspect, theme and part means per area and sex.

    ``weighting="row"`` is what the reference runs: a theme mean is the mean
    of its aspect means over indicator rows, so an aspect weighs as much as
    it has rows (G10). ``weighting="node"`` gives every aspect (and every
    theme in a part) equal weight, as the reference documents.

    Plan: rows are combined to aspect means before any shuffle, so duplicated
    rows of one area cannot pile up in one task. What is left of an area and
    sex has at most as many rows as the catalog has aspects; these are brought
    together once, and the two upper levels are windows over them.
    """
    if weighting not in ("row", "node"):
        raise ValueError(f"unknown weighting: {weighting!r}")
    by = [*AREA, "sex"]
    aspect = scored.groupBy(*by, *LEVEL_KEYS["aspect"]).agg(
        F.count(F.lit(1)).alias("n_rows"), F.avg("standard_value").alias("mean_aspect")
    )
    in_theme, in_part = Window.partitionBy(*by, *LEVEL_KEYS["theme"]), Window.partitionBy(*by, *LEVEL_KEYS["part"])
    rows = aspect.repartition(*by)
    n = F.col("n_rows")
    if weighting == "row":
        theme = _mean_over_rows(n, F.col("mean_aspect"), in_theme)
        part = _mean_over_rows(n, F.col("mean_theme"), in_part)
    else:
        theme = F.avg("mean_aspect").over(in_theme)
        part = F.avg(F.when(F.col("first_of_theme"), F.col("mean_theme"))).over(in_part)
    rows = rows.withColumns({
        "n_theme": F.sum(n).over(in_theme),
        "mean_theme": theme,
        "first_of_theme": F.row_number().over(in_theme.orderBy("aspect")) == 1,
    })
    rows = rows.withColumns({
        "n_part": F.sum(n).over(in_part),
        "mean_part": part,
        "first_of_part": F.row_number().over(in_part.orderBy("theme", "aspect")) == 1,
    })
    return Levels(rows)


@dataclass
class National:
    """Nation-wide means of a roll-up, from regions and from municipalities."""

    levels: Levels

    def get(self, level: str) -> DataFrame:
        """Means of one level (A10/A11): a mean is NULL where that area type
        has no row; ``n_region``/``n_municipal`` count the areas behind it."""
        t, m = F.col("area_type"), F.col(f"mean_{level}")
        rows = self.levels.get(level).where(t.isin("L", "K"))
        return rows.groupBy(*LEVEL_KEYS[level], "sex").agg(
            F.avg(F.when(t == "L", m)).alias(f"nat_region_{level}"),
            F.count(F.when(t == "L", 1)).alias("n_region"),
            F.avg(F.when(t == "K", m)).alias(f"nat_municipal_{level}"),
            F.count(F.when(t == "K", 1)).alias("n_municipal"),
        )

    def grain(self) -> DataFrame:
        """The means of all three levels per aspect and sex, from one
        aggregate: sums of the upper levels are taken over the rows that stand
        for their node, and added up by windows over the (few) nodes."""
        t = F.col("area_type")
        marks = {"aspect": F.lit(True), "theme": F.col("first_of_theme"), "part": F.col("first_of_part")}
        sums = []
        for level, mark in marks.items():
            for geo, kind in (("region", "L"), ("municipal", "K")):
                m = F.when(mark & (t == kind), F.col(f"mean_{level}"))
                sums += [F.sum(m).alias(f"_s_{geo}_{level}"), F.count(m).alias(f"_n_{geo}_{level}")]
        rows = self.levels.grain.where(t.isin("L", "K")).groupBy(*LEVEL_KEYS["aspect"], "sex").agg(*sums)
        rows = rows.repartition("part", "sex")
        out = []
        for level in marks:
            w = Window.partitionBy(*LEVEL_KEYS[level], "sex")
            for geo in ("region", "municipal"):
                mean = F.sum(f"_s_{geo}_{level}").over(w) / F.nullif(F.sum(f"_n_{geo}_{level}").over(w), F.lit(0))
                out.append(mean.alias(f"nat_{geo}_{level}"))
        return rows.select(*LEVEL_KEYS["aspect"], "sex", *out)


def national_means(levels: Levels) -> National:
    """Nation-wide means from regions and from municipalities."""
    return National(levels)


def _finals(rows: DataFrame, nat: DataFrame, keys: list[str], level_names: list[str]) -> DataFrame:
    """``rows`` with own means, or the national ones on the nation's rows."""
    is_r = F.col("area_type") == "R"
    joined = join_ns(rows, nat, keys, "left")
    return joined.select(
        *rows.columns,
        *[
            if_else(is_r, F.col(f"nat_{g}_{lv}"), F.col(f"mean_{lv}")).alias(f"mean_{g}_{lv}_final")
            for lv in level_names
            for g in ("region", "municipal")
        ],
    )


def final_level(levels: Levels, national: National, level: str) -> DataFrame:
    """One level: own mean, or the national mean on the nation's rows."""
    keys = [*LEVEL_KEYS[level], "sex"]
    nat = national.get(level).select(*keys, f"nat_region_{level}", f"nat_municipal_{level}")
    return _finals(levels.get(level), nat, keys, [level])


def final_grain(levels: Levels, national: National) -> DataFrame:
    """The roll-up with its six final means, a row per area, sex and aspect."""
    return _finals(levels.grain, national.grain(), [*LEVEL_KEYS["aspect"], "sex"], ["aspect", "theme", "part"])


def finalize(scored: DataFrame, levels: Levels, national: National) -> DataFrame:
    """Row-level final table: scored rows + six final means.

    The finals are assembled at aspect grain (a row per area, sex and aspect),
    then joined to the rows once; a hot key on the row side is split by AQE's
    skew join rather than sent to one task.
    """
    keys = [*LEVEL_KEYS["aspect"], "sex"]
    grain = final_grain(levels, national)
    finals = [c for c in grain.columns if c.endswith("_final")]
    return join_ns(scored, grain.select(*AREA, *keys, *finals), [*AREA, *keys], "left")


#: Column of a handed-over table that names the cell (area, sex, aspect) of a row.
CELL = "cell"
#: Rows of the scores that one bucket of a hand-over holds on average.
ROWS_PER_BUCKET = 1_000_000
MAX_BUCKETS = 50_000


def buckets_for(rows: int) -> int:
    """Buckets of a hand-over of so many rows."""
    return min(max(4, math.ceil(rows / ROWS_PER_BUCKET)), MAX_BUCKETS)


def hand_over(df: DataFrame, name: str, buckets: int) -> DataFrame:
    """Write scores or a roll-up for the steps after it, bucketed by ``CELL``.

    The cell is a text of the area, sex and aspect in which NULLs differ from
    any value, so that an ordinary equality of one column is the null-safe
    equality of all keys, which is what buckets can serve. A cell of the scores
    holds the indicators of one aspect, so no bucket gets a hot key: areas,
    sexes, themes and parts with many rows are spread over their cells."""
    cell = F.to_json(F.struct(*AREA, "sex", *LEVEL_KEYS["aspect"]))
    return materialize_bucketed(df.withColumn(CELL, cell), name, CELL, buckets)


def join_finals(scored: DataFrame, finals: DataFrame) -> DataFrame:
    """As ``finalize``, from scores and ``final_grain`` that were handed over
    in equal buckets: neither side is shuffled."""
    means = [c for c in finals.columns if c.endswith("_final")]
    return scored.join(finals.select(CELL, *means), CELL, "left").drop(CELL)


GEOGRAPHIES = {
    # geography: (area types, final column prefix, code, padded code, name)
    "municipality": (("K", "R"), "municipal", "Kommun_kod", "Kommun_kod_S", "Kommun_namn"),
    "region": (("L", "R"), "region", "Lan_kod", "Lan_kod_S", "Lan_Namn"),
}


def deliver(
    levels: Levels,
    national: National,
    codes: DataFrame,
    level: str = "part",
    geography: str = "region",
    sort: bool = True,
) -> DataFrame:
    """Publication table (D14): ``Region, Del, Kon, [Tema,] Varde_stand``.

    ``codes`` is the code key of the geography (municipality or region
    layout). Only the nation (area type R) is labelled as the nation; another
    area whose id has no code is published under its own name, and listed by
    ``checks.unmatched_areas`` (G12). Themes are sorted by full text, then cut at
    ``" - "`` (G21).
    """
    if level not in ("part", "theme"):
        raise ValueError(f"unknown delivery level: {level!r}")
    if geography not in GEOGRAPHIES:
        raise ValueError(f"unknown geography: {geography!r}")
    types, prefix, code, code_s, name = GEOGRAPHIES[geography]
    keys = LEVEL_KEYS[level]
    # one row per (area, node, sex) already: the reference's distinct() is implied
    rows = final_level(levels, national, level).where(F.col("area_type").isin(*types)).select(
        "area_id", "area_name", "area_type", *keys, "sex", F.col(f"mean_{prefix}_{level}_final").alias("Varde_stand")
    )
    key = codes.select(F.col(code).alias("_code"), F.col(code_s).alias("_code_s"), F.col(name).alias("_name"))
    joined = rows.withColumn("_code", F.col("area_id").cast("string")).join(key, "_code", "left")
    label = case_when(
        (F.col("area_type") == "R", F.lit(NATION_LABEL)),
        (F.col("_code_s").isNull(), F.col("area_name")),
        default=paste(F.col("_code_s"), F.col("_name"), sep=" "),
    )
    out = joined.select(
        label.alias("Region"),
        F.col("part").alias("Del"),
        recode(F.col("sex"), SEX_LABELS).alias("Kon"),
        *([F.col("theme").cast("string").alias("_tema_full")] if level == "theme" else []),
        "Varde_stand",
    )
    order = ["Region", "Del", "Kon"] + (["_tema_full"] if level == "theme" else [])
    if sort:
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in order])
    if level == "theme":
        out = out.select("Region", "Del", "Kon", cut_after_dash(F.col("_tema_full")).alias("Tema"), "Varde_stand")
    return out
