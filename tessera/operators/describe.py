"""Indicator texts to published descriptions.

Texts are reduced before they meet the (small) index keys: the source is
extracted per text row on the map side, then only distinct (indicator, title,
source) travel through the shuffle. One reduction then gives the titles and
sources of every theme and part (``level_members``), whatever their number:
their order comes from range partitions, so no task holds the members of a
group, and they are joined in segments of a bounded number (``segments``). The
published strings join a group's segments, and are as long as these.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.columns import map_prefixed, prefixed, select_prefixed
from tessera.functions.expr import NOT_EOL, WS, case_when, ensure_period, if_else, paste, recode, squish
from tessera.functions.joins import join_ns
from tessera.session import materialize

# Fixed values of the reference's texts (must be equal for equal output).
MARKER = "Källa"
SOURCE_ALIASES = {"SCB och Skolverket": "Skolverket och SCB"}
REGION_INDEX = "Regionindex"
MUNICIPAL_INDEX = "Kommunindex"
REGION_THEME_INDEX = "Regionindex för tema"
MUNICIPAL_THEME_INDEX = "Kommunindex för tema"
WOMEN_PREFIX = "Kvinnors"
MEN_PREFIX = "Mäns"
BASED_ON = "baseras på indikatorerna"
SOURCE_LABEL = "Källa:"
QUALITY_OF_LIFE_DESC = (
    "är en sammanvägning av samtliga ingående teman som mäter livskvalitet. Ingående indikatorer "
    "normaliseras så att samtliga regioners värden placeras på en skala från 0 till 100 där 0 är sämst "
    "och 100 är bäst (för vissa indikatorer används inverterad skala). I nästa steg vägs de "
    "standardiserade indikatorvärdena samman till index på aspektnivå. Detta görs med medelvärden, "
    "samtliga indikatorer vägs samman med samma vikt inom respektive aspekt. Värdena hamnar även på "
    "denna nivå i intervallet 0 till 100. Därefter vägs indexet på aspektnivå ihop till temanivå enligt "
    "samma princip och även dessa värden hamnar mellan 0 och 100. Slutligen vägs värdet för samtliga "
    "teman ihop enligt samma princip, med samma vikt, till ett sammantaget index för livskvalitet."
)
SUSTAINABILITY_DESC = (
    "är en sammanvägning av samtliga ingående teman som mäter hållbarhet. Ingående indikatorer "
    "normaliseras så att samtliga regioners värden placeras på en skala från 0 till 100 där 0 är sämst "
    "och 100 är bäst (för vissa indikatorer används inverterad skala). I nästa steg vägs de "
    "standardiserade indikatorvärdena samman till index på aspektnivå. Detta görs med medelvärden, "
    "samtliga indikatorer vägs samman med samma vikt inom respektive aspekt. Värdena hamnar även på "
    "denna nivå i intervallet 0 till 100. Därefter vägs indexet på aspektnivå ihop till temanivå enligt "
    "samma princip och även dessa värden hamnar mellan 0 och 100. Slutligen vägs värdet för samtliga "
    "teman ihop enligt samma princip, med samma vikt, till ett sammantaget index för hållbarhet."
)
INDICATOR_DESC = (
    "Nyckeltalen normaliseras så att samtliga regioners värden placeras på en skala från 0 till 100 där "
    "0 är sämst och 100 är bäst (för vissa indikatorer används inverterad skala). I nästa steg vägs de "
    "normaliserade indikatorvärdena samman till index på aspektnivå. Detta görs med medelvärden, "
    "samtliga indikatorer vägs samman med samma vikt inom respektive aspekt. Därefter vägs indexet på "
    "aspektnivå ihop till temanivå enligt samma princip och även dessa värden hamnar mellan 0 och 100. "
    "Viktningen är lika stor för samtliga aspekter inom temat."
)
NA_REMNANTS = " NA | NA|NA |^NA$"
INFO_PREFIX = "Information"
# Geography and sex columns of the wide tables and the description columns.
AREA_TYPES = ("K", "L")
SEX_ORDER = ("T", "K", "M")
DESCRIPTION_COLUMNS = {
    ("L", "T"): "Information_regionindex_totalt",
    ("L", "K"): "Information_regionindex_kvinnor",
    ("L", "M"): "Information_regionindex_män",
    ("K", "T"): "Information_kommunindex_totalt",
    ("K", "K"): "Information_kommunindex_kvinnor",
    ("K", "M"): "Information_kommunindex_män",
}

_META = set(".^$*+?()[]{}|\\")


def regex_quote(s: str) -> str:
    return "".join("\\" + ch if ch in _META else ch for ch in s)


# ------------------------------------------------------------ D16 source
def extract_source(text, marker: str = MARKER, aliases: Mapping[str, str] = SOURCE_ALIASES):
    """Source attribution from a description text.

    First the rest of the line after ``marker:``, else after ``marker``
    followed by any of ``:- `` and whitespace; NULL when the marker is
    absent, ``""`` when nothing follows it (as in the reference). The result
    is cleaned: escaped and real newlines to spaces, dots removed, a leading
    marker removed, ``//n`` to a space, whitespace squished; then aliases.
    """
    m = regex_quote(marker)
    # literal substring tests first: the regexes only run on texts that hold the marker
    try1 = F.when(text.contains(f"{marker}:"), F.regexp_extract(text, f"{m}:({NOT_EOL}*)", 1))
    try2 = F.when(text.contains(marker), F.regexp_extract(text, f"{m}([-:{WS}]*{NOT_EOL}*)", 1))
    raw = F.coalesce(try1, try2)
    s = F.regexp_replace(raw, r"\\n", " ")
    s = F.regexp_replace(s, r"\n", " ")
    s = F.regexp_replace(s, r"\.", "")
    s = F.regexp_replace(s, f"^[{WS}]*{m}[-:{WS}]*", "")
    s = F.regexp_replace(s, "//n", " ")
    return recode(squish(s), aliases)


def attribution(texts: DataFrame, text_col: str = "description", marker: str = MARKER) -> DataFrame:
    """Add ``source`` extracted from ``text_col`` (D16); map side only."""
    return texts.withColumn("source", extract_source(F.col(text_col), marker))


# ----------------------------------------------------- D17 collapse, widen
def index_keys(base: DataFrame) -> DataFrame:
    """Distinct (kpi, theme, part, area_type, sex) of the base table."""
    return base.select("kpi", F.col("theme").cast("string").alias("theme"), "part", "area_type", "sex").distinct()


def collapse_by_group(df: DataFrame, keys: Sequence[str], col: str, out: str, sep: str = ", ") -> DataFrame:
    """Distinct ``col`` values joined by ``sep`` per group.

    A group containing a NULL value gives NULL, as R's ``str_c`` does (G16).
    Values are joined in sorted order (the reference's order of first
    appearance has no meaning on a distributed table).
    """
    # collect_set de-duplicates (map-side too); the guard only tests whether a
    # NULL is present, which duplicates do not change, so no distinct() first
    return df.groupBy(*keys).agg(
        F.when(F.count(F.lit(1)) == F.count(col), F.array_join(F.array_sort(F.collect_set(col)), sep)).alias(out)
    )


def widen(long: DataFrame, key: str, value: str, prefix: str, types=AREA_TYPES, sexes=SEX_ORDER) -> DataFrame:
    """Long → wide on (area_type, sex) with a prefix (U4): ``{prefix}{type}_{sex}``.

    The pivot values are fixed, so no extra pass over the data is needed to
    find them; an absent combination is an all-NULL column.
    """
    values = [f"{t}_{s}" for t in types for s in sexes]
    k = F.concat_ws("_", F.col("area_type"), F.col("sex"))
    wide = long.withColumn("_k", k).groupBy(key).pivot("_k", values).agg(F.max(value))
    return wide.select(key, *[F.col(v).alias(f"{prefix}{v}") for v in values])


def text_triples(attributed: DataFrame) -> DataFrame:
    """Distinct (kpi, title, source) of the texts: the one reduction of the
    text table that every later step reads (one scan, partial aggregation)."""
    return attributed.select("kpi", "title", "source").distinct()


#: What the members of a level are: (level, column, kind of text).
MEMBERS = (("theme", "title", "text"), ("theme", "source", "source"), ("part", "source", "source"))
GROUP = ("level", "Tema", "kind", "area_type", "sex")
#: Members that are joined into one segment.
SEGMENT = 1_000


def level_members(keys: DataFrame, attributed: DataFrame, wanted: Sequence[tuple[str, str, str]] = MEMBERS) -> DataFrame:
    """``(level, Tema, kind, area_type, sex, member)``: the distinct titles and
    sources of every theme and part, a row each; NULL where an indicator has
    none. One join and one shuffle for all of them.

    The texts stay on the large side of the join: the index keys (indicators ×
    area types × sexes, bounded by the catalog) are the side that a planner
    can broadcast. Indicators without texts join them as a row of NULLs."""
    cols = sorted({col for _, col, _ in wanted})
    own = keys.select("kpi", "theme", "part", "area_type", "sex")
    texts = attributed.select("kpi", *cols).distinct()
    bare = own.select("kpi").distinct().join(texts.select("kpi").distinct(), "kpi", "left_anti")
    texts = texts.unionByName(bare, allowMissingColumns=True)
    kinds = [
        F.struct(F.lit(level).alias("level"), F.col(level).alias("Tema"), F.lit(kind).alias("kind"), F.col(col).alias("member"))
        for level, col, kind in wanted
    ]
    each = texts.join(own, "kpi").select("area_type", "sex", F.inline(F.array(*kinds)))
    return each.where(F.col("Tema").isNotNull()).select(*GROUP, "member").distinct()


def members(keys: DataFrame, attributed: DataFrame, level: str, col: str) -> DataFrame:
    """``(level, area_type, sex, col)``: ``level_members`` of one level and column."""
    found = level_members(keys, attributed, [(level, col, "")])
    return found.select(F.col("Tema").alias(level), "area_type", "sex", F.col("member").alias(col))


def segments(found: DataFrame, size: int | None = None, sep: str = ", ") -> DataFrame:
    """``(level, Tema, kind, area_type, sex, segment, n, text)``: the members of
    each group in order, joined in segments of ``size`` (the last one shorter).
    A group with a NULL member has one more row, all NULL from ``segment`` on.

    The members are range-partitioned and sorted, and written so; a member's
    position is its place in its partition and the sizes of the group's earlier
    ones. What a task gathers is a segment."""
    ordered = found.where(F.col("member").isNotNull()).repartitionByRange(*GROUP, "member").sortWithinPartitions(*GROUP, "member")
    at = F.monotonically_increasing_id()
    ordered = materialize(ordered.select(*GROUP, "member", F.spark_partition_id().alias("_part"), at.alias("_at")), "members")
    blocks = ordered.groupBy(*GROUP, "_part").agg(F.count("*").alias("_n"), F.min("_at").alias("_first"))
    before = F.sum("_n").over(Window.partitionBy(*GROUP).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1))
    blocks = blocks.withColumn("_before", F.coalesce(before, F.lit(0)) - F.col("_first")).select(*GROUP, "_part", "_before")
    place = F.col("_before") + F.col("_at")
    dealt = join_ns(ordered, blocks, [*GROUP, "_part"]).withColumn("segment", F.floor(place / (size or SEGMENT)).cast("int"))
    text = F.array_join(F.array_sort(F.collect_list("member")), sep)  # at most ``size`` of them
    made = dealt.groupBy(*GROUP, "segment").agg(F.count("*").alias("n"), text.alias("text"))
    nulls = found.where(F.col("member").isNull()).select(*GROUP)
    return made.unionByName(nulls, allowMissingColumns=True)


def joined_members(found: DataFrame, sep: str = ", ", size: int | None = None) -> DataFrame:
    """``(level, Tema, kind, area_type, sex, text)``: the published strings, a
    group's segments in order; NULL for a group with a NULL member (G16)."""
    whole = F.count(F.lit(1)) == F.count("text")
    parts = F.array_sort(F.collect_list(F.when(F.col("text").isNotNull(), F.struct("segment", "text"))))
    return segments(found, size, sep).groupBy(*GROUP).agg(F.when(whole, F.array_join(F.transform(parts, lambda p: p["text"]), sep)).alias("text"))


def _strings(keys: DataFrame, attributed: DataFrame, level: str, col: str, out: str) -> DataFrame:
    joined = joined_members(level_members(keys, attributed, [(level, col, "")]))
    return joined.select(F.col("Tema").alias(level), "area_type", "sex", F.col("text").alias(out))


def theme_titles(keys: DataFrame, attributed: DataFrame) -> DataFrame:
    """Titles joined per (theme, area_type, sex)."""
    return _strings(keys, attributed, "theme", "title", "titles_text")


def theme_sources(keys: DataFrame, attributed: DataFrame) -> DataFrame:
    return _strings(keys, attributed, "theme", "source", "source_text")


def part_sources(keys: DataFrame, attributed: DataFrame) -> DataFrame:
    return _strings(keys, attributed, "part", "source", "source_text")


def level_texts(keys: DataFrame, attributed: DataFrame) -> DataFrame:
    """The published strings of all levels, ``(level, Tema, kind, area_type,
    sex, text)``: what the wide tables are made of."""
    return joined_members(level_members(keys, attributed))


def _text_columns(level: str | None, kinds: Sequence[str] = ("text", "source")) -> dict[str, Column]:
    """The wide columns ``{kind}_{type}_{sex}`` as aggregates of level texts."""
    of = F.lit(True) if level is None else F.col("level") == level
    return {
        f"{kind}_{t}_{s}": F.max(F.when(of & (F.col("kind") == kind) & (F.col("area_type") == t) & (F.col("sex") == s), F.col("text")))
        for kind in kinds
        for t in AREA_TYPES
        for s in SEX_ORDER
    }


def _one_level(texts: DataFrame, level: str, kinds: Sequence[str]) -> DataFrame:
    columns = _text_columns(None, kinds)
    return texts.where(F.col("level") == level).groupBy("Tema").agg(*[c.alias(n) for n, c in columns.items()])


def theme_wide(texts: DataFrame) -> DataFrame:
    """Titles and sources of every theme, wide, keyed by ``Tema``."""
    return _one_level(texts, "theme", ("text", "source"))


def part_wide(texts: DataFrame) -> DataFrame:
    return _one_level(texts, "part", ("source",))


def merged_levels(texts: DataFrame, part_sorting: Mapping[str, int] | DataFrame) -> DataFrame:
    """``coalesce_levels`` of the theme and part tables in one aggregate of the
    level texts: per ``Tema`` the theme's string, else the part's (U3, A18)."""
    theme, part = _text_columns("theme"), _text_columns("part")
    merged = texts.groupBy("Tema").agg(*[F.coalesce(theme[n], part[n]).alias(n) for n in theme])
    return _with_sorting(merged, part_sorting)


def full_outer_levels(themes: DataFrame, parts: DataFrame) -> DataFrame:
    """Theme table full-joined to the part table by ``Tema`` (J11); shared
    columns get ``_x``/``_y`` suffixes."""
    shared = [c for c in themes.columns if c in parts.columns and c != "Tema"]
    t = themes.withColumnsRenamed({c: f"{c}_x" for c in shared})
    p = parts.withColumnsRenamed({c: f"{c}_y" for c in shared})
    return t.join(p, "Tema", "full")


def coalesce_levels(themes: DataFrame, parts: DataFrame, part_sorting: Mapping[str, int] | DataFrame) -> DataFrame:
    """Stack themes and parts, first non-NULL value per column and ``Tema``
    (U3, A18), plus the part sort code as text (``part_sorting``: a mapping,
    or a DataFrame of ``Tema, sorting`` rows for the parts).

    "First" is made exact by a source rank (themes before parts) instead of
    relying on row arrival order.
    """
    stacked = themes.withColumn("_rank", F.lit(0)).unionByName(
        parts.withColumn("_rank", F.lit(1)), allowMissingColumns=True
    )
    cols = [c for c in stacked.columns if c not in ("Tema", "_rank")]
    merged = stacked.groupBy("Tema").agg(
        *[F.min_by(F.col(c), F.when(F.col(c).isNotNull(), F.col("_rank"))).alias(c) for c in cols]
    )
    return _with_sorting(merged, part_sorting)


def _with_sorting(merged: DataFrame, part_sorting: Mapping[str, int] | DataFrame) -> DataFrame:
    if isinstance(part_sorting, DataFrame):
        codes = part_sorting.select("Tema", F.col("sorting").cast("string").alias("sorting"))
        return merged.join(codes, "Tema", "left")
    sort = None
    for label, code in part_sorting.items():
        cond = F.col("Tema") == label
        sort = F.when(cond, F.lit(str(code))) if sort is None else sort.when(cond, F.lit(str(code)))
    return merged.withColumn("sorting", sort if sort is not None else F.lit(None).cast("string"))


# ------------------------------------------------------ D18 descriptions
def describe(
    wide: DataFrame,
    part_labels: Sequence[str] | DataFrame,
    sustainability_part: str,
    sort_table: DataFrame | None = None,
) -> DataFrame:
    """Six published description texts per theme and part.

    ``part_labels`` are the part names (the reference's two parts), as a
    list or as a DataFrame with a ``Tema`` column;
    ``sustainability_part`` is the part described with the sustainability
    text, the others get the quality-of-life text. NULL pieces print as
    ``NA`` and are then cut out with their spaces, as in the reference (G9).
    ``sort_table`` (Tema, sorting) orders the result.
    """
    tema = F.col("Tema")
    if isinstance(part_labels, DataFrame):
        marks = part_labels.select("Tema").distinct().withColumn("_is_part", F.lit(True))
        wide = wide.join(marks, "Tema", "left")
        is_part = F.coalesce(F.col("_is_part"), F.lit(False))
    else:
        is_part = tema.isin(*part_labels)
    part_desc = if_else(tema == sustainability_part, F.lit(SUSTAINABILITY_DESC), F.lit(QUALITY_OF_LIFE_DESC))
    labels = {
        "L": if_else(is_part, F.lit(REGION_INDEX), F.lit(REGION_THEME_INDEX)),
        "K": if_else(is_part, F.lit(MUNICIPAL_INDEX), F.lit(MUNICIPAL_THEME_INDEX)),
    }
    prefix = {"T": [], "K": [F.lit(WOMEN_PREFIX)], "M": [F.lit(MEN_PREFIX)]}
    cols = []
    for (geo, sex), name in DESCRIPTION_COLUMNS.items():
        src = F.col(f"source_{geo}_{sex}")
        text = F.col(f"text_{geo}_{sex}")
        on_part = paste(*prefix[sex], labels[geo], tema, part_desc, F.lit(SOURCE_LABEL), src)
        on_theme = paste(
            *prefix[sex], labels[geo], tema, F.lit(BASED_ON), text, F.lit(INDICATOR_DESC), F.lit(SOURCE_LABEL), src
        )
        cols.append(case_when((is_part, on_part), default=on_theme).alias(name))
    out = wide.select(tema, *cols)
    # the reference's three passes over every Information_* column
    out = map_prefixed(out, INFO_PREFIX, lambda c: squish(F.regexp_replace(c, NA_REMNANTS, "")))
    out = map_prefixed(out, INFO_PREFIX, lambda c: F.regexp_replace(c, f"{SOURCE_LABEL} {SOURCE_LABEL}", SOURCE_LABEL))
    out = map_prefixed(out, INFO_PREFIX, ensure_period)
    out = select_prefixed(out, INFO_PREFIX, keep=["Tema"])
    if sort_table is None:
        return out
    return (
        out.join(sort_table, "Tema", "left")
        .select("sorting", "Tema", *prefixed(out, INFO_PREFIX))
        .orderBy(F.col("sorting").asc_nulls_last(), "Tema")
    )


def sort_table(catalog: DataFrame) -> DataFrame:
    """(Tema, sorting) from the catalog's sort codes: themes by their own
    code, parts by the hundred of their themes' codes (G19); a name that is
    both takes the smaller."""
    hundred = (F.floor(F.col("sort_order") / 100) * 100).cast("int")  # ascends with the code
    both = F.array(
        F.struct(F.col("theme").cast("string").alias("Tema"), F.col("sort_order").alias("sorting")),
        F.struct(F.col("part").alias("Tema"), hundred.alias("sorting")),
    )
    return catalog.select(F.inline(both)).groupBy("Tema").agg(F.min("sorting").alias("sorting"))
