"""Inputs of the index computation derived from the driver's TPC-H-style tables.

The reference fetches regional statistics from a web service; here the same
long table *(indicator, area, sex, year, value)* is aggregated from
``lineitem ⋈ part ⋈ supplier ⋈ nation`` (see FIXTURES.md). Every lineitem row
is used:

* indicator ``b`` = number of ``p_brand``; code ``I`` + two digits
* municipality (K) = supplier, region (L) = the supplier's nation, nation-wide
  total (L, id 0); a municipality's id is its region's id times
  ``COUNTY_DIVISOR`` plus the supplier key, so areas grow with the data
* sex = ``l_linestatus`` (F→K, O→M), not recorded (NULL) for the seventh line of
  an order and for every sixth indicator, plus the total T
* year = ``year(l_shipdate)``; value = mean amount of the cell's *returned*
  lines, so a cell without a returned line is a row without a value, as often
  at every scale (lines per supplier do not depend on it). The amount is the
  price; for every tenth indicator the discount in percent less 5, which can be
  zero or negative
* gaps of the nation: indicators with sexes whose brand number has the tens
  ``NO_NATION`` have no row for the nation, those with ``NO_NATION_BY_SEX`` rows without a value
  but for the total sex; both are filled from the areas (W1).

Plan shape: the lineitem side is joined to ``part`` once, dealt by brand, year
and supplier and summed there for every sex and the total; names are joined to
these cells, which are the municipalities' rows as they are. The coarser levels
come from one grouping-sets aggregate of the cells, combined map-side. Join
strategies are left to the planner and AQE's runtime sizes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schemas import NATION_NAME
from tessera.session import materialize

# Fixed values of the fixture (FIXTURES.md).
REGION_PREFIX = "Region "
COUNTY_DIVISOR = 1_000_000_000
SOURCE_MARKER = "Källa"
NO_NATION, NO_NATION_BY_SEX = 1, 2


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def brand_number(p_brand):
    return F.substring_index(p_brand, "#", -1).cast("int")


def kpi_code(b):
    return F.concat(F.lit("I"), F.lpad(b.cast("string"), 2, "0"))


def municipality_id(nationkey, suppkey):
    return (nationkey + 1).cast("bigint") * COUNTY_DIVISOR + suppkey


#: Codes of the sexes of a line in the cells: not recorded, K, M.
SEX_OF_CODE = (None, "K", "M")


def _lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row per line: brand, year, supplier, code of the sex, whether returned,
    and its amount in cents. Lines are cut to numbers before the join."""
    returned = F.col("l_returnflag") == "R"
    status = F.when(F.col("l_linestatus") == "F", 1).when(F.col("l_linestatus") == "O", 2)
    li = _t(spark, sf_dir, "lineitem").select(
        "l_partkey",
        F.col("l_suppkey").alias("suppkey"),
        F.year("l_shipdate").alias("year"),
        F.coalesce(F.when(F.col("l_linenumber") != 7, status), F.lit(0)).alias("code"),
        F.coalesce(returned, F.lit(False)).alias("returned"),
        F.when(returned, F.round(F.col("l_extendedprice") * 100).cast("bigint")).alias("price"),
        F.when(returned, F.round(F.col("l_discount") * 100).cast("bigint") - 5).alias("percent"),
    )
    part = _t(spark, sf_dir, "part").select("p_partkey", brand_number(F.col("p_brand")).alias("b"))
    return li.join(part, li.l_partkey == part.p_partkey).select(
        "b",
        "year",
        "suppkey",
        F.when(F.col("b") % 6 != 0, F.col("code")).otherwise(0).alias("code"),
        "returned",
        F.when(F.col("b") % 10 == 0, F.col("percent") * 100).otherwise(F.col("price")).alias("amount"),
    )


def _sums_by_sex(lines: DataFrame) -> DataFrame:
    """Per (brand, year, supplier): an entry for each sex with a line, and one for
    the total, of the sum of amounts in cents and the number of returned lines.

    The lines are dealt by brand, year and supplier before they are summed:
    combining them first would hold a task's lines in memory and save nothing,
    as hardly two of one cell lie together, and all sexes of a cell meet, so the
    total needs no further exchange."""
    keys = ["b", "year", "suppkey"]
    aggs = []
    for k in range(len(SEX_OF_CODE)):
        of_sex = F.col("code") == k
        aggs += [
            F.sum(F.when(of_sex, F.col("amount"))).alias(f"cents{k}"),
            F.count(F.when(of_sex & F.col("returned"), 1)).alias(f"n{k}"),
            F.count(F.when(of_sex, 1)).alias(f"lines{k}"),
        ]
    # by supplier, so that its long id and name lie together in the files written from here on
    wide = lines.repartition(*keys).groupBy(*keys).agg(*aggs).sortWithinPartitions("suppkey")

    def entry(sex, cents, n):
        return F.struct(F.lit(sex).cast("string").alias("sex"), cents.alias("cents"), n.alias("n"))

    codes = range(len(SEX_OF_CODE))
    some = F.coalesce(*[F.col(f"cents{k}") for k in codes]).isNotNull()
    cents = F.when(some, sum((F.coalesce(F.col(f"cents{k}"), F.lit(0)) for k in codes), F.lit(0).cast("bigint")))
    entries = [F.when(F.col(f"lines{k}") > 0, entry(SEX_OF_CODE[k], F.col(f"cents{k}"), F.col(f"n{k}"))) for k in codes]
    entries.append(entry("T", cents, sum((F.col(f"n{k}") for k in codes), F.lit(0).cast("bigint"))))
    return wide.select(*keys, F.inline(F.array_compact(F.array(*entries))))


def municipality_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sum of amounts in cents and number of returned lines per (brand, year,
    municipality, sex); cells without a returned line are kept. A supplier or
    nation that is listed repeatedly counts as often."""
    supplier = _t(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nation = _t(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    places = supplier.join(nation, supplier.s_nationkey == nation.n_nationkey)
    # written, so that the planner joins by its real size
    places = materialize(places.groupBy("s_suppkey", "s_name", "n_nationkey", "n_name").agg(F.count("*").alias("times")), "places")
    cells = _sums_by_sex(_lines(spark, sf_dir))
    return cells.join(places, cells.suppkey == places.s_suppkey).select(
        "b",
        municipality_id(F.col("n_nationkey"), F.col("s_suppkey")).alias("area_id"),
        F.col("s_name").alias("area_name"),
        F.lit("K").alias("area_type"),
        (F.col("n_nationkey") + 1).cast("bigint").alias("region_id"),
        F.concat(F.lit(REGION_PREFIX), F.col("n_name")).alias("region_name"),
        "sex",
        F.col("year").cast("int").alias("year"),
        (F.col("cents") * F.col("times")).alias("cents"),
        (F.col("n") * F.col("times")).alias("n"),
    )


def region_cells(cells: DataFrame) -> DataFrame:
    """The cells of the regions and of the nation, from those of the municipalities.
    Only the nation's have no ``region_id``."""
    sets = [["b", "year", "sex", "region_id", "region_name"], ["b", "year", "sex"]]
    agg = cells.groupingSets(sets, *sets[0]).agg(
        F.sum("cents").alias("cents"), F.sum("n").alias("n"), F.grouping("region_id").alias("g_region")
    )
    is_nation = F.col("g_region") == 1
    return agg.select(
        "b",
        F.when(is_nation, F.lit(0).cast("bigint")).otherwise(F.col("region_id")).alias("area_id"),
        F.when(is_nation, F.lit(NATION_NAME)).otherwise(F.col("region_name")).alias("area_name"),
        F.lit("L").alias("area_type"),
        "region_id",
        "region_name",
        "sex",
        "year",
        "cents",
        "n",
    )


def observations_of(cells: DataFrame, gaps: bool = True) -> DataFrame:
    """The long observation table of the cells of all areas.

    With ``gaps`` the nation lacks the rows and values named above; without,
    every cell is an observation."""
    value = F.when(F.col("n") > 0, F.col("cents").cast("double") / (F.lit(100.0) * F.col("n")))
    if gaps:
        is_nation, tens = F.col("region_id").isNull(), F.floor(F.col("b") / 10)
        cells = cells.where(~is_nation | (tens != NO_NATION) | (F.col("b") % 6 == 0))
        unknown = is_nation & ~F.col("sex").eqNullSafe("T") & (tens == NO_NATION_BY_SEX)
        value = F.when(~F.coalesce(unknown, F.lit(False)), value)
    return cells.select(kpi_code(F.col("b")).alias("kpi"), "area_id", "area_name", "area_type", "sex", "year", value.alias("value"))


def raw_observations(spark: SparkSession, sf_dir: str, gaps: bool = True) -> DataFrame:
    """The long observation table (S3 re-aimed), before any cleaning.

    Columns: kpi, area_id, area_name, area_type, sex, year, value.
    """
    cells = municipality_cells(spark, sf_dir)
    return observations_of(cells.unionByName(region_cells(cells)), gaps)


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Indicator catalog: kpi, kpi_text, aspect, theme, part, inverted, logged,
    sort_order.

    One indicator for each brand, and one without observations for each part
    type (``E`` + a hash). Theme 4 has the name of the second part, the others
    a number and, after ``" - "``, a name. Types have no logged flag."""
    b = F.col("b")
    aspect = (b - 1) % 10
    theme = aspect % 5
    theme_name = F.when(theme == 4, F.lit("D2")).otherwise(F.concat(F.lit("T"), theme.cast("string"), F.lit(" - theme "), theme.cast("string")))
    brands = _t(spark, sf_dir, "part").select(brand_number(F.col("p_brand")).alias("b"), F.col("p_brand")).distinct()
    types = _t(spark, sf_dir, "part").select("p_type").distinct()
    return brands.select(
        kpi_code(b).alias("kpi"),
        F.col("p_brand").alias("kpi_text"),
        aspect.cast("int").alias("aspect"),
        theme_name.alias("theme"),
        F.when(theme < 3, F.lit("D1")).otherwise(F.lit("D2")).alias("part"),
        (b % 2).cast("int").alias("inverted"),
        F.when((b % 5) == 0, 1).otherwise(0).cast("int").alias("logged"),
        (F.when(theme < 3, 100).otherwise(200) + theme + 1).cast("int").alias("sort_order"),
    ).unionByName(
        types.select(
            F.concat(F.lit("E"), F.substring(F.md5(F.col("p_type")), 1, 8)).alias("kpi"),
            F.col("p_type").alias("kpi_text"),
            F.lit(10).alias("aspect"),
            F.lit("T5 - theme 5").alias("theme"),
            F.lit("D2").alias("part"),
            F.lit(0).alias("inverted"),
            F.lit(None).cast("int").alias("logged"),
            F.lit(206).alias("sort_order"),
        )
    )


def other_orientation(catalog: DataFrame) -> DataFrame:
    """The catalog with the orientation of every third brand turned round."""
    turned = F.col("kpi").startswith("I") & (F.substring("kpi", 2, 8).try_cast("int") % 3 == 0)
    return catalog.withColumn("inverted", F.when(turned, 1 - F.col("inverted")).otherwise(F.col("inverted")))


def region_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Region code key (S2 layout): code, padded code, letter, names."""
    rk = F.col("n_nationkey") + 1
    return _t(spark, sf_dir, "nation").select(
        rk.cast("string").alias("Lan_kod"),
        F.lpad(rk.cast("string"), 2, "0").alias("Lan_kod_S"),
        # one region's letter is the file's mark for a missing value
        F.when(F.col("n_nationkey") == 0, F.lit("NA")).otherwise(F.char(F.col("n_nationkey") + 65)).alias("Lan_bokstav"),
        F.col("n_name").alias("Lan_Namn"),
        F.concat(F.lpad(rk.cast("string"), 2, "0"), F.lit(" "), F.col("n_name")).alias("SCB_lan_namn"),
        F.concat(F.lit(REGION_PREFIX), F.col("n_name")).alias("Data_lan_namn"),
    )


def municipality_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Municipality code key (absent from the reference), of the suppliers
    whose balance is not negative; the others have no code."""
    s = _t(spark, sf_dir, "supplier").where("s_acctbal >= 0")
    n = _t(spark, sf_dir, "nation")
    mid = municipality_id(F.col("n_nationkey"), F.col("s_suppkey")).cast("string")
    return s.join(n, s.s_nationkey == n.n_nationkey).select(
        mid.alias("Kommun_kod"),
        F.lpad(mid, 12, "0").alias("Kommun_kod_S"),
        F.col("s_name").alias("Kommun_namn"),
        F.lpad((F.col("n_nationkey") + 1).cast("string"), 2, "0").alias("Lan_kod_S"),
        F.col("n_name").alias("Lan_Namn"),
    )


def indicator_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Title and description per indicator (S10 re-aimed).

    Every document is a text record of one brand's indicator, dealt by its id;
    ``title = source``, ``description`` = the whole text and, on a line of its
    own, an attribution: with a colon, without one, or doubled, and none for
    every fifth indicator."""
    d = _t(spark, sf_dir, "documents")
    n = _t(spark, sf_dir, "part").select(F.count_distinct("p_brand").alias("n")).scalar()
    b = (F.col("doc_id") % n + 1).cast("int")
    kind = F.floor(F.col("doc_id") / n) % 3
    line = (
        F.when(b % 5 == 0, F.lit(""))
        .when(kind == 0, F.concat(F.lit(f"\n{SOURCE_MARKER}: "), F.col("source"), F.lit(".")))
        .when(kind == 1, F.concat(F.lit(f"\n{SOURCE_MARKER} "), F.col("source")))
        .otherwise(F.concat(F.lit(f"\n{SOURCE_MARKER}: {SOURCE_MARKER}: "), F.col("lang"), F.lit(".")))
    )
    return d.select(
        F.col("doc_id"), kpi_code(b).alias("kpi"), F.col("source").alias("title"), F.concat(F.col("text"), line).alias("description")
    )
