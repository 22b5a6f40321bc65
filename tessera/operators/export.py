"""Label keys and the flat spreadsheet-style export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.functions.expr import case_when, if_else, paste
from tessera.schemas import SEX_LABELS

# Column layout of the flat export (fixed values, the reference's sheet).
FLAT_LAYOUT = [
    ("Indikator_name", "kpi_text"),
    ("Number", "kpi"),
    ("Region", "_region"),
    ("Kon", "_sex_label"),
    ("Ar", "year"),
    ("Varde", "standard_value"),
    ("Del", "part"),
    ("Tema", "theme"),
    ("Aspekt", "aspect"),
    ("Kon_ford", "has_split"),
    ("Maxar", "last_year"),
    ("Lagar", "first_year"),
    ("Log", "logged"),
    ("Omvand_skala", "inverted"),
    ("Omrade_typ", "area_type"),
]


def region_lan_key(region_codes: DataFrame) -> DataFrame:
    """Region id, county name and the region's name in the data."""
    return region_codes.select(
        F.col("Lan_kod").cast("int").alias("area_id"),
        F.col("Lan_Namn").alias("region_lan"),
        F.col("Data_lan_namn").alias("area_name"),
    )


def area_labels(municipality_codes: DataFrame) -> DataFrame:
    """Text code per area name: counties and municipalities stacked.

    ``code_text`` is the padded code, ``area_name`` the label.
    """
    counties = municipality_codes.select(
        F.col("Lan_kod_S").alias("code_text"), F.col("Lan_Namn").alias("area_name")
    ).distinct()
    municipalities = municipality_codes.select(
        F.col("Kommun_kod_S").alias("code_text"), F.col("Kommun_namn").alias("area_name")
    ).distinct()
    return counties.unionByName(municipalities, allowMissingColumns=True)


def flat_export(scored: DataFrame, region_codes: DataFrame, municipality_codes: DataFrame, sort: bool = True) -> DataFrame:
    """One row per scored value in the reference's sheet layout.

    Regions are renamed to their county name (join on id and name), then
    every area gets its text code by name; areas without one keep their
    numeric id (the nation). ``Region`` is ``"<code> <name>"``.
    """
    rl = region_lan_key(region_codes)
    j = scored.join(rl, ["area_id", "area_name"], "left").withColumn(
        "area_name", if_else(F.col("region_lan").isNotNull(), F.col("region_lan"), F.col("area_name"))
    )
    j = j.join(area_labels(municipality_codes), "area_name", "left")
    code = if_else(F.col("code_text").isNull(), F.col("area_id").cast("string"), F.col("code_text"))
    sex = F.col("sex")
    label = case_when(*[(sex == k, v) for k, v in (("T", SEX_LABELS["T"]), ("K", SEX_LABELS["K"]), ("M", SEX_LABELS["M"]))], default=sex)
    j = j.withColumn("_region", paste(code, F.col("area_name"), sep=" ")).withColumn("_sex_label", label)
    out = j.select(*[F.col(src).alias(dst) for dst, src in FLAT_LAYOUT])
    if sort:
        out = out.orderBy(*[F.col(c).asc_nulls_last() for c in ("Indikator_name", "Region", "Kon", "Ar")])
    return out
