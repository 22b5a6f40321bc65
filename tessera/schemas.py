"""Schemas and fixed values of the data model."""

from __future__ import annotations

from pyspark.sql import types as T

# Fixed values that must equal the reference's for the same results.
NATION_NAME = "Riket"  # label of the nation-wide area
NATION_LABEL = "00 Riket"  # delivery label of an area without a code match
SEXES = ("T", "K", "M")  # total, women, men
SPLIT_PATTERN = "M|K"  # sexes counted for the split flag
REGION_NAME_PATTERN = "[rR]egion"  # area names treated as regions in the group key
SEX_LABELS = {"K": "Kvinnor", "M": "Män", "T": "Totalt"}
COUNTY_DIVISOR = 100  # municipality id // this = county number
REGION_DATA_NAME = "Data_lan_namn"  # the region's name in the observations
AREA_TYPES = ("K", "L", "R")  # municipality, region, nation

OBSERVATIONS = T.StructType(
    [
        T.StructField("kpi", T.StringType()),
        T.StructField("area_id", T.LongType()),
        T.StructField("area_name", T.StringType()),
        T.StructField("area_type", T.StringType()),
        T.StructField("sex", T.StringType()),
        T.StructField("year", T.IntegerType()),
        T.StructField("value", T.DoubleType()),
    ]
)

CATALOG = T.StructType(
    [
        T.StructField("kpi", T.StringType()),
        T.StructField("kpi_text", T.StringType()),
        T.StructField("aspect", T.StringType()),
        T.StructField("theme", T.StringType()),
        T.StructField("part", T.StringType()),
        T.StructField("inverted", T.IntegerType()),
        T.StructField("logged", T.IntegerType()),
        T.StructField("sort_order", T.IntegerType()),
        T.StructField("added", T.TimestampType()),
    ]
)

# Reference file layouts (``;``-separated CSV). Codes are text: "01" must not
# become 1 (G1).
INDICATOR_FILE = T.StructType(
    [
        T.StructField("Indikator_ID", T.StringType()),
        T.StructField("Indikator_namn", T.StringType()),
        T.StructField("Aspekt", T.StringType()),
        T.StructField("Tema", T.StringType()),
        T.StructField("Del", T.StringType()),
        T.StructField("Omvand_skala", T.IntegerType()),
        T.StructField("Log", T.IntegerType()),
        T.StructField("Sortering", T.IntegerType()),
        T.StructField("Tillagd_datum", T.StringType()),
    ]
)

CATEGORY_FILE = T.StructType(
    [
        T.StructField("Aspekt", T.StringType()),
        T.StructField("Tema", T.StringType()),
        T.StructField("Del", T.StringType()),
        T.StructField("Sortering", T.IntegerType()),
    ]
)

REGION_CODE_FILE = T.StructType(
    [
        T.StructField("Lan_kod", T.StringType()),
        T.StructField("Lan_kod_S", T.StringType()),
        T.StructField("Lan_bokstav", T.StringType()),
        T.StructField("Lan_Namn", T.StringType()),
        T.StructField("SCB_lan_namn", T.StringType()),
        T.StructField(REGION_DATA_NAME, T.StringType()),
    ]
)

MUNICIPALITY_CODE_FILE = T.StructType(
    [
        T.StructField("Lan_kod_S", T.StringType()),
        T.StructField("Lan_Namn", T.StringType()),
        T.StructField("Kommun_kod", T.StringType()),
        T.StructField("Kommun_kod_S", T.StringType()),
        T.StructField("Kommun_namn", T.StringType()),
    ]
)
