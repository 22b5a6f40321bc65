"""File sources and sinks.

* The reference's start files are ``;``-separated UTF-8 CSV with decimal
  commas, ``""``-escaped quotes and ``NA`` for missing values. They are read
  with explicit schemas (codes such as ``"01"`` stay text, G1); decimal
  columns are read as text and converted with ``try_cast``.
* The web fetch of observations and indicator texts is re-aimed at landed
  files (one file group per indicator), read with an explicit schema.
* Stage hand-off is Parquet partitioned by indicator; the CSV exchange
  format is kept for published tables.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas

CSV_OPTIONS = {
    "sep": ";",
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "NA",
    "encoding": "UTF-8",
    "mode": "PERMISSIVE",
}


CORRUPT = "_corrupt_record"
OTHER_FIELDS = "other fields than the header"
NOT_A_RECORD = "not a record"
JSON_OPTIONS = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}


def _nan_to_null(df: DataFrame) -> DataFrame:
    """NaN counts as missing in the reference (G3); Spark keeps NaN apart."""
    return df.select(
        *[
            F.when(~F.isnan(F.col(f.name)), F.col(f.name)).alias(f.name)
            if isinstance(f.dataType, (T.DoubleType, T.FloatType))
            else F.col(f.name)
            for f in df.schema.fields
        ]
    )


def _read_text_columns(spark: SparkSession, path: str | Sequence[str], schema: T.StructType) -> DataFrame:
    """Every column of ``;``-CSV files as text, by the header's own names, and
    ``CORRUPT``: the whole line where its fields are not those of the header.
    Files with another header than the first one's are refused."""
    names = spark.read.options(**CSV_OPTIONS).csv(path).columns
    missing = [f.name for f in schema.fields if f.name not in names]
    if missing:
        raise ValueError(f"{path}: no column {', '.join(missing)}; the header has {', '.join(names)}")
    text = T.StructType([T.StructField(n, T.StringType(), True) for n in [*names, CORRUPT]])
    reader = spark.read.schema(text).options(**CSV_OPTIONS).option("columnNameOfCorruptRecord", CORRUPT)
    # all columns are parsed, whichever are asked for: fields are counted against the header
    return reader.option("enforceSchema", "false").option("columnPruning", "false").csv(path)


def _typed(f: T.StructField, decimal_comma: set[str]) -> Column:
    c = F.col(f"`{f.name}`")
    if f.name in decimal_comma:
        c = F.regexp_replace(c, ",", ".")
    return c if isinstance(f.dataType, T.StringType) else c.try_cast(f.dataType)


def read_semicolon_csv(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, decimal_comma: Iterable[str] = ()
) -> DataFrame:
    """Read the columns of ``schema`` from ``;``-CSV, by the names in the
    header (S1/S2/S5): the order of the columns is free, further ones are left
    out, a missing one is an error, and so is a file whose header differs from
    the others'. ``decimal_comma`` columns use ``,``.

    Lines with more or fewer fields than the header are left out, cells that are
    not of their column's type are NULL; ``csv_rejects`` lists both."""
    df = _read_text_columns(spark, path, schema)
    # Spark refuses queries on the broken lines alone, such as a count, so the test names another column too
    df = df.where(F.concat(F.col(CORRUPT), F.coalesce(F.col(f"`{df.columns[0]}`"), F.lit(""))).isNull())
    return _nan_to_null(df.select(*[_typed(f, set(decimal_comma)).alias(f.name) for f in schema.fields]))


def csv_rejects(
    spark: SparkSession, path: str | Sequence[str], schema: T.StructType, decimal_comma: Iterable[str] = ()
) -> DataFrame:
    """``(file, line, column, reason)``: what ``read_semicolon_csv`` does not
    take over. A line whose fields are not those of the header is listed whole
    (``column`` NULL), any other line once for each cell of another type."""
    df = _read_text_columns(spark, path, schema)
    names = [c for c in df.columns if c != CORRUPT]
    whole = F.struct(F.lit(None).cast("string").alias("column"), F.lit(OTHER_FIELDS).alias("reason"))
    cells = []
    for f in schema.fields:
        if not isinstance(f.dataType, T.StringType):
            bad = F.col(f"`{f.name}`").isNotNull() & _typed(f, set(decimal_comma)).isNull()
            cells.append(F.when(bad, F.struct(F.lit(f.name).alias("column"), F.lit(f"not {f.dataType.simpleString()}").alias("reason"))))
    found = F.when(F.col(CORRUPT).isNotNull(), F.array(whole)).otherwise(F.array_compact(F.array(*cells)) if cells else F.array().cast("array<struct<column:string,reason:string>>"))
    line = F.coalesce(F.col(CORRUPT), F.concat_ws(";", *[F.coalesce(F.col(f"`{n}`"), F.lit(CSV_OPTIONS["nullValue"])) for n in names]))
    listed = df.select(F.col("_metadata.file_path").alias("file"), line.alias("line"), F.explode(found).alias("r"))
    return listed.select("file", "line", "r.column", "r.reason")


def write_semicolon_csv(
    df: DataFrame, path: str, decimal_comma: bool = True, single_file: bool = False, compression: str | None = None
) -> None:
    """Write ``;``-CSV (S6–S9). Doubles get a decimal comma; ``single_file``
    (one task) is meant only for the small published tables."""
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if decimal_comma and isinstance(f.dataType, (T.DoubleType, T.FloatType, T.DecimalType)):
            c = F.regexp_replace(c.cast("string"), r"\.", ",")
        cols.append(c.alias(f.name))
    out = df.select(*cols)
    if single_file:
        out = out.coalesce(1)
    w = out.write.mode("overwrite").options(**{k: v for k, v in CSV_OPTIONS.items() if k != "mode"})
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


# ------------------------------------------------------------ start files
def read_catalog(spark: SparkSession, path: str) -> DataFrame:
    """Indicator catalog file in English names; rows without an id dropped."""
    df = read_semicolon_csv(spark, path, schemas.INDICATOR_FILE)
    return df.where(F.col("Indikator_ID").isNotNull()).select(
        F.col("Indikator_ID").alias("kpi"),
        F.col("Indikator_namn").alias("kpi_text"),
        F.col("Aspekt").alias("aspect"),
        F.col("Tema").alias("theme"),
        F.col("Del").alias("part"),
        F.col("Omvand_skala").alias("inverted"),
        F.col("Log").alias("logged"),
        F.col("Sortering").alias("sort_order"),
        F.to_timestamp("Tillagd_datum").alias("added"),
    )


def read_categories(spark: SparkSession, path: str) -> DataFrame:
    df = read_semicolon_csv(spark, path, schemas.CATEGORY_FILE)
    return df.select(
        F.col("Aspekt").alias("aspect"),
        F.col("Tema").alias("theme"),
        F.col("Del").alias("part"),
        F.col("Sortering").alias("sort_order"),
    )


def read_region_codes(spark: SparkSession, path: str, data_name: str = schemas.REGION_DATA_NAME) -> DataFrame:
    """Region code key. ``data_name`` is the header of the column with the
    region's name in the observations; it is read as ``Data_lan_namn``."""
    return read_semicolon_csv(spark, path, region_code_file(data_name)).withColumnRenamed(data_name, schemas.REGION_DATA_NAME)


def region_code_file(data_name: str = schemas.REGION_DATA_NAME) -> T.StructType:
    """The columns of a region code key."""
    return T.StructType([T.StructField(data_name, f.dataType) if f.name == schemas.REGION_DATA_NAME else f for f in schemas.REGION_CODE_FILE])


def read_municipality_codes(spark: SparkSession, path: str) -> DataFrame:
    return read_semicolon_csv(spark, path, schemas.MUNICIPALITY_CODE_FILE)


# ------------------------------------------------------- landed inputs
LANDED = "landed"
#: What names an observation, in whatever version.
VERSION_KEYS = ("kpi", "area_id", "sex", "year")


def read_observations(
    spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet", landed: bool = False
) -> DataFrame:
    """Landed observation files (S3 re-aimed): explicit schema, NaN → NULL,
    only municipalities and regions (F1, pushed down to the scan).

    ``path`` may hold one file group per indicator (``kpi=<id>/``); a
    ``kpi`` partition column is then discovered. For JSON, malformed records
    land in ``_corrupt_record`` instead of failing the run (S4). With ``landed``
    the rows have the time at which their file landed (see ``newest``).
    """
    reader = spark.read.schema(observation_schema(fmt)).format(fmt)
    df = reader.options(**JSON_OPTIONS if fmt == "json" else {}).load(path)
    return clean_observations(with_landing_time(df) if landed else df)


def with_landing_time(df: DataFrame) -> DataFrame:
    """Rows of files, batch or stream, with the time of change of their file."""
    return df.withColumn(LANDED, F.col("_metadata.file_modification_time"))


def newest(obs: DataFrame) -> DataFrame:
    """One version of every observation (indicator, area, sex, year): that
    which landed last; of versions that landed together, the last in the order
    of their columns. Records that did not parse stay, each once.

    An aggregate with map-side combine: an observation that landed often is one
    row before the shuffle."""
    keys = [*VERSION_KEYS, *([CORRUPT] if CORRUPT in obs.columns else [])]
    rest = [c for c in obs.columns if c not in (*keys, LANDED)]
    last = obs.groupBy(*keys).agg(F.max(F.struct(LANDED, *rest)).alias("_last"))
    return last.select(*[F.col(f"_last.{c}") if c in (*rest, LANDED) else F.col(c) for c in obs.columns])


def observation_schema(fmt: str = "parquet") -> T.StructType:
    """Observations as landed; JSON has a column for records that do not parse."""
    extra = [T.StructField(CORRUPT, T.StringType())] if fmt == "json" else []
    return T.StructType([*schemas.OBSERVATIONS.fields, *extra])


def clean_observations(df: DataFrame) -> DataFrame:
    """NaN to NULL; municipalities and regions only, and records that did not
    parse. Batch or stream."""
    keep = F.col("area_type").isin("L", "K")
    if CORRUPT in df.columns:
        keep = keep | F.col(CORRUPT).isNotNull()
    return _nan_to_null(df).where(keep)


def split_rejected(obs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Good observations, and the records that did not parse (None if the
    format has none)."""
    if CORRUPT not in obs.columns:
        return obs, None
    return obs.where(F.col(CORRUPT).isNull()).drop(CORRUPT), obs.where(F.col(CORRUPT).isNotNull()).select(CORRUPT, "kpi")


def read_texts(spark: SparkSession, path: str | Sequence[str], fmt: str = "parquet") -> DataFrame:
    """Landed indicator texts (S10 re-aimed): kpi, title, description."""
    schema = T.StructType(
        [
            T.StructField("kpi", T.StringType()),
            T.StructField("title", T.StringType()),
            T.StructField("description", T.StringType()),
        ]
    )
    return spark.read.schema(schema).format(fmt).load(path)


# --------------------------------------------------------- hand-off
def write_table(
    df: DataFrame, path: str, partition_by: Sequence[str] = ("kpi",), replace: str = "table", metrics: dict[str, Column] | None = None
) -> dict[str, object]:
    """Parquet hand-off partitioned by indicator (S6/S7), so a reader of a
    few indicators prunes the rest.

    Rows are brought together by indicator, and the tasks that write them are
    cut by bytes (``spark.sql.adaptive.advisoryPartitionSizeInBytes``): small
    indicators share a task, a large one has as many as its size asks for.
    ``replace="partitions"`` overwrites the indicators that ``df`` has rows of
    and leaves the others' files alone.

    ``metrics`` are aggregates of the rows, computed by the write itself; their
    values are returned."""
    if replace not in ("table", "partitions"):
        raise ValueError(f"unknown extent of the replacement: {replace!r}")
    seen, asked = Observation(), [m.alias(name) for name, m in (metrics or {}).items()]
    out = df.observe(seen, *asked) if asked else df
    if partition_by:
        out = out.hint("rebalance", *[F.col(c) for c in partition_by])
    w = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic" if replace == "partitions" else "static")
    (w.partitionBy(*partition_by) if partition_by else w).parquet(path)
    try:
        return seen.get if asked else {}
    except Py4JJavaError:  # the planner saw that there are no rows and left the observation out
        return df.sparkSession.createDataFrame([], df.schema).agg(*asked).first().asDict()


def read_table(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)
