"""Incremental landing of observation files.

The reference has no streaming: it fetches every indicator once a year, and a
later fetch replaces an earlier one. Its fetch step is re-aimed at landed files
(``sources.files``); this module is the same ingest in two steps:

* ``land_observations``, a Structured Streaming query, appends what has landed
  to a log, exactly once (file source + checkpoint), with the landing time;
* ``refresh_table`` brings a table partitioned by indicator up to date: of the
  indicators with rows that landed later than the table's, the newest version
  of every observation replaces the indicator's partition. It is a batch job
  that only reads the log, so a run that was cut off is run again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tessera.sources import files


def land_observations(
    spark: SparkSession,
    source: str,
    sink: str,
    checkpoint: str | None = None,
    fmt: str = "json",
    available_now: bool = True,
) -> StreamingQuery:
    """Append landed observation files under ``source`` to Parquet at
    ``sink``, partitioned by ``kpi``, with the time at which each file landed.

    The stream reads and cleans as the batch reader does: explicit schema, NaN
    as NULL, municipalities and regions only, JSON records that do not parse
    kept in ``_corrupt_record`` (``files.split_rejected`` takes them out).

    ``checkpoint`` defaults to a folder inside ``sink`` that readers skip: the
    record of what has landed lives and dies with the table, so a later
    application goes on where this one stopped. With ``available_now`` the
    query processes what has landed and stops.
    """
    reader = spark.readStream.schema(files.observation_schema(fmt)).format(fmt)
    stream = reader.options(**files.JSON_OPTIONS if fmt == "json" else {}).load(source)
    writer = (
        files.clean_observations(files.with_landing_time(stream))
        .writeStream.format("parquet")
        .option("path", sink)
        .option("checkpointLocation", checkpoint or f"{sink.rstrip('/')}/_landed")
        .partitionBy("kpi")
        .outputMode("append")
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def read_log(spark: SparkSession, log: str, fmt: str = "json") -> DataFrame:
    """The log of ``land_observations``: every version of every observation."""
    schema = T.StructType([*files.observation_schema(fmt).fields, T.StructField(files.LANDED, T.TimestampType())])
    return spark.read.schema(schema).parquet(log)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def refresh_table(spark: SparkSession, log: str, table: str, fmt: str = "json") -> int:
    """Bring the observations at ``table`` (Parquet by ``kpi``) up to date with
    the log; returns how many indicators changed. Indicators without news keep
    their files. Records that did not parse stay in the log."""
    landed = read_log(spark, log, fmt)
    if files.CORRUPT in landed.columns:
        landed = landed.where(F.col(files.CORRUPT).isNull()).drop(files.CORRUPT)
    last = landed.groupBy("kpi").agg(F.max(files.LANDED).alias("last"))
    if _exists(spark, table):
        have = spark.read.schema(landed.schema).parquet(table).groupBy("kpi").agg(F.max(files.LANDED).alias("had"))
        last = last.join(have, "kpi", "left").where(F.col("had").isNull() | (F.col("last") > F.col("had")))
    # the comparison is over before the table is written
    changed = [r["kpi"] for r in last.select("kpi").collect()]  # indicators: as many as the catalog has
    if changed:
        rows = files.newest(landed.where(F.col("kpi").isin(changed)))
        files.write_table(rows, table, replace="partitions")
    return len(changed)
