"""Session helpers: building a session for tests/bench, and the shared folder
used to cut lineage between processing steps.

On a cluster the shared folder is whatever the cluster names in
``spark.checkpoint.dir``; it is only chosen here when that is unset and the
master is local (tests, bench).
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def get_session(
    master: str | None = None,
    app_name: str = "tessera",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with the settings this library assumes.

    Only settings that are not already present on an active session are
    applied; a cluster's own configuration always wins.
    """
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
    }
    if shuffle_partitions is not None:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def _is_local(spark: SparkSession) -> bool:
    """One JVM for driver and tasks (``local``, ``local[n]``, ``local[n, f]``)."""
    return re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master) is not None


def checkpoint_root(spark: SparkSession) -> str:
    """The shared folder for materialized intermediate tables.

    Read from the session (``spark.checkpoint.dir`` or the context's
    checkpoint dir). Only a local session may fall back to a private temp
    folder; a cluster without the setting is an error, because a
    machine-local folder is not visible to other executors.
    """
    sc = spark.sparkContext
    path = sc.getCheckpointDir()
    if not path:
        path = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get(
            "spark.checkpoint.dir", None
        )
        if not path:
            if not _is_local(spark):
                raise RuntimeError(
                    "spark.checkpoint.dir is not set; a shared folder is required on a cluster"
                )
            path = tempfile.mkdtemp(prefix="tessera-ckpt-")
        sc.setCheckpointDir(path)
        path = sc.getCheckpointDir() or path
    return path


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet into the shared folder and read it back.

    This cuts the lineage (a lost executor re-reads the table instead of
    recomputing the upstream joins) and is how processing steps hand over,
    like the base-table file the reference hands between its steps.
    """
    spark = df.sparkSession
    root = checkpoint_root(spark).rstrip("/")
    path = f"{root}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def materialize_with(df: DataFrame, name: str, more: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """As ``materialize``, with further rows in the same table: ``more`` of the
    rows as written, so that ``df`` is computed once."""
    path = f"{checkpoint_root(df.sparkSession).rstrip('/')}/tessera/{name}-{uuid.uuid4().hex}"
    df.write.mode("overwrite").parquet(path)
    more(df.sparkSession.read.parquet(path)).write.mode("append").parquet(path)
    return df.sparkSession.read.parquet(path)


def materialize_bucketed(df: DataFrame, name: str, key: str, buckets: int) -> DataFrame:
    """As ``materialize``, dealt into ``buckets`` by ``key``: tables of equal
    ``buckets`` are joined on ``key`` as they lie, without an exchange.

    Spark keeps buckets with tables only, so the files get an entry in the
    session's catalog: an external table, whose removal leaves the files."""
    spark = df.sparkSession
    full = f"{name}-{uuid.uuid4().hex}"
    entry = "tessera_" + re.sub(r"\W", "_", full)
    writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)  # one file a bucket
    writer.option("path", f"{checkpoint_root(spark).rstrip('/')}/tessera/{full}").format("parquet").saveAsTable(entry)
    return spark.table(entry)


def local_scratch(prefix: str = "tessera-") -> str:
    """A private scratch folder, for tests and local runs only."""
    return tempfile.mkdtemp(prefix=prefix, dir=os.environ.get("TMPDIR", "/tmp"))
