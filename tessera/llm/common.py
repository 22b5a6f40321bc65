"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.session import materialize

__all__ = [
    "Buckets",
    "buckets_by",
    "column",
    "crc32_text",
    "fresh_names",
    "materialize",
    "null_batch",
    "sort_key",
    "table",
    "text_bytes",
    "utf8_size",
]

#: Rows that one bucket of an ordered table holds on average.
ROWS_PER_BUCKET = 20_000
#: Fewest buckets of an ordered table, so that small tables still spread.
MIN_BUCKETS = 64
#: Sub-buckets of rows whose order key is NULL (dealt by a hash of the text).
NULL_BUCKETS = 16


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def crc32_text(c: Column) -> Column:
    """CRC-32 of the UTF-8 text, unsigned; NULL counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(c, F.lit("")), "UTF-8"))


def utf8_size(c: Column) -> Column:
    """UTF-8 bytes of the text; 0 for NULL."""
    return F.coalesce(F.octet_length(c), F.lit(0)).cast("long")


def column(name: str) -> Column:
    """The column of this name, whatever characters it has."""
    return F.col("`" + name.replace("`", "``") + "`")


def fresh_names(df: DataFrame, *bases: str) -> list[str]:
    """A name for each of ``bases`` that no column of ``df`` has, in any case of letters."""
    taken, out = {c.lower() for c in df.columns}, []
    for base in bases:
        while base.lower() in taken:
            base += "_"
        taken.add(base.lower())
        out.append(base)
    return out


def sort_key(df: DataFrame, without: tuple[str, ...] = ()) -> Column:
    """A text that orders rows by all columns but ``without``, also by those
    of a type without an order, such as maps; rows that are equal there are tied."""
    others = [column(c) for c in df.columns if c not in without]
    return F.to_json(F.struct(*others)) if others else F.lit("")


def text_bytes(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8 bytes; NULL is the empty text."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [b"" if x is None else x for x in column.cast(kind).to_pylist()]


def null_batch(schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([], schema=schema)


class Buckets:
    """Consecutive ranges of an integer order key, for work in global order.

    ``bounds`` are the keys at which a new range begins, from an approximate
    quantile sketch over all rows: a few thousand numbers at most, whatever
    the size of the table. A range is a bucket: buckets are ordered, and rows
    of one key are always in the same bucket. Rows whose key is NULL come
    last, in ``NULL_BUCKETS`` ranges of a 64-bit hash of their text.
    """

    def __init__(self, bounds: list[int]):
        self.bounds = np.array(sorted(set(bounds)), dtype=np.int64)

    def __len__(self) -> int:
        return len(self.bounds) + 1 + NULL_BUCKETS

    def of(self, keys: pa.Array, hashes: np.ndarray) -> np.ndarray:
        """Bucket of each key; ``hashes`` (int64) deal the NULL ones."""
        keys = keys.cast(pa.int64())
        null = np.asarray(keys.is_null())
        at = np.searchsorted(self.bounds, keys.fill_null(0).to_numpy(zero_copy_only=False), side="right")
        spread = (hashes.astype(np.int64) >> 60) + 8  # the sign and 3 bits: 0 to 15, in order
        return np.where(null, len(self.bounds) + 1 + spread, at).astype(np.int32)

    def column(self, key: str, hash_: str) -> Column:
        """The same as a Spark column (Arrow-batched, over two integers a row)."""

        @F.pandas_udf(T.IntegerType())
        def bucket(k: pd.Series, h: pd.Series) -> pd.Series:
            keys = pa.Array.from_pandas(k)
            if not pa.types.is_integer(keys.type):  # pandas holds integers with gaps as doubles
                keys = pa.array([None if x is None or x != x else int(x) for x in keys.to_pylist()], pa.int64())
            return pd.Series(self.of(keys, h.to_numpy(dtype=np.int64)))

        return bucket(F.col(key), F.col(hash_))


def buckets_by(df: DataFrame, key: str, rows_per_bucket: int = ROWS_PER_BUCKET) -> Buckets:
    """Bucket bounds of ``df`` by the integer column ``key`` (one aggregate).

    The sketch is fine enough for ``accuracy`` / 4 buckets; beyond that the
    buckets grow, never their number on the driver.
    """
    accuracy = 40_000
    n = df.select(F.count(key).alias("n")).first()["n"]
    k = min(max(MIN_BUCKETS, math.ceil(n / rows_per_bucket)), accuracy // 4)
    if not n:
        return Buckets([])
    cuts = [i / k for i in range(1, k)]
    return Buckets(df.select(F.percentile_approx(F.col(key).cast("long"), cuts, accuracy).alias("b")).first()["b"])
