"""Sharding by a Feistel permutation of global row numbers.

Rows are numbered 0 to N-1 in ascending order of id (and of a hash of the
content among equal ids), without a global sort: ids fall into consecutive
buckets, rows are counted by bucket, and a row's number is its bucket's start
plus its rank in the bucket.

A balanced Feistel network over the smallest even number of bits that holds N
permutes the numbers; a result of N or more is put through the network again
(cycle walking: the domain is less than four times N, so that ends soon) until
it is below N. The permuted number p gives shard ``p % shards`` and slot
``p // shards``. So shards hold equal numbers of rows, one apart at most, slots
have no gaps, the shuffle depends on the key and N only, and the way is open in
both directions: ``row_at`` computes the row number of any shard and slot.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.llm.common import buckets_by, fresh_names

SHARDS = 8
KEY = 0x5EED
ROUNDS = 6
#: Rows of one shard in one file of ``write_shards``.
ROWS_PER_FILE = 1_000_000


def _half_bits(size: int) -> int:
    return max(1, (max(size - 1, 1).bit_length() + 1) // 2)


def _round(x: np.ndarray, k: int, key: int, mask: np.uint64) -> np.ndarray:
    """The round function: a 64-bit mix of half the number, the round and the key."""
    with np.errstate(over="ignore"):
        x = x + np.uint64((key * 0x9E3779B97F4A7C15 + (k + 1) * 0xD1B54A32D192ED03) % 2**64)
        x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
        x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return (x ^ (x >> np.uint64(32))) & mask


def _network(x: np.ndarray, half: int, key: int, rounds: int, back: bool) -> np.ndarray:
    mask, h = np.uint64((1 << half) - 1), np.uint64(half)
    left, right = x >> h, x & mask
    for k in reversed(range(rounds)) if back else range(rounds):
        if back:
            left, right = right ^ _round(left, k, key, mask), left
        else:
            left, right = right, left ^ _round(right, k, key, mask)
    return (left << h) | right


def permute(numbers: np.ndarray, size: int, key: int = KEY, rounds: int = ROUNDS, back: bool = False) -> np.ndarray:
    """The permuted numbers (int64) of ``numbers``, all from 0 to size - 1;
    with ``back``, the numbers that are permuted to these."""
    out = np.asarray(numbers, dtype=np.int64).astype(np.uint64)
    half, todo = _half_bits(size), np.arange(len(out))
    while len(todo):
        out[todo] = _network(out[todo], half, key, rounds, back)
        todo = todo[out[todo] >= np.uint64(size)]
    return out.astype(np.int64)


def row_at(shard: int, slot: int, size: int, shards: int = SHARDS, key: int = KEY) -> int:
    """The row number of a slot of a shard."""
    return int(permute(np.array([slot * shards + shard]), size, key, back=True)[0])


def permuted(number: Column, size: int, key: int = KEY) -> Column:
    @F.pandas_udf(T.LongType())
    def run(n: pd.Series) -> pd.Series:
        return pd.Series(permute(n.to_numpy(), size, key))

    return run(number)


def number_rows(rows: DataFrame, id_col: str, hash_col: str, out: str = "row_number") -> DataFrame:
    """``rows`` with the column ``out`` (replaced if it exists): 0 to N-1 by
    ``id_col`` (integer, NULL last), then ``hash_col`` (long, not NULL). Rows
    equal in both are numbered in any order."""
    cut = rows.drop(out)
    bucket, n, start = fresh_names(cut.withColumn(out, F.lit(0)), "bucket", "n", "start")
    buckets = buckets_by(rows, id_col)
    cut = cut.withColumn(bucket, buckets.column(id_col, hash_col))
    # one row for each bucket: thousands, whatever the table
    counts = cut.groupBy(bucket).agg(F.count("*").alias(n))
    before = Window.orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(bucket, F.coalesce(F.sum(n).over(before), F.lit(0)).alias(start))
    rank = F.row_number().over(Window.partitionBy(bucket).orderBy(id_col, hash_col))
    numbered = cut.join(starts, bucket).withColumn(out, F.col(start) + rank - 1)
    return numbered.drop(bucket, start)


def deal(rows: DataFrame, id_col: str, hash_col: str, shards: int = SHARDS, key: int = KEY) -> DataFrame:
    """``rows`` with ``row_number``, ``shard`` (int) and ``slot`` (long), which
    replace columns of these names. All rows count, repeated ones and those
    with a NULL id too; an empty table stays empty."""
    size = rows.count()
    numbered = number_rows(rows.drop("row_number", "shard", "slot"), id_col, hash_col)
    at = fresh_names(numbered, "permuted")[0]
    p = numbered.withColumn(at, permuted(F.col("row_number"), size, key))
    return p.withColumns({"shard": (F.col(at) % shards).cast("int"), "slot": F.floor(F.col(at) / shards).cast("long")}).drop(at)


def write_shards(
    docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text", shards: int = SHARDS, key: int = KEY, rows_per_file: int = ROWS_PER_FILE
) -> None:
    """Write ``docs`` as Parquet under ``path``, one folder ``shard=k`` each,
    rows in slot order, at most ``rows_per_file`` rows in a file. Rows with a
    NULL id or text and repeated rows are written each; an empty table writes no
    file. Further columns may have any names but those of ``deal``."""
    hash_, part = fresh_names(docs, "hash", "part")
    hashed = docs.withColumn(hash_, F.xxhash64(F.col(id_col), F.coalesce(F.col(text_col), F.lit(""))))
    dealt = deal(hashed, id_col, hash_, shards, key).drop(hash_)
    dealt = dealt.withColumn(part, F.floor(F.col("slot") / rows_per_file)).repartition("shard", part).sortWithinPartitions("shard", "slot")
    dealt.drop(part).write.mode("overwrite").option("maxRecordsPerFile", rows_per_file).partitionBy("shard").parquet(path)
