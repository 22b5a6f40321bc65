"""Column-set helpers: one expression over every column with a prefix (P8),
selection by prefix (P9), renames by list (P3)."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def prefixed(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def map_prefixed(df: DataFrame, prefix: str, fn: Callable[[Column], Column]) -> DataFrame:
    """Replace every column whose name starts with ``prefix`` by ``fn(col)``,
    keeping names and order (``mutate(across(starts_with(prefix), fn))``)."""
    targets = set(prefixed(df, prefix))
    return df.select(*[fn(F.col(c)).alias(c) if c in targets else F.col(c) for c in df.columns])


def select_prefixed(df: DataFrame, prefix: str, keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` columns followed by every column starting with ``prefix``."""
    return df.select(*keep, *prefixed(df, prefix))


def rename_list(df: DataFrame, old: Sequence[str], new: Sequence[str]) -> DataFrame:
    """Rename columns by parallel name lists (``rename_at``)."""
    return df.withColumnsRenamed(dict(zip(old, new)))
