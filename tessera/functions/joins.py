"""Join helpers.

Joins in the reference are dplyr joins: NULL keys match NULL keys (G2). Spark
plans ``<=>`` keys as ordinary equi-join keys, so null-safe joins keep the
hash/sort-merge strategies.

No helper here forces a broadcast: aggregates joined back to their source
are sized by their keys, which the data decides. They are written first, so
that the planner's size is the real one and a join becomes a broadcast only
when the side is small.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.session import materialize


def join_ns(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Null-safe equi-join on same-named ``keys``; one copy of each key is kept.

    For ``right``/``full`` joins the key is coalesced from both sides.
    """
    keys = list(keys)
    tmp = {k: f"__r_{k}" for k in keys}
    r = right.withColumnsRenamed(tmp)
    cond = None
    for k in keys:
        c = F.col(k).eqNullSafe(F.col(tmp[k]))
        cond = c if cond is None else cond & c
    out = left.join(r, cond, how)
    if how in ("left_semi", "semi", "left_anti", "anti"):
        return out
    if how in ("right", "right_outer", "full", "outer", "full_outer"):
        out = out.withColumns({k: F.coalesce(F.col(k), F.col(tmp[k])) for k in keys})
    return out.drop(*tmp.values())


def join_back(rows: DataFrame, agg: DataFrame, keys: Sequence[str], how: str = "inner", name: str = "groups") -> DataFrame:
    """Join a per-group aggregate back to the rows it summarizes (null-safe).

    The aggregate is first written to the shared folder, so the planner sees
    its real size: a small one is broadcast and the rows are never shuffled
    for this join; a large one gets a shuffle join. Either way a lost executor
    re-reads a file.
    """
    return join_ns(rows, materialize(agg, name), keys, how)
