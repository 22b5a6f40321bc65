"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each source has a weight and a size (the words of its documents). The mix
shares a total among the sources by weight; no target is above ``max_epochs``
times its source's size, and what exceeds that is shared again by weight.
A source is taken in complete epochs first; what remains of its target is
filled with a weighted sample without replacement: every document draws the
key -ln(u) / quality from a digest of its id and text, the documents of a source
are sorted by key, and those whose words fit the remaining budget are taken.

A source may hold most of the rows, so it is never sorted in one task: keys
fall into ranges (more for sources with more documents; none holds many,
whatever the qualities), the words of each range are summed, a window over ranges gives the words before each of them,
and only the documents of one range are sorted together.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import column, fresh_names, materialize, sort_key

WEIGHTS = (3, 1, 2)
TOTAL_SHARE = 1.5
MAX_EPOCHS = 2
SEED = 7
#: Documents that one range of keys holds on average.
ROWS_PER_RANGE = 2_000
#: Fewest ranges of keys, so that small tables still spread.
MIN_RANGES = 64
_NOT_LETTER = bytes(i for i in range(128) if not chr(i).isalpha())
_SPACE = b" \t\n\x0b\x0c\r"


def word_stats(text: Column) -> Column:
    """Struct of ``size`` (words between ASCII white space) and ``quality``:
    the share of letters (and of all bytes beyond ASCII) among the bytes that
    are not white space, 0.05 at least, in steps of 1/1024. NULL: 0 words."""

    @F.pandas_udf("size long, quality double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for t in b:
                raw = (t or "").encode("utf-8", "surrogatepass")
                solid = len(raw.translate(None, _SPACE))
                letters = len(raw.translate(None, _NOT_LETTER))
                rows.append((len(raw.split()), max(0.05, letters * 1024 // solid / 1024) if solid else 1.0))
            yield pd.DataFrame(rows, columns=["size", "quality"])

    return run(text)


def source_targets(
    sizes: DataFrame,
    weights: tuple[int, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_epochs: int = MAX_EPOCHS,
) -> DataFrame:
    """``(src, source, source_size, target)`` from ``(src, source, source_size)``;
    ``src`` is a key of the source that is never NULL.

    Weights repeat over the sources by code point, NULL last. The targets are
    ``min(scale * weight, max_epochs * size)`` with the scale at which they
    add up; it is found by freezing the sources above their cap and sharing
    the rest again until none is above. Each round is one aggregate of the
    sources and sends three numbers to the driver."""
    ranked = sizes.withColumn(
        "__rank", F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    )
    ws = F.array(*map(F.lit, weights))
    ranked = materialize(
        ranked.select("src", "source", "source_size", F.element_at(ws, (F.col("__rank") % len(weights) + 1).cast("int")).cast("long").alias("w")),
        "mix-sources",
    )
    cap = F.col("source_size") * max_epochs
    total = (ranked.agg(F.sum("source_size").alias("s")).first()["s"] or 0) * total_share
    scale, over = 0.0, -1
    while True:
        full = F.lit(scale) * F.col("w") >= cap if over >= 0 else F.lit(False)
        row = ranked.agg(
            F.sum(F.when(full, cap)).alias("fixed"), F.sum(F.when(~full, F.col("w"))).alias("w"), F.count(F.when(full, 1)).alias("over")
        ).first()
        if row["over"] == over or not row["w"]:
            break
        over, scale = row["over"], (total - (row["fixed"] or 0)) / row["w"]
    target = F.least(F.lit(scale) * F.col("w"), cap.cast("double"))
    if row["over"] and not row["w"]:
        target = cap.cast("double")
    return ranked.select("src", "source", "source_size", target.alias("target"))


def _row_key(id_col: str, text_col: str, source_col: str, seed: int) -> Column:
    return F.xxhash64(column(id_col).cast("long"), F.coalesce(column(text_col), F.lit("")), column(source_col).cast("string"), F.lit(seed))


def key_cell(key: Column, ranges: int) -> Column:
    """The key's range, ascending with the key. Of keys -ln(u) / quality with
    qualities up to 1, whatever they are, a range is expected to hold at most
    1 / ``ranges``: keys are dense by 1 at most, their logarithms by 1/e."""
    return F.floor(F.when(key < 1, key).otherwise(1 + F.log(key) / math.e) * ranges).cast("long")


def mix(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    weights: tuple[int, ...] = WEIGHTS,
    total_share: float = TOTAL_SHARE,
    max_epochs: int = MAX_EPOCHS,
    seed: int = SEED,
    rows_per_range: int = ROWS_PER_RANGE,
) -> DataFrame:
    """``(doc_id, row_key, source, size, source_size, target, epochs, taken)``
    of every row: ``epochs`` is how often the document is in the mix, ``taken``
    its words there. In the last, partial epoch the documents are taken in
    order of their keys while the middle of a document lies within the budget,
    so a source misses its target by half a document at most.

    NULL sources are one source; NULL and empty texts have size 0 and are
    taken 0 words; repeated rows count one by one, with one key; sources without a word have target 0. Reruns give the same mix, as
    keys are digests of id, text and ``seed``."""
    drawn = F.concat_ws("|", F.lit(seed), column(id_col).cast("long").cast("string"), column(text_col))
    rows = docs.select(
        column(id_col).cast("long").alias("doc_id"),
        F.conv(F.substring(F.md5(F.encode(drawn, "UTF-8")), 1, 13), 16, 10).cast("long").alias("draw"),
        _row_key(id_col, text_col, source_col, seed).alias("row_key"),
        column(source_col).cast("string").alias("source"),
        word_stats(column(text_col)).alias("s"),
    ).select("doc_id", "row_key", "draw", "source", "s.size", "s.quality")
    # a source's name as a key that is never NULL
    rows = materialize(rows.withColumn("src", F.coalesce(F.concat(F.lit("="), "source"), F.lit("-"))), "mix-rows")

    sizes = rows.groupBy("src").agg(F.first("source").alias("source"), F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sizes = materialize(sizes, "mix-sizes")
    targets = source_targets(sizes.select("src", "source", "source_size"), weights, total_share, max_epochs)
    largest = sizes.agg(F.max("n")).first()[0] or 0
    ranges = max(MIN_RANGES, math.ceil(largest / rows_per_range))

    # u in (0, 1), drawn by 52 bits of the digest, gives the exponential key, divided by the quality
    u = (F.col("draw") + F.lit(0.5)) / F.lit(float(1 << 52))
    keyed = rows.withColumn("key", -F.log(u) / F.col("quality"))
    keyed = keyed.withColumn("cell", key_cell(F.col("key"), ranges))
    before = Window.partitionBy("src").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    cells = keyed.groupBy("src", "cell").agg(F.sum("size").alias("cell_size"))
    cells = cells.select("src", "cell", F.coalesce(F.sum("cell_size").over(before), F.lit(0)).alias("before")).join(targets, "src")

    order = Window.partitionBy("src", "cell").orderBy("key", "doc_id", "row_key", "size")
    out = keyed.drop("source").join(cells, ["src", "cell"])
    out = out.withColumn("upto", F.col("before") + F.sum("size").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    whole = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    out = out.withColumn("whole", whole)
    rest = F.col("target") - F.col("whole") * F.col("source_size")
    extra = (F.col("upto") - F.col("size") / 2 <= rest) & (rest > 0)
    out = out.withColumn("epochs", F.col("whole") + extra.cast("long"))
    return out.select(
        "doc_id", "row_key", "source", "size", "source_size", "target", "epochs", (F.col("epochs") * F.col("size")).alias("taken")
    )


def mixed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **how) -> DataFrame:
    """The mix itself: each row of ``docs`` as often as it was taken, all its
    columns kept, of any names and types. Rows that the mix leaves out, and rows
    without a word, are not in it."""
    each = mix(docs, id_col, text_col, source_col, **how)
    seed = how.get("seed", SEED)
    key, own, sum_, n, turn, copy = fresh_names(docs, "key", "own", "epochs", "n", "turn", "copy")
    # repeated rows share a key; what was taken of them is dealt to them in turn
    taken = each.groupBy(F.col("row_key").alias(key)).agg(F.sum(F.when(F.col("taken") > 0, F.col("epochs"))).alias(sum_), F.count("*").alias(n))
    keyed = docs.withColumn(own, _row_key(id_col, text_col, source_col, seed))
    joined = keyed.join(taken.where(F.col(sum_) > 0), F.col(own) == F.col(key))
    order = Window.partitionBy(own).orderBy(sort_key(docs, (id_col, text_col, source_col)))
    joined = joined.withColumn(turn, F.row_number().over(order) - 1)
    times = F.floor(F.col(sum_) / F.col(n)) + (F.col(turn) < F.col(sum_) % F.col(n)).cast("long")
    copies = joined.withColumn(turn, times.cast("int")).where(F.col(turn) > 0)
    copies = copies.withColumn(copy, F.explode(F.sequence(F.lit(1), F.col(turn))))
    return copies.select(*map(column, docs.columns))
