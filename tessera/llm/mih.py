"""Nearest neighbours by largest inner product, with multi-index hashing.

**Codes.** Vectors get one more component, so that all have the largest norm;
the angle to a query (with 0 there) then orders vectors as the inner product
does. A code has the signs of the vector under learned rotations: iterative
quantisation turns the axes of a bounded sample so that signs lose least, from
as many random starts as ``CODE_BITS`` asks for, less what would fill no
substring: all substrings have the same number of bits, none is padded.

**Index.** A code is split into substrings of 16 bits, and each substring is
an index of its own: its values, and the rows that have each. A code within
``radius`` bits of a query is, in at least one substring, within the share of
the radius that the pigeonhole principle gives that substring; probing every
value within these shares retrieves every code within the radius. What the
probes retrieve is checked on the whole code, and what is left is ranked by
the inner product of the original vectors in double precision.

How much the probes leave out depends on the radius. Vectors whose neighbours
are near have a small one; for nearly isotropic vectors the radius that keeps
the recall is two fifths of the bits, and then the substrings together
retrieve nearly every row: the search is a scan (figures in the README).

**Radius.** The radius is the one within which ``SAMPLE_RECALL`` of the true
neighbours of sample queries lie, among the sample. Neighbours among all rows
are nearer than those in a sample, so the recall over the table is higher. A
query that finds fewer than ``k`` rows within the radius is asked again of all
rows, so every query gets its ``k``.

**On Spark.** Queries and rows are cut into blocks by hash; each pair of a
query block and a row block is one task, which builds the substring indexes of
its rows, probes them, and returns the ``k`` best of each query. Only those
are shuffled again. Sizes in a task are bounded by the block sizes, and a
vector that fills a third of the table fills no more of a block than of the
table. The table is never collected; the sample is bounded by ``SAMPLE_ROWS``.
"""

from __future__ import annotations

import functools
import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize

K = 20
CODE_BITS = 256
SUBSTRING_BITS = 16
SAMPLE_ROWS = 4_000
SAMPLE_QUERIES = 400
SAMPLE_RECALL = 0.985
QUERY_BLOCK = 4_096
ROW_BLOCK = 4_096
_STRIP = 64
_SEED = 20


class Codes:
    """Learned rotations and the radius."""

    def __init__(self, norm: float, rotations: list[np.ndarray], radius: int = 0):
        self.norm, self.rotations, self.radius = norm, rotations, radius

    @property
    def bits(self) -> int:
        return sum(r.shape[1] for r in self.rotations)

    def encode(self, x: np.ndarray, query: bool = False) -> np.ndarray:
        """Codes of the rows of ``x``, as rows of 16-bit substrings."""
        lifted = lift(x, self.norm, query)
        bits = np.concatenate([lifted @ r > 0 for r in self.rotations], axis=1)
        return np.packbits(bits, axis=1, bitorder="little").view("<u2")


def lift(x: np.ndarray, norm: float, query: bool) -> np.ndarray:
    """One more component: 0 for queries, else what ``norm`` lacks."""
    square = (x * x).sum(axis=1)
    extra = np.zeros(len(x)) if query else np.sqrt(np.maximum(0, norm * norm - square))
    scale = np.sqrt(square) if query else norm
    return np.concatenate([x, extra[:, None]], axis=1) / np.reshape(scale, (-1, 1) if query else ())


def _rotation(x: np.ndarray, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Iterative quantisation: the rotation from a random start whose signs
    are nearest to the rotated sample."""
    r = np.linalg.qr(rng.standard_normal((x.shape[1], x.shape[1])))[0]
    for _ in range(rounds if len(x) else 0):
        u, _, vt = np.linalg.svd(x.T @ np.where(x @ r > 0, 1.0, -1.0))
        r = u @ vt
    return r


def fit(sample: np.ndarray, norm: float, k: int = K, code_bits: int = CODE_BITS, recall: float = SAMPLE_RECALL) -> Codes:
    """Rotations and radius from the rows of ``sample``."""
    rng = np.random.default_rng(_SEED)
    x = lift(sample, norm, False)
    whole = math.ceil(code_bits / SUBSTRING_BITS) * SUBSTRING_BITS
    rotations = [_rotation(x, rng) for _ in range(max(1, math.ceil(whole / x.shape[1])))]
    # equal substrings of real bits: directions that would begin one they cannot fill are left out
    over = sum(r.shape[1] for r in rotations) % SUBSTRING_BITS
    rotations[-1] = rotations[-1][:, : rotations[-1].shape[1] - over]
    codes = Codes(norm, rotations)
    q = sample[: min(SAMPLE_QUERIES, len(sample))]
    score = q @ sample.T
    np.fill_diagonal(score, -np.inf)
    n = min(k, len(sample) - 1)
    if n < k:
        codes.radius = codes.bits
        return codes
    near = np.argpartition(-score, n - 1, axis=1)[:, :n]
    far = hamming(codes.encode(q, True)[:, None, :], codes.encode(sample)[near])
    codes.radius = int(np.quantile(far, recall, method="higher"))
    return codes


def hamming(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).sum(axis=-1, dtype=np.int32)


def shares(radius: int, substrings: int) -> list[int]:
    """Radius of each substring: were a code farther than that in all of
    them, it would be farther than ``radius`` in the whole. -1: no probe."""
    whole, over = divmod(radius, substrings)
    return [whole if j <= over else whole - 1 for j in range(substrings)]


def probe(queries: np.ndarray, rows: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs (query, row) whose codes are within ``radius`` bits: every
    substring's index is probed, retrieved codes are checked whole."""
    index = [np.unique(rows[:, j], return_inverse=True) for j in range(rows.shape[1])]
    parts = shares(radius, rows.shape[1])
    out_q, out_r = [], []
    for s in range(0, len(queries), _STRIP):
        q = queries[s : s + _STRIP]
        got = np.zeros((len(q), len(rows)), dtype=bool)
        for j, (values, where) in enumerate(index):
            if parts[j] >= 0:
                hit = np.bitwise_count(q[:, j, None] ^ values[None, :]) <= parts[j]
                got |= hit[:, where]
        i, r = np.nonzero(got)
        for a in range(0, len(i), 1 << 18):
            ii, rr = i[a : a + (1 << 18)], r[a : a + (1 << 18)]
            keep = hamming(q[ii], rows[rr]) <= radius
            out_q.append(ii[keep] + s)
            out_r.append(rr[keep])
    return (np.concatenate(out_q), np.concatenate(out_r)) if out_q else (np.empty(0, int), np.empty(0, int))


def best(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, r: np.ndarray, i: np.ndarray, j: np.ndarray, k: int):
    """The ``k`` best rows of each query among the pairs (i, j), as places of
    queries, ids and scores; rows with the query's id are left out."""
    own = qid[i] != rid[j]
    i, j = i[own], j[own]
    score = np.empty(len(i))
    for a in range(0, len(i), 1 << 14):
        score[a : a + (1 << 14)] = np.einsum("nd,nd->n", q[i[a : a + (1 << 14)]], r[j[a : a + (1 << 14)]])
    order = np.lexsort((rid[j], -score, i))
    i, j, score = i[order], j[order], score[order]
    first = np.searchsorted(i, i, side="left")
    top = np.arange(len(i)) - first < k
    return i[top], rid[j[top]], score[top]


def valid_vectors(table: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """``(row, vec_id, vector)`` of the rows that take part: id not NULL, vector
    neither NULL, empty nor zero, all components finite. ``row`` is a number of
    its own for each row, as ids may repeat."""
    v = F.col("vector")
    rows = table.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    rows = rows.where("vec_id is not null and size(vector) > 0")
    rows = rows.where(F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0))
    return materialize(rows.select(F.monotonically_increasing_id().alias("row"), "vec_id", "vector"), "vectors")


_FOUND = "query_row long, query_id long, vec_id long, score double"
_EMPTY = pa.table({"query_row": pa.array([], pa.int64()), "query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})


def _vectors(column: pa.ChunkedArray) -> np.ndarray:
    column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else np.empty((0, 1))


def _search(queries: DataFrame, rows: DataFrame, codes: Codes, n_queries: int, n_rows: int, k: int, radius: int) -> DataFrame:
    """The ``k`` best of each query within each block of rows."""
    qb, rb = max(1, math.ceil(n_queries / QUERY_BLOCK)), max(1, math.ceil(n_rows / ROW_BLOCK))
    norm, rotations = codes.norm, codes.rotations

    def block(n: int, salt: int) -> Column:
        return F.pmod(F.xxhash64("row", F.lit(salt)), F.lit(n)).cast("int")

    def all_of(n: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(n - 1)))

    sides = queries.select("row", "vec_id", "vector", F.lit(True).alias("is_query"), block(qb, 1).alias("q"), all_of(rb).alias("r")).unionByName(
        rows.select("row", "vec_id", "vector", F.lit(False).alias("is_query"), block(rb, 2).alias("r"), all_of(qb).alias("q"))
    )

    def run(t: pa.Table) -> pa.Table:
        is_query = t.column("is_query").combine_chunks()
        q, r = t.filter(is_query), t.filter(pc.invert(is_query))
        if not len(q) or not len(r):
            return _EMPTY
        own = Codes(norm, rotations)
        qv, rv = _vectors(q.column("vector")), _vectors(r.column("vector"))
        i, j = probe(own.encode(qv, True), own.encode(rv), radius)
        a, b, s = best(q.column("vec_id").to_numpy(), qv, r.column("vec_id").to_numpy(), rv, i, j, k)
        return pa.table({"query_row": q.column("row").to_numpy()[a], "query_id": q.column("vec_id").to_numpy()[a], "vec_id": b, "score": s})

    return sides.groupBy("q", "r").applyInArrow(run, _FOUND)


def nearest(
    table: DataFrame,
    is_query: Column,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    sample_rows: int = SAMPLE_ROWS,
) -> DataFrame:
    """``(query_id, rank, vec_id, score, query_row)``: for each row that
    satisfies ``is_query`` (a condition on ``vec_id``), the ``k`` rows found
    with the largest inner product, ties to the smaller id.

    Every row is a candidate, also rows of one id; those with the query's own id
    are none. Fewer than ``k`` candidates are all returned. Rows of one id that
    are queries are asked each (``query_row`` tells them apart). The inner
    product is that of vectors of one length: the rows of each length are
    searched by themselves. See ``valid_vectors`` for the rows that take part;
    an empty table, or a query without candidates, gives no rows."""
    rows = valid_vectors(table, id_col, vector_col)
    length = F.size("vector")
    sizes = rows.groupBy(length.alias("d")).agg(F.count("*").alias("n"), F.count(F.when(is_query, 1)).alias("q")).where("q > 0").orderBy("d").collect()
    found = [_nearest_of_length(rows.where(length == s["d"]), is_query, s["n"], s["q"], k, sample_rows) for s in sizes]
    if not found:
        return table.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double, query_row long")
    order = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    ranked = functools.reduce(DataFrame.unionByName, found).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score", "query_row")


def _nearest_of_length(rows: DataFrame, is_query: Column, n_rows: int, n_queries: int, k: int, sample_rows: int) -> DataFrame:
    """``_FOUND`` rows, among them the ``k`` best of each query, of vectors of one length."""
    square = F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)
    norm = math.sqrt(rows.agg(F.max(square)).first()[0]) * (1 + 1e-9)
    sample = rows.orderBy(F.xxhash64("vec_id"), "vec_id", "vector").limit(sample_rows).collect()  # bounded by sample_rows
    codes = fit(np.array([r["vector"] for r in sample]), norm, k)
    queries = rows.where(is_query)
    found = materialize(_search(queries, rows, codes, n_queries, n_rows, k, codes.radius), "neighbours")
    # queries with fewer than k rows within the radius are asked again, of all rows
    enough = found.groupBy("query_row").agg(F.count("*").alias("n")).where(F.col("n") >= k)
    again = materialize(queries.join(enough, F.col("row") == F.col("query_row"), "left_anti"), "neighbours-few")
    if left := again.count():
        more = _search(again, rows, codes, left, n_rows, k, codes.bits)
        found = found.join(again.select(F.col("row").alias("query_row")), "query_row", "left_anti").unionByName(more)
    return found
