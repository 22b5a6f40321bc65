"""SimHash near-duplicates, found with pivot distance tables.

A fingerprint is 64 bits: of every shingle's 64-bit hash a bit is counted,
and a fingerprint bit is set if it is set in more than half of the hashes.
Two fingerprints link if they differ in at most ``max_bits`` bits; a class is
what links connect.

**Pivot distance tables.** A pivot is a reference fingerprint; the table of a
fingerprint holds its Hamming distances to many pivots. By the triangle
inequality two fingerprints within ``max_bits`` differ by at most that in
every coordinate, so a pair whose largest coordinate difference is more is
discarded without being compared; survivors are verified on all 64 bits.

The tables are also what fingerprints meet by, so that not every pair is
looked at. Next to the scattered pivots stand the axis pivots: the zero
fingerprint and the 64 that have one bit. The distance to an axis pivot less
the distance to zero is +1 or -1, and differs between two fingerprints only
where they differ themselves: in at most ``max_bits`` of the 64 coordinates.
With the coordinates dealt into ``max_bits + 3`` blocks, two linked
fingerprints agree on all coordinates of three blocks at least. Each
fingerprint is therefore filed once under each choice of three blocks (35
choices for 4 bits), and only those filed together are compared. That is
exact: no link is missed and no bin is capped.

**Large bins.** Many near copies of one text share bins. Bins are read in
sorted runs; a run is compared in chunks of ``CHUNK`` fingerprints, and what
a chunk finds leaves as a spanning forest (fewer edges than members), never
as all pairs. Runs longer than a chunk are dealt out again, one task for each
pair of chunks. Equal fingerprints are one before any of this.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column, fresh_names, materialize, sort_key, text_bytes
from tessera.llm.components import components

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
#: Fingerprints of one bin that are compared with each other in one step.
CHUNK = 4096
#: Shingle hashes held at once while a long text is counted.
HASHES_AT_ONCE = 1 << 16
#: Scattered pivots of the table.
PIVOTS = 16


def scattered_pivots(n: int = PIVOTS) -> np.ndarray:
    """``n`` reference fingerprints: rows of the 64 x 64 Hadamard matrix,
    which differ from each other in exactly 32 bits."""
    i = np.arange(64, dtype=np.uint64)
    # rows that are spread over the index range, beginning with the one that changes fastest
    rows = [(2 * k + 1) * 64 // (2 * n) for k in range(n)]
    bits = [(np.bitwise_count(i & np.uint64(r)) & 1).astype(np.uint64) for r in rows]
    return np.array([np.bitwise_or.reduce(b << i) for b in bits], dtype=np.uint64)


def pivot_table(fps: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """Hamming distances (rows: pivots, columns: fingerprints)."""
    return np.bitwise_count(pivots[:, None] ^ fps[None, :]).astype(np.int8)


def words_of(text: bytes) -> list[bytes]:
    """Words between ASCII white space, A-Z lower-cased."""
    return text.lower().split()


def fingerprint(text: bytes, shingle: int = SHINGLE_WORDS) -> int:
    """The fingerprint of one whole UTF-8 text, unsigned."""
    words = words_of(text)
    if not words:
        return 0
    hash_ = xxhash.xxh64_intdigest
    if len(words) <= shingle:
        return hash_(b" ".join(words), SEED)
    total = len(words) - shingle + 1
    if total <= HASHES_AT_ONCE:
        parts = [words]
    else:
        parts = (words[i : i + HASHES_AT_ONCE + shingle - 1] for i in range(0, total, HASHES_AT_ONCE))
    ones = np.zeros(64, dtype=np.int64)
    for part in parts:
        grams = map(b" ".join, zip(*(part[i:] for i in range(shingle)), strict=False))
        h = np.fromiter((hash_(g, SEED) for g in grams), dtype="<u8", count=len(part) - shingle + 1)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<u8")[0])


def _row_key(id_col: str, text_col: str):
    return F.xxhash64(column(id_col).cast("long"), F.coalesce(column(text_col), F.lit("")))


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE_WORDS) -> DataFrame:
    """``(doc_id, row_key, fp)`` of every row; ``fp`` is the fingerprint as a
    signed long, ``row_key`` a hash of id and text. NULL and empty texts, and
    texts without a word, get fingerprint 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = np.fromiter((fingerprint(t, shingle) for t in text_bytes(b.column(2))), dtype=np.uint64, count=b.num_rows)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(fp.view(np.int64))], ["doc_id", "row_key", "fp"])

    rows = docs.select(column(id_col).cast("long").alias("doc_id"), _row_key(id_col, text_col).alias("row_key"), column(text_col).alias("text"))
    return rows.mapInArrow(run, "doc_id long, row_key long, fp long")


def _masks(max_bits: int) -> list[int]:
    """The bits of each choice of three blocks of coordinates."""
    cuts = np.linspace(0, 64, max_bits + 4).round().astype(int)
    blocks = [sum(1 << i for i in range(a, b)) for a, b in zip(cuts, cuts[1:], strict=False)]
    return [a | b | c for a, b, c in combinations(blocks, 3)]


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _bins(fps: DataFrame, max_bits: int) -> DataFrame:
    """``(bin, fp)``: each fingerprint under each choice of three blocks of
    its axis coordinates. +1 and -1 are the bits themselves, so a bin is a
    hash of the chosen bits; a clash of hashes costs a comparison only."""
    masks = _masks(max_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = b.column(0).to_numpy(zero_copy_only=False).view(np.uint64)
            for k, m in enumerate(masks):
                with np.errstate(over="ignore"):
                    bin_ = _mix(_mix(fp & np.uint64(m)) + np.uint64((k + 1) * 0x9E3779B97F4A7C15 % 2**64))
                yield pa.RecordBatch.from_arrays([pa.array(bin_.view(np.int64)), b.column(0)], ["bin", "fp"])

    return fps.mapInArrow(run, "bin long, fp long")


def _labels(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The smallest index that each of ``n`` can reach over the pairs (i, j)."""
    at = np.arange(n)
    while True:
        low = np.minimum(at[i], at[j])
        new = at.copy()
        np.minimum.at(new, at[i], low)
        np.minimum.at(new, at[j], low)
        while not np.array_equal(new, new[new]):
            new = new[new]
        if np.array_equal(new, at):
            return at
        at = new


def linked(x: np.ndarray, y: np.ndarray, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Indices of the pairs of ``x`` and ``y`` (fingerprints) that differ in
    at most ``max_bits`` bits: by the pivot tables first, coordinate after
    coordinate, then by all 64 bits."""
    tx, ty = pivot_table(x, pivots), pivot_table(y, pivots)
    i, j = np.nonzero(np.abs(tx[0][:, None] - ty[0][None, :]) <= max_bits)
    for k in range(1, len(pivots)):
        keep = np.abs(tx[k][i] - ty[k][j]) <= max_bits
        i, j = i[keep], j[keep]
    keep = np.bitwise_count(x[i] ^ y[j]) <= max_bits
    return i[keep], j[keep]


def _forest(x: np.ndarray, y: np.ndarray | None, max_bits: int, pivots: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links within ``x`` (``y`` None), or between
    ``x`` and ``y``, as pairs of fingerprints. The table is made in strips,
    so that memory stays bounded."""
    both = x if y is None else np.concatenate([x, y])
    other, shift = (x, 0) if y is None else (y, len(x))
    at = np.arange(len(both))
    strip = max(1, (1 << 20) // len(other))
    for s in range(0, len(x), strip):
        i, j = linked(x[s : s + strip], other[s:] if y is None else other, max_bits, pivots)
        i, j = i + s, j + (s if y is None else shift)
        new = at[i] != at[j]
        if new.any():
            at = _labels(len(both), np.concatenate([i[new], np.arange(len(both))]), np.concatenate([j[new], at]))
    child = np.flatnonzero(at != np.arange(len(both)))
    return both[child], both[at[child]]


_LINKS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("bin", pa.int64()), ("chunk", pa.int32())])


def _links_batch(a: np.ndarray, b: np.ndarray) -> pa.RecordBatch:
    n = len(a)
    return pa.RecordBatch.from_arrays(
        [pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.nulls(n, pa.int64()), pa.nulls(n, pa.int32())], schema=_LINKS
    )


def _within_runs(max_bits: int, chunk: int):
    """Links inside the chunks of each run of equal bins. A run of more than
    one chunk also leaves its members, numbered by chunk (``bin`` not NULL)."""
    pivots = scattered_pivots()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held_k, held_v, number = np.empty(0, np.int64), np.empty(0, np.uint64), 0

        def done(v: np.ndarray, out: list) -> None:
            if len(v) > 1:
                out.append(_forest(v, None, max_bits, pivots))

        def members(k: int, v: np.ndarray, no: int) -> pa.RecordBatch:
            n = len(v)
            cols = [pa.array(v.view(np.int64)), pa.nulls(n, pa.int64()), pa.array(np.full(n, k)), pa.array(np.full(n, no, np.int32))]
            return pa.RecordBatch.from_arrays(cols, schema=_LINKS)

        for b in batches:
            k = np.concatenate([held_k, b.column(0).to_numpy(zero_copy_only=False)])
            v = np.concatenate([held_v, b.column(1).to_numpy(zero_copy_only=False).view(np.uint64)])
            starts = np.flatnonzero(np.concatenate([[True], k[1:] != k[:-1]])) if len(k) else np.empty(0, int)
            ends = np.append(starts[1:], len(k))
            out: list = []
            for s, e in zip(starts[:-1], ends[:-1], strict=True):
                if e - s == 1 and number == 0:
                    continue
                while e - s > chunk:
                    done(v[s : s + chunk], out)
                    yield members(k[s], v[s : s + chunk], number)
                    s, number = s + chunk, number + 1
                done(v[s:e], out)
                if number:
                    yield members(k[s], v[s:e], number)
                number = 0
            s = starts[-1] if len(starts) else 0
            while len(k) - s > chunk:  # the run that may go on: whole chunks leave at once
                done(v[s : s + chunk], out)
                yield members(k[s], v[s : s + chunk], number)
                s, number = s + chunk, number + 1
            held_k, held_v = k[s:], v[s:]
            if out:
                yield _links_batch(np.concatenate([x[0] for x in out]), np.concatenate([x[1] for x in out]))
        out = []
        done(held_v, out)
        if number and len(held_v):
            yield members(held_k[0], held_v, number)
        if out:
            yield _links_batch(*out[0])

    return run


def _between_chunks(members: DataFrame, max_bits: int) -> DataFrame:
    """Links between the chunks of a long run, one task for each two."""
    pivots = scattered_pivots()
    last = members.groupBy("bin").agg(F.max("chunk").alias("last"))
    dealt = members.join(last, "bin").select(
        "bin", "chunk", "fp", F.explode(F.sequence(F.lit(0), "last")).alias("other")
    ).where("chunk <> other").select("bin", F.least("chunk", "other").alias("i"), F.greatest("chunk", "other").alias("j"), "chunk", "fp")

    def run(t: pa.Table) -> pa.Table:
        fp = t.column("fp").to_numpy().view(np.uint64)
        left = t.column("chunk").to_numpy() == t.column("i").to_numpy()
        a, b = _forest(fp[left], fp[~left], max_bits, pivots) if left.any() and not left.all() else (fp[:0], fp[:0])
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    return dealt.groupBy("bin", "i", "j").applyInArrow(run, "a long, b long")


def links(fps: DataFrame, max_bits: int = MAX_BITS, chunk: int = CHUNK) -> DataFrame:
    """Edges ``(a, b)`` that connect the distinct fingerprints ``fps`` (one
    column ``fp``) exactly as all links of at most ``max_bits`` bits would."""
    found = materialize(
        _bins(fps, max_bits).repartition("bin").sortWithinPartitions("bin").mapInArrow(
            _within_runs(max_bits, chunk), "a long, b long, bin long, chunk int"
        ),
        "simhash-links",
    )
    members = found.where("bin is not null").select("bin", "chunk", F.col("a").alias("fp"))
    return found.where("bin is null").select("a", "b").unionByName(_between_chunks(members, max_bits)).distinct()


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE_WORDS,
    max_bits: int = MAX_BITS,
    chunk: int = CHUNK,
) -> DataFrame:
    """``(doc_id, row_key, fp, root, component_id)``, a row for each row of ``docs``.

    ``root`` names the class (a fingerprint of it), ``component_id`` is the
    smallest id in it. NULL, empty and blank texts have fingerprint 0 and link
    like any other. Rows with a NULL id take part and get their class; a class
    of such rows only has a NULL ``component_id``. Repeated rows stay
    repeated. An empty table gives an empty result.
    """
    fps = materialize(fingerprints(docs, id_col, text_col, shingle), "simhash-fingerprints")
    each = fps.groupBy("fp").agg(F.min("doc_id").alias("low"))
    roots = components(links(each.select("fp"), max_bits, chunk), "simhash-components")
    named = each.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    named = materialize(named, "simhash-classes")
    low = named.groupBy("root").agg(F.min("low").alias("component_id"))
    classes = named.select("fp", "root").join(low, "root")
    return fps.join(classes, "fp").select("doc_id", "row_key", "fp", "root", "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` with one row of each near-duplicate class, all
    columns kept: the row of the smallest id (NULL last); among repeated rows
    of that id and text, the one whose other columns sort first as JSON. The
    columns may have any names and types."""
    classes = near_duplicates(docs, id_col, text_col, **how)
    best = classes.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("k"))
    key, low, own = fresh_names(docs, "key", "low", "own")
    best = best.select(F.col("k.row_key").alias(key), F.col("k.doc_id").alias(low))
    keyed = docs.withColumn(own, _row_key(id_col, text_col))
    kept = keyed.join(best, (F.col(own) == F.col(key)) & column(id_col).cast("long").eqNullSafe(F.col(low)))
    # one row of each key, map-side first, so that a row repeated often is one
    rows = kept.groupBy(key, low).agg(F.min_by(F.struct(*map(column, docs.columns)), sort_key(docs, (id_col, text_col))).alias("row"))
    return rows.select(*(F.col("row").getField(c).alias(c) for c in docs.columns))
