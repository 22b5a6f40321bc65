"""Language-model scores: Katz back-off over bigrams of words.

P(v | u), for a token v after u:

* seen together c(u, v) > 0 times: d(c(u, v)) c(u, v) / c(u), where d is the
  Good-Turing discount of counts up to ``GT_MOST``; larger counts lose
  ``RELIABLE_LOSS`` of one count only, so that every history keeps some mass;
* else, if u was seen: a(u) P(v); if u was not seen: P(v);
* P(v), for a token seen alone: d(c(v)) c(v) / N; all tokens never seen are one
  unknown token, which has what the others leave.

a(u) = (1 - sum of P(v | u) over seen v) / (1 - sum of P(v) over the same v), so
the probabilities after every history add up to 1 exactly. A text's first
token follows a start mark, its last is the end mark, which is scored.

**Tables.** Words are 64-bit hashes. Texts are read once, into batches of about
``BATCH_TOKENS`` tokens: sorted distinct words, and the tokens as places among
them. The count tables are partitioned by key (equal ranges of the hash, of
about ``KEYS_PER_PARTITION`` keys each, as many as the corpus asks for): every
batch sends each partition its distinct keys and their counts in one block;
the partition adds up, answers every batch with the corpus counts of its keys,
and names one batch as owner of each key. So a very common word or bigram
is one entry a batch, nothing that grows with the corpus is broadcast, and what
is exchanged grows with the corpus. Three rounds: words, bigrams, and the two
sums of a(u), which the owners of the bigrams add up by history.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize, text_bytes

GT_MOST = 5
RELIABLE_LOSS = 0.01
BATCH_TOKENS = 2_500_000
KEYS_PER_PARTITION = 2_000_000
START, END = np.uint64(1), np.uint64(2)
FOLDS, HELD_OUT_FOLD = 5, 1


# ---- blocks of arrays ----------------------------------------------------------


def _press(a: np.ndarray) -> bytes:
    """An array, byte plane by byte plane, compressed."""
    planes = np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _open(raw: bytes, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    plain = zstandard.ZstdDecompressor().decompress(raw)
    planes = np.frombuffer(plain, np.uint8).reshape(size, len(plain) // size)
    return np.ascontiguousarray(planes.T).reshape(-1).view(kind)


def _press_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys, as differences."""
    return _press(np.diff(keys, prepend=np.uint64(0)))


def _open_keys(raw: bytes) -> np.ndarray:
    return np.cumsum(_open(raw, "<u8"), dtype=np.uint64)


def _cuts(keys: np.ndarray, parts: int) -> np.ndarray:
    """Where the keys of each of ``parts`` equal ranges of the hash begin."""
    edges = np.array([(2**64 * p + parts - 1) // parts for p in range(1, parts)], dtype=np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges, side="left"), [len(keys)]])


def pair_keys(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """64-bit hashes of bigrams from those of their words."""
    with np.errstate(over="ignore"):
        x = u * np.uint64(0x9E3779B97F4A7C15) + (v ^ (v >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F)
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


# ---- the model -----------------------------------------------------------------


def discounts(count_of_counts: list[int]) -> np.ndarray:
    """d(0) .. d(GT_MOST) from the numbers of keys seen 1, 2, .. GT_MOST + 1
    times. Where Good-Turing gives no discount between 0 and 1 (too few keys
    to tell), half a count is taken off instead."""
    n = [0, *count_of_counts]
    out = np.ones(GT_MOST + 1)
    common = (GT_MOST + 1) * n[GT_MOST + 1] / n[1] if n[1] else 1.0
    for r in range(1, GT_MOST + 1):
        d = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if n[r] and common < 1 else 0.0
        out[r] = d if 0 < d < 1 else (r - 0.5) / r
    return out


def discounted(c: np.ndarray, d: np.ndarray) -> np.ndarray:
    """Discounted counts."""
    c = c.astype(np.float64)
    return np.where(c <= GT_MOST, c * d[np.minimum(c, GT_MOST).astype(np.int64)], c - RELIABLE_LOSS)


class Model:
    """What the driver knows of the corpus: a few numbers."""

    def __init__(self, words: dict[str, int], bigrams: dict[str, int], documents: int):
        self.tokens, self.types, self.documents = words["total"], words["types"], documents
        self.word_d = discounts([words[f"n{r}"] for r in range(1, GT_MOST + 2)])
        self.pair_d = discounts([bigrams[f"n{r}"] for r in range(1, GT_MOST + 2)])
        n = [words[f"n{r}"] for r in range(1, GT_MOST + 1)]
        lost = sum(k * r * (1 - self.word_d[r]) for r, k in enumerate(n, 1)) + RELIABLE_LOSS * (self.types - sum(n))
        self.unknown = lost / self.tokens if self.tokens else 1.0

    def word_probability(self, c: np.ndarray) -> np.ndarray:
        return np.where(c > 0, discounted(c, self.word_d) / max(1, self.tokens), self.unknown)

    def base(self, c: np.ndarray) -> np.ndarray:
        return np.log10((c + 0.5) / (self.tokens + 0.5 * (self.types + 1)))


# ---- batches -------------------------------------------------------------------

_BATCH = "batch long, n_tokens long, train_docs long, doc_ids binary, flags binary, lengths binary, words binary, tokens binary"


def _batches(docs: DataFrame, id_col: str, text_col: str, held: Column, batch_tokens: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq = TaskContext.get().partitionId(), 0
        ids: list[int | None] = []
        flags: list[int] = []
        found: list[np.ndarray] = []
        size = 0
        hash_ = xxhash.xxh64_intdigest

        def full() -> pa.RecordBatch:
            words, tokens = np.unique(np.concatenate(found), return_inverse=True)
            row = {
                "batch": (part << 32) + seq,
                "n_tokens": size,
                "train_docs": sum(not f & 1 for f in flags),
                "doc_ids": np.array([i or 0 for i in ids], "<i8").tobytes(),
                "flags": bytes(flags),
                "lengths": np.array([len(x) for x in found], "<u4").tobytes(),
                "words": _press_keys(words),
                "tokens": _press(tokens.astype("<u4")),
            }
            schema = pa.schema([(n, pa.int64() if k == "long" else pa.binary()) for n, k in (c.split() for c in _BATCH.split(", "))])
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for b in batches:
            for i, h, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), text_bytes(b.column(2)), strict=True):
                own = t.lower().split()
                got = np.empty(len(own) + 1, np.uint64)
                got[:-1] = np.fromiter(map(hash_, own), np.uint64, len(own))
                got[-1] = END
                ids.append(i)
                flags.append(int(h) | (2 if i is None else 0))
                found.append(got)
                size += len(got)
                if size >= batch_tokens:
                    yield full()
                    seq, size = seq + 1, 0
                    ids, flags, found = [], [], []
        if ids:
            yield full()

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held"), F.col(text_col).alias("text"))
    return rows.mapInArrow(run, _BATCH)


class Batch:
    """A batch, opened: tokens as places in ``words``; the start mark has the
    place after the last."""

    def __init__(self, row: dict):
        self.id = row["batch"]
        self.doc_ids = np.frombuffer(row["doc_ids"], "<i8")
        flags = np.frombuffer(row["flags"], np.uint8)
        self.held, self.no_id = (flags & 1).astype(bool), (flags & 2).astype(bool)
        self.lengths = np.frombuffer(row["lengths"], "<u4").astype(np.int64)
        self.words = _open_keys(row["words"])
        self.tokens = _open(row["tokens"], "<u4").astype(np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lengths)[:-1]])
        self.train = np.repeat(~self.held, self.lengths)

    def word_counts(self) -> np.ndarray:
        return np.bincount(self.tokens[self.train], minlength=len(self.words))

    def bigrams(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Sorted keys of the distinct bigrams, the places of their words, and
        the bigram of each token."""
        before = np.concatenate([[0], self.tokens[:-1]])
        before[self.starts] = len(self.words)
        pairs, at = np.unique(before * (len(self.words) + 1) + self.tokens, return_inverse=True)
        u, v = np.divmod(pairs, len(self.words) + 1)
        keys = pair_keys(np.append(self.words, START)[u], self.words[v])
        order = np.argsort(keys, kind="stable")
        place = np.empty(len(order), np.int64)
        place[order] = np.arange(len(order))
        return keys[order], u[order], v[order], place[at]


# ---- counting: every batch asks every partition ----------------------------------

_STATS = [*(f"n{r}" for r in range(1, GT_MOST + 2)), "types", "total"]
_ASK = "part int, batch long, keys binary, counts binary"
_ANSWER = "batch long, part int, counts binary, owned binary, " + ", ".join(f"{s} long" for s in _STATS)
_KINDS = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "double": pa.float64(), "boolean": pa.bool_()}


def _schema(ddl: str) -> pa.Schema:
    return pa.schema([(n, _KINDS[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _table(rows: list[dict], ddl: str) -> pa.Table:
    return pa.Table.from_pylist(rows, schema=_schema(ddl))


def _count(batches: DataFrame, bigrams: bool, parts: int, name: str) -> DataFrame:
    """Answers: for each batch and partition the corpus counts of the batch's
    keys, and which of them it owns; a row without batch has the statistics
    of the partition."""
    ask_schema = _schema(_ASK)

    def ask(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in rows:
            for row in b.to_pylist():
                own = Batch(row)
                if bigrams:
                    keys, _, _, at = own.bigrams()
                    counts = np.bincount(at[own.train], minlength=len(keys))
                else:
                    keys, counts = own.words, own.word_counts()
                cut = _cuts(keys, parts)
                for p in range(parts):
                    k = slice(cut[p], cut[p + 1])
                    if cut[p] < cut[p + 1]:
                        made = {"part": p, "batch": own.id, "keys": _press_keys(keys[k]), "counts": _press(counts[k].astype("<u4"))}
                        yield pa.RecordBatch.from_pylist([made], schema=ask_schema)

    def answer(t: pa.Table) -> pa.Table:
        rows = sorted(t.to_pylist(), key=lambda r: r["batch"])
        keys = [_open_keys(r["keys"]) for r in rows]
        counts = [_open(r["counts"], "<u4").astype(np.int64) for r in rows]
        all_counts = np.concatenate(counts)
        distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(at, weights=all_counts, minlength=len(distinct)).astype(np.int64)
        # the owner of a key is the first batch that counts it
        counting = np.flatnonzero(all_counts > 0)
        first = np.full(len(distinct), len(at))
        np.minimum.at(first, at[counting], counting)
        owned = np.zeros(len(at), bool)
        owned[first[first < len(at)]] = True
        out, s = [], 0
        for r, k in zip(rows, keys, strict=True):
            mine = slice(s, s + len(k))
            out.append({"batch": r["batch"], "part": r["part"], "counts": _press(total[at[mine]].astype("<u8")), "owned": np.packbits(owned[mine]).tobytes()})
            s += len(k)
        stats = {f"n{r}": int((total == r).sum()) for r in range(1, GT_MOST + 2)}
        out.append({**stats, "types": int((total > 0).sum()), "total": int(total.sum()), "part": rows[0]["part"]})
        return _table(out, _ANSWER)

    asked = batches.mapInArrow(ask, _ASK)
    return materialize(asked.groupBy("part").applyInArrow(answer, _ANSWER), name)


def _stats(answers: DataFrame) -> dict[str, int]:
    row = answers.where("batch is null").agg(*[F.coalesce(F.sum(s), F.lit(0)).alias(s) for s in _STATS]).first()
    return row.asDict()


# ---- scoring -------------------------------------------------------------------

_SCORED = (
    "kind int, part int, batch long, doc_no int, doc_id long, held_out boolean, n_tokens long, n_known long, "
    "base_score double, score double, keys binary, a binary, b binary"
)
_DOC, _OPEN, _WANT, _SUM = range(4)
_SUMS = "kind int, part int, batch long, keys binary, a binary, b binary"


def _gather(rows: list[dict], field: str, kind: str) -> np.ndarray:
    rows = sorted(rows, key=lambda r: r["part"])
    return np.concatenate([_open(r[field], kind) for r in rows]) if rows else np.empty(0, kind)


def _score_batch(model: Model, parts: int):
    """All of a batch's scores but the back-off weights, which its owners'
    sums are still needed for: rows of documents, one row with the places where
    a weight is missing, and by partition the histories asked for and the sums."""

    def run(own: pa.Table, words: pa.Table, pairs: pa.Table) -> pa.Table:
        batch = Batch(own.to_pylist()[0])
        cw = _gather(words.to_pylist(), "counts", "<u8").astype(np.int64)
        answers = sorted(pairs.to_pylist(), key=lambda r: r["part"])
        keys, u, v, at = batch.bigrams()
        cb = _gather(answers, "counts", "<u8").astype(np.int64)
        cut = _cuts(keys, parts)
        owned = np.zeros(len(keys), bool)
        for r in answers:
            a, b = cut[r["part"]], cut[r["part"] + 1]
            owned[a:b] = np.unpackbits(np.frombuffer(r["owned"], np.uint8), count=b - a).astype(bool)

        history = np.append(cw, model.documents)  # how often each word, and the start mark, has a follower
        p1 = model.word_probability(cw)
        lost = discounted(cb, model.pair_d)
        seen = cb > 0
        with np.errstate(divide="ignore"):
            each = np.where(seen, np.log10(lost) - np.log10(np.maximum(1, history[u])), np.log10(p1[v]))
        missing = ~seen & (history[u] > 0)

        def by_doc(x: np.ndarray) -> np.ndarray:
            return np.add.reduceat(x, batch.starts) if len(x) else np.zeros(0)

        score, base = by_doc(each[at]), by_doc(model.base(cw)[batch.tokens])
        known = by_doc((cw > 0).astype(np.int64)[batch.tokens])
        out = [
            {
                "kind": _DOC, "batch": batch.id, "doc_no": i, "doc_id": None if batch.no_id[i] else int(batch.doc_ids[i]),
                "held_out": bool(batch.held[i]), "n_tokens": int(batch.lengths[i]), "n_known": int(known[i]),
                "base_score": float(base[i]), "score": float(score[i]),
            }
            for i in range(len(batch.doc_ids))
        ]

        # sums of the owned bigrams by history
        mine = owned & seen
        s1 = np.bincount(u[mine], weights=lost[mine], minlength=len(history))
        s2 = np.bincount(u[mine], weights=p1[v[mine]], minlength=len(history))
        names = np.append(batch.words, START)
        order = np.argsort(names, kind="stable")
        order_sum = order[np.bincount(u[mine], minlength=len(history))[order] > 0]
        # the places where a(u) is missing: document, history (as a place among those asked for), how often
        open_at = np.flatnonzero(missing[at])
        doc = np.repeat(np.arange(len(batch.lengths)), batch.lengths)[open_at]
        place, times = np.unique(doc * len(history) + u[at[open_at]], return_counts=True)
        doc, hist = np.divmod(place, len(history))
        asked = np.zeros(len(history), bool)
        asked[hist] = True
        order_want = order[asked[order]]
        where = np.empty(len(history), np.int64)
        where[order_want] = np.arange(len(order_want))
        out.append({
            "kind": _OPEN, "batch": batch.id, "keys": _press(np.stack([doc, where[hist], times], 1).astype("<u4").reshape(-1)),
            "a": _press(history[order_want].astype("<i8")),
        })
        for kind, chosen in ((_SUM, order_sum), (_WANT, order_want)):
            cut = _cuts(names[chosen], parts)
            for p in range(parts):
                k = chosen[cut[p] : cut[p + 1]]
                if len(k):
                    row = {"kind": kind, "part": p, "batch": batch.id, "keys": _press_keys(names[k])}
                    out.append(row | ({"a": _press(s1[k]), "b": _press(s2[k])} if kind == _SUM else {}))
        return _table(out, _SCORED)

    return run


def _answer_sums(t: pa.Table) -> pa.Table:
    """The sums of every history that a batch asks for."""
    rows = sorted(t.to_pylist(), key=lambda r: (r["kind"], r["batch"]))
    sums, wants = [r for r in rows if r["kind"] == _SUM], [r for r in rows if r["kind"] == _WANT]
    keys = np.concatenate([_open_keys(r["keys"]) for r in sums]) if sums else np.empty(0, np.uint64)
    distinct, at = np.unique(keys, return_inverse=True)
    total = [np.bincount(at, weights=np.concatenate([_open(r[f], "<f8") for r in sums]), minlength=len(distinct)) if sums else np.empty(0) for f in "ab"]
    out = []
    for r in wants:
        own = np.searchsorted(distinct, _open_keys(r["keys"]))
        out.append({"kind": _WANT, "part": r["part"], "batch": r["batch"], "a": _press(total[0][own]), "b": _press(total[1][own])})
    return _table(out, _SUMS)


_RESULT = "doc_id long, held_out boolean, n_tokens long, n_known long, base_score double, score double"


def _finish(t: pa.Table) -> pa.Table:
    """A batch's scores with the logarithms of the missing weights added."""
    kind = t.column("kind").to_numpy()
    rows = t.take(pa.array(np.flatnonzero(kind != _DOC))).to_pylist()
    docs = t.take(pa.array(np.flatnonzero(kind == _DOC)))
    docs = docs.take(pc.sort_indices(docs.column("doc_no")))
    score = docs.column("score").to_numpy().copy()
    opened = next(r for r in rows if r["kind"] == _OPEN)
    doc, at, times = _open(opened["keys"], "<u4").reshape(-1, 3).astype(np.int64).T
    answers = [r for r in rows if r["kind"] == _WANT]
    s1, s2 = _gather(answers, "a", "<f8"), _gather(answers, "b", "<f8")
    weight = np.log10(1 - s1 / _open(opened["a"], "<i8")) - np.log10(1 - s2)
    np.add.at(score, doc, times * weight[at])
    names = [c.split()[0] for c in _RESULT.split(", ")]
    return pa.table([docs.column(n) if n != "score" else pa.array(score) for n in names], names)


def scores(
    docs: DataFrame,
    held: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    batch_tokens: int = BATCH_TOKENS,
    keys_per_partition: int = KEYS_PER_PARTITION,
) -> DataFrame:
    """``(doc_id, held_out, n_tokens, n_known, train_tokens, base_score,
    score)`` of every row; the model learns from the rows where ``held`` is
    false. ``base_score`` is the add-half unigram's, ``score`` the model's,
    both log10 probabilities of the whole text and its end.

    NULL and empty texts have the end mark only. Repeated rows and rows with a
    NULL id count and are scored one by one. With nothing to learn from all
    tokens are the unknown one, of probability 1 (score 0). An empty table
    gives an empty result."""
    batches = materialize(_batches(docs, id_col, text_col, held, batch_tokens), "lm-batches")
    size = batches.agg(F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n"), F.coalesce(F.sum("train_docs"), F.lit(0)).alias("d")).first()
    parts = max(16, math.ceil(size["n"] / keys_per_partition))
    words = _count(batches, False, parts, "lm-words")
    pairs = _count(batches, True, parts, "lm-bigrams")
    model = Model(_stats(words), _stats(pairs), size["d"])
    scored = _cogrouped(batches, words, pairs, model, parts)
    asked = scored.where(F.col("kind").isin(_WANT, _SUM)).select(*[c.split()[0] for c in _SUMS.split(", ")])
    sums = asked.groupBy("part").applyInArrow(_answer_sums, _SUMS)
    rest = scored.where(F.col("kind").isin(_DOC, _OPEN)).unionByName(sums, allowMissingColumns=True)
    done = rest.groupBy("batch").applyInArrow(_finish, _RESULT)
    return done.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.tokens).cast("long").alias("train_tokens"), "base_score", "score")


def _cogrouped(batches: DataFrame, words: DataFrame, pairs: DataFrame, model: Model, parts: int) -> DataFrame:
    """Each batch with the answers to it."""
    answers = words.where("batch is not null").select("batch", "part", "counts", F.lit(None).cast("binary").alias("owned")).unionByName(
        pairs.where("batch is not null").select("batch", "part", "counts", "owned")
    )
    score = _score_batch(model, parts)

    def run(own: pa.Table, got: pa.Table) -> pa.Table:
        words_only = pc.is_null(got.column("owned"))
        return score(own, got.filter(words_only), got.filter(pc.invert(words_only)))

    found = batches.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(run, _SCORED)
    return materialize(found, "lm-scored")


def held_out(id_col: str, folds: int = FOLDS, fold: int = HELD_OUT_FOLD) -> Column:
    """crc32 of the id as text, modulo ``folds``, is ``fold``; a NULL id
    counts as the empty text."""
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % folds == fold
