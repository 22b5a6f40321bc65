"""Phrases whose words stand together more often than their parts would.

**Counting.** Every word begins a window: itself and the next words of its
piece, in as many columns as the longest phrase has words, padded with NULL.
Only these longest windows are counted. A phrase's occurrences are the windows
that begin with it, so Spark's ROLLUP over the columns, which drops the last
one after the other, sums the counts of all shorter phrases from them.

**What needs no window.** A phrase is at most as frequent as any phrase in it.
Before the windows, words, then runs of two, up to ``MARKED`` words, are counted
as keys of ``KEY_BITS`` bits; keys that reach the least count are marked in a
bitmap of at most ``MAX_BITS`` bits. Only runs whose words, pairs and so on are
marked count as the next longer key, and a window ends before the first run
without a mark. Keys that collide, and marks that many keys share, only leave
windows longer than they need be: all counts come from the windows' whole words.

**Text.** A-Z are lower-cased. Pieces are split at ``[.,;:!?\\x0A-\\x0D]``, words
at spaces and tabs. Texts are read as bytes, some MB at a time; a long text is
cut between words, with the following words at hand.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import materialize, text_bytes

LONGEST = 5
MIN_COUNT = 100
CONTAINED_SHARE = 100
TOP = 2000
NO_LANGUAGE = "und"
#: Words of the longest runs that are marked.
MARKED = 3
#: Bits of a key. With far more than 10^13 words, more would mark less.
KEY_BITS = 40
#: Bytes of text that are worked on at once.
CHUNK = 1 << 21
#: Distinct keys that a task adds up before it hands them on.
HELD_KEYS = 1 << 21
#: Bits of a bitmap: 32 for each key, up to this many (16 MB).
MAX_BITS = 1 << 27
#: First steps of the ranking, so that no task sorts a whole language.
RANK_SALTS = 256

_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_BREAKS, _BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
_KIND = np.full(256, 2, np.uint8)  # 0: ends a piece, 1: between words, 2: in a word
_KIND[list(_BREAKS)], _KIND[list(_BLANKS)] = 0, 1
_BETWEEN = re.compile(rb"[ \t.,;:!?\n-\r]")


# ---- words of a chunk of text ---------------------------------------------------


def _mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit keys."""
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


class Words:
    """The words of some texts: ``code`` (place in ``names``), ``piece`` and
    ``lang`` (place in ``langs``) of each, and ``own``: whether its window is
    counted here, not with the next part of its text."""

    def __init__(self, texts: list[bytes], langs: list[str], own_bytes: int | None = None):
        raw = b"\n".join(texts).translate(_LOWER)
        data = np.frombuffer(raw, np.uint8)
        kind = _KIND[data]
        inside = kind == 2
        edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
        starts, ends = edge[::2], edge[1::2]
        self.piece = np.cumsum(kind == 0, dtype=np.int32)[starts]
        offsets = np.concatenate([[0], np.cumsum(ends - starts)]).astype(np.int64)
        words = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(data[inside])])
        coded = words.dictionary_encode()
        self.code = coded.indices.to_numpy()
        self.names = coded.dictionary
        self.own = np.ones(len(starts), bool) if own_bytes is None else starts < own_bytes
        self.langs = sorted(set(langs))
        at = {v: k for k, v in enumerate(self.langs)}
        begins = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
        self.lang = np.array([at[v] for v in langs], np.int32)[np.searchsorted(begins, starts, side="right") - 1]

    def __len__(self) -> int:
        return len(self.code)

    def keys(self) -> np.ndarray:
        """A 64-bit key of each word and its language."""
        ends = np.frombuffer(self.names.buffers()[1], np.int64)[self.names.offset : self.names.offset + len(self.names) + 1]
        data = np.frombuffer(self.names.buffers()[2], np.uint8)[ends[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
        starts = (ends - ends[0])[:-1]
        length = np.diff(ends)
        power = np.multiply.accumulate(np.full(int(length.max()), 0x9E3779B97F4A7C15, np.uint64))
        sums = np.add.reduceat(data * power[np.arange(len(data)) - np.repeat(starts, length)], starts)
        own = np.array([xxhash.xxh64_intdigest(v.encode()) for v in self.langs], np.uint64)
        return _mix(_mix(sums)[self.code] ^ own[self.lang])

    def next_in_piece(self) -> np.ndarray:
        """Whether each word but the last is followed in its piece."""
        return self.piece[1:] == self.piece[:-1]


def longer_keys(keys: np.ndarray, words: np.ndarray, size: int) -> np.ndarray:
    """Keys of the runs of ``size`` words: those of one word less, at ``keys``,
    with the keys of the next ``words``."""
    return _mix(keys[:-1] * np.uint64(0x9FB21C651E98DF25) + words[size - 1 :])


def _parts(text: bytes, size: int, ahead: int) -> Iterator[tuple[bytes, int]]:
    """A long text in parts of about ``size`` bytes, cut between words, each
    with up to ``ahead`` more words of its last piece; and the part's own bytes."""
    more = re.compile(rb"(?:[ \t]*[^ \t.,;:!?\n-\r]+){0,%d}" % ahead)
    at = 0
    while at < len(text):
        cut = _BETWEEN.search(text, at + size)
        stop = cut.start() if cut else len(text)
        yield text[at : more.match(text, stop).end()], stop - at
        at = max(stop, at + 1)


def read_words(batches: Iterator[pa.RecordBatch], longest: int, chunk: int = CHUNK) -> Iterator[Words]:
    """The words of batches ``(lang, text)``, about ``chunk`` bytes at a time."""
    for b in batches:
        texts, langs, size = [], [], 0
        for lang, text in zip(b.column(0).to_pylist(), text_bytes(b.column(1)), strict=True):
            if len(text) > chunk:
                for part, own in _parts(text, chunk, longest - 1):
                    yield Words([part], [lang], own)
                continue
            texts.append(text)
            langs.append(lang)
            size += len(text)
            if size >= chunk:
                yield Words(texts, langs)
                texts, langs, size = [], [], 0
        if texts:
            yield Words(texts, langs)


# ---- keys that reach the least count --------------------------------------------


class _Tally:
    """Adds up keys; hands them on when it holds too many."""

    def __init__(self):
        self.held: list[tuple[np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, keys: np.ndarray) -> Iterator[pa.RecordBatch]:
        if len(keys):
            self.held.append(np.unique(keys >> np.uint64(64 - KEY_BITS), return_counts=True))
            self.size += len(self.held[-1][0])
        if self.size > 2 * HELD_KEYS:
            self._join()
            if self.size > HELD_KEYS:
                yield from self.out()

    def _join(self) -> None:
        keys, at = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
        n = np.zeros(len(keys), np.int64)
        np.add.at(n, at, np.concatenate([c for _, c in self.held]))
        self.held, self.size = [(keys, n)], len(keys)

    def out(self) -> Iterator[pa.RecordBatch]:
        if self.held:
            self._join()
            (keys, n), self.held, self.size = self.held[0], [], 0
            yield from _counted(pa.array(keys.view(np.int64)), pa.array(n))


def _counted(keys: pa.Array, n: pa.Array, lang: str | None = None) -> Iterator[pa.RecordBatch]:
    whole = pa.RecordBatch.from_arrays([pa.array([lang] * len(keys), pa.string()), keys, n], ["lang", "key", "n"])
    for at in range(0, whole.num_rows, 1 << 16):
        yield whole.slice(at, 1 << 16)


class Marks:
    """A bitmap of keys, sent to all tasks; its size has a fixed bound."""

    def __init__(self, keys: DataFrame):
        spark = keys.sparkSession
        n = keys.count()
        self.log = min(MAX_BITS, max(1 << 15, 32 * n)).bit_length() - 1
        place = F.shiftrightunsigned(F.col("key"), KEY_BITS - self.log) + 1
        rows = keys.groupBy(F.bitmap_bucket_number(place).alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("m"))
        bits = np.zeros(1 << (self.log - 3), np.uint8)
        block = (1 << 15) >> 3
        for r in rows.toLocalIterator():
            bits[(r["b"] - 1) * block : r["b"] * block] = np.frombuffer(r["m"], np.uint8)[:block]
        self.sent = spark.sparkContext.broadcast(bits)

    def has(self, keys: np.ndarray) -> np.ndarray:
        at = keys >> np.uint64(64 - self.log)
        return (self.sent.value[(at >> np.uint64(3)).astype(np.int64)] >> (at & np.uint64(7)).astype(np.uint8) & 1).astype(bool)


def _word_keys(texts: DataFrame, longest: int) -> DataFrame:
    """``(lang, key, n)``: the words' keys (lang NULL), and of each language
    its number of words (key NULL)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally, totals = _Tally(), {}
        for w in read_words(batches, longest):
            if len(w):
                yield from tally.add(w.keys()[w.own])
                for lang, n in zip(w.langs, np.bincount(w.lang[w.own], minlength=len(w.langs)).tolist(), strict=True):
                    totals[lang] = totals.get(lang, 0) + n
        yield from tally.out()
        for lang, n in totals.items():
            if n:
                yield from _counted(pa.array([None], pa.int64()), pa.array([n], pa.int64()), lang)

    return texts.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def _marked_runs(w: Words, marks: list[Callable[[np.ndarray], np.ndarray]], sizes: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For runs of 1, 2, ... ``sizes`` words: their keys, and whether all runs
    of the sizes that ``marks`` knows are marked in each; longer runs need no
    key. A run is named by its first word and lies in one piece."""
    words = w.keys()
    keys, good = words, marks[0](words) if marks else np.ones(len(words), bool)
    yield keys, good
    for size in range(2, sizes + 1):
        if len(good) < 2:
            return
        good = good[:-1] & good[1:]
        if size == 2:
            good &= w.next_in_piece()
        if size <= len(marks) + 1:
            keys = longer_keys(keys, words, size)
        if size <= len(marks):
            good &= marks[size - 1](keys)
        yield keys, good


def _run_keys(texts: DataFrame, longest: int, marks: list[Marks]) -> DataFrame:
    """``(key, n)`` of the runs of one word more than ``marks`` knows."""
    known = [m.has for m in marks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tally = _Tally()
        for w in read_words(batches, longest):
            if len(w) > len(known):
                runs = list(_marked_runs(w, known, len(known) + 1))
                if len(runs) > len(known):
                    keys, good = runs[-1]
                    yield from tally.add(keys[good & w.own[: len(good)]])
        yield from tally.out()

    counted = texts.mapInArrow(run, "lang string, key long, n long")
    return counted.groupBy("key").agg(F.sum("n").alias("n"))


# ---- windows ----------------------------------------------------------------------


def _distinct_rows(columns: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Places of the distinct rows of some columns of small numbers (below
    2^21, from -1), and how often each is there."""
    packed = []
    for k in range(0, len(columns), 3):
        p = np.zeros(len(columns[0]), np.int64)
        for c in columns[k : k + 3]:
            p = (p << 21) | (c.astype(np.int64) + 1)
        packed.append(p)
    order = np.lexsort(packed)
    new = np.ones(len(order), bool)
    new[1:] = np.any([p[order][1:] != p[order][:-1] for p in packed], axis=0)
    first = np.flatnonzero(new)
    return order[first], np.diff(np.append(first, len(order)))


def _windows(texts: DataFrame, longest: int, marks: list[Marks]) -> DataFrame:
    """``(lang, w1, ..., n)``: padded windows, counted within a chunk of text."""
    columns = [f"w{k + 1}" for k in range(longest)]
    known = [m.has for m in marks]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for w in read_words(batches, longest):
            if not len(w):
                continue
            at, lead = None, []
            for size, (_, good) in enumerate(_marked_runs(w, known, longest), 1):
                if at is None:
                    at = np.flatnonzero(good & w.own)
                whole = np.zeros(len(w), bool)
                whole[: len(good)] = good
                lead.append(np.where(whole[at], w.code[np.minimum(at + size - 1, len(w) - 1)], -1))
            lead += [np.full(len(at), -1, w.code.dtype)] * (longest - len(lead))
            if not len(at):
                continue
            first, n = _distinct_rows([w.lang[at], *lead])
            names, langs = w.names.cast(pa.binary()).cast(pa.string()), pa.array(w.langs)
            for s in range(0, len(first), 1 << 16):
                f = first[s : s + (1 << 16)]
                made = [names.take(pa.array(c[f], mask=c[f] < 0)) for c in lead]
                yield pa.RecordBatch.from_arrays([langs.take(pa.array(w.lang[at][f])), *made, pa.array(n[s : s + (1 << 16)])], ["lang", *columns, "n"])

    return texts.mapInArrow(run, "lang string, " + "".join(f"{c} string, " for c in columns) + "n long")


def prefix_counts(windows: DataFrame, longest: int, min_count: int) -> DataFrame:
    """``(lang, phrase, size, a)`` of all phrases of 1 to ``longest`` words that
    begin at least ``min_count`` windows ``(lang, w1, ..., n)``; the words of a
    phrase are joined by spaces."""
    columns = [f"w{k + 1}" for k in range(longest)]
    counted = windows.groupBy("lang", *columns).agg(F.sum("n").alias("n"))
    shorter = f", ROLLUP({', '.join(columns[1:])})" if longest > 1 else ""
    summed = windows.sparkSession.sql(
        f"SELECT lang, {', '.join(columns)}, grouping_id() AS left_out, sum(n) AS a FROM {{counted}} "
        f"GROUP BY lang, w1{shorter} HAVING sum(n) >= {int(min_count)}"
        if longest > 1
        else f"SELECT lang, w1, 0L AS left_out, sum(n) AS a FROM {{counted}} GROUP BY lang, w1 HAVING sum(n) >= {int(min_count)}",
        counted=counted,
    )
    words = F.array_compact(F.array(*columns))
    # a prefix that reaches into the padding is a shorter phrase's, which has its own row
    whole = F.size(words) == longest - F.bit_count("left_out")
    return summed.where(whole).select("lang", F.array_join(words, " ").alias("phrase"), F.size(words).alias("size"), "a")


def phrase_counts(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", longest: int = LONGEST, min_count: int = MIN_COUNT
) -> tuple[DataFrame, DataFrame]:
    """``(lang, phrase, size, a)`` of the phrases of up to ``longest`` words
    with at least ``min_count`` contiguous occurrences within pieces, and
    ``(lang, n)``: all words of each language."""
    lang = F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANGUAGE))
    texts = docs.select(lang.alias("lang"), F.col(f"`{text_col}`").alias("text")).where("text <> ''")
    single = materialize(_word_keys(texts, longest).where(F.col("key").isNull() | (F.col("n") >= min_count)), "phrase-words")
    marks = [Marks(single.where("key is not null"))]
    while len(marks) < min(MARKED, longest):
        marks.append(Marks(materialize(_run_keys(texts, longest, marks).where(F.col("n") >= min_count), "phrase-runs")))
    counts = materialize(prefix_counts(_windows(texts, longest, marks), longest, min_count), "phrase-counts")
    return counts, single.where("key is null").select("lang", "n")


# ---- scores ---------------------------------------------------------------------


def _not_contained(counts: DataFrame, share: int) -> DataFrame:
    """Phrases of two words and more that no longer one holds at least
    ``share`` per cent as often. A phrase two words longer is no more frequent
    than the one between them, so one word more is enough to look at."""
    words = F.split("phrase", " ")
    parts = F.array(F.array_join(F.slice(words, 1, F.col("size") - 1), " "), F.array_join(F.slice(words, 2, F.col("size") - 1), " "))
    inner = counts.where("size > 2").select("lang", F.explode(parts).alias("phrase"), F.col("a").alias("longer"))
    inner = inner.groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    candidates = counts.where("size > 1").join(inner, ["lang", "phrase"], "left")
    return candidates.where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("a") * share)).drop("longer")


def _exact(c: Column) -> Column:
    return c.cast("decimal(38,0)")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    longest: int = LONGEST,
    min_count: int = MIN_COUNT,
    share: int = CONTAINED_SHARE,
    top: int = TOP,
) -> DataFrame:
    """``(lang, rank, phrase, a, l, r, n, score)``: the first ``top`` phrases of
    each language by score, then ``a`` (descending), then phrase.

    Candidates are phrases of 2 to ``longest`` words with ``a >= min_count``
    occurrences. A cut after the first k words has counts l and r of its two
    parts and the score ``floor(1000 a n / (l r))``, in exact arithmetic; the
    cut of the lowest score counts (ties: the first). A candidate inside a
    longer one that is at least ``share`` per cent as frequent is dropped.

    A NULL language is ``und``; NULL and empty texts have no words; repeated
    rows count each; an empty table gives an empty result. Other columns,
    whatever their names, are not read."""
    counts, totals = phrase_counts(docs, text_col, lang_col, longest, min_count)
    words, size = F.split("phrase", " "), F.col("size")
    cuts = _not_contained(counts, share).withColumn("k", F.explode(F.sequence(F.lit(1), size - 1)))
    cuts = cuts.select(
        "lang", "phrase", "a", "k",
        F.array_join(F.slice(words, 1, F.col("k")), " ").alias("head"),
        F.array_join(F.slice(words, F.col("k") + 1, size - F.col("k")), " ").alias("tail"),
    )
    part = counts.select("lang", "phrase", "a")
    cuts = cuts.join(part.toDF("lang", "head", "l"), ["lang", "head"]).join(part.toDF("lang", "tail", "r"), ["lang", "tail"]).join(totals, "lang")
    cuts = cuts.withColumns({"above": _exact(F.lit(1000)) * _exact(F.col("a")) * _exact(F.col("n")), "below": _exact(F.col("l")) * _exact(F.col("r"))})
    cuts = cuts.withColumn("score", F.expr("above div below"))
    best = cuts.groupBy("lang", "phrase").agg(F.min(F.struct("score", "k", "a", "l", "r", "n")).alias("b")).select("lang", "phrase", "b.*")

    order = [F.col("score").desc(), F.col("a").desc(), "phrase"]
    salted = best.withColumn("salt", F.pmod(F.xxhash64("phrase"), F.lit(RANK_SALTS)))
    first = salted.withColumn("at", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order))).where(F.col("at") <= top)
    ranked = first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.select("lang", *(F.col(c).cast("long").alias(c) if c != "phrase" else F.col(c) for c in ("rank", "phrase", "a", "l", "r", "n", "score")))
