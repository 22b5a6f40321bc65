"""Language identification: multinomial naive Bayes over hashed character
n-grams.

A text is lower-cased and every run of characters that are not letters
becomes one space, with one space before and after. Its features are all
n-grams of 1 to ``MAX_N`` code points, hashed into ``FEATURES`` bins.

Training counts the bins of every training text: each task adds up one count
vector for each language, and only those vectors are shuffled and summed. The
model is the matrix of log-probabilities (languages x bins, Laplace
smoothing) and the log-priors. Its size is bounded by the number of languages
times ``FEATURES``, whatever the corpus, so it is broadcast; ``fit`` refuses
more than ``MAX_LANGUAGES`` languages, as that many mean a wrong column.

Scoring counts the bins of a batch of texts as sparse rows, and multiplies
them by the matrix at once in numpy.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import column, fresh_names

FEATURES = 1 << 15
MAX_N = 3
SMOOTHING = 0.5
MAX_LANGUAGES = 1000
UNKNOWN = "und"
#: Products of a count and a log-probability held at once (one text's at least).
PRODUCTS = 1 << 21
#: Code points handled at once of a long text.
PIECE = 1 << 20

_NOT_LETTERS = regex.compile(r"[^\p{L}\p{M}]+")
_LETTER = regex.compile(r"\p{L}")


@dataclass
class Model:
    """``languages`` sorted by code point; ``log_prob`` is (bins, languages)."""

    languages: list[str]
    log_prior: np.ndarray
    log_prob: np.ndarray


def _hashes(codes: np.ndarray, max_n: int, features: int) -> np.ndarray:
    """Bins of all n-grams of 1 to ``max_n`` of the code points."""
    out, h = [], np.zeros(len(codes), dtype=np.uint32)
    for n in range(1, max_n + 1):
        h = (h[: len(codes) - n + 1] if n > 1 else h) * np.uint32(0x01000193) ^ codes[n - 1 :]
        if not len(h):
            break
        x = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D + 2 * n)
        out.append((x ^ (x >> np.uint32(13))) % np.uint32(features))
    return np.concatenate(out) if out else np.empty(0, np.uint32)


def counts(text: str | None, max_n: int = MAX_N, features: int = FEATURES) -> np.ndarray | None:
    """Counts of the bins of one whole text; None if it has no letter."""
    if text is None or not _LETTER.search(text):
        return None
    total = np.zeros(features, dtype=np.int64)
    norm = f" {_NOT_LETTERS.sub(' ', text.lower()).strip()} "
    for s in range(0, len(norm), PIECE):
        codes = np.frombuffer(norm[s : s + PIECE + max_n - 1].encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        own = _hashes(codes, max_n, features)
        if s + PIECE < len(norm):  # n-grams that begin in the next piece are counted there
            own = np.concatenate([_hashes(codes[: PIECE + n - 1], n, features)[-PIECE:] for n in range(1, max_n + 1)])
        total += np.bincount(own, minlength=features)
    return total


def training_counts(
    docs: DataFrame, label: Column, text: Column, max_n: int = MAX_N, features: int = FEATURES
) -> DataFrame:
    """``(lang, bin, n, docs)``: how often each bin occurs in the texts of
    each language; the row with bin -1 has the number of texts in ``docs``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        seen: dict[str, int] = {}
        for b in batches:
            for lang, t in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                if (c := counts(t, max_n, features)) is not None:
                    seen[lang] = seen.get(lang, 0) + 1
                    if lang in sums:
                        sums[lang] += c
                    else:
                        sums[lang] = c
        for lang, c in sums.items():
            at = np.flatnonzero(c)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * (len(at) + 1)), pa.array(np.append(at, -1)), pa.array(np.append(c[at], seen[lang]))],
                ["lang", "bin", "n"],
            )

    rows = docs.select(label.cast("string").alias("lang"), text.alias("text")).where("lang is not null and text is not null")
    return rows.mapInArrow(run, "lang string, bin long, n long").groupBy("lang", "bin").agg(F.sum("n").alias("n"))


def fit(
    docs: DataFrame,
    label: Column,
    text: Column,
    max_n: int = MAX_N,
    features: int = FEATURES,
    smoothing: float = SMOOTHING,
) -> Model:
    """Learn from every row whose label and text are not NULL and whose text
    has a letter. What reaches the driver is the count matrix, at most
    languages x ``features`` numbers. No such row: a model without languages."""
    summed = training_counts(docs, label, text, max_n, features)
    rows = summed.groupBy("lang").agg(
        F.max(F.when(F.col("bin") < 0, F.col("n"))).alias("docs"),
        F.collect_list(F.when(F.col("bin") >= 0, F.struct("bin", "n"))).alias("bins"),
    )
    rows = rows.limit(MAX_LANGUAGES + 1).toPandas().sort_values("lang", ignore_index=True)
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages in the label column")
    if not len(rows):
        return Model([], np.empty(0), np.empty((features, 0), np.float32))
    matrix = np.full((features, len(rows)), smoothing)
    for k, bins in enumerate(rows["bins"]):
        matrix[[b["bin"] for b in bins], k] += [b["n"] for b in bins]
    log_prob = np.log(matrix) - np.log(matrix.sum(axis=0))
    prior = rows["docs"].to_numpy(dtype=float)
    return Model(rows["lang"].tolist(), np.log(prior / prior.sum()), log_prob)


def predict_batch(texts: Iterable[str | None], model: Model, max_n: int = MAX_N) -> Iterator[tuple[str, float]]:
    """Most likely language of each text and its posterior probability, with
    the mean log-likelihood of a character weighed as ``min(length, 100)`` of
    them, so that the probability of a long text says more than 1.0. Ties go to
    the first language by code point.

    Texts are gathered as sparse rows (bins, counts) until ``PRODUCTS`` are
    reached, then scored together."""
    rows: list[tuple[np.ndarray, np.ndarray] | None] = []
    held = 0
    for t in texts:
        c = counts(t, max_n, len(model.log_prob)) if model.languages else None
        if c is None:
            rows.append(None)
            continue
        at = np.flatnonzero(c)
        if held and (held + len(at)) * len(model.languages) > PRODUCTS:
            yield from _scored(rows, model)
            rows, held = [], 0
        rows.append((at, c[at]))
        held += len(at)
    yield from _scored(rows, model)


def _scored(rows: list[tuple[np.ndarray, np.ndarray] | None], model: Model) -> Iterator[tuple[str, float]]:
    """Language and score of sparse rows, by one product for all; None has no letter."""
    known = [r for r in rows if r is not None]
    if not known:
        yield from [(UNKNOWN, 0.0)] * len(rows)
        return
    bins, n = (np.concatenate(x) for x in zip(*known, strict=True))
    starts = np.cumsum([0] + [len(at) for at, _ in known[:-1]])
    width = max(1, PRODUCTS // len(bins))  # a single text with many languages is scored by blocks of them
    like = np.concatenate(
        [np.add.reduceat(n[:, None] * model.log_prob[bins, s : s + width], starts) for s in range(0, len(model.languages), width)], axis=1
    )
    size = np.add.reduceat(n, starts)
    like = like * (np.minimum(100.0, size) / size)[:, None] + model.log_prior
    best = like.argmax(axis=1)
    score = 1 / np.exp(like - like.max(axis=1, keepdims=True)).sum(axis=1)
    found = zip(best.tolist(), score.tolist(), strict=True)
    for r in rows:
        if r is None:
            yield UNKNOWN, 0.0
        else:
            k, p = next(found)
            yield model.languages[k], p


def predict_one(text: str | None, model: Model, max_n: int = MAX_N) -> tuple[str, float]:
    """As ``predict_batch``, for one text."""
    return next(predict_batch([text], model, max_n))


def predict(
    docs: DataFrame, model: Model, text: Column, max_n: int = MAX_N, names: tuple[str, str] = ("lang_pred", "score")
) -> DataFrame:
    """``docs`` with the columns ``names``, language and score (replaced if they
    exist). A NULL text, one without a letter, or a model without languages
    gives ``und`` with score 0."""
    sent = docs.sparkSession.sparkContext.broadcast((model.languages, model.log_prior, model.log_prob))

    @F.pandas_udf("lang_pred string, score double")
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        own = Model(*sent.value)
        for b in batches:
            yield pd.DataFrame(list(predict_batch(b, own, max_n)), columns=["lang_pred", "score"])

    kept = [column(c) for c in docs.columns if c not in names]
    found = fresh_names(docs, "found")[0]
    made = docs.select(*kept, run(text).alias(found))
    return made.select(*kept, *(F.col(found)[x].alias(n) for x, n in zip(("lang_pred", "score"), names, strict=True)))


def identify(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "lang",
    folds: int = 4,
    held_out_fold: int = 2,
) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` for every row, by a model of
    the rows whose crc32 of the id as text, modulo ``folds``, is not
    ``held_out_fold``. A NULL id counts as the empty text there. Repeated rows
    are learned from and predicted one by one."""
    held = held_out(id_col, folds, held_out_fold)
    model = fit(docs.where(~held), F.col(label_col), F.col(text_col))
    rows = docs.select(column(id_col).cast("long").alias("doc_id"), held.alias("held_out"), column(text_col).alias("text"))
    return predict(rows, model, F.col("text")).drop("text")


def held_out(id_col: str, folds: int, fold: int) -> Column:
    return F.crc32(F.encode(F.coalesce(F.col(id_col).cast("string"), F.lit("")), "UTF-8")) % folds == fold
