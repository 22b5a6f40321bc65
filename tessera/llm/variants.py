"""Spelling variants: words one code point apart, and the form each stands for.

**Words.** Runs of letters, A-Z lower-cased; those that are long and frequent
enough are the vocabulary, numbered in code-point order.

**Pairs of trie nodes.** The prefixes of all words are the nodes of a trie, the
suffixes those of a trie of the reversed words. A node is a number: a prefix of
up to ``SHALLOW`` letters is read as digits of base ``len(LETTERS) + 1``, deeper
ones are numbered in a table. Each word is filed under integer pairs (prefix
node, suffix node): for each letter the pair around it (the letter skipped), and
for each place between letters the pair that meets there (nothing skipped).

* two words that share a pair with a letter skipped in both differ in that
  letter alone, and share no other such pair;
* a word with a letter skipped meets the word that has nothing there. Of equal
  neighbouring letters only the first counts as skipped, so they meet once.

So a pair holds at most one word for each letter and one without it, and what a
word has near it is added up over its pairs. Neither words nor candidates are
compared with each other outside a pair.

**Forms.** A word's form is the most frequent near word, if it is
``FORM_RATIO`` times as frequent; the root is where the forms lead. Forms grow
by that ratio at each step, so pointers are doubled a few times only.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import materialize

MIN_LENGTH = 6
MIN_COUNT = 5
FORM_RATIO = 5
#: Letters of a word: a-z and U+00C0 to U+00FF, as only A-Z are lower-cased.
LETTERS = "".join(map(chr, [*range(97, 123), *range(0xC0, 0x100)]))
RUNS = r"[A-Za-z\x{C0}-\x{FF}]+"
#: Letters of a node that is numbered by its letters: 91^9 < 2^63.
SHALLOW = 9
#: Bytes of a prefix that its node is looked up by; longer ones by SHA-256.
PLAIN_KEY = 64

_CODE = {c: k + 1 for k, c in enumerate(LETTERS)}
_BASE = len(LETTERS) + 1


# ---- words ------------------------------------------------------------------------


def letter_runs(text: Column) -> Column:
    """The runs of letters of a text, A-Z lower-cased, as an array."""
    upper = "".join(map(chr, range(65, 91)))
    return F.regexp_extract_all(F.translate(text, upper, upper.lower()), F.lit(RUNS), F.lit(0))


def word_counts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    misspell_every: int | None = None,
) -> DataFrame:
    """``(word, n)`` of the words with at least ``min_length`` letters and
    ``min_count`` occurrences in all texts.

    With ``misspell_every``, runs lose a letter first, as a test of what is
    found: h is the CRC-32 of ``<id>:<run>``; if that number divides h, the run
    loses its letter ``h % length``. A NULL id counts as the empty text there;
    NULL and empty texts have no words; repeated rows count each."""
    docs = docs.select(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("")).alias("id"), F.col(f"`{text_col}`").alias("text"))
    runs = docs.select("id", F.explode(letter_runs(F.col("text"))).alias("run")).where(F.length("run") >= min_length)
    word = F.col("run")
    if misspell_every:
        runs = runs.withColumn("h", F.crc32(F.encode(F.concat("id", F.lit(":"), "run"), "UTF-8")))
        at = (F.col("h") % F.length("run")).cast("int")
        less = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
        word = F.when(F.col("h") % misspell_every == 0, less).otherwise(F.col("run"))
    words = runs.select(word.alias("word")).where(F.length("word") >= min_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= min_count)


def numbered(words: DataFrame) -> DataFrame:
    """``(id, word, n)``: numbers ascend with the words by code point."""
    return materialize(words.sort("word").select(F.monotonically_increasing_id().alias("id"), "word", "n"), "variant-words")


# ---- pairs of trie nodes ------------------------------------------------------------


def _walk(word: str) -> list[tuple[int | None, bytes | None]]:
    """The trie nodes from the root along ``word``: number, or what a deep node
    is looked up by."""
    out: list[tuple[int | None, bytes | None]] = [(0, None)]
    number = 0
    for c in word[:SHALLOW]:
        number = number * _BASE + _CODE[c]
        out.append((number, None))
    if len(word) > SHALLOW:
        digest = hashlib.sha256(word[:SHALLOW].encode())
        for j in range(SHALLOW, len(word)):
            digest.update(word[j].encode())
            # U+00FF ends in the byte BF, so no prefix looks like a digest
            out.append((None, word[: j + 1].encode() if j < PLAIN_KEY // 2 else b"\xff" + digest.copy().digest()))
    return out


def _filed(words: DataFrame) -> DataFrame:
    """``(id, n, skipped, first, p, s, p_key, s_key)``: the pairs of each word.
    ``skipped``: a letter is skipped; ``first``: it is not the one before it."""
    names = ["id", "n", "skipped", "first", "p", "s", "p_key", "s_key"]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.int64(), pa.binary(), pa.binary()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []

        def full() -> pa.RecordBatch:
            made = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
            rows.clear()
            return pa.RecordBatch.from_arrays(made, names)

        for b in batches:
            for number, word, n in zip(*(c.to_pylist() for c in b.columns), strict=True):
                ahead, behind = _walk(word), _walk(word[::-1])[::-1]
                for i, (p, p_key) in enumerate(ahead):
                    s, s_key = behind[i]
                    rows.append((number, n, False, True, p, s, p_key, s_key))
                    if i < len(word):
                        s, s_key = behind[i + 1]
                        rows.append((number, n, True, i == 0 or word[i] != word[i - 1], p, s, p_key, s_key))
                    if len(rows) >= 1 << 16:
                        yield full()
        if rows:
            yield full()

    return words.select("id", "word", "n").mapInArrow(
        run, "id long, n long, skipped boolean, first boolean, p long, s long, p_key binary, s_key binary"
    )


def _with_numbers(filed: DataFrame, side: str, nodes: DataFrame) -> DataFrame:
    """The number of a deep node in place of what it is looked up by."""
    key = f"{side}_key"
    shallow = filed.where(F.col(key).isNull()).drop(key)
    deep = filed.where(F.col(key).isNotNull()).drop(side).join(nodes.toDF(key, side), key).drop(key)
    return shallow.unionByName(deep)


def node_pairs(words: DataFrame) -> DataFrame:
    """``(id, n, skipped, first, p, s)`` of the numbered words: every pair of
    prefix and suffix node. Deep nodes have negative numbers."""
    filed = materialize(_filed(words), "variant-pairs")
    keys = filed.select(F.col("p_key").alias("key")).union(filed.select("s_key")).where("key is not null").distinct()
    nodes = materialize(keys.select("key", (-1 - F.monotonically_increasing_id()).alias("node")), "variant-nodes")
    return _with_numbers(_with_numbers(filed, "p", nodes), "s", nodes)


def near_words(words: DataFrame) -> DataFrame:
    """``(id, n_near, best)`` of the numbered words that have a near word:
    how many, and the most frequent one as ``(minus_n, id)`` (ties: the first
    by code point)."""
    member = F.struct((-F.col("n")).alias("minus_n"), "id", "skipped", "first")
    # at most one word for each letter, and the one without it
    pairs = node_pairs(words).groupBy("p", "s").agg(F.collect_list(member).alias("all")).where(F.size("all") > 1)

    def near(a: Column, b: Column) -> Column:
        both = a["skipped"] & b["skipped"] & (a["id"] != b["id"])
        return both | (a["skipped"] & a["first"] & ~b["skipped"]) | (b["skipped"] & b["first"] & ~a["skipped"])

    each = pairs.select(F.explode(F.transform("all", lambda a: F.struct(a["id"].alias("id"), F.filter("all", lambda b: near(a, b)).alias("near")))).alias("x"))
    each = each.select("x.id", F.size("x.near").alias("n_near"), F.array_min("x.near").alias("b")).where("n_near > 0")
    best = F.min(F.struct("b.minus_n", "b.id")).alias("best")
    return each.groupBy("id").agg(F.sum("n_near").cast("long").alias("n_near"), best)


# ---- forms ------------------------------------------------------------------------


def roots(forms: DataFrame) -> DataFrame:
    """``(id, root)`` of the ``forms`` ``(id, form)``, which have no circles:
    the last id that the forms lead to. Each round doubles the steps taken."""
    cur = materialize(forms.select("id", F.col("form").alias("root")), "variant-roots")
    while True:
        then = cur.select(F.col("id").alias("root"), F.col("root").alias("then"))
        cur = materialize(cur.join(then, "root", "left").select("id", F.coalesce("then", "root").alias("root"), F.col("then").isNotNull().alias("moved")), "variant-roots")
        if not cur.where("moved").limit(1).count():
            return cur.select("id", "root")
        cur = cur.drop("moved")


def group_variants(words: DataFrame, form_ratio: int = FORM_RATIO) -> DataFrame:
    """``(word, form, root, n, n_near, form_n)`` of a vocabulary ``(word, n)``
    of distinct words of ``LETTERS``. Two words are near if they differ by one
    inserted, deleted or replaced letter; the form is the near word of largest
    n (ties: first by code point) if it has at least ``form_ratio`` times the
    n, else NULL; the root is the last of the forms, the word itself without
    one. An empty vocabulary gives an empty result."""
    words = numbered(words.select("word", "n"))
    found = words.join(near_words(words), "id", "left")
    found = found.withColumn("likely", -F.col("best.minus_n") >= F.col("n") * form_ratio)
    found = materialize(
        found.select(
            "id", "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"), F.when(F.col("likely"), F.col("best.id")).alias("form")
        ),
        "variant-forms",
    )
    named = words.select(F.col("id").alias("to"), F.col("word").alias("name"), F.col("n").alias("to_n"))
    lead = found.where("form is not null").select("id", "form")
    lead = lead.join(roots(lead), "id")
    lead = lead.join(named.toDF("form", "form_word", "form_n"), "form").join(named.drop("to_n").toDF("root", "root_word"), "root")
    out = found.select("id", "word", "n", "n_near").join(lead.select("id", "form_word", "form_n", "root_word"), "id", "left")
    return out.select(
        "word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n", "n_near", F.col("form_n").cast("long").alias("form_n")
    )


def spelling_variants(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_length: int = MIN_LENGTH,
    min_count: int = MIN_COUNT,
    form_ratio: int = FORM_RATIO,
    misspell_every: int | None = None,
) -> DataFrame:
    """``group_variants`` of the ``word_counts`` of ``docs``. Other columns,
    whatever their names, are not read; an empty table gives an empty result."""
    return group_variants(word_counts(docs, id_col, text_col, min_length, min_count, misspell_every), form_ratio)
