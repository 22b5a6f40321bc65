"""BPE encoding and decoding with a contiguous rank array.

The vocabulary is a file of the ``tokenizers`` library (byte-level symbols,
word ends marked by a suffix, lower case, white space dropped); its path is a
parameter and must be readable on the executors. No tokenizer is trained
here, and the library does no encoding: it only normalises and splits words with
characters beyond Latin, where its own tables of characters decide.

A word is held as a list of its parts and a list of the ranks of each two
adjacent parts. The smallest rank is looked for by a scan; its left part takes
the merged symbol, the right part's boundary is deleted, and only the two
neighbouring ranks are looked up again. For the short words of prose a scan of
a contiguous list is faster than any heap. Words longer than ``SHORT`` would
make the scans quadratic; they keep candidates in a heap, with the same
result (lowest rank first, leftmost among equals).

White space never lies inside a token, and neither normalisation nor the
split into words looks across it, so a text is encoded word by word, each
distinct word once while it is remembered (two generations of ``CACHED_WORDS``;
what is used again stays).
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import unicodedata
from collections.abc import Callable, Iterator
from operator import itemgetter

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

VOCABULARY = "word_bpe_49k.json"
CACHED_WORDS = 150_000
SHORT = 96
NO_RANK = 1 << 30
#: Texts are split at Unicode white space; Python's split also takes these, which are none.
_ODD_SPACE = regex.compile("[\x1c-\x1f]")
_LAST_LATIN = "\u024f"
_SPACES = regex.compile(r"[\p{White_Space}]+")


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte: the printable ones
    of Latin-1 for themselves, the others in order from U+0100."""
    own = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in own]
    return [chr(b) if b in own else chr(256 + rest.index(b)) for b in range(256)]


class Bpe:
    """One vocabulary file, ready to encode and decode."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        library = Tokenizer.from_file(path)
        self.normalize, self.split = library.normalizer.normalize_str, library.pre_tokenizer.pre_tokenize_str
        model = spec["model"]
        ids: dict[str, int] = model["vocab"]
        self.suffix: str = model["end_of_word_suffix"] or ""
        split = spec["pre_tokenizer"]["pretokenizers"][0]
        self.words = regex.compile(split["pattern"]["Regex"].replace(r"\s", r"\p{White_Space}"))
        added = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.added = regex.compile("(" + "|".join(map(regex.escape, sorted(added, key=len, reverse=True))) + ")")
        self.added_ids = added
        self.lead = os.path.commonprefix([*added])[:1]  # what every special token begins with
        self.tokens = [""] * (max([*ids.values(), *added.values()]) + 1)
        for t, i in [*ids.items(), *added.items()]:
            self.tokens[i] = t
        symbols = byte_symbols()
        self.byte = {c: i for i, c in enumerate(symbols)}
        self.first = [ids[s] for s in symbols]
        self.last = [ids[s + self.suffix] for s in symbols]
        self.base = 1 << 17
        self.rank: dict[int, int] = {}
        self.merged: list[int] = []
        for r, (a, b) in enumerate(model["merges"]):
            self.rank.setdefault(ids[a] * self.base + ids[b], r)
            self.merged.append(ids[a + b])
        self.digits = [str(i) for i in range(len(self.tokens))]
        self.cache: dict[str, list[int]] = {}
        self.older: dict[str, list[int]] = {}

    def merge(self, parts: list[int]) -> list[int]:
        """Merge the symbols of one word, lowest rank first."""
        if len(parts) > SHORT:
            return self._merge_long(parts)
        rank, base, merged = self.rank.get, self.base, self.merged
        ranks = [rank(a * base + b, NO_RANK) for a, b in zip(parts, parts[1:], strict=False)]
        while ranks:
            low = min(ranks)
            if low == NO_RANK:
                break
            i = ranks.index(low)
            parts[i] = merged[low]
            del parts[i + 1], ranks[i]
            if i:
                ranks[i - 1] = rank(parts[i - 1] * base + parts[i], NO_RANK)
            if i < len(ranks):
                ranks[i] = rank(parts[i] * base + parts[i + 1], NO_RANK)
        return parts

    def _merge_long(self, parts: list[int]) -> list[int]:
        rank, base, n = self.rank.get, self.base, len(parts)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, i + 1, parts[i], parts[i + 1]) for i in range(n - 1) if (r := rank(parts[i] * base + parts[i + 1])) is not None]
        heapq.heapify(heap)
        gone = bytearray(n)
        while heap:
            r, i, j, a, b = heapq.heappop(heap)
            if gone[i] or gone[j] or parts[i] != a or parts[j] != b or after[i] != j:
                continue
            parts[i], gone[j], after[i] = self.merged[r], 1, after[j]
            if after[i] < n:
                before[after[i]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (r := rank(parts[x] * base + parts[y])) is not None:
                    heapq.heappush(heap, (r, x, y, parts[x], parts[y]))
        return [p for p, g in zip(parts, gone, strict=True) if not g]

    def _word(self, raw: str) -> list[int]:
        """Ids of a run of characters without white space."""
        out: list[int] = []
        for k, piece in enumerate(self.added.split(raw) if self.lead in raw else (raw,)):
            if k % 2:
                out.append(self.added_ids[piece])
                continue
            if not piece.isascii():
                if max(piece) > _LAST_LATIN:
                    for symbols, _ in self.split(self.normalize(piece)):
                        parts = [self.first[self.byte[c]] for c in symbols]
                        parts[-1] = self.last[self.byte[symbols[-1]]]
                        out += self.merge(parts)
                    continue
                piece = unicodedata.normalize("NFC", piece)
            # the final form of sigma depends on its neighbours only in Python
            piece = "".join(c.lower() for c in piece) if "Σ" in piece else piece.lower()
            for word in self.words.findall(piece):
                b = word.encode("utf-8", "surrogatepass")
                parts = [self.first[x] for x in b]
                parts[-1] = self.last[b[-1]]
                out += self.merge(parts)
        return out

    def encode(self, text: str | None) -> list[int]:
        """Ids of a whole text, special tokens in it included; NULL: none."""
        if not text:
            return []
        raw = [w for w in _SPACES.split(text) if w] if _ODD_SPACE.search(text) else text.split()
        cache, out = self.cache, []
        for w in raw:
            got = cache.get(w)
            if got is None:
                got = self.older.get(w)
                if got is None:
                    got = self._word(w)
                if len(w) <= SHORT:
                    if len(cache) >= CACHED_WORDS:
                        self.older = cache
                        cache = self.cache = {}
                    cache[w] = got
            out += got
        return out

    def _of(self, table: list[str], ids: list[int]) -> str:
        if len(ids) < 2:
            return table[ids[0]] if len(ids) else ""
        return " ".join(itemgetter(*ids)(table))

    def decode(self, ids: list[int]) -> str:
        """The tokens of ``ids``, special ones included, between single
        spaces: this vocabulary's file names no decoder."""
        return self._of(self.tokens, ids)

    def written(self, ids: list[int]) -> str:
        """The ids in decimal, between single spaces."""
        return self._of(self.digits, ids)


@functools.lru_cache(maxsize=2)
def load(path: str) -> Bpe:
    return Bpe(path)


def _mapped(docs: DataFrame, keep: list[str], column: str, path: str, f: Callable[[Bpe, object], tuple], out: pa.Schema, ddl: str) -> DataFrame:
    """``keep`` of every row with the columns that ``f`` makes of ``column``,
    a few rows at a time, so that no batch holds many long results."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                rows = [f(bpe, t) for t in b.column(len(keep)).to_pylist()]
                made = [pa.array([r[i] for r in rows], out.field(i).type) for i in range(len(out))]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *made], [*keep, *out.names])

    kinds = dict(docs.dtypes)
    kept = ", ".join(f"`{c}` {kinds[c]}" for c in keep)
    return docs.select(*keep, F.col(column).alias("__in")).mapInArrow(run, f"{kept}, {ddl}" if kept else ddl)


def encode_table(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None) -> DataFrame:
    """``keep`` and ``ids`` (array of int) of every row, whole texts. NULL and
    empty texts, and texts of white space, have no ids; repeated rows stay."""
    out = pa.schema([("ids", pa.list_(pa.int32()))])
    return _mapped(docs, keep, text_col, path or vocabulary_path(), lambda b, t: (b.encode(t),), out, "ids array<int>")


def decode_table(tokens: DataFrame, keep: list[str], ids_col: str = "ids", path: str | None = None) -> DataFrame:
    """``keep`` and the decoded ``text`` of every row; NULL: empty."""
    out = pa.schema([("text", pa.string())])
    return _mapped(tokens, keep, ids_col, path or vocabulary_path(), lambda b, i: (b.decode(i or []),), out, "text string")


def sha256(text: str) -> str:
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def digests(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None, ids: bool = False) -> DataFrame:
    """``keep``, ``n_tokens`` and the SHA-256 of the ids (decimal, between
    spaces) and of the decoded text, from one encoding and decoding of every
    row; with ``ids`` also the ids themselves."""

    def made(b: Bpe, t: object) -> tuple:
        own = b.encode(t)
        row = (len(own), sha256(b.written(own)), sha256(b.decode(own)))
        return (*row, own) if ids else row

    fields = [("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
    ddl = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    if ids:
        fields, ddl = [*fields, ("ids", pa.list_(pa.int32()))], f"{ddl}, ids array<int>"
    return _mapped(docs, keep, text_col, path or vocabulary_path(), made, pa.schema(fields), ddl)
