"""Byte-level BPE through the tiktoken library, from a local file of ranks.

The library gets whole texts, but long ones in parts: its splitter keeps the
state of a search on the stack, which a long run of white space overflows.
Texts are cut where the pattern always begins a new match, so the matches, and
with them the ids, are those of the whole text:

* before a white space that follows another character, as no alternative of
  the pattern goes on into white space (and none looks back);
* around a long run of white space. ``\\s+(?!\\S)`` takes the run up to its last
  character (all of it at the end of a text), which is one match; the last
  character begins the next one.

Decoding joins the bytes of the ids.
"""

from __future__ import annotations

import base64
import functools
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RANKS = "byte_bpe_50k.tiktoken"
#: Characters of a part of a long text, if it has a place to cut.
PART = 1 << 16
#: Runs of white space from this length on are encoded as the match they are.
LONG_RUN = 1 << 12

# The characters with the Unicode property White_Space.
_WHITE = "\t-\r \x85\xa0" + "".join(map(chr, (0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))
_CUT = re.compile(f"(?<=[^{_WHITE}])(?=[{_WHITE}])")
_RUN = re.compile(f"[{_WHITE}]{{{LONG_RUN},}}")


def ranks_path(name: str = RANKS) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes and ranks of a file with a token in base 64 and its rank a line."""
    with open(path, "rb") as f:
        pairs = (line.split() for line in f)
        return {base64.b64decode(p[0]): int(p[1]) for p in pairs if p}


class ByteBpe:
    """The library's ids of whole texts, and their bytes."""

    def __init__(self, path: str, split: str):
        import tiktoken

        self.library = tiktoken.Encoding("local", pat_str=split, mergeable_ranks=read_ranks(path), special_tokens={})

    def _match(self, text: str) -> np.ndarray:
        """Ids of a text that is one match of the pattern."""
        return np.array(self.library._core_bpe.encode_single_piece(text.encode()), np.uint32)

    def _parts(self, text: str) -> Iterator[np.ndarray]:
        """Ids of a text without a long run of white space, part by part."""
        at = 0
        while len(text) - at > PART:
            cut = _CUT.search(text, at + PART)
            if cut is None:
                break
            yield self.library.encode_to_numpy(text[at : cut.start()], disallowed_special=())
            at = cut.start()
        yield self.library.encode_to_numpy(text[at:], disallowed_special=())

    def _long(self, text: str) -> Iterator[np.ndarray]:
        at = 0
        for run in _RUN.finditer(text):
            end = run.end() if run.end() == len(text) else run.end() - 1
            yield from self._parts(text[at : run.start()])
            yield self._match(text[run.start() : end])
            at = end
        yield from self._parts(text[at:])

    def encode(self, text: str | None) -> np.ndarray:
        """Ids (uint32) of a whole text, special tokens' strings being
        ordinary text; NULL and the empty text have none."""
        if not text:
            return np.empty(0, np.uint32)
        if len(text) < LONG_RUN:
            return self.library.encode_to_numpy(text, disallowed_special=())
        return np.concatenate(list(self._long(text)))

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of the ids, which need not be whole characters."""
        return self.library.decode_bytes(ids.tolist())


@functools.lru_cache(maxsize=2)
def load(path: str, split: str) -> ByteBpe:
    return ByteBpe(path, split)


def _mapped(docs: DataFrame, keep: list[str], column: str, path: str | None, split: str | None, f, made: dict[str, tuple[pa.DataType, str]]) -> DataFrame:
    """``keep`` of every row with the columns ``made`` (Arrow type and DDL) that
    ``f`` makes of ``column``, a few rows at a time."""
    path, split = path or ranks_path(), split or pattern()
    names = [f"c{i}" for i in range(len(keep))]  # the callers' names may be any, also twice the same as ours

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path, split)
        for whole in batches:
            for at in range(0, whole.num_rows, 256):
                b = whole.slice(at, 256)
                rows = [f(bpe, x) for x in b.column(len(keep))]
                new = [pa.array([r[i] for r in rows], kind) for i, (kind, _) in enumerate(made.values())]
                yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], *new], [*names, *made])

    picked = docs.select(*[F.col(f"`{c}`").alias(n) for c, n in zip(keep, names, strict=True)], F.col(f"`{column}`").alias("input"))
    ddl = [f"{n} {kind}" for n, kind in picked.dtypes[:-1]] + [f"{n} {kind}" for n, (_, kind) in made.items()]
    out = picked.mapInArrow(run, ", ".join(ddl))
    return out.toDF(*keep, *made)


def encode_table(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None, split: str | None = None) -> DataFrame:
    """``keep`` and ``ids`` (array of int) of every row, whole texts. NULL and
    empty texts have no ids; repeated rows stay, each with its ids; an empty
    table stays empty. Other columns, whatever their names, are not read."""
    made = {"ids": (pa.list_(pa.int32()), "array<int>")}
    return _mapped(docs, keep, text_col, path, split, lambda b, t: (b.encode(t.as_py()).astype(np.int32),), made)


def decode_table(tokens: DataFrame, keep: list[str], ids_col: str = "ids", path: str | None = None, split: str | None = None) -> DataFrame:
    """``keep`` and the decoded ``bytes`` (binary: ids may end inside a
    character) of every row; NULL and empty lists give no bytes."""

    def bytes_of(b: ByteBpe, ids: pa.Scalar) -> tuple:
        return (b.decode(np.array(ids.as_py() or [], np.uint32)),)

    return _mapped(tokens, keep, ids_col, path, split, bytes_of, {"bytes": (pa.binary(), "binary")})


def digests(docs: DataFrame, keep: list[str], text_col: str = "text", path: str | None = None, split: str | None = None) -> DataFrame:
    """``keep``, ``n_tokens`` and the SHA-256 of the ids (unsigned 32-bit,
    little-endian) and of the decoded bytes, from one encoding and decoding of
    every row. Cases as in ``encode_table``."""

    def made(b: ByteBpe, text: pa.Scalar) -> tuple:
        ids = b.encode(text.as_py())
        return len(ids), hashlib.sha256(ids.astype("<u4").tobytes()).hexdigest(), hashlib.sha256(b.decode(ids)).hexdigest()

    out = {"n_tokens": (pa.int64(), "long"), "ids_sha256": (pa.string(), "string"), "decoded_sha256": (pa.string(), "string")}
    return _mapped(docs, keep, text_col, path, split, made, out)
