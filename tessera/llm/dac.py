"""Token ids in binary files of directly addressable codes.

An id is cut into chunks of 8 bits, lowest first. Level 0 holds the first
chunk of every token, level 1 the second chunk of those that have one, and so
on; each level but the last has a bitmap that says which of its tokens go on,
and a rank directory (ones before each 512 bits). Token i is read in a few
steps, without decoding any block: its chunk at level 0, and while the bitmap
says that it goes on, the chunk at ``rank(i)`` of the next level.

**File.** Files are segments: runs of whole documents in ascending order of
id, of about ``SEGMENT_TOKENS`` tokens. A segment is one row of a Parquet table
(so any store that Spark writes to can hold it): its place in the order
(``bucket``, ``seq``), its numbers of documents and tokens, and the ``payload``:

    header       4 bytes "DAC1", u8 levels, u32 documents, u64 tokens
    documents    i64 ids, u8 flags (1: the id is NULL), u64 starts (one more than documents)
    each level   u64 n, n chunk bytes; but for the last level:
                 bitmap (u64 words, lowest bit first), u32 ones before each 8 words

All numbers are little-endian.
"""

from __future__ import annotations

import functools
import itertools
import struct
import zlib
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import Buckets, buckets_by, materialize, text_bytes

VOCABULARY = "byte_bpe_50k.json"
END_ID = 0
SEGMENT_TOKENS = 1 << 20
#: Distinct pieces of text, and pre-tokens, whose ids a worker remembers.
KNOWN_PIECES, CACHED_WORDS = 1_000_000, 50_000
#: Bytes of text that are encoded at once.
TEXT_BYTES = 1 << 22
#: Longer ones are encoded each time.
SHORT = 64
WORDS_PER_BLOCK = 8
_HEADER = struct.Struct("<4sBIQ")


# ---- the code ----------------------------------------------------------------


def _pack(bits: np.ndarray) -> tuple[bytes, bytes]:
    """Bitmap and rank directory."""
    words = -(-len(bits) // 64)
    raw = np.packbits(bits, bitorder="little").tobytes().ljust(words * 8, b"\0")
    ones = np.bitwise_count(np.frombuffer(raw, "<u8")).astype(np.int64)
    blocks = np.add.reduceat(ones, np.arange(0, words, WORDS_PER_BLOCK)) if words else np.empty(0, np.int64)
    return raw, np.concatenate([[0], np.cumsum(blocks)])[: len(blocks)].astype("<u4").tobytes()


def encode_segment(ids: np.ndarray, docs: list[int | None], starts: np.ndarray) -> bytes:
    """The payload of a segment: ``ids`` of all its documents, one after the
    other; document k has those from ``starts[k]`` to ``starts[k + 1]``."""
    rest, levels = np.ascontiguousarray(ids).astype(np.uint32), []
    while True:
        more = rest >= 256
        levels.append(((rest & 0xFF).astype(np.uint8), more))
        if not more.any():
            break
        rest = rest[more] >> 8
    out = [
        _HEADER.pack(b"DAC1", len(levels), len(docs), len(ids)),
        np.array([d or 0 for d in docs], "<i8").tobytes(),
        np.array([d is None for d in docs], "u1").tobytes(),
        np.asarray(starts, "<u8").tobytes(),
    ]
    for k, (chunks, more) in enumerate(levels):
        out += [struct.pack("<Q", len(chunks)), chunks.tobytes()]
        if k < len(levels) - 1:
            out += _pack(more)
    return b"".join(out)


class Segment:
    """Reads single tokens and documents from a payload."""

    def __init__(self, payload: bytes):
        magic, levels, n, self.tokens = _HEADER.unpack_from(payload)
        if magic != b"DAC1":
            raise ValueError("not a segment of directly addressable codes")
        at = _HEADER.size

        def take(kind: str, count: int) -> np.ndarray:
            nonlocal at
            got = np.frombuffer(payload, kind, count, at)
            at += got.nbytes
            return got

        ids, null = take("<i8", n), take("u1", n)
        self.docs = [None if z else int(d) for d, z in zip(ids, null, strict=True)]
        self.starts = take("<u8", n + 1).astype(np.int64)
        self.levels = []
        for k in range(levels):
            size = int(take("<u8", 1)[0])
            chunks = take("u1", size)
            bits = ranks = None
            if k < levels - 1:
                words = -(-size // 64)
                bits, ranks = take("<u8", words), take("<u4", -(-words // WORDS_PER_BLOCK))
            self.levels.append((chunks, bits, ranks))

    @staticmethod
    def _rank(bits: np.ndarray, ranks: np.ndarray, i: int) -> int:
        """Ones before bit i."""
        word, bit = divmod(i, 64)
        block = word // WORDS_PER_BLOCK
        if block >= len(ranks):
            return int(ranks[-1]) + int(np.bitwise_count(bits[(len(ranks) - 1) * WORDS_PER_BLOCK :]).sum()) if len(ranks) else 0
        n = int(ranks[block]) + int(np.bitwise_count(bits[block * WORDS_PER_BLOCK : word]).sum())
        return n + ((int(bits[word]) & ((1 << bit) - 1)).bit_count() if bit else 0)

    def token(self, i: int) -> int:
        """Token i of the segment."""
        value, shift = 0, 0
        for chunks, bits, ranks in self.levels:
            value |= int(chunks[i]) << shift
            if bits is None or not int(bits[i // 64]) >> (i % 64) & 1:
                return value
            i, shift = self._rank(bits, ranks, i), shift + 8
        return value

    def slice(self, a: int, b: int) -> np.ndarray:
        """Tokens a to b - 1 (uint32), level by level."""
        out = np.zeros(b - a, np.uint32)
        at = np.arange(b - a)
        for shift, (chunks, bits, ranks) in enumerate(self.levels):
            out[at] |= chunks[a:b].astype(np.uint32) << np.uint32(8 * shift)
            if bits is None or a == b:
                break
            words = bits[a // 64 : -(-b // 64)]
            more = np.unpackbits(words.view(np.uint8), bitorder="little")[a % 64 : a % 64 + b - a].astype(bool)
            at, a = at[more], self._rank(bits, ranks, a)
            b = a + len(at)
        return out

    def document(self, k: int) -> np.ndarray:
        return self.slice(int(self.starts[k]), int(self.starts[k + 1]))


# ---- tokenizing --------------------------------------------------------------

# The split of byte-level vocabularies, and the characters that
# stand for bytes in them (printable Latin-1 for themselves, the others in order
# from U+0100).
_SPLIT = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
_OWN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_SYMBOLS = dict(zip([b for b in range(256) if b not in _OWN], map(chr, range(256, 512)), strict=False))
_LAST_LATIN = "\u024f"


class _Words(dict):
    """Ids, as bytes, of pre-tokens, found by ``encode`` when first asked for."""

    def __init__(self, encode: Callable[[str], bytes]):
        super().__init__()
        self.encode = encode

    def __missing__(self, word: str) -> bytes:
        got = self.encode(word)
        if len(word) <= SHORT:
            if len(self) >= CACHED_WORDS:
                self.clear()
            self[word] = got
        return got


# What a byte is, as bits: a printable ASCII character, an ASCII letter or digit, a space or line feed, ASCII
# punctuation, a later byte of a character, the first of U+00C0 to U+07FF, the first of U+00C0 to U+00FF.
_SOLID, _WORD, _SPACE, _MARK, _LATER, _TWO, _LATIN = (1 << k for k in range(7))


def _byte_kinds() -> np.ndarray:
    kind = np.zeros(256, np.uint8)
    kind[0x21:0x7F] = _SOLID | _MARK
    for c in (*range(48, 58), *range(65, 91), *range(97, 123)):
        kind[c] = _SOLID | _WORD
    kind[[0x20, 0x0A]] = _SPACE
    kind[0x80:0xC0] = _LATER
    kind[0xC3:0xE0] = _TWO
    kind[0xC3] |= _LATIN
    return kind


_KIND = _byte_kinds()


def safe_cuts(data: np.ndarray) -> np.ndarray:
    """Places in UTF-8 bytes at which the split always begins a new match:
    before a space or line feed that follows a character that is no white space
    (matches begin with white space or have none), and before ASCII punctuation
    that follows a letter or digit (no match goes from one to the other).
    Characters of more than two bytes, and those before U+00C0, are not looked
    at: the pieces around them are longer."""
    kind = _KIND[data]
    before, here = kind[:-1], kind[1:]
    two = np.zeros(len(before), np.uint8)  # the first byte of a character of two bytes that ends just before
    two[1:] = np.where(before[1:] & _LATER, kind[:-2] & (_TWO | _LATIN), 0)
    solid = (before & _SOLID) | (two & _TWO)
    # U+00D7 and U+00F7 are the only ones among U+00C0 to U+00FF that are no letters
    latin = (two & _LATIN) * ((data[:-1] != 0x97) & (data[:-1] != 0xB7))
    word = (before & _WORD) | latin
    return np.flatnonzero(((solid != 0) & (here & _SPACE != 0)) | ((word != 0) & (here & _MARK != 0))) + 1


def _runs(values: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Runs of ``values``, one after the other: ``size[k]`` of them from ``first[k]`` on."""
    before = np.cumsum(size) - size
    return values[np.arange(size.sum()) + np.repeat(first - before, size)]


class Encoder:
    """The library's encoding of whole texts, many at a time.

    Texts are cut where the split of this vocabulary always begins a new match
    (``safe_cuts``); the pieces of all texts are numbered, each distinct one is
    encoded once, and in it each distinct pre-token, by the library's model;
    the ids are put together by number. Pieces with characters beyond Latin go
    to the library as they are, texts with a special token as a whole."""

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.library = Tokenizer.from_file(path)
        self.library.no_truncation()
        self.library.no_padding()
        self.kind = np.dtype("<u2" if self.library.get_vocab_size(with_added_tokens=True) <= 1 << 16 else "<u4")
        self.code = "H" if self.kind.itemsize == 2 else "I"
        self.special = [t.content.encode() for t in self.library.get_added_tokens_decoder().values()]
        self.tokenize = self.library.model.tokenize
        self.by_pieces = self.library.normalizer is None
        self.words = _Words(self._word)
        self._forget()

    def _whole(self, text: str) -> bytes:
        return np.array(self.library.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _word(self, word: str) -> bytes:
        """A pre-token of Latin characters, by the library's model."""
        if word.isascii() and word.isprintable():
            symbols = word.replace(" ", _SYMBOLS[32])
        else:
            symbols = word.encode().decode("latin-1").translate(_SYMBOLS)
        return array(self.code, [t.id for t in self.tokenize(symbols)]).tobytes()

    def _piece(self, raw: bytes) -> bytes:
        if raw[:1] == b" " and raw[1:].isalpha():  # of a space and ASCII letters, as most
            return array(self.code, [t.id for t in self.tokenize(_SYMBOLS[32] + raw[1:].decode())]).tobytes()
        piece = raw.decode()
        # the library splits what is not plain Latin text, so that its tables of letters hold
        if not piece.isascii() and max(piece) > _LAST_LATIN:
            return self._whole(piece)
        if piece.isalpha() or piece[0] == " " and piece[1:].isalpha():
            return self._word(piece)
        return b"".join(map(self.words.__getitem__, _SPLIT.findall(piece)))

    def _forget(self) -> None:
        """Pieces whose ids are known, as columns: a million take some 30 MB."""
        self.names = pa.array([], pa.large_binary())
        self.first, self.size, self.flat = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, self.kind)

    def _ids(self, names: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces, one after the other, and for each piece the
        place of its first one and their number. Pieces that are not known are
        encoded; short ones are known from then on, until there are too many."""
        at = pc.fill_null(pc.index_in(names, value_set=self.names), -1).to_numpy()
        new = np.flatnonzero(at < 0)
        made = [self._piece(p) for p in names.take(pa.array(new)).to_pylist()]
        n = np.fromiter(map(len, made), np.int64, len(made)) // self.kind.itemsize
        flat = np.concatenate([self.flat, np.frombuffer(b"".join(made), self.kind)])
        first, size = np.empty(len(names), np.int64), np.empty(len(names), np.int64)
        old = at >= 0
        first[old], size[old] = self.first[at[old]], self.size[at[old]]
        first[new], size[new] = len(self.flat) + np.cumsum(n) - n, n
        short = new[pc.binary_length(names).to_numpy()[new] <= SHORT]
        if len(self.names) + len(short) > KNOWN_PIECES:
            self._forget()
        else:
            self.names = pa.concat_arrays([self.names, names.take(pa.array(short))])
            base = len(self.flat)
            self.flat = np.concatenate([self.flat, _runs(flat, first[short], size[short])])
            self.first = np.concatenate([self.first, base + np.cumsum(size[short]) - size[short]])
            self.size = np.concatenate([self.size, size[short]])
        return flat, first, size

    def _together(self, texts: list[bytes]) -> Iterator[bytes]:
        """Ids of texts that are not empty and hold no special token."""
        begins = np.cumsum([0, *map(len, texts)])
        data = b"".join(texts)
        cut = np.zeros(len(data) + 1, bool)
        cut[begins] = cut[safe_cuts(np.frombuffer(data, np.uint8))] = True
        starts = np.flatnonzero(cut)
        pieces = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(starts) - 1, [None, pa.py_buffer(starts.astype(np.int64)), pa.py_buffer(data)])
        numbered = pieces.dictionary_encode()
        number = numbered.indices.to_numpy()
        ids, first, size = self._ids(numbered.dictionary)
        out = _runs(ids, first[number], size[number])
        cuts = np.append(0, np.cumsum(size[number]))[np.searchsorted(starts, begins)]
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield out[a:b].tobytes()

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of each UTF-8 text, as bytes of ``kind``."""
        plain = [bool(t) and self.by_pieces and not any(s in t for s in self.special) for t in texts]
        together = self._together([t for t, p in zip(texts, plain, strict=True) if p]) if any(plain) else iter(())
        return [next(together) if p else self._whole(t.decode()) if t else b"" for t, p in zip(texts, plain, strict=True)]


@functools.lru_cache(maxsize=2)
def load(path: str) -> Encoder:
    return Encoder(path)


def vocabulary_path(name: str = VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


# ---- tables ------------------------------------------------------------------

_ROWS = "bucket int, doc_id long, hash long, ids binary"
_SEGMENTS = "bucket int, seq int, n_docs long, n_tokens long, payload binary"


def _encoded(docs: DataFrame, id_col: str, text_col: str, buckets: Buckets, path: str, end_id: int) -> DataFrame:
    """``(bucket, doc_id, hash, ids)``: the ids with the end id, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc = load(path)
        end = np.array([end_id], enc.kind).tobytes()
        for whole in batches:
            group = np.cumsum(pc.fill_null(pc.binary_length(whole.column(2)), 0).to_numpy(), dtype=np.int64) // TEXT_BYTES
            for at, until in itertools.pairwise([0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), whole.num_rows]):
                b = whole.slice(at, until - at)
                ids = [x + end for x in enc.encode(text_bytes(b.column(2)))]
                bucket = buckets.of(b.column(0), b.column(1).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(bucket), b.column(0), b.column(1), pa.array(ids, pa.binary())], ["bucket", "doc_id", "hash", "ids"]
                )

    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("hash"), F.col(text_col).alias("text")
    )
    return rows.mapInArrow(run, _ROWS)


def _segments(rows: DataFrame, kind: str, segment_tokens: int) -> DataFrame:
    """Segments of rows that are sorted by bucket and place."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, seq, docs, parts, tokens = None, 0, [], [], 0
        size = np.dtype(kind).itemsize

        def full() -> pa.RecordBatch:
            starts = np.concatenate([[0], np.cumsum([len(p) // size for p in parts])])
            payload = encode_segment(np.frombuffer(b"".join(parts), kind), docs, starts)
            made = {"bucket": bucket, "seq": seq, "n_docs": len(docs), "n_tokens": tokens, "payload": payload}
            schema = pa.schema([("bucket", pa.int32()), ("seq", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("payload", pa.binary())])
            return pa.RecordBatch.from_pylist([made], schema=schema)

        for b in batches:
            for k, d, ids in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(3).to_pylist(), strict=True):
                if docs and (k != bucket or tokens >= segment_tokens):
                    yield full()
                    seq = seq + 1 if k == bucket else 0
                    docs, parts, tokens = [], [], 0
                bucket = k
                docs.append(d)
                parts.append(ids)
                tokens += len(ids) // size
        if docs:
            yield full()

    return rows.mapInArrow(run, _SEGMENTS)


def write_tokens(
    docs: DataFrame,
    out: str | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    path: str | None = None,
    end_id: int = END_ID,
    segment_tokens: int = SEGMENT_TOKENS,
) -> DataFrame:
    """Encode every whole text, append ``end_id``, and write the segments to
    ``out`` (a Parquet folder; None: the shared folder). Returns the written
    table. Documents are in ascending order of id, NULL ids last, ties by a
    hash of the text. NULL and empty texts have the end id only; repeated rows
    are written each; an empty table gives no segment."""
    path = path or vocabulary_path()
    buckets = buckets_by(docs, id_col)
    rows = _encoded(docs, id_col, text_col, buckets, path, end_id)
    # as many tasks as buckets: a task holds about one, whatever the table
    rows = rows.repartition(len(buckets), "bucket").sortWithinPartitions("bucket", "doc_id", "hash")
    segments = _segments(rows, load(path).kind.str, segment_tokens)
    if out is None:
        return materialize(segments, "token-segments")
    segments.write.mode("overwrite").parquet(out)
    return docs.sparkSession.read.parquet(out)


def read_documents(segments: DataFrame) -> DataFrame:
    """``(bucket, seq, doc_id, at, n_tokens, ids)`` of every document of the
    written ``segments``: ``at`` is its place in the segment."""
    return _read(segments, "ids array<long>", lambda ids: ids, pa.list_(pa.int64()))


def _read(segments: DataFrame, ddl: str, f, kind: pa.DataType) -> DataFrame:
    name = ddl.split()[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for bucket, seq, payload in zip(*(c.to_pylist() for c in b.columns), strict=True):
                s = Segment(payload)
                for a in range(0, len(s.docs), 512):
                    ks = range(a, min(a + 512, len(s.docs)))
                    ids = [s.document(k) for k in ks]
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([bucket] * len(ks), pa.int32()),
                            pa.array([seq] * len(ks), pa.int32()),
                            pa.array([s.docs[k] for k in ks], pa.int64()),
                            pa.array(s.starts[a : a + len(ks)]),
                            pa.array([len(x) for x in ids], pa.int64()),
                            pa.array([f(x) for x in ids], kind),
                        ],
                        ["bucket", "seq", "doc_id", "at", "n_tokens", name],
                    )

    slim = segments.select("bucket", "seq", "payload")
    return slim.mapInArrow(run, f"bucket int, seq int, doc_id long, at long, n_tokens long, {ddl}")


def segment_starts(segments: DataFrame) -> DataFrame:
    """``(bucket, seq, first)``: tokens of all segments before each."""
    slim = segments.select("bucket", "seq", "n_tokens")
    prior = Window.unboundedPreceding
    # buckets are a few thousand, whatever the table; segments are summed inside their bucket
    whole = slim.groupBy("bucket").agg(F.sum("n_tokens").alias("n"))
    whole = whole.select("bucket", F.coalesce(F.sum("n").over(Window.orderBy("bucket").rowsBetween(prior, -1)), F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("bucket").orderBy("seq").rowsBetween(prior, -1))
    return slim.withColumn("own", F.coalesce(inside, F.lit(0))).join(whole, "bucket").select("bucket", "seq", (F.col("before") + F.col("own")).alias("first"))


def document_digests(segments: DataFrame) -> DataFrame:
    """``(doc_id, start, n_tokens, ids_crc32)`` of every document, read from
    the written segments."""
    docs = _read(segments, "ids_crc32 long", lambda ids: zlib.crc32(ids.astype("<u4").tobytes()), pa.int64())
    starts = segment_starts(segments)
    return docs.join(starts, ["bucket", "seq"]).select("doc_id", (F.col("first") + F.col("at")).alias("start"), "n_tokens", "ids_crc32")
