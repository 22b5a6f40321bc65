import base64
import hashlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import byte_bpe

PATH, SPLIT = byte_bpe.ranks_path(), byte_bpe.pattern()
with open(PATH, "rb") as f:
    RANKS = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
LIBRARY = tiktoken.Encoding("test", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})
PARTS = ["the", " Thing", "can't", " '", "s", "we'RE", " ", "  ", "\t\n", "\x1c", "\x85", "\xa0", "\u3000", "1", " 23", "...", "<|endoftext|>", "\xe9", "\u65e5\u672c", "\U0001f600", "\0", "\xb2"]


def plain_merge(piece: bytes) -> list[int]:
    """The two neighbours of least rank are joined until none can be."""
    parts = [bytes([b]) for b in piece]
    while len(parts) > 1:
        best = min(range(len(parts) - 1), key=lambda i: RANKS.get(parts[i] + parts[i + 1], 1 << 60))
        if parts[best] + parts[best + 1] not in RANKS:
            break
        parts[best : best + 2] = [parts[best] + parts[best + 1]]
    return [RANKS[p] for p in parts]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=4), max_size=20), st.integers(1, 12))
def test_equals_the_library_and_round_trips(parts, part):
    text = "".join(parts)
    b = byte_bpe.load(PATH, SPLIT)
    want = LIBRARY.encode_ordinary(text)
    assert b.encode(text).tolist() == want
    kept = byte_bpe.PART
    try:  # cut as often as can be
        byte_bpe.PART = part
        assert np.concatenate(list(b._long(text))).tolist() == want
    finally:
        byte_bpe.PART = kept
    assert b.decode(b.encode(text)) == text.encode()


@pytest.mark.parametrize("white", [" ", "\n", "\u3000", " \n"])
@pytest.mark.parametrize("tail", ["", "x", " x", ".", "'s"])
def test_long_runs_of_white_space(white, tail):
    b = byte_bpe.load(PATH, SPLIT)
    for head in ("", "word", "word."):
        text = head + white * 5000 + tail + white * 4096 + "end"
        assert b.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_runs_that_the_library_cannot_split():
    b = byte_bpe.load(PATH, SPLIT)
    text = "a b" + " " * 1_500_000 + "c" + "\n" * 1_200_000
    ids = b.encode(text)
    assert b.decode(ids) == text.encode()
    assert ids.max() < len(RANKS)


def test_long_texts_and_long_words():
    b = byte_bpe.load(PATH, SPLIT)
    for text in ("Some words, some 'more'. " * 20_000, "ab" * 150_000, "日本語" * 40_000, "x  y\n\n" * 30_000):
        assert b.encode(text).tolist() == LIBRARY.encode_ordinary(text)


def test_merges_by_rank():
    b = byte_bpe.load(PATH, SPLIT)
    for word in (" internationalisation", "zzzz", "éèê", "aaaaaaaaaaaaaaaaab"):
        assert b.encode(word).tolist() == plain_merge(word.encode())


def test_table(spark):
    texts = ["Some words, some more.", "", None, "  ", "Some words, some more.", "x y " * 30_000, "� \x00"]
    df = spark.createDataFrame([(i if i != 3 else None, t, "a", 1) for i, t in enumerate(texts)], "doc_id long, text string, ids string, `input` int")
    rows = byte_bpe.digests(df, ["doc_id", "ids", "input"]).collect()
    assert len(rows) == len(texts)
    for r in rows:
        text = texts[3 if r.doc_id is None else r.doc_id] or ""
        want = LIBRARY.encode_ordinary(text)
        assert (r.n_tokens, r.ids, r.input) == (len(want), "a", 1)
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    back = byte_bpe.decode_table(byte_bpe.encode_table(df, ["doc_id"]), ["doc_id"])
    assert {r.doc_id: bytes(r.bytes) for r in back.collect()} == {i if i != 3 else None: (t or "").encode() for i, t in enumerate(texts)}
    assert byte_bpe.digests(df.limit(0), ["doc_id"]).count() == 0
