import random
import zlib

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import dac

PATH = dac.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
PARTS = ["the", " the", " ", "  ", "\n", "\n\n", "\t", "\xa0", "'s", " 're", "12", "...", "<|endoftext|>", "é", "日本", "😀", "A", "ÿß", " ñandú,", "\U0003d000", "\u0558", "\x85", "x" * 70, "　"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from(PARTS) | st.text(max_size=3), max_size=10).map("".join), max_size=4))
def test_encoder_equals_the_library(texts):
    enc = dac.load(PATH)
    got = [np.frombuffer(x, enc.kind).tolist() for x in enc.encode([t.encode() for t in [*texts, ""]])]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in [*texts, ""]]


def test_pieces_begin_where_matches_begin():
    letters = ["a", "Z", "7", "é", "ß", "×", "÷", "ж", "日", "²", "\xa0", "\x85", "ª", "\u2003", "\u0300", "😀", "'", ",", "_", "|", " ", "\n", "\t", "s"]
    for a in letters:
        for b in letters:
            for c in letters:
                text = f"x{a}{b}{c}y"
                starts = {len(text[: m.start()].encode()) for m in dac._SPLIT.finditer(text)}
                assert set(dac.safe_cuts(np.frombuffer(text.encode(), np.uint8)).tolist()) <= starts


def test_codes_round_trip_with_random_access():
    r = random.Random(4)
    for n in (0, 1, 63, 64, 65, 511, 512, 513, 5000):
        ids = np.array([r.choice([r.randrange(256), r.randrange(65536), r.randrange(2**32)]) for _ in range(n)], np.uint32)
        cut = sorted({0, n, *(r.randrange(n + 1) for _ in range(6))})
        starts = np.array([0, *cut[1:]]) if n else np.array([0, 0])
        docs = [None if k == 1 else -k for k in range(len(starts) - 1)]
        s = dac.Segment(dac.encode_segment(ids, docs, starts))
        assert s.docs == docs and s.tokens == n
        assert [s.token(i) for i in range(n)] == ids.tolist()
        assert s.slice(0, n).tolist() == ids.tolist()
        for k in range(len(docs)):
            assert s.document(k).tolist() == ids[starts[k] : starts[k + 1]].tolist()
        for _ in range(20):
            a, b = sorted((r.randrange(n + 1), r.randrange(n + 1)))
            assert s.slice(a, b).tolist() == ids[a:b].tolist()


def test_files(spark, tmp_dir):
    texts = [(i * 7 % 90, f"Text number {i} " * (i % 5) + "end", "x") for i in range(90)]
    texts += [(None, "no id", "x"), (None, "no id", "x"), (None, None, "x"), (91, None, "x"), (92, "", "x"), (93, "two  spaces ", "x"), (5, "again", "x"), (94, "long " * 3000, "x")]
    df = spark.createDataFrame(texts, "doc_id long, text string, n_tokens string")
    segments = dac.write_tokens(df, f"{tmp_dir}/t", segment_tokens=50)
    assert segments.count() > 5
    got = dac.document_digests(segments).orderBy("start").collect()
    assert [r.doc_id is None for r in got] == [False] * (len(texts) - 3) + [True] * 3
    ids = [r.doc_id for r in got if r.doc_id is not None]
    assert ids == sorted(ids) and len(got) == len(texts)
    at = 0
    for r in got:
        assert r.start == at
        at += r.n_tokens
    want = sorted((d is None, d or 0, zlib.crc32(np.array([*LIBRARY.encode(t or "", add_special_tokens=False).ids, 0], "<u4").tobytes())) for d, t, _ in texts)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.ids_crc32) for r in got) == want
    ids_of = {r.doc_id: list(r.ids) for r in dac.read_documents(segments).collect()}
    assert LIBRARY.decode(ids_of[94][:-1]) == "long " * 3000
    assert dac.document_digests(dac.write_tokens(df.limit(0))).count() == 0


def test_what_is_remembered_changes_nothing(monkeypatch):
    r = random.Random(8)
    texts = ["".join(r.choice(PARTS) for _ in range(200)).encode() for _ in range(30)]
    want = [LIBRARY.encode(t.decode(), add_special_tokens=False).ids for t in texts]
    for known in (0, 5, 40, 10**6):
        monkeypatch.setattr(dac, "KNOWN_PIECES", known)
        monkeypatch.setattr(dac, "CACHED_WORDS", max(1, known))
        enc = dac.Encoder(PATH)
        for _ in range(3):
            got = [i for at in range(0, 30, 7) for i in enc.encode(texts[at : at + 7])]
            assert [np.frombuffer(x, enc.kind).tolist() for x in got] == want
            assert len(enc.names) <= known
