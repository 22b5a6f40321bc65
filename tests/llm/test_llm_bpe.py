import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tessera.llm import bpe

PATH = bpe.vocabulary_path()
LIBRARY = Tokenizer.from_file(PATH)
LIBRARY.no_truncation()
LIBRARY.no_padding()
PARTS = ["the", "Thing", "can't", "we'RE", " ", "\t\n", "\x1c", "\x85", "\xa0", " ", "1", "23", "...", "<|endoftext|>", "<|startoftext|>", "<|", "é", "é", "Σας", "ΟΣ", "İ", "日本", "한국", "ß", "²", "Ⅳ", "😀", "​", "_", "\0", ":\U0003d000", "\u0558a", "ʰx", "א1"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PARTS) | st.text(max_size=4), max_size=12))
def test_equals_the_library(parts):
    text = "".join(parts)
    own = bpe.load(PATH).encode(text)
    assert own == LIBRARY.encode(text, add_special_tokens=False).ids
    assert bpe.load(PATH).decode(own) == LIBRARY.decode(own, skip_special_tokens=False)


def test_long_words_use_the_heap_with_the_same_result():
    b = bpe.load(PATH)
    for word in ("abcdefgh" * 30, "the" * 400, "aaaa" * 200, "é日" * 90, "ing" * 32):
        assert b.encode(word) == LIBRARY.encode(word, add_special_tokens=False).ids
    x = [b.first[c] for c in b"internationalisation"]
    assert b.merge(list(x)) == b._merge_long(list(x))


def test_table_and_digests(spark):
    texts = ["Some words, some more.", "", None, "  ", "Some words, some more.", "x" * 5000]
    df = spark.createDataFrame([(i, t, "a") for i, t in enumerate(texts)], "doc_id long, text string, ids string")
    ids = {r.doc_id: list(r.ids) for r in bpe.encode_table(df, ["doc_id"]).collect()}
    back = {r.doc_id: r.text for r in bpe.decode_table(bpe.encode_table(df, ["doc_id"]), ["doc_id"]).collect()}
    for r in bpe.digests(df, ["doc_id"]).collect():
        want = LIBRARY.encode(texts[r.doc_id] or "", add_special_tokens=False).ids
        assert ids[r.doc_id] == want and r.n_tokens == len(want)
        assert r.ids_sha256 == hashlib.sha256(" ".join(map(str, want)).encode()).hexdigest()
        text = LIBRARY.decode(want, skip_special_tokens=False)
        assert back[r.doc_id] == text and r.decoded_sha256 == hashlib.sha256(text.encode()).hexdigest()
    assert bpe.digests(df.limit(0), ["doc_id"]).count() == 0


def test_full_cache_changes_nothing(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_WORDS", 3)
    text = "one two three four five two one six"
    assert bpe.Bpe(PATH).encode(text) == LIBRARY.encode(text, add_special_tokens=False).ids
