"""The pipeline's stages, each held against a plain version over its own input."""

import importlib.util
import sys
from collections import Counter

from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline as P
from tessera.llm import bpe, langid, mixing

spec = importlib.util.spec_from_file_location("simhash_brute", __file__.replace("test_llm_pipeline", "test_llm_simhash"))
brute = importlib.util.module_from_spec(spec)
sys.modules["simhash_brute"] = brute
spec.loader.exec_module(brute)

SF = "/root/testdata/sf0.001"
COLS = ["doc_id", "text", "lang", "source", "n_chars"]


def rows_of(df):
    return Counter(tuple(r) for r in df.collect())


def test_stages_equal_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    odd = [(-1, None, "en", "src0", 0), (-2, "", None, None, None), (-3, "12 %", "en", "src1", 4), (None, "the thing that was here", None, None, 3), (None, "the thing that was here", None, None, 3)]
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema))
    kept = P.language_id(spark, docs, SF).cache()
    assert kept.columns == COLS
    model = langid.fit(docs, F.col("lang"), F.col("text"))
    guess = {t: langid.predict_one(t, model) for t in {r.text for r in docs.collect()}}
    assert rows_of(kept) == Counter(tuple(r) for r in docs.collect() if guess[r.text][0] != "und" and guess[r.text][1] >= P.MIN_LANGUAGE_SCORE)
    assert kept.where("doc_id >= 0").count() >= 0.98 * docs.count() - 5  # clean documents stay

    one = P.near_duplicates(spark, kept, SF).cache()
    rows = kept.collect()
    fps, ids = brute.brute_classes([(r.doc_id, r.text) for r in rows])
    assert one.columns == COLS
    assert sorted(r.doc_id for r in one.collect() if r.doc_id is not None) == sorted({i for i in ids if i is not None})
    assert sum(r.doc_id is None for r in one.collect()) == (1 if None in ids else 0)
    assert not rows_of(one) - rows_of(kept)

    mixed = P.source_mix(spark, one, SF).cache()
    want = {(r.doc_id, r.row_key): r for r in mixing.mix(one).collect()}
    got = rows_of(mixed)
    assert mixed.columns == COLS and not set(got) - set(rows_of(one))
    assert sorted(got.values()) == sorted(r.epochs for r in want.values() if r.taken)

    out = P.tokens(spark, mixed, SF).collect()
    library = Tokenizer.from_file(bpe.vocabulary_path())
    texts = {r.doc_id: r.text for r in mixed.collect()}
    assert len(out) == mixed.count()
    for r in out:
        ids = library.encode(texts[r.doc_id], add_special_tokens=False).ids
        assert list(r.ids) == ids and r.n_tokens == len(ids)
        assert r.decoded_sha256 == bpe.sha256(library.decode(ids, skip_special_tokens=False))


def test_empty_tables(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for k, (_, stage) in enumerate(P.STAGES):
        out = stage(spark, docs, SF)
        assert out.count() == 0
        if k < len(P.STAGES) - 1:
            assert out.columns == COLS


def test_run_is_the_stages_in_order(spark):
    out = P.run(spark, SF)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    for _, stage in P.STAGES:
        docs = stage(spark, docs, SF)
    assert sorted((r.doc_id, r.ids_sha256) for r in out.collect()) == sorted((r.doc_id, r.ids_sha256) for r in docs.collect())
