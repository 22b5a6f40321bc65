"""Inputs whose further columns have the names that operators use, and types without an order."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tessera.llm import feistel, mixing, simhash
from tessera.llm.common import fresh_names

SF = "/root/testdata/sf0.001"
NAMES = [
    "__key", "__own", "__text", "__start", "__bucket", "__in", "KEY", "own", "low", "row", "epochs", "n", "turn", "copy", "bucket", "start",
    "permuted", "hash", "part", "language", "score", "lang_pred", "found", "input", "fp", "root", "row_key", "component_id", "a.b", "c`d",
]


def documents(spark, n=120):
    docs = spark.read.parquet(f"{SF}/documents.parquet").orderBy("doc_id").limit(n)
    docs = docs.unionByName(docs.where("doc_id % 5 = 0"))  # repeated rows
    extra = {name: F.concat(F.lit(f"{k}:"), "doc_id") for k, name in enumerate(NAMES)}
    extra["m"] = F.create_map(F.col("source"), F.rand(3))
    return docs.withColumns(extra).cache()


def plain(df):
    return Counter(tuple(tuple(sorted(x.items())) if isinstance(x, dict) else x for x in r) for r in df.collect())


def test_fresh_names(spark):
    df = spark.createDataFrame([(1, 2)], "key int, `Own` int")
    assert fresh_names(df, "key", "own", "new", "new") == ["key_", "own_", "new", "new_"]


@pytest.mark.parametrize("stage", range(3))
def test_stages_keep_every_column(spark, stage):
    docs = documents(spark)
    out = P.STAGES[stage][1](spark, docs, SF)
    assert out.columns == docs.columns
    rows, before = plain(out), plain(docs)
    assert rows and not set(rows) - set(before)
    slim = P.STAGES[stage][1](spark, docs.select("doc_id", "text", "lang", "source", "n_chars"), SF)
    assert Counter(r.doc_id for r in out.collect()) == Counter(r.doc_id for r in slim.collect())


def test_one_of_each_and_mixed(spark):
    docs = documents(spark)
    one = simhash.one_of_each(docs)
    assert one.columns == docs.columns and not plain(one) - plain(docs)
    assert Counter(r.doc_id for r in one.collect()).most_common(1)[0][1] == 1
    mixed = mixing.mixed(docs)
    assert mixed.columns == docs.columns and not set(plain(mixed)) - set(plain(docs))
    taken = mixing.mix(docs).where("taken > 0").agg(F.sum("epochs")).first()[0]
    assert mixed.count() == taken


def test_rows_are_numbered_and_dealt(spark, tmp_dir):
    docs = documents(spark).drop("a.b", "c`d").withColumn("h", F.xxhash64("text"))
    numbered = feistel.number_rows(docs, "doc_id", "h")
    assert numbered.columns == [*docs.columns, "row_number"]
    assert sorted(r.row_number for r in numbered.collect()) == list(range(docs.count()))
    dealt = feistel.deal(docs, "doc_id", "h")
    assert dealt.columns == [*docs.columns, "row_number", "shard", "slot"]
    assert not plain(dealt.select(docs.columns)) - plain(docs)
    feistel.write_shards(docs.drop("m"), f"{tmp_dir}/s")
    back = spark.read.parquet(f"{tmp_dir}/s")
    assert set(back.columns) >= {*docs.columns, "shard", "slot"} - {"m"} and back.count() == docs.count()
