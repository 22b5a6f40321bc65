import zlib
from collections import Counter

import numpy as np

from tessera.llm import feistel
from tessera.llm.queries import op10_feistel

SCHEMA = "doc_id long, text string, hash long, shard string, slot string, row_number string"


def test_permutation_and_its_inverse():
    for n in (1, 2, 3, 5, 16, 17, 1000, 4097):
        p = feistel.permute(np.arange(n), n)
        assert sorted(p.tolist()) == list(range(n))
        assert (feistel.permute(p, n, back=True) == np.arange(n)).all()
    assert (feistel.permute(np.arange(1000), 1000, key=1) != feistel.permute(np.arange(1000), 1000, key=2)).any()
    big = feistel.permute(np.arange(2000), 10**12)
    assert len(set(big.tolist())) == 2000 and 0 <= big.min() and big.max() < 10**12
    assert np.corrcoef(np.arange(5000), feistel.permute(np.arange(5000), 5000))[0, 1] < 0.1


def rows():
    return [(i * 3 % 500, f"t{i}", i, "", "", "") for i in range(700)] + [(None, "n", 10**18 * i, "", "", "") for i in range(-9, 9)] + [(7, "same", 4, "", "", "")] * 6


def test_deal(spark):
    data = rows()
    got = feistel.deal(spark.createDataFrame(data, SCHEMA), "doc_id", "hash").collect()
    again = feistel.deal(spark.createDataFrame(data, SCHEMA).repartition(5), "doc_id", "hash").collect()
    pick = lambda rs: sorted((r.doc_id is None, r.doc_id or 0, r.hash, r.shard, r.slot) for r in rs)
    assert pick(got) == pick(again)
    order = sorted(((d is None, d or 0, h) for d, _, h, *_ in data))
    assert [(r.doc_id is None, r.doc_id or 0, r.hash) for r in sorted(got, key=lambda r: r.row_number)] == order
    n = Counter(r.shard for r in got)
    assert max(n.values()) - min(n.values()) <= 1 and set(n) == set(range(8))
    for s in range(8):
        assert sorted(r.slot for r in got if r.shard == s) == list(range(n[s]))
    for r in got[:50]:
        assert feistel.row_at(r.shard, r.slot, len(data)) == r.row_number


def test_few_rows_and_empty(spark):
    df = spark.createDataFrame(rows(), SCHEMA)
    assert feistel.deal(df.limit(0), "doc_id", "hash").count() == 0
    assert feistel.deal(df.limit(3), "doc_id", "hash").count() == 3
    nulls = feistel.deal(df.where("doc_id is null"), "doc_id", "hash").collect()
    assert sorted(r.row_number for r in nulls) == list(range(18))


def test_query_and_files(spark, tmp_dir):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = {r.doc_id: r for r in op10_feistel(spark, "/root/testdata/sf0.001").collect()}
    for r in docs.collect():
        b = r.text.encode()
        assert (got[r.doc_id].size, got[r.doc_id].text_crc32, got[r.doc_id].law) == (len(b) + 1, zlib.crc32(b), "rows")
        assert got[r.doc_id].grown_shard is None
    feistel.write_shards(docs, f"{tmp_dir}/s", rows_per_file=10)
    back = spark.read.parquet(f"{tmp_dir}/s")
    assert sorted((r.doc_id, r.shard, r.slot, r.text) for r in back.collect()) == sorted((r.doc_id, got[r.doc_id].shard, got[r.doc_id].slot, r.text) for r in docs.collect())
