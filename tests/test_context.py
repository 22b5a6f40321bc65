import os

from tessera.plans import context as ctx
from tests.conftest import SF


def test_a_changed_folder_is_built_anew(spark, tmp_dir):
    for t in ctx.SOURCES:
        spark.read.parquet(f"{SF}/{t}.parquet").write.parquet(os.path.join(tmp_dir, f"{t}.parquet"))
    first = ctx.text_triples(spark, tmp_dir)
    assert ctx.text_triples(spark, tmp_dir) is first
    spark.read.parquet(f"{SF}/documents.parquet").limit(10).write.mode("overwrite").parquet(os.path.join(tmp_dir, "documents.parquet"))
    again = ctx.text_triples(spark, tmp_dir)
    assert again is not first and again.count() <= 10
