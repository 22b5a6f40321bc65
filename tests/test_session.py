import pytest

from tessera import session


def test_materialize_round_trip(spark):
    root = session.checkpoint_root(spark)
    assert root
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    out = session.materialize(df, "roundtrip")
    assert sorted(tuple(r) for r in out.collect()) == [(1, "a"), (2, "b")]
    def norm(p):
        return p.split(":", 1)[-1].lstrip("/")

    assert all(norm(f).startswith(norm(root)) for f in out.inputFiles())


def test_cluster_without_shared_folder_is_refused(monkeypatch):
    class FakeConf:
        def get(self, key, default=None):
            return default

    class FakeContext:
        master = "spark://cluster:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return FakeConf()

    class FakeSession:
        sparkContext = FakeContext()
        conf = FakeConf()

    with pytest.raises(RuntimeError):
        session.checkpoint_root(FakeSession())
