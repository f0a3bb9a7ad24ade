import pytest

from tracemill import session


class Fake:
    """A session with a master and no settings."""

    def __init__(self, master):
        self.master, self.conf, self.sparkContext, self.held = master, self, self, {}

    def getConf(self):
        return {}

    def get(self, key, default=None):
        return self.held.get(key, default)

    def set(self, key, value):
        self.held[key] = value


def test_a_cluster_needs_a_shared_folder():
    for master in ("yarn", "spark://host:7077", "k8s://host", "local-cluster[3,2,1000]"):
        with pytest.raises(ValueError):
            session.shared_dir(Fake(master))
    own = Fake("local[4]")
    assert session.shared_dir(own) == session.shared_dir(own)


def test_scratch_removes_only_its_own_copies(spark, tmp_path):
    df = spark.range(10)
    outer = session.materialize(df, "outer")
    with session.scratch(spark):
        inner = session.materialize(df, "inner")
        assert inner.count() == 10
    assert outer.count() == 10
    with pytest.raises(Exception):
        inner.count()


def test_spread_moves_small_tables_only(spark, tmp_path, monkeypatch):
    spark.range(100).coalesce(1).write.parquet(f"{tmp_path}/t")
    df = spark.read.parquet(f"{tmp_path}/t")
    assert session.spread(df).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(session, "SPREAD_BYTES", 10)
    assert session.spread(df).rdd.getNumPartitions() == 1
