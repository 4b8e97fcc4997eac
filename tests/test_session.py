import pytest

from starloom.session import checkpoint_root, cluster_conf


class _Conf:
    def __init__(self, d):
        self.d = d

    def get(self, k, default=None):
        return self.d.get(k, default)


class _SC:
    def __init__(self, master, ckpt=None):
        self.master, self._ckpt, self.applicationId = master, ckpt, "app-stub"

    def getCheckpointDir(self):
        return self._ckpt


class _Session:
    def __init__(self, conf, master, ckpt=None):
        self.conf, self.sparkContext = _Conf(conf), _SC(master, ckpt)


def test_session_without_checkpoint_dir_is_refused():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session({}, "local[4]"))
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        checkpoint_root(_Session({}, "yarn"))


def test_configured_folder_is_used():
    assert checkpoint_root(_Session({"spark.checkpoint.dir": "hdfs://nn/ckpt/"}, "yarn")) == "hdfs://nn/ckpt"
    assert checkpoint_root(_Session({}, "k8s://x", "s3a://b/ck")) == "s3a://b/ck"


def test_cluster_conf_bounds():
    assert cluster_conf(1 << 20)["spark.sql.shuffle.partitions"] == "200"
    assert cluster_conf(100 << 40)["spark.sql.shuffle.partitions"] == "102400"
    assert cluster_conf(1 << 40)["spark.sql.autoBroadcastJoinThreshold"] == "-1"


def test_reports_unchanged_under_cluster_conf(spark):
    from conftest import SF_SMALL
    from starloom.plans import catalog

    def rows(df):
        return sorted((tuple(r) for r in df.collect()), key=lambda t: tuple(map(str, t)))

    base = rows(catalog.QUERIES["q_spend_by_version"](spark, SF_SMALL))
    conf = cluster_conf(1 << 40)
    conf["spark.sql.shuffle.partitions"] = "64"          # keep the local run small
    old = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        from starloom.plans.warehouse import build
        from starloom.sources import adapter
        from starloom.sources.tables import load_tables

        w = build(adapter.retail_sources(load_tables(spark, SF_SMALL)), adapter.SNAPSHOT_DATE)
        from starloom.plans import reports as R

        assert rows(R.q_spend_by_version(w.sales)) == base
    finally:
        for k, v in old.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
