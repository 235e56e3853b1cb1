"""Session helpers: required settings and the checkpoint folder."""

from dialogprep.session import REQUIRED_CONF, apply_conf, ensure_checkpoint_dir


def test_required_settings_applied(spark):
    apply_conf(spark)
    for key, value in REQUIRED_CONF.items():
        assert spark.conf.get(key) == value


def test_checkpoint_dir_comes_from_the_session(spark):
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    path = ensure_checkpoint_dir(spark)
    assert path
    assert spark.sparkContext.getCheckpointDir()
    if configured:
        # Spark appends a per-application folder below the configured one.
        assert configured.rstrip("/").split(":")[-1] in path


def test_a_cluster_needs_a_shared_checkpoint_folder():
    import pytest

    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

        def getConf(self):
            return {}

    class Conf:
        def get(self, key, default):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(RuntimeError):
        ensure_checkpoint_dir(Session())
