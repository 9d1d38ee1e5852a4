from types import SimpleNamespace

import pytest

from tripmart import session


def cluster(master, folder=None):
    """What checkpoint_dir asks of a session, without a cluster."""
    unset = SimpleNamespace(isDefined=lambda: False)
    made = []
    context = SimpleNamespace(
        master=master, getConf=lambda: {"spark.checkpoint.dir": folder} if folder else {}, _jsc=SimpleNamespace(
            sc=lambda: SimpleNamespace(getCheckpointDir=lambda: unset)
        ), setCheckpointDir=made.append
    )
    return SimpleNamespace(sparkContext=context), made


def test_a_cluster_names_its_folder():
    spark, made = cluster("spark://host:7077", "s3a://bucket/shared")
    assert session.checkpoint_dir(spark) == "s3a://bucket/shared" and made == ["s3a://bucket/shared"]
    with pytest.raises(session.NoSharedFolder):
        session.checkpoint_dir(cluster("yarn")[0])
    spark, made = cluster("local[4]")
    assert session.checkpoint_dir(spark) == made[0]


def test_the_master_of_a_submitted_job_stands(monkeypatch):
    monkeypatch.setenv("PYSPARK_SUBMIT_ARGS", "--master yarn --deploy-mode client pyspark-shell")
    assert session._submitted_master() == "yarn"
    monkeypatch.delenv("PYSPARK_SUBMIT_ARGS")
    assert session._submitted_master() is None
