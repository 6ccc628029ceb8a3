import os
from types import SimpleNamespace

import pytest

from cardweave.storage import folder_in_task, fresh_path, shared_folder, stage, staging


class Session:
    """What :func:`shared_folder` asks of a session."""

    def __init__(self, master, setting=None, folder=None):
        self.conf = SimpleNamespace(get=lambda name, default: setting or default)
        self.sparkContext = self
        self.master = master
        self.folder = folder

    def getCheckpointDir(self):
        return self.folder

    def setCheckpointDir(self, folder):
        self.folder = folder + "/x"


def test_the_setting_of_the_session_is_used():
    assert shared_folder(Session("spark://h:7077", "hdfs://n/shared/", "file:/x")) == "hdfs://n/shared"
    assert shared_folder(Session("spark://h:7077", None, "hdfs://n/shared/1")) == "hdfs://n/shared/1"


def test_a_cluster_without_a_shared_folder_is_refused():
    with pytest.raises(ValueError):
        shared_folder(Session("spark://h:7077"))


def test_a_local_session_gets_one_folder(tmp_path, monkeypatch):
    monkeypatch.setattr("tempfile.tempdir", str(tmp_path))
    session = Session("local[2]")
    folder = shared_folder(session)
    assert folder.startswith(f"file:{tmp_path}/cardweave-")
    assert shared_folder(session) == folder


def test_paths_are_fresh(spark):
    assert fresh_path(spark, "x") != fresh_path(spark, "x")
    assert fresh_path(spark, "x").startswith(shared_folder(spark) + "/x-")


@pytest.fixture
def folder(tmp_path, monkeypatch):
    monkeypatch.setattr("cardweave.storage.shared_folder", lambda spark: f"file:{tmp_path}")
    return tmp_path


def test_staged_rows_are_computed_once(spark, folder):
    from pyspark.sql import functions as F

    df = stage(spark.range(50).withColumn("r", F.rand()), "rows")
    assert sorted(df.collect()) == sorted(df.collect())
    assert df.columns == ["id", "r"]
    assert len(os.listdir(folder)) == 1


def test_staging_cleans_up_even_after_an_error(spark, folder):
    kept = stage(spark.range(3), "kept")
    with pytest.raises(RuntimeError), staging():
        assert stage(spark.range(5), "gone").count() == 5
        assert len(os.listdir(folder)) == 2
        raise RuntimeError
    assert kept.count() == 3
    assert len(os.listdir(folder)) == 1


def test_folders_in_tasks(tmp_path):
    for name in (f"file:{tmp_path}/a b", f"file://{tmp_path}/a b/", f"{tmp_path}/a b"):
        filesystem, path = folder_in_task(name)
        assert path == f"{tmp_path}/a b"
        filesystem.create_dir(path)
    assert os.path.isdir(tmp_path / "a b")
