"""Where checkpoints and staged tables go, by the kind of cluster. The master's name stands in for a real cluster."""

import pytest
from pyspark.sql import functions as F

import ledgersieve.session as session
from ledgersieve.operators.ranges import range_split
from ledgersieve.session import new_work_dir, shared_dir, staged_table


@pytest.fixture
def on_cluster(spark, monkeypatch):
    monkeypatch.setattr(spark.sparkContext, "master", "spark://head:7077")
    monkeypatch.setattr(session, "_seen", set())


@pytest.fixture
def named(spark, monkeypatch):
    """Names the folder for checkpoints, which a session cannot change."""
    get = spark.conf.get

    def name(folder):
        monkeypatch.setattr(spark.conf, "get", lambda key, *default: folder if key == "spark.checkpoint.dir" else get(key, *default))

    return name


def test_mounted_folder_serves_a_cluster(spark, on_cluster):
    assert shared_dir(spark) == spark.conf.get("spark.checkpoint.dir")
    staged = staged_table(spark.range(10), "ten")
    assert staged.count() == 10
    split = range_split(spark.range(10), ["id"], 4)
    assert [r.n for r in split.groupBy("partition").agg(F.count("*").alias("n")).orderBy("partition").collect()] == [3, 3, 3, 1]


def test_folder_is_tried_once_and_left_clean(spark, on_cluster, named, tmp_path, monkeypatch):
    tried = []
    is_shared = session._is_shared
    monkeypatch.setattr(session, "_is_shared", lambda *args: tried.append(args[1]) or is_shared(*args))
    named(str(tmp_path))
    assert [shared_dir(spark) for _ in range(2)] == [str(tmp_path)] * 2
    assert tried == [str(tmp_path)]
    assert not list(tmp_path.iterdir())


def test_folder_that_tasks_do_not_share_is_refused(spark, on_cluster, named, tmp_path):
    (tmp_path / "file").write_text("no folder")
    named(str(tmp_path / "file"))
    with pytest.raises(ValueError, match="local to each machine"):
        new_work_dir(spark, "rows")


def test_warehouse_serves_a_cluster_without_a_checkpoint_folder(spark, on_cluster, named, monkeypatch):
    named(None)
    monkeypatch.setattr(spark.sparkContext, "getCheckpointDir", lambda: None)
    monkeypatch.setattr(spark.sparkContext, "setCheckpointDir", lambda folder: None)
    assert shared_dir(spark).startswith(spark.conf.get("spark.sql.warehouse.dir").rstrip("/"))
