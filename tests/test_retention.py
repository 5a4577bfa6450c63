"""What is removed from table and staging folders, and what is not."""

import time

from pyspark.sql import functions as F

from stratamart.operators import monitor
from stratamart.plans import medallion
from stratamart.sources import sinks
from verification.registry import Tables


def versions(folder):
    return sorted(p.name for p in folder.iterdir() if p.name.startswith("version-"))


def test_old_versions_go_after_their_age(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in (1, 2, 3, 4):
        sinks.replace(spark.range(n), path)
    assert sinks.collect_garbage(spark, path) == [] and len(versions(tmp_path / "t")) == 4
    assert len(sinks.collect_garbage(spark, path, keep=2, min_age=0)) == 2
    assert sinks.collect_garbage(spark, path, keep=2, min_age=0) == []
    assert sinks.read(spark, path).count() == 4
    sinks.replace(spark.range(5), path)
    assert len(sinks.collect_garbage(spark, path, keep=1, min_age=0)) == 2
    assert sinks.read(spark, path).count() == 5


def test_a_slow_reader_is_not_cut_off(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(spark.range(1), path)
    with sinks.reading(spark, path) as df:
        for n in (2, 3):
            sinks.replace(spark.range(n), path)
        assert len(sinks.collect_garbage(spark, path, keep=1, min_age=0)) == 1
        assert df.count() == 1
    assert len(sinks.collect_garbage(spark, path, keep=1, min_age=0)) == 1
    assert len(versions(tmp_path / "t")) == 1 and sinks.read(spark, path).count() == 3


def test_a_lease_runs_out(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.replace(spark.range(1), path)
    with sinks.reading(spark, path, seconds=-5):
        sinks.replace(spark.range(2), path)
        assert len(sinks.collect_garbage(spark, path, keep=1, min_age=0)) == 1


def test_uncommitted_folders_go_when_abandoned(spark, tmp_path):
    path = str(tmp_path / "t")
    sinks.write_version(spark.range(1), path)
    assert sinks.collect_garbage(spark, path, min_age=0) == []
    assert len(sinks.collect_garbage(spark, path, abandoned_after=0)) == 1
    version = sinks.write_version(spark.range(2), path)
    sinks.commit(spark, path, version)
    assert sinks.collect_garbage(spark, path, keep=1, min_age=0, abandoned_after=0) == []
    assert sinks.read(spark, path).count() == 2
    assert sinks.collect_garbage(spark, str(tmp_path / "absent")) == []


def test_staged_tables_go_with_age(spark):
    staged = sinks.stage(spark.range(3), "aged")
    assert staged.count() == 3
    assert not any(name.startswith("aged") for name in sinks.remove_staged(spark))
    time.sleep(0.1)
    kept = sinks.entries(spark, f"{spark.conf.get('spark.checkpoint.dir')}/{sinks.STAGED}")
    assert any(name.startswith("aged") for name in kept)


def test_a_run_removes_what_earlier_runs_left(spark, tmp_path, monkeypatch):
    bronze = Tables(spark, "/root/testdata/sf0.001").bronze()
    out, log_path = tmp_path / "tables", str(tmp_path / "log")
    removed = []
    monkeypatch.setattr(sinks, "collect_garbage", lambda spark, path: removed.append(path))
    published = medallion.run(spark, bronze, str(out), log_path)
    assert sorted(removed) == sorted(f"{out}/{name}" for name in published)
    assert monitor.read_log(spark, log_path).where(F.col("log_date").isNull()).isEmpty()
