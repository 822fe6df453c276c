import os

import pytest
from pyspark.sql import functions as F

from lakeloom.operators import clustering, layout
from lakeloom.sources.files import stored_bytes
from tests.conftest import rows_of


def _grid(spark, low, high):
    return spark.range(low, high).select((F.col("id") % 64).alias("a"), F.expr("int(id / 64)").alias("b"), F.col("id"))


def _same_time(path):
    """All files get one modification time, the same millisecond."""
    for name in os.listdir(path):
        os.utime(os.path.join(path, name), (1_600_000_000, 1_600_000_000))


def test_each_file_is_taken_once_whatever_its_time(spark, folder):
    """Twenty arrivals in a row, all files of the same time, a repeated run each time."""
    source, target = folder("source"), folder("target")
    for turn in range(20):
        _grid(spark, 50 * turn, 50 * turn + 50).coalesce(1).write.mode("append").parquet(source)
        _same_time(source)
        assert clustering.cluster_new(spark, source, target, ["a", "b"]) == 1
        if turn % 7 == 0:
            assert clustering.cluster_new(spark, source, target, ["a", "b"]) == 0
    assert rows_of(clustering.read_clustered(spark, target)) == rows_of(_grid(spark, 0, 1000))


def test_a_file_that_lands_during_the_job_is_taken_next(spark, folder, monkeypatch):
    source, target = folder("source"), folder("target")
    _grid(spark, 0, 100).write.parquet(source)
    original = clustering.cluster

    def slow(rows, *args):
        _grid(spark, 100, 130).coalesce(1).write.mode("append").parquet(source)
        return original(rows, *args)

    with monkeypatch.context() as patch:
        patch.setattr(clustering, "cluster", slow)
        clustering.cluster_new(spark, source, target, ["a"])
    assert clustering.read_clustered(spark, target).count() == 100
    assert clustering.cluster_new(spark, source, target, ["a"]) == 1
    assert rows_of(clustering.read_clustered(spark, target)) == rows_of(_grid(spark, 0, 130))


@pytest.mark.parametrize("lost_at", ["cluster", "store_bounds"])
def test_a_run_cut_short_is_done_again(spark, folder, monkeypatch, lost_at):
    source, target = folder("source"), folder("target")
    _grid(spark, 0, 100).write.parquet(source)
    clustering.cluster_new(spark, source, target, ["a"])
    _grid(spark, 100, 160).write.mode("append").parquet(source)

    def lose(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        patch.setattr(clustering, lost_at, lose)
        with pytest.raises(RuntimeError, match="driver lost"):
            clustering.cluster_new(spark, source, target, ["a"])
    assert clustering.read_clustered(spark, target).count() == 100
    _grid(spark, 160, 170).coalesce(1).write.mode("append").parquet(source)
    assert clustering.cluster_new(spark, source, target, ["a"]) == 1
    assert rows_of(clustering.read_clustered(spark, target)) == rows_of(_grid(spark, 0, 170))


def test_names_with_pattern_characters(spark, folder):
    source, target = folder("source[1]{x}"), folder("target")
    _grid(spark, 0, 40).write.parquet(source)
    assert clustering.cluster_new(spark, clustering._literal(source), target, ["a"]) > 0
    assert clustering.read_clustered(spark, target).count() == 40


def test_lookup_opens_matching_files_only(spark, folder):
    source, target = folder("source"), folder("tar get+%41")
    _grid(spark, 0, 4096).write.parquet(source)
    clustering.cluster_new(spark, source, target, ["a", "b"], file_bytes=stored_bytes(spark, source) // 16)
    for ranges, most in (({"a": (20, 20)}, 10), ({"a": (20, 20), "b": (20, 20)}, 4), ({"a": (900, 901)}, 0)):
        rows, opened = clustering.read_matching(spark, target, ranges)
        assert opened <= most and len(rows.inputFiles()) == (opened or len(rows.inputFiles()))
        wanted = _grid(spark, 0, 4096)
        for name, (low, high) in ranges.items():
            wanted = wanted.where(F.col(name).between(low, high))
        assert rows_of(rows) == rows_of(wanted)


def test_compaction_leaves_large_files_alone(spark, folder):
    path = folder("mixed")
    _grid(spark, 0, 50_000).coalesce(1).write.parquet(path)
    large = {name: os.stat(os.path.join(path, name)).st_mtime_ns for name in os.listdir(path) if name.endswith(".parquet")}
    size = stored_bytes(spark, path)
    layout.spread_by(_grid(spark, 50_000, 52_000), 20, "id").write.mode("append").parquet(path)
    done = clustering.compact_small(spark, path, file_bytes=size)
    assert done == (20, 1, 1) and rows_of(spark.read.parquet(path)) == rows_of(_grid(spark, 0, 52_000))
    assert {name: os.stat(os.path.join(path, name)).st_mtime_ns for name in large} == large
    assert clustering.compact_small(spark, path, file_bytes=size) == (0, 0, 2)


@pytest.mark.parametrize("lost_at", ["record", "move"])
def test_driver_lost_within_a_compaction(spark, folder, monkeypatch, lost_at):
    path = folder("small")
    layout.spread_by(_grid(spark, 0, 2000), 10, "id").write.parquet(path)

    def lose(*_):
        raise RuntimeError("driver lost")

    with monkeypatch.context() as patch:
        if lost_at == "record":
            patch.setattr(clustering.json, "dumps", lose)
        else:
            original, calls = clustering.finish_compaction, []
            patch.setattr(clustering, "finish_compaction", lambda *args: lose() if calls.append(1) or len(calls) > 1 else original(*args))
        with pytest.raises(RuntimeError, match="driver lost"):
            clustering.compact_small(spark, path)
    assert rows_of(spark.read.parquet(path)) == rows_of(_grid(spark, 0, 2000))
    clustering.compact_small(spark, path)
    assert rows_of(spark.read.parquet(path)) == rows_of(_grid(spark, 0, 2000))
    assert len([name for name in os.listdir(path) if name.endswith(".parquet")]) == 1


def test_partition_columns_of_the_source_are_kept(spark, folder):
    source, target = folder("source"), folder("target")
    _grid(spark, 0, 128).write.partitionBy("b").parquet(source)
    clustering.cluster_new(spark, source, target, ["a", "b"])
    assert rows_of(clustering.read_clustered(spark, target).select("a", "b", "id")) == rows_of(_grid(spark, 0, 128))


def test_a_sorting_task_is_bounded(spark, folder, monkeypatch):
    """640 MB are clustered by ten sorting tasks."""
    source, target, asked = folder("source"), folder("target"), []
    _grid(spark, 0, 100).coalesce(1).write.parquet(source)
    listing, original = clustering.stored_files, clustering.cluster
    monkeypatch.setattr(clustering, "stored_files", lambda *a: listing(*a).withColumn("length", F.lit(640 << 20).cast("bigint")))

    def noted(rows, folder, columns, files, bits):
        asked.append(files)
        original(rows, folder, columns, files, bits)

    monkeypatch.setattr(clustering, "cluster", noted)
    clustering.cluster_new(spark, source, target, ["a", "b"])
    assert asked == [10] and clustering.read_clustered(spark, target).count() == 100
