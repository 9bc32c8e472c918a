"""A table in versions: a rewrite that stops leaves the old version readable."""

import json

import pytest
from pyspark.sql import functions as F
from rows import row

from ledgerline.plans import pipeline
from ledgerline.schema import raw_schema
from ledgerline.sinks import files, versions


def frame(spark, n):
    return spark.range(n).select("id", F.lit("2024-01").alias("order_year_month"))


def test_versions_follow_each_other(spark, tmp_path):
    path = str(tmp_path / "t")
    assert versions.current(spark, path) is None
    with pytest.raises(FileNotFoundError):
        versions.read_current(spark, path)
    assert [versions.write_version(frame(spark, n), path) for n in (3, 5)] == [1, 2]
    assert versions.read_current(spark, path).count() == 5


def test_rewrite_from_itself(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(frame(spark, 4), path)
    old = versions.read_current(spark, path)
    versions.write_version(old.withColumn("id", F.col("id") * 10), path)
    assert sorted(r.id for r in versions.read_current(spark, path).collect()) == [0, 10, 20, 30]
    assert old.count() == 4   # a reader of the old version keeps its files


def test_a_write_that_stops_changes_nothing(spark, tmp_path):
    path = str(tmp_path / "t")
    versions.write_version(frame(spark, 4), path)
    broken = frame(spark, 9).withColumn("id", F.when(F.col("id") == 8, F.raise_error(F.lit("stopped"))).otherwise(F.col("id")))
    with pytest.raises(Exception, match="stopped"):
        versions.write_version(broken, path)
    assert versions.read_current(spark, path).count() == 4
    # files written, the run stopped before or within the commit
    files.write_processed(frame(spark, 7), versions.begin(path))
    (tmp_path / "t" / "manifest" / "000000000002").write_text('{"data": "hal')
    assert versions.read_current(spark, path).count() == 4
    assert versions.write_version(frame(spark, 6), path) == 3
    assert versions.read_current(spark, path).count() == 6


def test_second_writer_of_a_number_fails(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    versions.write_version(frame(spark, 4), path)
    monkeypatch.setattr(versions, "manifests", lambda *_: [])   # both saw no version
    with pytest.raises(Exception, match="already exists"):
        versions.write_version(frame(spark, 5), path)
    monkeypatch.undo()
    assert versions.read_current(spark, path).count() == 4


def test_prune_keeps_the_last(spark, tmp_path):
    path = str(tmp_path / "t")
    for n in range(1, 5):
        versions.write_version(frame(spark, n), path)
    pending = versions.begin(path)
    files.write_processed(frame(spark, 9), pending)
    assert len(versions.prune(spark, path, keep=2)) == 2
    assert [n for n, _ in versions.manifests(spark, path)] == [4, 3]
    assert versions.read_current(spark, path).count() == 4
    assert versions.commit(spark, path, pending) == 5 and versions.read_current(spark, path).count() == 9
    assert versions.prune(spark, path, keep=9) == []
    with pytest.raises(ValueError):
        versions.prune(spark, path, keep=0)


def test_run_with_versions(spark, tmp_path):
    path = str(tmp_path / "processed")
    for n in (2, 3):
        raw = spark.createDataFrame([row(f"T{i}") for i in range(n)], raw_schema())
        res = pipeline.run(spark, raw=raw, processed_path=path, versioned=True)
        assert versions.read_current(spark, path, res.processed.schema).count() == n == res.processed.count()
    [(_, entry), _] = versions.manifests(spark, path)
    assert json.dumps(entry) and entry["rows"] == 3 and res.processed_path.endswith(entry["data"])
