"""Incremental runs: any sequence of batches equals one run over all files."""

import random

from ledgerline.plans import pipeline
from ledgerline.schema import RAW_COLUMNS
from ledgerline.sinks import versions
from ledgerline.streaming import incremental

GOOD = "{id},C{c},P1,{cat},Mumbai,S1,{q},10.50,0.1000,18.90,UPI,2024-0{m}-10,2024-01-12"


def some_lines(rng, n):
    out = []
    for _ in range(n):
        line = GOOD.format(id=rng.choice(["", *[f"T{k}" for k in range(40)]]), c=rng.randint(1, 5), cat=rng.choice(["Toys & Games", "x", ""]),
                           q=rng.choice([1, -2, "#REF!"]), m=rng.choice([1, 2, 0]))
        out.append(rng.choice([line, line, line, line + ",more", line.rpartition(",")[0]]))
    return out


def put(folder, name, lines):
    folder.mkdir(exist_ok=True)
    (folder / name).write_text("\n".join([",".join(RAW_COLUMNS), *lines]) + "\n")


def report(res):
    return ({k: v.collect() for k, v in res.reports.items()}, sorted(res.processed.collect(), key=str))


def test_batches_equal_one_run(spark, tmp_path):
    rng, arrived, root = random.Random(3), tmp_path / "in", str(tmp_path / "state")
    for day in range(2):
        for part in range(2):
            put(arrived, f"{day}-{part}.csv", some_lines(rng, 60))
        res = incremental.run_new(spark, str(arrived), root, max_files=1, processed_path=str(tmp_path / "table"), versioned=True)
        whole = pipeline.run(spark, csv_path=str(arrived), processed_path=str(tmp_path / f"whole{day}"))
        assert report(res) == report(whole)
        assert res.ingest_counts == whole.ingest_counts
        assert versions.read_current(spark, str(tmp_path / "table")).count() == whole.processed.count()
    # nothing new: nothing is parsed, the result is the same
    batches = sorted(p.name for p in (tmp_path / "state" / "staged").iterdir())
    again = incremental.run_new(spark, str(arrived), root)
    assert report(again) == report(whole)
    assert sorted(p.name for p in (tmp_path / "state" / "staged").iterdir()) == batches and len(batches) == 4


def test_a_batch_that_failed_is_taken_again(spark, tmp_path, monkeypatch):
    import pytest
    arrived, root = tmp_path / "in", str(tmp_path / "state")
    put(arrived, "a.csv", some_lines(random.Random(1), 50))
    incremental.run_new(spark, str(arrived), root)
    put(arrived, "b.csv", some_lines(random.Random(2), 50))
    real = incremental.csv_ingest.write_staged

    def broken(parsed, path, *args, **kwargs):
        real(parsed.limit(3), path, *args, **kwargs)   # part of the batch is written, then the driver is gone
        raise OSError("stopped")
    monkeypatch.setattr(incremental.csv_ingest, "write_staged", broken)
    with pytest.raises(Exception, match="stopped"):
        incremental.ingest_new(spark, str(arrived), root)
    monkeypatch.undo()
    res = incremental.run_new(spark, str(arrived), root)
    assert report(res) == report(pipeline.run(spark, csv_path=str(arrived), processed_path=str(tmp_path / "p")))


def test_no_rows(spark, tmp_path):
    put(tmp_path / "in", "a.csv", [])
    res = incremental.run_new(spark, str(tmp_path / "in"), str(tmp_path / "state"))
    assert res.processed.count() == 0 and res.ingest_counts["total_records"] == 0


def test_no_state_store(spark, tmp_path):
    """Micro-batches are reduced by themselves; no executor holds all ids, none is committed a partition at a time."""
    for name in ("a", "b"):
        put(tmp_path / "in", f"{name}.csv", some_lines(random.Random(7), 40))
    incremental.run_new(spark, str(tmp_path / "in"), str(tmp_path / "state"), max_files=1)
    assert not [p for p in (tmp_path / "state" / "checkpoints").iterdir() if (p / "state").exists()]
