"""Malformed lines, run logs, versioned runs and the hash order."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from medlattice import schema as S
from medlattice.operators import split
from medlattice.sources import files, results
from medlattice.streaming import patient_stream as streams
from medlattice.streaming import run_log

HEADER = ",".join(S.STREAM.names)
GOOD = "1,50,Male,25.0,120,90,180,7,Low,Light,Vegan,Never,1"
LINES = [HEADER, GOOD, GOOD.replace("25.0", "heavy"), GOOD + ",more", "1,50,Male", GOOD.replace(",120,", ",,"), "x", GOOD.replace("1,50", "é,50")]


@pytest.fixture
def folder(tmp_path):
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / "in" / f"{i}.csv").write_text("\n".join(LINES) + "\n")
    return tmp_path


def test_good_and_bad_lines_are_all_lines(spark, folder):
    order = S.STREAM.names
    good, bad = files.read_patients_csv_checked(spark, str(folder / "in"), S.STREAM)
    assert good.columns == order and good.count() + bad.count() == 3 * (len(LINES) - 1)
    assert sorted(r["line"] for r in bad.collect()) == sorted(3 * [LINES[2], LINES[3], LINES[4], LINES[6]])
    assert bad.select("file").distinct().count() == 3
    # an empty cell is a missing value, not a bad line
    assert good.where("bp_systolic IS NULL").count() == 3


def test_stream_quarantine_and_log(spark, folder):
    log = run_log.BatchLog(spark).start()
    try:
        log.wait(streams.score_stream(spark, str(folder / "in"), str(folder / "out"), str(folder / "ck"), quarantine=True))
        log.wait(streams.score_stream(spark, str(folder / "in"), str(folder / "out"), str(folder / "ck"), quarantine=True))
    finally:
        log.stop()
    out = spark.read.parquet(str(folder / "out"))
    bad = out.where("verdict = 'malformed'")
    assert out.count() == 3 * (len(LINES) - 1) and bad.count() == 12
    assert {r[0] for r in bad.select(files.BAD_LINE).collect()} == {LINES[2], LINES[3], LINES[4], LINES[6]}
    # one file a batch; the second run found nothing new
    rows = log.table().collect()
    assert len(rows) == 3 and sum(r["rows"] for r in rows) == out.count() and all(r["seconds"] > 0 for r in rows)


def test_fit_log(spark):
    log, rows = run_log.FitLog(spark), spark.range(7)
    with log.fit("works", rows):
        pass
    with pytest.raises(ZeroDivisionError), log.fit("fails", rows):
        1 / 0
    assert [(r["name"], r["rows"], r["failed"]) for r in log.table().collect()] == [("works", 7, False), ("fails", 7, True)]


def test_last_complete_run_is_read(spark, tmp_path):
    root = str(tmp_path / "runs")
    with pytest.raises(FileNotFoundError):
        results.last_run(spark, root)
    table = spark.createDataFrame([("disease", "SVM", 0.5, 0.4, 0.3, 0.2, 1.0, None, None, 11)], S.MODEL_RESULTS)
    metadata = results.run_metadata(spark.range(8), spark.range(2), 12, "SVM", "2000-01-01 00:00:00")
    document = results.nested_document(table, metadata=metadata)
    assert [results.write_run(document, metadata, root) for _ in range(3)] == [1, 2, 3]
    # stopped after the document; and with a manifest that was not committed
    results.write_document(document, f"{root}/run-000010-a/document")
    (tmp_path / "runs" / "run-000011-b" / "manifest").mkdir(parents=True)
    path, stored = results.last_run(spark, root)
    assert "run-000003-" in path and stored.first()["total_samples"] == 10
    assert results.read_metadata(spark, path).first().asDict() == {"train_samples": 8, "test_samples": 2, "total_samples": 10, "features": 12, "timestamp": "2000-01-01 00:00:00"}
    assert results.read_nested(spark, path).count() == 1


def test_hash_order_takes_one_exchange_and_any_partitions(spark):
    keys = spark.range(5000).select(F.col("id").alias("patient_id"))
    keys = keys.unionByName(keys.limit(50))
    one, many = (split.rank_by_hash(keys.repartition(n)).groupBy("patient_id").agg(F.sort_array(F.collect_list("position")).alias("p")) for n in (1, 13))
    assert one.exceptAll(many).count() == 0 and many.exceptAll(one).count() == 0
    assert sorted(r[0] for r in split.rank_by_hash(keys).select("position").collect()) == list(range(1, 5051))
    # reading the positions moves no rows: only the ranges' sizes are exchanged
    plan = split.rank_by_hash(keys)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" not in plan and "rangepartitioning" not in plan


def test_a_file_without_rows_is_no_batch(spark):
    """Where the first split of the patients' file holds no row group, its CSV file holds a header alone."""
    from medlattice.plans import queries

    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
    try:
        found = [tuple(r) for r in queries.queries()["stream_batches"](spark, "/root/testdata/sf0.01").collect()]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert len(found) == 1 and found[0][0] is True and found[0][1] > 0
