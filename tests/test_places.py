"""Closed versions of a stored history are told by their places."""

import contextlib
import io

from pyspark.sql import functions as F

from strata.operators.merge import MergeKeys, merge
from strata.plans import jobs, snapshot

COLS = "k string, v string, w int"
HISTORY = COLS + ", start_date date, end_date date"
MK = MergeKeys(["k"], ["v", "w"])


def _plan(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


def _rows(df):
    return sorted(map(str, df.select("k", "v", "w", "start_date", "end_date").collect()))


def _inputs(spark):
    old = [(f"k{i}", "a" if i % 3 else None, i) for i in range(300)] + [("k7", "a", 7), ("k7", "z", 8), (None, "n", 1)]
    history = spark.createDataFrame(old, COLS).selectExpr("*", "date'2024-01-01' as start_date", "cast(null as date) as end_date")
    add = spark.createDataFrame([("k1", "x", 1), ("n1", "x", 1), ("n1", "x", 1), ("n2", "y", 2), (None, "n", 1)], COLS)
    change = spark.createDataFrame([(f"k{i}", "b", i) for i in range(0, 300, 4)] + [("k7", "a", 7), ("n1", "x", 2), (None, "n", 1)], COLS)
    return history, add, change


def test_merged_history_reads_the_same_by_places(spark, tmp_root):
    history, add, change = _inputs(spark)
    root = f"{tmp_root}/data/table"      # a folder above is named data, too
    snapshot.publish(spark, root, history, None, fresh=True, cluster=("k",), ranges=3)
    want = history
    for day, a, c in (("2024-02-01", add, change), ("2024-03-01", change, add)):
        want = spark.createDataFrame(merge(want, a, c, keys=MK.keys, values=MK.values, as_of=day).collect(), HISTORY)
        jobs.merge_into(spark, root, a, c, MK, day, broadcast_limit=0)
        assert _rows(snapshot.read_history(spark, root)) == _rows(want)
    snapshot.compact(spark, root)
    assert _rows(snapshot.read_history(spark, root)) == _rows(want)


def test_reading_shuffles_and_sorts_no_wide_row(spark, tmp_root):
    """Closed versions too many to broadcast were joined on all columns."""
    history, add, change = _inputs(spark)
    snapshot.publish(spark, tmp_root, history, None, fresh=True, cluster=("k",))
    ptr = jobs.merge_into(spark, tmp_root, add, change, MK, "2024-02-01", broadcast_limit=0)
    assert ptr.new and ptr.closed
    spark.conf.set("strata.broadcast.maxBytes", "1")
    try:
        plan = _plan(snapshot.read_open(spark, tmp_root))
    finally:
        spark.conf.unset("strata.broadcast.maxBytes")
    assert "SortMergeJoin" not in plan and "Sort " not in plan


def test_closed_parts_without_places_are_matched_whole(spark, tmp_root):
    history, _, _ = _inputs(spark)
    ptr = snapshot.publish(spark, tmp_root, history, None, fresh=True, cluster=("k",))
    closing = history.where("w % 2 = 0").withColumn("end_date", F.lit("2024-02-01").cast("date")).withColumn(
        snapshot.RUN, F.lit(ptr.version).cast("long"))
    opened = history.where("w = 3").withColumn("k", F.lit("o"))
    both = opened.withColumn("end_date", F.lit("2024-02-01").cast("date")).withColumn(snapshot.RUN, F.lit(None).cast("long"))
    snapshot.publish_delta(spark, tmp_root, opened, closing.unionByName(both), ptr)
    want = history.where("w % 2 <> 0").unionByName(closing.drop(snapshot.RUN)).unionByName(both.drop(snapshot.RUN))
    assert _rows(snapshot.read_history(spark, tmp_root)) == _rows(want)


def test_places_hold_every_row_of_large_files(spark, tmp_root):
    spark.range(20000, numPartitions=2).selectExpr("id", "cast(id as string) f").write.parquet(tmp_root + "/t")
    rows = spark.read.parquet(tmp_root + "/t").select(
        "id", F.col("_metadata.file_path").alias(snapshot.FILE), F.col("_metadata.row_index").alias(snapshot.ROW))
    found = snapshot.places(rows.where("id % 3 = 0 or id between 5000 and 9500"))
    hit = [r.id for r in snapshot.at_places(rows, found, "left_semi").collect()]
    assert sorted(hit) == [i for i in range(20000) if i % 3 == 0 or 5000 <= i <= 9500]
    assert snapshot.at_places(rows, found, "left_anti").count() == 20000 - len(hit)
