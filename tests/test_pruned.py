"""Stored histories dealt out by key ranges: what a merge reads and shuffles."""

import datetime as dt
import json
import os
import random

import pytest
from pyspark.sql import functions as F

from strata.operators.merge import MergeKeys, merge
from strata.plans import jobs, snapshot

KV = MergeKeys(["k"], ["v"])
D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)
SCH = "k long, v string, start_date date, end_date date"


def history(spark, n):
    return spark.range(n).selectExpr("id as k", "sha2(string(id), 256) as v", "date'2024-01-01' as start_date",
                                     "cast(null as date) as end_date")


def base_files(df):
    return {f for f in df.inputFiles() if "/part=base/" in f}


def test_a_batch_in_one_percent_of_the_keys_reads_few_base_files(spark, tmp_root):
    tbl = f"{tmp_root}/t"
    ptr = snapshot.publish(spark, tbl, history(spark, 40_000), fresh=True, cluster=["k"], ranges=200)
    every = base_files(snapshot.open_with_run(spark, tbl, ptr=ptr))
    assert len(every) == 200
    chg = spark.range(20_000, 20_400).selectExpr("id as k", "'new' as v")
    add = spark.range(20_390, 20_400).selectExpr("id as k", "'add' as v")
    ranges = snapshot.touched(spark, tbl, ptr, [add, chg])
    some = base_files(snapshot.open_with_run(spark, tbl, ptr=ptr, ranges=ranges))
    assert some < every and 0 < len(some) < 0.05 * len(every)
    jobs.merge_into(spark, tbl, add, chg, KV, D2)
    got = snapshot.read_history(spark, tbl)
    assert got.count() == 40_400 and got.where("v = 'new' and end_date is null").count() == 400
    assert got.where("end_date = date'2024-03-02'").count() == 400


def test_the_merge_reads_only_touched_ranges(spark, tmp_root):
    """The other ranges' files can even be gone."""
    import shutil
    tbl = f"{tmp_root}/t"
    ptr = snapshot.publish(spark, tbl, history(spark, 2000), fresh=True, cluster=["k"], ranges=20)
    chg = spark.range(1000, 1010).selectExpr("id as k", "'new' as v")
    keep = snapshot.touched(spark, tbl, ptr, [chg])[snapshot.BASE]
    for d in os.listdir(f"{tbl}/data/run=0/part=base"):
        if d.startswith("kr=") and int(d[3:]) not in keep and d != "kr=0":
            shutil.move(f"{tbl}/data/run=0/part=base/{d}", f"{tmp_root}/{d}")
    jobs.merge_into(spark, tbl, None, chg, KV, D2)
    assert snapshot.read_open(spark, tbl).where("v = 'new'").count() == 10


@pytest.mark.parametrize("limit", [None, 0])
def test_pruned_runs_equal_the_plain_merge(spark, tmp_root, limit):
    """Random batches with null and hot keys, closed and reopened versions, a
    compaction between, against the merge of whole DataFrames."""
    rnd = random.Random(7)
    tbl = f"{tmp_root}/t"
    keys = [None, *range(60)] + [5] * 40
    rows = [(rnd.choice(keys), rnd.choice("ab"), D1, None) for _ in range(200)]
    df = spark.createDataFrame(rows, SCH)
    snapshot.publish(spark, tbl, df, fresh=True, cluster=["k"], ranges=16)
    plain = df
    for step in range(4):
        day = D2 + dt.timedelta(days=step)
        some = lambda lo: spark.createDataFrame(
            [(rnd.choice([None, *range(lo, lo + 12), 5]), rnd.choice("abc") if rnd.random() < 0.9 else None)
             for _ in range(15)], "k long, v string")
        add, chg = some(10 * step + 30), some(10 * step)
        jobs.merge_into(spark, tbl, add, chg, KV, day, broadcast_limit=limit)
        plain = spark.createDataFrame(merge(plain, add, chg, as_of=day, keys=["k"], values=["v"]).collect(), SCH)
        if step == 1:
            snapshot.compact(spark, tbl, ranges=16)
        same = lambda d: sorted(map(tuple, d.select("k", "v", "start_date", "end_date").collect()), key=str)
        assert same(snapshot.read_history(spark, tbl)) == same(plain), step


def test_an_interrupted_pointer_hides_nothing(spark, tmp_root):
    tbl = f"{tmp_root}/t"
    snapshot.publish(spark, tbl, history(spark, 10), fresh=True)
    with open(f"{tbl}/_versions/_0123", "w") as f:      # what a writer leaves that dies before the rename
        f.write('{"version": 1')
    assert snapshot.read_history(spark, tbl).count() == 10
    assert snapshot.publish(spark, tbl, history(spark, 11), fresh=True).version == 1
    assert snapshot.read_history(spark, tbl).count() == 11
    with pytest.raises(snapshot.VersionExists):
        snapshot._switch(spark, tbl, snapshot.Pointer(1, 0, 0))
    names = sorted(os.listdir(f"{tbl}/_versions"))
    assert [n for n in names if not n.startswith(".")] == ["_0123", "v0.json", "v1.json"]


def test_what_a_reader_opens_does_not_grow_with_the_runs(spark, tmp_root):
    """Pointers as 200 runs with a compaction after every 10 leave them."""
    tbl = f"{tmp_root}/t"
    snapshot.publish(spark, tbl, history(spark, 50), fresh=True, cluster=["k"], ranges=2)
    most = 0
    for k in range(12):
        chg = spark.createDataFrame([(k, f"run {k}")], "k long, v string")
        ptr = jobs.merge_into(spark, tbl, None, chg, KV, D2, compact_after=4)
        most = max(most, len(ptr.new) + len(ptr.closed))
    assert most <= 8 and ptr.shut is not None
    got = snapshot.read_history(spark, tbl)
    assert got.count() == 62 and got.where("end_date is not null").count() == 12
    before = sorted(map(tuple, got.collect()), key=str)
    gone = snapshot.vacuum(spark, tbl, keep=1, closed=True)
    assert any("part=closed" in g for g in gone) and any("part=ranges" in g for g in gone)
    assert sorted(map(tuple, snapshot.read_history(spark, tbl).collect()), key=str) == before


def test_no_file_system_calls_per_run(spark, tmp_root, monkeypatch):
    tbl = f"{tmp_root}/t"
    snapshot.publish(spark, tbl, history(spark, 50), fresh=True)
    for k in range(5):
        ptr = jobs.merge_into(spark, tbl, None, spark.createDataFrame([(k, "x")], "k long, v string"), KV, D2)
    calls = []
    for name in ("exists", "_names"):
        own = getattr(snapshot, name)
        monkeypatch.setattr(snapshot, name, lambda *a, own=own: calls.append(a[1]) or own(*a))
    assert snapshot.read_history(spark, tbl, ptr=ptr).count() == 55 and calls == []


def test_large_batches_leave_other_versions_out_by_a_semi_join(spark, tmp_root):
    tbl = f"{tmp_root}/t"
    snapshot.publish(spark, tbl, history(spark, 100), fresh=True)
    chg = spark.range(10).selectExpr("id as k", "'new' as v")
    from strata.operators.merge import merge_parts
    rows = snapshot.open_with_run(spark, tbl)
    parts = merge_parts(rows, None, chg, KV, D2, broadcast_limit=0, closed=snapshot.read_closed(spark, tbl),
                        carry={snapshot.RUN: F.lit(None).cast("long")}, changes_only=True)
    plan = parts.closing._jdf.queryExecution().optimizedPlan().toString()
    assert "LeftSemi" in plan
    assert parts.closing.count() == 10 and parts.opened.count() == 10


def test_pointers_name_their_parts(spark, tmp_root):
    tbl = f"{tmp_root}/t"
    snapshot.publish(spark, tbl, history(spark, 5), fresh=True, cluster=["k"], ranges=2)
    with open(f"{tbl}/_versions/v0.json") as f:
        assert json.load(f)["cluster"] == ["k"]
    empty = spark.createDataFrame([], SCH)
    ptr = snapshot.publish(spark, tbl, empty, fresh=True, cluster=["k"], ranges=2)
    assert snapshot.read_history(spark, tbl).count() == 0
    jobs.merge_into(spark, tbl, spark.createDataFrame([(1, "a")], "k long, v string"), None, KV, D2)
    assert snapshot.read_open(spark, tbl).count() == 1 and ptr.base == 1


def test_touched_places_keys_without_a_shuffle_or_a_test_per_range(spark, tmp_root):
    """The same ranges as by comparing each key with each range; the plan does not
    grow with them and shuffles no keys."""
    rnd = random.Random(11)
    for kind, make in (("long", lambda i: i), ("string", lambda i: f"k{i}é")):
        keys = [None] * 5 + [make(rnd.randrange(400)) for _ in range(300)] + [make(7)] * 60
        tbl = f"{tmp_root}/{kind}"
        df = spark.createDataFrame([(k, f"v{i}", D1, None) for i, k in enumerate(keys)], f"k {kind}, v string, start_date date, end_date date")
        ptr = snapshot.publish(spark, tbl, df, fresh=True, cluster=["k"], ranges=40)
        ranges = spark.read.parquet(f"{tbl}/data/run=0/part=ranges").collect()
        for some in ([None], [make(7)], [make(rnd.randrange(450)) for _ in range(4)], [make(-3), None], []):
            want = {r.kr for r in ranges for k in some
                    if (r.nulls > 0 if k is None else r.low is not None and r.low <= k <= r.high)}
            batch = spark.createDataFrame([(k,) for k in some], f"k {kind}")
            assert snapshot.touched(spark, tbl, ptr, [batch])[snapshot.BASE] == want, (kind, some)
    at = snapshot._below(F.array(*[F.lit(2 * i) for i in range(100)]), 100, F.col("id"), True)
    plan = spark.range(300).select(at.alias("i"))
    assert [r.i for r in plan.orderBy("id").collect()] == [min(100, i // 2 + 1) for i in range(300)]
    assert plan._jdf.queryExecution().optimizedPlan().toString().count("CASE WHEN") == 1


def test_ranges_are_cut_from_keys_alone_and_spread_a_hot_key(spark, tmp_root):
    import pathlib
    text = f"{tmp_root}/text"
    rows = [f"{i if i % 2 else 7}|{i}|{'x' * 50}" for i in range(4000)]
    spark.createDataFrame([(r,) for r in rows], "value string").write.text(text)
    df = spark.read.schema("k long, v string, w string").option("sep", "|").csv(text)
    cuts = snapshot._cuts(df, "k", 8)
    assert len(cuts) == 7
    ptr = snapshot.publish(spark, f"{tmp_root}/t", df.selectExpr("*", "date'2024-01-01' as start_date", "cast(null as date) as end_date"),
                           fresh=True, cluster=["k"], ranges=8)
    base = spark.read.parquet(f"{tmp_root}/t/data/run=0/part=base")
    sizes = [r["count"] for r in base.groupBy("kr").count().collect()]
    assert len(sizes) == 8 and max(sizes) < 3 * 4000 / 8
    assert base.where("k = 7").select("kr").distinct().count() >= 3
    hot = spark.createDataFrame([(7,)], "k long")
    assert len(snapshot.touched(spark, f"{tmp_root}/t", ptr, [hot])[snapshot.BASE]) >= 3
    src = pathlib.Path(snapshot.__file__).read_text()
    assert "repartitionByRange" not in src      # it computes whole rows twice, once for a sample


def test_a_stored_version_is_matched_by_one_join_key(spark, tmp_root):
    """Columns compared on their own were two join keys each, 170 of the widest feed."""
    tbl = f"{tmp_root}/t"
    rows = [(1, None, D1, None), (1, "a", D1, None), (2, "b", D1, None), (None, "c", D1, None)]
    snapshot.publish(spark, tbl, spark.createDataFrame(rows, SCH), fresh=True)
    jobs.merge_into(spark, tbl, None, spark.createDataFrame([(1, "b"), (2, "b")], "k long, v string"), KV, D2)
    got = snapshot.open_with_run(spark, tbl)
    assert sorted(map(str, got.select("k", "v").collect())) == sorted(map(str, spark.createDataFrame(
        [(1, None), (1, "b"), (2, "b"), (None, "c")], "k long, v string").collect()))
    assert "coalesce" not in got._jdf.queryExecution().optimizedPlan().toString()
