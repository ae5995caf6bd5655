import datetime as dt
from collections import Counter

import pytest

from strata.operators.merge import MergeKeys, merge, merge_parts

S, C, D = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
SCHEMA = "k long, v string, w string, start_date date, end_date date"
BATCH = "k long, v string, w string"
MK = MergeKeys(["k"], ["v", "w"])


def frames(spark):
    h = spark.createDataFrame([(1, "a", None, S, None), (2, "b", "x", S, None),
                               (3, "c", "y", S, None), (7, "g", "g", S, C)], SCHEMA)
    add = spark.createDataFrame([(2, "zz", "zz"), (5, "e", "e"), (5, "e", "e"), (7, "h", "h")], BATCH)
    chg = spark.createDataFrame([(1, "a", "new"), (2, "B", "x"), (2, "B", "x"), (3, "c", "y"),
                                 (4, "n", "n"), (7, "g", "g")], BATCH)
    return h, add, chg


EXPECTED = Counter([
    (1, "a", None, S, None), (1, "a", "new", D, None), (2, "b", "x", S, D), (2, "B", "x", D, None),
    (3, "c", "y", S, None), (4, "n", "n", D, None), (5, "e", "e", D, None), (5, "e", "e", D, None),
    (7, "g", "g", S, C), (7, "g", "g", D, None),
])


@pytest.mark.parametrize("close_test", ["auto", "pairwise", "summary"])
@pytest.mark.parametrize("limit", [None, 0])
def test_fixture_merge(spark, limit, close_test):
    """limit=0 forces the shuffle-join fallback; same answer either way, and
    with either close test."""
    h, add, chg = frames(spark)
    out = merge(h, add, chg, keys=MK.keys, values=MK.values, as_of=D, broadcast_limit=limit,
                close_test=close_test)
    assert Counter(tuple(r) for r in out.collect()) == EXPECTED


@pytest.mark.parametrize("close_test", ["pairwise", "summary"])
def test_fixture_merge_null_safe(spark, close_test):
    h, add, chg = frames(spark)
    out = merge(h, add, chg, keys=MK.keys, values=MK.values, as_of=D, null_safe=True,
                close_test=close_test)
    exp = EXPECTED.copy()
    exp[(1, "a", None, S, None)] -= 1
    exp[(1, "a", None, S, D)] += 1
    assert Counter(tuple(r) for r in out.collect()) == +exp


def test_null_key_add_inserts_every_run(spark):
    sch = "k long, k2 long, v string, start_date date, end_date date"
    h = spark.createDataFrame([(1, 1, "a", S, None)], sch)
    add = spark.createDataFrame([(1, None, "n"), (1, 1, "dup")], "k long, k2 long, v string")
    mk = MergeKeys(["k", "k2"], ["v"])
    once = merge(h, add, None, keys=mk.keys, values=mk.values, as_of=D)
    twice = merge(once, add, None, keys=mk.keys, values=mk.values, as_of=D)
    rows = Counter(tuple(r) for r in twice.collect())
    assert rows[(1, None, "n", D, None)] == 2
    assert rows[(1, 1, "dup", D, None)] == 0


def test_properties(spark):
    h, add, chg = frames(spark)
    p = merge_parts(h, add, chg, MK, D)
    out = p.result().collect()
    assert len(out) == h.count() + p.added.count() + p.inserted.count()
    # closed versions never change
    closed_before = Counter(tuple(r) for r in h.filter("end_date IS NOT NULL").collect())
    after = Counter(tuple(r) for r in out)
    assert all(after[r] >= c for r, c in closed_before.items())
    # a second run of the same ADD inserts nothing for non-null keys
    again = merge(p.result(), add, None, keys=MK.keys, values=MK.values, as_of=D)
    assert again.count() == len(out)


def test_unique_keys_null_safe_one_open_version(spark):
    h = spark.createDataFrame([(k, "a", None if k % 2 else "b", S, None) for k in range(20)], SCHEMA)
    chg = spark.createDataFrame([(k, "a", "c") for k in range(0, 20, 3)], BATCH)
    out = merge(h, None, chg, keys=["k"], values=["v", "w"], as_of=D, null_safe=True)
    open_per_key = Counter(r.k for r in out.filter("end_date IS NULL").collect())
    assert set(open_per_key.values()) == {1}


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_plan_streams_history_through_broadcasts(spark):
    h, add, chg = frames(spark)
    p = merge_parts(h, add, chg, MK, D)
    plan = _plan(p.result())
    for kind in ("LeftOuter", "LeftAnti", "LeftSemi"):
        assert kind in plan
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    # the versions themselves (the bulk) never meet a shuffle
    assert "SortMergeJoin" not in _plan(p.updated)


def test_plan_fallback_is_shuffle_join(spark):
    h, add, chg = frames(spark)
    p = merge_parts(h, add, chg, MK, D, broadcast_limit=0)
    assert "SortMergeJoin" in _plan(p.updated) or "ShuffledHashJoin" in _plan(p.updated)


def test_stored_history_is_streamed_three_times_and_nothing_is_persisted(spark, tmp_root):
    """Open versions: keys for ADD, the close pass, the rows equal to CHANGE."""
    from strata.plans import snapshot
    h, add, chg = frames(spark)
    snapshot.publish(spark, tmp_root, *snapshot.split_open(h), fresh=True)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    p = merge_parts(snapshot.read_open(spark, tmp_root), add, chg, MK, D,
                    closed=snapshot.read_closed(spark, tmp_root))
    scans = lambda df: _plan(df).count("FileScan parquet")
    # updated: closed rows, both parts' keys for ADD, one pass over the open rows;
    # inserted: another pass over the open rows, and ADD's check again
    assert scans(p.updated) == 4 and scans(p.inserted) == 3
    assert Counter(map(tuple, p.result().collect())) == Counter(map(tuple, merge(
        h, add, chg, keys=MK.keys, values=MK.values, as_of=D).collect()))
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == before


def test_measured_size_of_wide_rows(spark):
    """The measure of sparse 82-column rows against their real bytes."""
    from pyspark.sql import functions as F
    from strata.plans.sizing import measure
    from strata.specs import FEEDS
    spec = FEEDS["mdrfoi_event"]
    rows = [tuple(None if i % 5 else ("v" * 9 if c.kind == "string" else None)
                  for i, c in enumerate(spec.columns)) for _ in range(2000)]
    df = spark.createDataFrame(rows, spec.typed_schema(with_tech=False))
    n, measured = measure(df)
    rdd = df._jdf.queryExecution().toRdd()
    sizes = rdd.toJavaRDD().collect()
    first = sizes[0]
    assert n == 2000 and abs(measured / n - first.getSizeInBytes()) <= 0.2 * first.getSizeInBytes()


def test_conflicting_changes_flip_on_rerun(spark):
    """Two CHANGE rows for one key both open; an identical second run closes
    each by the other and reopens both."""
    D2 = dt.date(2024, 3, 2)
    h = spark.createDataFrame([(1, "x", "x", S, None)], SCHEMA)
    chg = spark.createDataFrame([(1, "a", "a"), (1, "b", "b")], BATCH)
    r1 = merge(h, None, chg, keys=["k"], values=["v", "w"], as_of=D)
    assert Counter(tuple(r) for r in r1.collect()) == Counter(
        [(1, "x", "x", S, D), (1, "a", "a", D, None), (1, "b", "b", D, None)])
    r2 = merge(r1, None, chg, keys=["k"], values=["v", "w"], as_of=D2)
    assert Counter(tuple(r) for r in r2.collect()) == Counter(
        [(1, "x", "x", S, D), (1, "a", "a", D, D2), (1, "b", "b", D, D2),
         (1, "a", "a", D2, None), (1, "b", "b", D2, None)])


def test_same_day_add_then_change(spark):
    """Added and changed in one run: start_date = end_date."""
    h = spark.createDataFrame([(1, "x", "x", S, None)], SCHEMA)
    add = spark.createDataFrame([(9, "n", "n")], BATCH)
    chg = spark.createDataFrame([(9, "n", "m")], BATCH)
    out = Counter(tuple(r) for r in merge(h, add, chg, keys=["k"], values=["v", "w"],
                                          as_of=D).collect())
    assert out[(9, "n", "n", D, D)] == 1 and out[(9, "n", "m", D, None)] == 1


@pytest.mark.parametrize("close_test", ["pairwise", "summary"])
@pytest.mark.parametrize("limit", [None, 0])
def test_collation_opt_in(spark, limit, close_test):
    """Case- and trailing-blank-insensitive comparisons on request."""
    h = spark.createDataFrame([(1, "a", "x", S, None), (2, "B ", "y", S, None)], SCHEMA)
    chg = spark.createDataFrame([(1, "A", "x"), (2, "b", "y"), (3, "n", "n")], BATCH)
    out = merge(h, None, chg, keys=["k"], values=["v", "w"], as_of=D,
                collation="UTF8_LCASE_RTRIM", broadcast_limit=limit, close_test=close_test)
    assert dict(out.dtypes)["v"] == "string"
    assert Counter(tuple(r) for r in out.collect()) == Counter(
        [(1, "a", "x", S, None), (2, "B ", "y", S, None), (3, "n", "n", D, None)])
    binary = merge(h, None, chg, keys=["k"], values=["v", "w"], as_of=D)
    assert binary.filter("end_date IS NOT NULL").count() == 2


def test_auto_picks_summary_for_a_hot_change_key(spark):
    """More CHANGE rows on one key than PAIRWISE_MAX: the summary join is
    planned (no theta join), with the same result as the pairwise test."""
    from strata.operators.merge import PAIRWISE_MAX
    h = spark.createDataFrame([(1, "a", "x", S, None), (2, "b", "y", S, None)], SCHEMA)
    chg = spark.createDataFrame([(1, "a", f"x{i % 3}") for i in range(PAIRWISE_MAX + 5)]
                                + [(2, "b", "y")], BATCH)
    auto = merge_parts(h, None, chg, MK, D)
    plan = _plan(auto.result())
    assert "LeftOuter" in plan
    want = Counter(tuple(r) for r in merge(h, None, chg, keys=MK.keys, values=MK.values, as_of=D,
                                           close_test="pairwise").collect())
    assert Counter(tuple(r) for r in auto.result().collect()) == want
