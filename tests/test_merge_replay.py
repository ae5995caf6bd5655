"""The merge against a literal, imperative replay of the three statements in
DuckDB (INSERT ... LEFT JOIN ... IS NULL; UPDATE ... FROM; INSERT ... EXCEPT),
on random trios with null keys, duplicates and one hot key holding about a
third of the rows."""

import datetime as dt
import random
from collections import Counter

import pytest

from strata.operators.merge import merge

S, C, D = dt.date(2024, 1, 1), dt.date(2024, 2, 1), dt.date(2024, 3, 1)
HOT = 1


def _key(rng):
    r = rng.random()
    if r < 0.33:
        return HOT
    if r < 0.40:
        return None
    return rng.randint(2, 9)


def _val(rng):
    return rng.choice(["a", "b", "c", None])


def make_trio(seed):
    rng = random.Random(seed)
    hist = []
    for _ in range(rng.randint(10, 40)):
        closed = rng.random() < 0.3
        hist.append((_key(rng), rng.randint(0, 2), _val(rng), _val(rng), S, C if closed else None))
    add = [(_key(rng), rng.randint(0, 2), _val(rng), _val(rng)) for _ in range(rng.randint(0, 15))]
    chg = [(_key(rng), rng.randint(0, 2), _val(rng), _val(rng)) for _ in range(rng.randint(0, 15))]
    if add and rng.random() < 0.5:
        add += add[:3]               # duplicates inside ADD
    if chg and rng.random() < 0.5:
        chg += chg[:3]               # duplicates inside CHANGE
    return hist, add, chg


def replay(hist, add, chg, null_safe):
    import duckdb
    con = duckdb.connect()
    con.execute("CREATE TABLE main (k BIGINT, k2 BIGINT, v VARCHAR, w VARCHAR, "
                "start_date DATE, end_date DATE)")
    con.execute("CREATE TABLE stg_add (k BIGINT, k2 BIGINT, v VARCHAR, w VARCHAR)")
    con.execute("CREATE TABLE stg_chg (k BIGINT, k2 BIGINT, v VARCHAR, w VARCHAR)")
    if hist:
        con.executemany("INSERT INTO main VALUES (?, ?, ?, ?, ?, ?)", hist)
    if add:
        con.executemany("INSERT INTO stg_add VALUES (?, ?, ?, ?)", add)
    if chg:
        con.executemany("INSERT INTO stg_chg VALUES (?, ?, ?, ?)", chg)
    d = f"DATE '{D.isoformat()}'"
    con.execute(f"""INSERT INTO main
        SELECT a.k, a.k2, a.v, a.w, {d}, NULL FROM stg_add a
        LEFT JOIN main m ON a.k = m.k AND a.k2 = m.k2 WHERE m.k IS NULL""")
    op = "IS DISTINCT FROM" if null_safe else "<>"
    con.execute(f"""UPDATE main SET end_date = {d} FROM stg_chg c
        WHERE c.k = main.k AND c.k2 = main.k2 AND main.end_date IS NULL
          AND (c.v {op} main.v OR c.w {op} main.w)""")
    con.execute(f"""INSERT INTO main SELECT k, k2, v, w, {d}, NULL FROM (
        SELECT k, k2, v, w FROM stg_chg EXCEPT
        SELECT k, k2, v, w FROM main WHERE end_date IS NULL)""")
    return Counter(con.execute("SELECT * FROM main").fetchall())


@pytest.mark.parametrize("seed", range(8))
def test_merge_equals_imperative_replay(spark, seed):
    hist, add, chg = make_trio(seed)
    null_safe = seed % 2 == 1
    h = spark.createDataFrame(hist, "k long, k2 long, v string, w string, start_date date, end_date date")
    a = spark.createDataFrame(add, "k long, k2 long, v string, w string")
    c = spark.createDataFrame(chg, "k long, k2 long, v string, w string")
    want = replay(hist, add, chg, null_safe)
    for limit in (None, 0):   # measured broadcast, and the shuffle-join fallback
        for close_test in ("pairwise", "summary"):
            got = merge(h, a, c, keys=["k", "k2"], values=["v", "w"], as_of=D,
                        null_safe=null_safe, broadcast_limit=limit, close_test=close_test)
            assert Counter(tuple(r) for r in got.collect()) == want, (seed, limit, close_test)
    spark.catalog.clearCache()


@pytest.mark.parametrize("seed", range(6))
def test_one_change_row_per_key_equals_imperative_replay(spark, seed):
    """Keys (null ones too) that occur once in CHANGE, many rows of which equal a version."""
    hist, add, chg = make_trio(100 + seed)
    rng = random.Random(seed)
    chg += [rng.choice(hist)[:4] for _ in range(12)]
    chg = list({r[:2]: r for r in chg}.values())
    h = spark.createDataFrame(hist, "k long, k2 long, v string, w string, start_date date, end_date date")
    a = spark.createDataFrame(add, "k long, k2 long, v string, w string")
    c = spark.createDataFrame(chg, "k long, k2 long, v string, w string")
    want = replay(hist, add, chg, seed % 2 == 1)
    for limit in (None, 0):
        got = merge(h, a, c, keys=["k", "k2"], values=["v", "w"], as_of=D,
                    null_safe=seed % 2 == 1, broadcast_limit=limit)
        assert Counter(tuple(r) for r in got.collect()) == want, (seed, limit)


def test_wide_rows_are_not_hashed_whole(spark):
    """Beyond the broadcast limit, CHANGE with one row per key meets the versions by keys alone."""
    h = spark.createDataFrame([(1, 1, "a", "b", S, None)],
                              "k long, k2 long, v string, w string, start_date date, end_date date")
    c = spark.createDataFrame([(1, 1, "a", "b"), (2, 1, "a", None)], "k long, k2 long, v string, w string")
    from strata.operators.merge import MergeKeys, merge_parts
    new = merge_parts(h, None, c, MergeKeys(["k", "k2"], ["v", "w"]), D, broadcast_limit=0).inserted
    plan = new._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct" not in "".join(x for x in plan.splitlines() if "Join" in x)
    assert [(r.k, r.v) for r in new.collect()] == [(2, "a")]
