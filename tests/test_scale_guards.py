"""Guards for the scale rules: no pair-emitting joins in merge plans, and no
driver-side row handling or machine-local lineage cuts in the library."""

import datetime as dt
import pathlib
import re

import pytest

from strata.operators.merge import MergeKeys, merge_parts

PKG = pathlib.Path(__file__).resolve().parents[1] / "strata"
S, D = dt.date(2024, 1, 1), dt.date(2024, 3, 1)


@pytest.mark.parametrize("close_test", ["pairwise", "summary"])
@pytest.mark.parametrize("limit", [None, 0])
def test_merge_plans_have_no_pair_joins(spark, limit, close_test):
    h = spark.createDataFrame([(1, "a", S, None), (2, "b", S, None)],
                              "k long, v string, start_date date, end_date date")
    b = spark.createDataFrame([(1, "x"), (3, "y")], "k long, v string")
    p = merge_parts(h, b, b, MergeKeys(["k"], ["v"]), D, broadcast_limit=limit,
                    close_test=close_test)
    plan = p.result()._jdf.queryExecution().executedPlan().toString()
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_library_source_rules():
    # the corpus subpackage has guards of its own
    src = {p: p.read_text() for p in PKG.rglob("*.py") if "llm" not in p.relative_to(PKG).parts}
    for p, text in src.items():
        assert "localCheckpoint" not in text, p
        assert "crossJoin" not in text, p
        if p.name != "merge.py":     # there: the CHANGE rows of a key, bounded by measure
            assert "collect_list" not in text and "collect_set" not in text, p
        # no loops over collected rows: results reach the driver only as
        # single measured rows or pointers
        assert not re.search(r"for \w+ in [^\n]*\.collect\(\)", text), p
        assert ".toPandas()" not in text, p
