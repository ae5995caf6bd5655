import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from strata.functions.dates import DATE_FORMATS
from strata.functions import (file_stem, landing_key, link_kept, load_filter, load_folder,
                              member_name, parse_date, parse_date_drop_time, route_load,
                              route_table, text_to_int, url_basename)

DATE_CASES = [
    ("03/04/2020", dt.date(2020, 3, 4), dt.date(2020, 3, 4)),
    ("25/12/2020", dt.date(2020, 12, 25), dt.date(2020, 12, 25)),
    ("2020/12/25", dt.date(2020, 12, 25), dt.date(2020, 12, 25)),
    ("12/25/2020 10:00:00", None, dt.date(2020, 12, 25)),
    ("1/5/2020", None, None),
    ("02/30/2020", None, None),
    ("2020-01-01", None, None),
    ("", None, None),
    (None, None, None),
]


@pytest.mark.parametrize("ansi", [True, False])
def test_dates(spark, ansi):
    spark.conf.set("spark.sql.ansi.enabled", str(ansi).lower())
    try:
        df = spark.createDataFrame([(r,) for r, _, _ in DATE_CASES], "raw string")
        got = df.select("raw", parse_date("raw").alias("p"),
                        parse_date_drop_time("raw").alias("q")).collect()
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert [(r.raw, r.p, r.q) for r in got] == DATE_CASES


INT_CASES = ["12", " 7 ", "1.0", "1.9", "123456789", "99999999999", "abc", "", None, ".5",
             "-.5", ".", "-", "+3", "-1.9", "1.x", "2147483647", "2147483648", "-2147483648",
             "\t5\n", "1.", "+", "0012", " - 3", "3 4", "1e3", "１２"]


@pytest.mark.parametrize("ansi", [True, False])
def test_ints_match_non_ansi_cast(spark, ansi):
    """Ground truth is Spark's own cast with ANSI off."""
    df = spark.createDataFrame([(v,) for v in INT_CASES], "raw string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        expected = [r[0] for r in df.select(F.col("raw").cast("int")).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", str(ansi).lower())
    try:
        got = [r[0] for r in df.select(text_to_int("raw")).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    assert got == expected


def test_ints_property(spark):
    """Random strings over digits, signs, dots and blanks: equal to the
    ANSI-off cast."""
    import random
    rnd = random.Random(63)
    vals = ["".join(rnd.choice(" 0123456789+-.\tx") for _ in range(rnd.randint(0, 12))) for _ in range(2000)]
    df = spark.createDataFrame([(v,) for v in vals], "raw string")
    spark.conf.set("spark.sql.ansi.enabled", "false")
    try:
        expected = [r[0] for r in df.select(F.col("raw").cast("int")).collect()]
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")
    got = [r[0] for r in df.select(text_to_int("raw")).collect()]
    assert got == expected and any(v is not None for v in got)


ROUTING = [  # file, link kept, feed, load after the .txt rename
    ("mdrfoi.zip", True, "mdrfoi_event", "FUL"),
    ("mdrfoiAdd.zip", True, "mdrfoi_event", "add"),
    ("patientchange.zip", True, "patient", "change"),
    ("foidev2020.zip", True, "foidev_device", "FUL"),
    ("foitextadd.zip", True, "foitext_text", "add"),
    ("foidevproblem.zip", False, "foidev_device", "FUL"),
    ("misc.zip", True, "notfound", "FUL"),
    ("MDRFOI.zip", True, "notfound", "FUL"),
]


def test_routing(spark):
    df = spark.createDataFrame([(r[0],) for r in ROUTING], "name string")
    got = df.select("name", link_kept("name").alias("kept"), route_table("name").alias("feed"),
                    route_load(member_name("name")).alias("load")).collect()
    assert [(r.name, r.kept, r.feed, r.load) for r in got] == ROUTING


def test_names_and_keys(spark):
    df = spark.createDataFrame([("https://h.example/f/mdrfoiAdd.zip",)], "url string")
    r = df.select(url_basename("url").alias("b")).select(
        "b", file_stem("b").alias("s"), member_name("b").alias("m"),
        load_filter("b", "FUL").alias("full"), load_filter("b", "INC").alias("inc"),
        landing_key("landing/", route_table("b"), load_folder(route_load(member_name("b"))),
                    member_name("b")).alias("k")).first()
    assert (r.b, r.s, r.m, r.full, r.inc) == ("mdrfoiAdd.zip", "mdrfoiAdd", "mdrfoiAdd.txt",
                                              False, True)
    assert r.k == "landing/mdrfoi_event/INC/add/mdrfoiAdd.txt"


def test_width_enforcement(spark):
    from strata.operators.checks import enforce_widths, width_report
    df = spark.createDataFrame([("abc", "x"), ("abcdef", None)], "a string, b string")
    rep = {r.col: (r.rows_over, r.max_len) for r in width_report(df, [("a", 4), ("b", 1)]).collect()}
    assert rep == {"a": (1, 6), "b": (0, 1)}
    assert [r.a for r in enforce_widths(df, {"a": 4}, "null").collect()] == ["abc", None]
    assert [r.width_ok for r in enforce_widths(df, {"a": 4}, "flag").collect()] == [True, False]
    with pytest.raises(Exception):
        enforce_widths(df, {"a": 4}, "fail").collect()


def test_dates_of_another_shape_are_not_tried(spark):
    """Same dates as by trying every format on every text; a plan tries a format
    only where the text has its shape."""
    texts = ["12/25/2020", "25/12/2020", "2020/12/25", "03/04/2020", "2/3/2020", "02/30/2020", "30/02/2020", "31/04/2020",
             "13/13/2020", "2020/13/01", "2020/01/32", "unknown", "", " 12/25/2020", "12/25/2020 ", "12/25/20", "12-25-2020",
             "-2020/12/25", "+12020/12/25", "12/25/-0044", "12/25/12020", "12/25/+12020", "0000/01/01", "12/25/2020\n", "١٢/25/2020", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)).cast("date") for f in DATE_FORMATS])
    bad = df.select("t", parse_date("t").cast("string").alias("a"), plain.cast("string").alias("b")).where("not (a <=> b)")
    assert bad.collect() == []
    plan = df.select(parse_date("t").alias("d"))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("RLIKE") == len(DATE_FORMATS)
    assert "RLIKE" not in df.select(parse_date("t", ("MMM d, yyyy",)).alias("d"))._jdf.queryExecution().optimizedPlan().toString()
