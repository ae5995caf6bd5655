import os

from pyspark.sql import functions as F

from strata.operators.typed import lower_rename, typed
from strata.sources.delimited import land_lines, read_delimited, read_feed, read_feed_files
from strata.specs import FEEDS, make_spec

SPEC = make_spec("lines", """
mdr_report_key nvarchar(50) key
text nvarchar(max)
d nvarchar(10)
""")

LINES = [
    ('1|plain|x', ("1", "plain", "x", None, None)),
    ('2|"quo|ted"|x', ("2", "quo|ted", "x", None, None)),
    ('3|he said "hi"|x', ("3", 'he said "hi"', "x", None, None)),
    ('4|short', ("4", "short", None, None, None)),
    ('5|a|b|extra|more', ("5", "a", "b", "extra", "more")),
    ('|nokey|x', (None, "nokey", "x", None, None)),
    ('6|"open quote|x', ("6", "open quote|x", None, None, None)),
    ('7|next|x', ("7", "next", "x", None, None)),
]


def test_fixture_lines(spark, tmp_root):
    path = os.path.join(tmp_root, "feed")
    lines = spark.createDataFrame([(l,) for l, _ in LINES], "line string")
    land_lines(lines, path, "MDR_REPORT_KEY|TEXT|D")
    raw = read_feed_files(spark, path, SPEC)
    got = sorted((tuple(r) for r in raw.collect()), key=repr)
    assert got == sorted((e for _, e in LINES), key=repr)
    # the key filter drops the key-less line; surplus fields never reach the result
    t = typed(raw, SPEC, as_of="2024-03-01").collect()
    assert len(t) == len(LINES) - 1
    assert all(r.start_date.isoformat() == "2024-03-01" and r.end_date is None for r in t)


def test_quote_off(spark, tmp_root):
    path = os.path.join(tmp_root, "feed")
    lines = spark.createDataFrame([('6|"open quote|x',)], "line string")
    land_lines(lines, path, "K|T|D")
    r = read_delimited(spark, path, SPEC.raw_schema(), quote="").first()
    assert (r[0], r[1], r[2]) == ("6", '"open quote', "x")


def test_feed_folder_pruning(spark, tmp_root):
    spec = FEEDS["patient"]
    rows = [("1|1|01/02/2020|t|o", "FUL"), ("2|1|01/02/2020|t|o", "add"),
            ("3|x|bad|t|o", "change")]
    df = spark.createDataFrame([(l, spec.name, k) for l, k in rows], "line string, feed string, load string")
    land_lines(df, tmp_root, "|".join(spec.names), partition_by=("feed", "load"))
    add = read_feed(spark, tmp_root, spec, "add")
    assert [r.mdr_report_key for r in add.collect()] == ["2"]
    assert add.inputFiles() and all("/feed=patient/load=add/" in f for f in add.inputFiles())
    assert read_feed(spark, tmp_root, FEEDS["foitext_text"], "add").count() == 0
    chg = typed(read_feed(spark, tmp_root, spec, "change"), spec).first()
    assert chg.patient_sequence_number is None and chg.date_received is None


def test_lower_rename(spark):
    spec = FEEDS["foitext_text"]
    df = spark.createDataFrame([("1", "x")], "MDR_REPORT_KEY string, FOI_TEXT string")
    assert lower_rename(df, spec).columns == ["mdr_report_key", "text"]


def test_feed_specs():
    assert [len(FEEDS[n].columns) for n in ("foidev_device", "foitext_text", "mdrfoi_event",
                                            "patient")] == [31, 6, 82, 5]
    assert FEEDS["mdrfoi_event"].keys == ["mdr_report_key", "event_key"]
    assert FEEDS["patient"].column("patient_sequence_number").kind == "int"
    assert FEEDS["mdrfoi_event"].column("date_facility_aware").drop_time
    assert FEEDS["foidev_device"].column("udi-di").width == 200


def test_hyphen_columns_typed(spark):
    spec = FEEDS["foidev_device"]
    raw = spark.createDataFrame([tuple(["k"] + [None] * 29 + ["u"])],
                                ", ".join(f"`{n}` string" for n in spec.names))
    r = typed(raw, spec).first()
    assert r["udi-public"] == "u"
    assert F is not None


def test_declared_widths_enforced_by_table(spark, tmp_root):
    """A target created from the spec's DDL (VARCHAR(n) columns) rejects an
    over-long value on insert, as the declared nvarchar(n) target does."""
    import pytest
    spec = make_spec("w", """
k nvarchar(5) key
d date
""")
    spark.sql("DROP TABLE IF EXISTS width_target")
    spark.sql(f"CREATE TABLE width_target ({spec.ddl()}) USING parquet LOCATION '{tmp_root}/wt'")
    spark.sql("INSERT INTO width_target VALUES ('abc', DATE'2024-01-01', NULL, NULL)")
    with pytest.raises(Exception, match="(?i)length|limit"):
        spark.sql("INSERT INTO width_target VALUES ('abcdefgh', NULL, NULL, NULL)")
    assert spark.table("width_target").count() == 1
    spark.sql("DROP TABLE width_target")


def test_latin1_feed_file(spark, tmp_root):
    path = os.path.join(tmp_root, "raw")
    os.makedirs(path)
    with open(os.path.join(path, "f.txt"), "wb") as fh:
        fh.write("K|T|D\n1|Müller café|x\n".encode("latin-1"))
    r = read_feed_files(spark, path, SPEC, encoding="ISO-8859-1").first()
    assert r.text == "Müller café"


def test_lines_land_byte_for_byte(spark, tmp_root):
    import glob
    texts = ["  4|5..", "trailing \t ", "", '"quoted" |"', "a\x01b\x00c", "x\r", "é ", "﻿bom", "line"]
    path = os.path.join(tmp_root, "exact")
    df = spark.createDataFrame([(t, k) for k in "ab" for t in texts * 3], "line string, k string").coalesce(1)
    land_lines(df, path, "H|é", partition_by=("k",))
    for k in "ab":
        name, = glob.glob(f"{path}/k={k}/part-*")
        with open(name, "rb") as f:
            assert f.read() == "".join(x + "\n" for x in ["H|é", *texts * 3]).encode()
    many = os.path.join(tmp_root, "many")
    land_lines(df.repartition(3), many, "H")
    names = glob.glob(f"{many}/part-*")
    assert len(names) > 1 and all(open(n, "rb").read().startswith(b"H\n") for n in names)


def test_a_landed_archive_equals_its_member(spark, tmp_root):
    import glob
    import zipfile

    from strata.plans import jobs
    body = b"H1|H2\r\n  4|5..\r\n\r\n\n\t x \n\"q|\x01\nlast\n"
    arch, landing = f"{tmp_root}/arch", f"{tmp_root}/landing"
    os.makedirs(arch)
    with zipfile.ZipFile(f"{arch}/patient.zip", "w") as zf:
        zf.writestr("patient.txt", body)
    with zipfile.ZipFile(f"{arch}/patientAdd.zip", "w") as zf:
        zf.writestr("a.txt", b"A\n1\n2")
        zf.writestr("b.txt", b"B\n3\n")
    for _ in range(2):
        jobs.land_archives(spark, arch, landing)
        name, = glob.glob(f"{landing}/feed=patient/load=FUL/archive=patient.zip/part-*")
        assert open(name, "rb").read() == body
        name, = glob.glob(f"{landing}/feed=patient/load=add/archive=patientAdd.zip/part-*")
        assert open(name, "rb").read() == b"A\n1\n2\n3\n"


def test_whole_folders_land_without_python_or_a_sort_and_compressed(spark, tmp_root):
    import glob
    import gzip
    df = spark.range(100, numPartitions=3).selectExpr("concat(id, '|é ') as line", "id")
    land_lines(df.where("id % 7 <> 0"), tmp_root + "/z", "H|T", compression="gzip")
    names = glob.glob(f"{tmp_root}/z/part-*.gz")
    text = [gzip.open(n, "rb").read().decode().splitlines() for n in names]
    assert len(names) == 3 and all(t[0] == "H|T" and t.count("H|T") == 1 for t in text)
    assert sorted(x for t in text for x in t[1:]) == sorted(f"{i}|é " for i in range(100) if i % 7)


def test_wide_layouts_land_small(spark, tmp_root):
    """Landed text of a layout was the larger part of what a run wrote."""
    import glob
    import gzip
    import os

    from strata.plans import feedfiles as FF
    from strata.specs import FEEDS
    spark.range(3000).selectExpr("id as event_id", "timestamp'2024-01-01 00:00:01' as ts", "id % 50 as user_id", "'view' as event_type",
                                 "1.5D as value", "'{\"k\": 7}' as props").write.parquet(f"{tmp_root}/sf/events.parquet")
    spec = FEEDS["mdrfoi_event"]
    root = FF.land_layout_from_events(spark, f"{tmp_root}/sf", spec, f"{tmp_root}/landing", incremental=True)
    names = glob.glob(f"{root}/feed={spec.name}/load=*/part-*")
    whole = sum(len(gzip.open(n).read()) for n in names)
    assert sum(map(os.path.getsize, names)) * 4 < whole
    assert [read_feed(spark, root, spec, load).count() for load in ("FUL", "add", "change")] == [3000, 600, 750]
