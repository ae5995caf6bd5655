import datetime as dt

from strata.operators.merge import MergeKeys
from strata.plans import jobs, snapshot
from strata.sources.delimited import land_lines
from strata.specs import FEEDS
from strata.streaming.feed_stream import merge_batch

SPEC = FEEDS["patient"]
D1, D2 = dt.date(2024, 3, 1), dt.date(2024, 3, 2)


def land(spark, root, rows):
    df = spark.createDataFrame([(l, SPEC.name, k) for l, k in rows],
                               "line string, feed string, load string")
    land_lines(df, root, "|".join(c.upper() for c in SPEC.names), partition_by=("feed", "load"),
               mode="append")


def test_feed_run_full_then_incremental(spark, tmp_root):
    landing, tbl = f"{tmp_root}/landing", f"{tmp_root}/patient"
    land(spark, landing, [("1|1|01/02/2020|t|o", "FUL"), ("2|1|01/02/2020|t|o", "FUL"),
                          ("|1|01/02/2020|t|o", "FUL"),
                          ("3|1|01/03/2020|t|o", "add"), ("1|1|01/02/2020|t|NEW", "change")])
    ptr = jobs.run_feed(spark, landing, tbl, SPEC, D1, full=True)
    assert ptr.version == 1
    h = {(r.mdr_report_key, r.sequence_number_outcome, r.end_date)
         for r in snapshot.read_history(spark, tbl).collect()}
    assert h == {("1", "o", D1), ("1", "NEW", None), ("2", "o", None), ("3", "o", None)}
    # a FULL reload drops all history
    jobs.full_load(spark, landing, SPEC, tbl, D2)
    h2 = snapshot.read_history(spark, tbl).collect()
    assert len(h2) == 2 and all(r.start_date == D2 and r.end_date is None for r in h2)


def test_stream_batch_replay_is_skipped(spark, tmp_root):
    tbl = f"{tmp_root}/t"
    base = spark.createDataFrame([("1", 1, None, "t", "o", D1, None)],
                                 "mdr_report_key string, patient_sequence_number int, "
                                 "date_received date, sequence_number_treatment string, "
                                 "sequence_number_outcome string, start_date date, end_date date")
    snapshot.publish(spark, tbl, base, None, fresh=True)
    raw_cols = ", ".join(f"`{n}` string" for n in SPEC.names) + \
        ", start_date string, end_date string, feed string, load string"
    batch = spark.createDataFrame([("1", "1", None, "t", "X", None, None, SPEC.name, "change")],
                                  raw_cols)
    run = merge_batch(spark, tbl, SPEC, D2)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "stream-a")
    run(batch, 0)
    first = sorted((tuple(r) for r in snapshot.read_history(spark, tbl).collect()), key=repr)
    run(batch, 0)   # replay after a restart: no second version
    again = sorted((tuple(r) for r in snapshot.read_history(spark, tbl).collect()), key=repr)
    assert first == again and len(first) == 2
    assert snapshot.current(spark, tbl).batch_id == 0
    # another stream's batch of the same number is not the same batch
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", "stream-b")
    more = spark.createDataFrame([("7", "1", None, "t", "o", None, None, SPEC.name, "add")], raw_cols)
    merge_batch(spark, tbl, SPEC, lambda batch_id: D2)(more, 0)
    spark.sparkContext.setLocalProperty("sql.streaming.queryId", None)
    assert snapshot.read_history(spark, tbl).count() == 3
    assert snapshot.current(spark, tbl).stream_id == "stream-b"
    assert MergeKeys.of(SPEC).keys == ["mdr_report_key", "patient_sequence_number"]


def test_archives_to_typed_history(spark, tmp_root):
    """Published archives -> routed landing -> typed FULL load of a real feed."""
    import io
    import os
    import zipfile
    arch = os.path.join(tmp_root, "arch")
    os.makedirs(arch)
    header = "|".join(c.upper() for c in SPEC.names)
    for name, body in {"patient.zip": ["1|1|01/02/2020|t|o", "2|x|2020/01/03|t|o"],
                       "patientAdd.zip": ["3|2|25/12/2020|t|o"],
                       "misc.zip": ["junk"]}.items():
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr(name.replace(".zip", ".txt"), "\n".join([header] + body) + "\n")
        with open(os.path.join(arch, name), "wb") as fh:
            fh.write(buf.getvalue())
    landing = os.path.join(tmp_root, "landing")
    jobs.land_archives(spark, arch, landing)
    loads = sorted((r.feed, r.load) for r in spark.read.text(landing)
                   .select("feed", "load").distinct().collect())
    assert loads == [("notfound", "FUL"), ("patient", "FUL"), ("patient", "add")]
    full = jobs.typed_batch(spark, landing, SPEC, "FUL", D1).collect()
    assert sorted((r.mdr_report_key, r.patient_sequence_number, str(r.date_received))
                  for r in full) == [("1", 1, "2020-01-02"), ("2", None, "2020-01-03")]
    add = jobs.typed_batch(spark, landing, SPEC, "add", D1).first()
    assert str(add.date_received) == "2020-12-25"


def test_cli_land_and_load(spark, tmp_root):
    """The command line over archives: land, FULL load, then an INC run."""
    import io
    import os
    import zipfile

    from strata.cli import main
    arch = os.path.join(tmp_root, "arch")
    os.makedirs(arch)
    header = "|".join(c.upper() for c in SPEC.names)
    for name, body in {"patient.zip": ["1|1|01/02/2020|t|o", "2|1|01/02/2020|t|o"],
                       "patientchange.zip": ["1|1|01/02/2020|t|NEW"]}.items():
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            zf.writestr(name.replace(".zip", ".txt"), "\n".join([header] + body) + "\n")
        with open(os.path.join(arch, name), "wb") as fh:
            fh.write(buf.getvalue())
    landing, tables = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "tables")
    assert main(["land", "--archives", arch, "--landing", landing]) == 0
    assert main(["load", "--landing", landing, "--tables", tables, "--load-type", "FUL",
                 "--as-of", "2024-03-01", "--feeds", "patient"]) == 0
    rows = {(r.mdr_report_key, r.sequence_number_outcome, r.end_date)
            for r in snapshot.read_history(spark, f"{tables}/patient").collect()}
    assert rows == {("1", "o", D1), ("1", "NEW", None), ("2", "o", None)}


def test_vacuum_keeps_current_history(spark, tmp_root):
    from strata.operators.merge import MergeKeys
    tbl = f"{tmp_root}/v"
    sch = "k long, v string, start_date date, end_date date"
    snapshot.publish(spark, tbl, spark.createDataFrame([(1, "a", D1, None)], sch), fresh=True)
    chg = spark.createDataFrame([(1, "b")], "k long, v string")
    jobs.merge_into(spark, tbl, None, chg, MergeKeys(["k"], ["v"]), D2)
    jobs.merge_into(spark, tbl, None, spark.createDataFrame([(1, "c")], "k long, v string"),
                    MergeKeys(["k"], ["v"]), dt.date(2024, 3, 3))
    before = sorted(tuple(r) for r in snapshot.read_history(spark, tbl).collect())
    assert snapshot.vacuum(spark, tbl, keep=1) == []      # the base is still read
    snapshot.compact(spark, tbl)
    gone = snapshot.vacuum(spark, tbl, keep=1)
    assert len(gone) == 3
    after = sorted(tuple(r) for r in snapshot.read_history(spark, tbl).collect())
    assert before == after and len(after) == 3


def test_stream_one_file_per_batch(spark, tmp_root):
    """Files landed at different times are folded in as successive
    micro-batches, each publishing one version."""
    import time

    from strata.streaming import start_merge_stream
    landing, tbl = f"{tmp_root}/landing", f"{tmp_root}/t"
    land(spark, landing, [("1|1|01/02/2020|t|o", "FUL")])
    jobs.full_load(spark, landing, SPEC, tbl, D1)
    land(spark, landing, [("2|1|01/02/2020|t|o", "add")])
    time.sleep(1.1)
    land(spark, landing, [("1|1|01/02/2020|t|X", "change")])
    q = start_merge_stream(spark, landing, SPEC, tbl, D2, max_files_per_trigger=1,
                           checkpoint=f"{tmp_root}/ckpt")
    q.awaitTermination()
    ptr = snapshot.current(spark, tbl)
    # micro-batch 0 held only the FULL file (skipped); 1 = ADD, 2 = CHANGE
    assert ptr.version == 2 and ptr.batch_id == 2
    rows = {(r.mdr_report_key, r.sequence_number_outcome, r.end_date)
            for r in snapshot.read_history(spark, tbl).collect()}
    assert rows == {("1", "o", D2), ("1", "X", None), ("2", "o", None)}


def test_feed_run_with_staging_tables(spark, tmp_root):
    """Staging tables are written, merged from, and dropped after the merge."""
    import os
    landing, tbl, stg = f"{tmp_root}/landing", f"{tmp_root}/p", f"{tmp_root}/staging"
    land(spark, landing, [("1|1|01/02/2020|t|o", "FUL"), ("2|1|01/02/2020|t|o", "add"),
                          ("1|1|01/02/2020|t|NEW", "change")])
    jobs.run_feed(spark, landing, tbl, SPEC, D1, full=True, staging_root=stg)
    rows = {(r.mdr_report_key, r.sequence_number_outcome, r.end_date)
            for r in snapshot.read_history(spark, tbl).collect()}
    assert rows == {("1", "o", D1), ("1", "NEW", None), ("2", "o", None)}
    assert not any(os.path.exists(p) for p in jobs.staging_paths(stg, SPEC))


SCH = "k long, v string, start_date date, end_date date"
KV = MergeKeys(["k"], ["v"])


def test_unreadable_pointer_is_an_error_and_nothing_is_overwritten(spark, tmp_root):
    import os

    import pytest
    tbl = f"{tmp_root}/p"
    rows = spark.createDataFrame([(1, "a", D1, None)], SCH)
    snapshot.publish(spark, tbl, rows, spark.createDataFrame([(0, "z", D1, D1)], SCH), fresh=True)
    with open(os.path.join(tbl, "_versions", "v1.json"), "w") as fh:
        fh.write("{not json")
    with pytest.raises(RuntimeError, match="unreadable"):
        snapshot.publish(spark, tbl, rows, fresh=True)
    assert sorted(os.listdir(os.path.join(tbl, "data"))) == ["run=0"]
    # what a failed run left behind is neither read nor written over
    os.replace(os.path.join(tbl, "_versions", "v1.json"), os.path.join(tmp_root, "bad"))
    os.makedirs(os.path.join(tbl, "data", "run=1", "part=closed"))
    assert snapshot.read_history(spark, tbl).count() == 2
    assert snapshot.publish(spark, tbl, rows).version == 2
    assert snapshot.read_history(spark, tbl).count() == 2


def test_second_writer_of_a_version_fails(spark, tmp_root):
    import pytest
    tbl = f"{tmp_root}/w"
    rows = spark.createDataFrame([(1, "a", D1, None)], SCH)
    ptr = snapshot.publish(spark, tbl, rows, fresh=True)
    opened = spark.createDataFrame([(2, "b", D2, None)], SCH)
    none = opened.limit(0).selectExpr("*", "cast(null as long) as __run")
    snapshot.publish_delta(spark, tbl, opened, none, ptr)
    with pytest.raises(snapshot.VersionExists):
        snapshot.publish_delta(spark, tbl, opened, none, ptr)
    with pytest.raises(snapshot.VersionExists):
        snapshot._switch(spark, tbl, snapshot.Pointer(1, 0, 0))
    assert snapshot.read_history(spark, tbl).count() == 2


def test_small_batch_writes_little_and_compaction_keeps_the_history(spark, tmp_root):
    import os
    tbl = f"{tmp_root}/d"
    rows = spark.range(20000).selectExpr("id as k", "sha2(string(id), 256) as v",
                                         "date'2024-01-01' as start_date", "cast(null as date) as end_date")
    snapshot.publish(spark, tbl, rows, fresh=True)

    def size(run):
        return sum(os.path.getsize(os.path.join(d, f)) for d, _, fs in os.walk(f"{tbl}/data/run={run}") for f in fs)

    chg = spark.range(0, 20000, 100).selectExpr("id as k", "'new' as v")
    add = spark.range(20000, 20100).selectExpr("id as k", "'add' as v")
    ptr = jobs.merge_into(spark, tbl, add, chg, KV, D2)
    assert ptr.version == 1 and ptr.base == 0
    assert size(1) < 0.05 * size(0)
    # the same keys again: what this run closes was opened by the last
    jobs.merge_into(spark, tbl, None, spark.range(0, 20000, 100).selectExpr("id as k", "'newer' as v"), KV,
                    dt.date(2024, 3, 3))
    history = lambda: sorted(map(tuple, snapshot.read_history(spark, tbl).collect()), key=str)
    before = history()
    assert len(before) == 20000 + 100 + 400
    assert sum(r[3] is None for r in before) == 20100
    assert snapshot.compact(spark, tbl).base == 3
    assert history() == before
    assert jobs.merge_into(spark, tbl, None, add, KV, D2, compact_after=1).base == 5


def test_landing_twice_changes_nothing_and_text_is_kept(spark, tmp_root):
    import os
    import zipfile

    import pytest
    arch, landing = f"{tmp_root}/arch", f"{tmp_root}/landing"
    os.makedirs(arch)
    with zipfile.ZipFile(f"{arch}/patient.zip", "w") as zf:
        zf.writestr("patient.txt", "H\n1|1|01/02/2020|caf\u00e9|o\r\n2|1|01/02/2020|\u00df|o\n3|1|01/02/2020|t|o")
    for _ in range(2):
        jobs.land_archives(spark, arch, landing)
        got = jobs.typed_batch(spark, landing, SPEC, "FUL", D1).collect()
        assert sorted(r.sequence_number_treatment for r in got) == ["caf\u00e9", "t", "\u00df"]
    # another archive lands beside it
    with zipfile.ZipFile(f"{arch}/patientAdd.zip", "w") as zf:
        zf.writestr("patientAdd.txt", "H\n9|1|01/02/2020|t|o\n")
    jobs.land_archives(spark, arch, landing, glob="*Add.zip")
    assert jobs.typed_batch(spark, landing, SPEC, "FUL", D1).count() == 3
    assert jobs.typed_batch(spark, landing, SPEC, "add", D1).count() == 1
    with zipfile.ZipFile(f"{arch}/patientchange.zip", "w") as zf:
        zf.writestr("patientchange.txt", b"H\n1|1|01/02/2020|caf\xe9|o\n")
    with pytest.raises(Exception):
        jobs.land_archives(spark, arch, landing, glob="*change.zip")
    jobs.land_archives(spark, arch, landing, glob="*change.zip", encoding="latin-1")
    assert jobs.typed_batch(spark, landing, SPEC, "change", D1).first().sequence_number_treatment == "caf\u00e9"


def test_two_stream_starts_lose_nothing(spark, tmp_root):
    from strata.streaming import start_merge_stream
    landing, tbl = f"{tmp_root}/landing", f"{tmp_root}/t"
    land(spark, landing, [("1|1|01/02/2020|t|o", "FUL")])
    jobs.full_load(spark, landing, SPEC, tbl, D1)
    for n in (2, 3):
        land(spark, landing, [(f"{n}|1|01/02/2020|t|o", "add")])
        start_merge_stream(spark, landing, SPEC, tbl, D2).awaitTermination()
    assert snapshot.read_history(spark, tbl).count() == 3


def test_staging_survives_a_failed_merge(spark, tmp_root):
    import os

    import pytest
    landing, stg = f"{tmp_root}/landing", f"{tmp_root}/staging"
    land(spark, landing, [("1|1|01/02/2020|t|o", "add"), ("1|1|01/02/2020|t|o", "change")])
    with pytest.raises(FileNotFoundError):
        jobs.run_feed(spark, landing, f"{tmp_root}/none", SPEC, D1, staging_root=stg)
    assert all(os.path.exists(p) for p in jobs.staging_paths(stg, SPEC))


def test_full_load_enforces_widths(spark, tmp_root):
    import pytest
    landing, tbl = f"{tmp_root}/landing", f"{tmp_root}/t"
    land(spark, landing, [(f"{'9' * 300}|1|01/02/2020|t|o", "FUL"), ("1|1|01/02/2020|t|o", "FUL")])
    with pytest.raises(Exception, match="too long"):
        jobs.full_load(spark, landing, SPEC, tbl, D1, enforce="fail")
    jobs.full_load(spark, landing, SPEC, tbl, D1, enforce="null")
    assert sorted(str(r.mdr_report_key) for r in snapshot.read_history(spark, tbl).collect()) == ["1", "None"]


def test_a_polling_stream_refuses_a_fixed_date(spark, tmp_root):
    import pytest

    from strata.streaming import start_merge_stream
    with pytest.raises(ValueError, match="as_of"):
        start_merge_stream(spark, tmp_root, SPEC, f"{tmp_root}/t", D2, available_now=False, processing_time="1 minute")
