import io
import json
import os
import zipfile

import pytest

from strata.plans import jobs, snapshot, tables
from strata.sources.archives import archive_lines, member_runs
from strata.sources.rejects import RejectChannel
from strata.specs import make_spec

SPEC = make_spec("small", """
k nvarchar(4) key
n int
t nvarchar(5)
""")
LINES = ["1|10|a", "2|20", "3|30|c|x", "4|40|d|x|y|z", '5|50|"p|q"', "6", "", "7||", '8|80|"open|']


def land(root, **loads):
    for load, lines in loads.items():
        path = os.path.join(root, "feed=small", f"load={load}")
        os.makedirs(path)
        with open(os.path.join(path, "f.txt"), "w") as f:
            f.write("\n".join(["K|N|T", *lines]) + "\n")
    return root


def loaded(spark, root):
    return sorted((r.k, r.n, r.t) for r in snapshot.read_history(spark, root).collect())


def test_rejects_are_kept_beside_the_load(spark, tmp_root):
    landing = land(f"{tmp_root}/landing", FUL=LINES)
    channel = RejectChannel(f"{tmp_root}/rejects")
    jobs.full_load(spark, landing, SPEC, f"{tmp_root}/plain", "2024-01-01")
    for _ in range(2):      # a run replaces what the one before rejected
        jobs.full_load(spark, landing, SPEC, f"{tmp_root}/kept", "2024-01-01", rejects=channel)
    assert loaded(spark, f"{tmp_root}/kept") == loaded(spark, f"{tmp_root}/plain")
    got = {r.record: r.k for r in channel.rejected(spark, SPEC, "FUL").collect()}
    assert got == {"2|20": "2", "3|30|c|x": "3", "4|40|d|x|y|z": "4", "6": "6"}
    assert channel.counts == {("small", "FUL"): {"lines": 8, "rejected": 4, "short_lines": 2, "surplus_lines": 2}}


def test_rejects_are_left_out_on_request(spark, tmp_root):
    landing = land(f"{tmp_root}/landing", FUL=LINES, add=["9|90", "10|100|j"])
    channel = RejectChannel(f"{tmp_root}/rejects", drop=True)
    jobs.run_feed(spark, landing, f"{tmp_root}/t", SPEC, "2024-01-01", full=True, rejects=channel)
    assert [r[0] for r in loaded(spark, f"{tmp_root}/t")] == ["1", "10", "5", "7", "8"]
    assert channel.counts["small", "add"] == {"lines": 2, "rejected": 1, "short_lines": 1, "surplus_lines": 0}
    assert channel.counts["small", "change"] == {"lines": 0, "rejected": 0, "short_lines": 0, "surplus_lines": 0}
    assert channel.rejected(spark, SPEC, "change").count() == 0


def test_cli_prints_reject_counts(spark, tmp_root, capsys):
    from strata.cli import main
    path = os.path.join(tmp_root, "landing", "feed=patient", "load=FUL")
    os.makedirs(path)
    with open(os.path.join(path, "f.txt"), "w") as f:
        f.write("H\n1|2\n")
    args = ["load", "--landing", f"{tmp_root}/landing", "--tables", f"{tmp_root}/t", "--load-type", "FUL",
            "--feeds", "patient", "--as-of", "2024-01-01"]
    assert main([*args, "--rejects", f"{tmp_root}/r"]) == 0
    assert json.loads(capsys.readouterr().out.strip())["rejects"]["patient FUL"]["rejected"] == 1
    with pytest.raises(SystemExit):
        main([*args, "--drop-rejects"])


@pytest.mark.parametrize("load", ["FUL", "add", "change"])
def test_declared_width_fails_every_load(spark, tmp_root, load):
    landing = land(f"{tmp_root}/landing", **{load: ["1|1|short", "2|2|trail    ", "3|3|"]})
    name = f"declared_{load}"
    try:
        jobs.declared_load(spark, landing, SPEC, load, "2024-01-01", name, f"{tmp_root}/t")
        assert sorted((r.k, r.t) for r in spark.table(name).collect()) == [("1", "short"), ("2", "trail"), ("3", None)]
        wide = land(f"{tmp_root}/wide", **{load: ["1|1|toolong"]})
        with pytest.raises(Exception, match="EXCEED_LIMIT_LENGTH"):
            jobs.declared_load(spark, wide, SPEC, load, "2024-01-01", name, f"{tmp_root}/t")
        assert spark.table(name).count() == 3       # the failed write changed nothing
        spark.createDataFrame([("9", 9, "x", None, None)],
                              SPEC.typed_schema()).toDF(*"abcde").createOrReplaceTempView("one_more")
        tables.insert_select(spark, name, "one_more")
        assert spark.table(name).where("k = '9' and t = 'x'").count() == 1
        for _ in range(3):
            jobs.declared_load(spark, landing, SPEC, load, "2024-01-01", name, f"{tmp_root}/t")
        assert spark.table(name).count() == 3
        assert len(os.listdir(f"{tmp_root}/t")) == 2    # the present rows and those before
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def write_zip(path, members, **kw):
    with zipfile.ZipFile(path, "w", **kw) as zf:
        for name, text in members.items():
            zf.writestr(name, text)


def test_member_runs():
    assert member_runs([], 10) == []
    assert member_runs([4, 4, 4, 1], 8) == [(0, 2, 8), (2, 4, 5)]
    assert member_runs([100, 0, 1], 8) == [(0, 1, 100), (1, 3, 1)]


def test_a_large_archive_fills_several_tasks(spark, tmp_root):
    from pyspark.sql import functions as F
    members = {f"d/{i}.txt": "".join(f"{i} line {j}\n" for j in range(200)) for i in range(12)}
    write_zip(f"{tmp_root}/big one%20.zip", {"d/": "", **members}, compression=zipfile.ZIP_DEFLATED)
    write_zip(f"{tmp_root}/empty.zip", {})
    whole = archive_lines(spark, tmp_root)
    split = archive_lines(spark, tmp_root, split_bytes=4000)
    want = sorted(("big one%20.zip", m, j, x) for m, t in members.items() for j, x in enumerate(t.splitlines()))
    for df in (whole, split):
        assert sorted(tuple(r) for r in df.collect()) == want
    tasks = lambda df: df.select(F.spark_partition_id()).distinct().count()
    assert tasks(whole) == 1 and tasks(split) > 3
    # a member is read by one task
    assert split.select("member", F.spark_partition_id()).distinct().count() == len(members)


def test_archives_by_an_opener(spark, tmp_root):
    write_zip(f"{tmp_root}/a.zip", {"m.txt": "H\n1\n"})
    with open(f"{tmp_root}/a.zip", "rb") as f:
        data = f.read()
    got = archive_lines(spark, tmp_root, open_file=lambda path: io.BytesIO(data)).collect()
    assert [r.line for r in got] == ["H", "1"]
