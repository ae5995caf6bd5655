import io
import os
import zipfile

from strata.sources.archives import archive_lines
from strata.sources.links import anchor_links, kept_links, parse_index_table, table_links

PAGE = """<table class="other"><tr><td><a href="/no">no.zip</a></td></tr></table>
<table class="table">
<tr><th>File</th><th>Size</th></tr>
<tr><td><a href="https://h.example/f/mdrfoi.zip">mdrfoi.zip</a></td><td>1</td></tr>
<tr><td>no anchor</td><td><a href="/second-cell">x</a></td></tr>
<tr><td><a href="https://h.example/f/foidevproblem.zip">foidevproblem.zip</a></td></tr>
</table>"""


def test_index_table_rule(spark):
    assert parse_index_table(PAGE) == [("mdrfoi.zip", "https://h.example/f/mdrfoi.zip"),
                                       ("foidevproblem.zip", "https://h.example/f/foidevproblem.zip")]
    pages = spark.createDataFrame([(1, PAGE), (2, "<p>no table</p>")], "page_id long, html string")
    got = [(r.page_id, r.pos, r.name, r.url) for r in kept_links(table_links(pages)).collect()]
    assert got == [(1, 0, "mdrfoi.zip", "https://h.example/f/mdrfoi.zip")]


def test_index_table_entities_unclosed_anchors_and_nested_tables():
    page = """<table class="big table"><tr><th>File</th></tr>
<tr><td><a href="/1">a &amp;lt; b</a></td></tr>
<tr><td><a href="/2">open</td><td><a href="/no">x</a></td></tr>
<tr><td>text <b><a class="y" href="/3">x<i>y</i></a></b> tail</td></tr>
<tr><td>more<table><tr><td><a href="/4">in</a></td></tr></table></td></tr>
<tr></tr><tr><td>none</td></tr></table><table class="table"><tr><td></td></tr><tr><td><a href="/5">z</a></td></tr></table>"""
    assert parse_index_table(page) == [("a &lt; b", "/1"), ("open", "/2"), ("xy", "/3"), ("in", "/4"), ("in", "/4")]
    assert parse_index_table(None) == parse_index_table("") == []


def test_anchor_forms(spark):
    html = """<A title="t" HREF='/1'>one</A><a href=/2>t<b>w</b>o</a><abbr href="/no">no</abbr><a name="n">no</a>"""
    pages = spark.createDataFrame([(1, html), (2, None)], "page_id long, html string")
    assert [(r.name, r.url) for r in anchor_links(pages).orderBy("pos").collect()] == [("one", "/1"), ("two", "/2")]


def test_anchor_rule(spark):
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    got = [(r.pos, r.name) for r in anchor_links(pages).orderBy("pos").collect()]
    assert got == [(0, "no.zip"), (1, "mdrfoi.zip"), (2, "x"), (3, "foidevproblem.zip")]


def test_archive_lines(spark, tmp_root):
    for name, members in {"mdrfoiAdd.zip": {"mdrfoiAdd.txt": "H1|H2\n1|a\n2|b\n"},
                          "two.zip": {"a.txt": "H\r\nx\r\n", "b.txt": "H\ny"}}.items():
        buf = io.BytesIO()
        with zipfile.ZipFile(buf, "w") as zf:
            for m, text in members.items():
                zf.writestr(m, text)
        with open(os.path.join(tmp_root, name), "wb") as fh:
            fh.write(buf.getvalue())
    got = sorted(tuple(r) for r in archive_lines(spark, tmp_root).collect())
    assert got == sorted([("mdrfoiAdd.zip", "mdrfoiAdd.txt", 0, "H1|H2"),
                          ("mdrfoiAdd.zip", "mdrfoiAdd.txt", 1, "1|a"),
                          ("mdrfoiAdd.zip", "mdrfoiAdd.txt", 2, "2|b"),
                          ("two.zip", "a.txt", 0, "H"), ("two.zip", "a.txt", 1, "x"),
                          ("two.zip", "b.txt", 0, "H"), ("two.zip", "b.txt", 1, "y")])


def test_cli_files_from_index_page(spark, tmp_root):
    from strata.cli import main
    pages = spark.createDataFrame([(1, PAGE)], "page_id long, html string")
    src, out = os.path.join(tmp_root, "pages"), os.path.join(tmp_root, "files")
    pages.write.parquet(src)
    assert main(["files", "--pages", src, "--out", out, "--load-type", "FUL"]) == 0
    got = [tuple(r) for r in spark.read.parquet(out).collect()]
    assert got == [("mdrfoi.zip", "https://h.example/f/mdrfoi.zip", "mdrfoi.zip", "mdrfoi",
                     "mdrfoi_event", "FUL", "landing/mdrfoi_event/FUL/mdrfoi.txt")]
    assert main(["files", "--pages", src, "--out", out, "--load-type", "INC"]) == 0
    assert spark.read.parquet(out).count() == 0
