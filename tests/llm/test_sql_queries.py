"""Corpus queries that SQL can express, against DuckDB, on driver tables and on
tables full of nulls, repeats, ties, empty texts and unusual characters."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", "..", "tools"))

from check_oracle import digest  # noqa: E402

from strata.llm.queries import ORACLE, QUERIES  # noqa: E402

SF = "/root/testdata/sf0.001"

LONG = "one two three four five six seven eight nine ten " * 30
DOCS = [
    (1, "a b c", "en", "s1"), (1, "a b c", "en", "s1"), (2, None, "en", "s1"), (3, "", "en", None),
    (4, " \t\n\x0b\x0c\r ", None, "s2"), (None, "x y", "en", "s2"), (None, None, None, None),
    (5, LONG, "en", "s3"), (6, LONG, "en", "s3"), (7, "É É É " * 20, "fr", "a'b"),
    (8, "\n".join(["same line here"] * 9 + ["other"]), "en", "s1"), (9, "#*$ %&| <> !?" * 12, "en", "s1"),
    (10, "\u00a0 \u2003 no break", "de", "Z"), (11, "w" * 9000, "en", ""), (12, "😀 " * 40, "en", "s1"),
    (13, " ".join(f"w{i}" for i in range(40)), "en", "s1"), (14, " lead and trail ", "en", "big"),
    (15, " ".join(f"v{i}" for i in range(3000)), "en", "big"), (16, "AB " * 30, "en", "\u00e9"),
    (17, "station " * 30 + "Stations stations statoin statoin", "en", "s1"), (18, "\u00c9trang\u00e8re \u00e9trang\u00e8re " * 2, "fr", "s2"),
]
PAGES = [
    (1, "http://a.org"), (1, "http://a.org"), (2, None), (3, "no scheme/org/"), (4, "https://A.Example.ORG/es/x?y"),
    (5, "http://example.org/en/17"), (6, "http://example.org/EN/17"), (7, "http://x.com/de/?a"), (8, "http://com/fr/"),
    (9, "x://h?://b.org/"), (10, "http://ads-track.com/"), (11, "http://my-ads-track.com/"), (12, ""),
    (13, "http://spam-farm.example.com/en/1"), (14, "http://q.net/a?phpsessid=1"), (15, "http://q.net/run.exe"),
    (16, "http://q.net/run.exe?x"), (17, "http://org#f"), (18, "http://notorg/"), (19, "http://É.ORG/É"),
    (None, "http://q.net/doubleclick"), (20, "http://q.net/doubleclicks"), (21, "http://a.org\n/x"), (22, "://"),
]
# blanks here are space, tab and newline only: the SQL of op12_ takes \x0b, \x0c and
# \r for characters; test_conversations.py has those against a plain program
TURNS = [
    *[(1, k, "user" if k % 2 == 0 else "assistant", f"t{k}.") for k in range(60)], *[(2, 5, "user", "same.")] * 3,
    (3, None, "user", "no turn."), (3, 1, None, None), (None, 1, "system", "s."), (None, None, "assistant", "a!"),
    (4, 0, "system", "s."), (4, 2, "user", "u?"), (4, 9, "assistant", "cut off"), (5, 0, "tool", " \t\n "),
    (6, 0, "assistant", "É…"), (6, 1, "", "x.\n\t"), (7, -3, "user", "😀"), (7, 3, "u", "w " * 5000 + "."),
    *[(c, 0, "user", "a.") for c in range(100, 160)],
]


def compare(spark, name, folder, tables):
    con = duckdb.connect()
    for t in tables:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{folder}/{t}.parquet')")
    df = QUERIES[name](spark, folder)
    rows = [tuple(r) for r in df.collect()]
    res = con.execute(ORACLE[name])
    cols = [d[0] for d in res.description]
    want = res.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert len(rows) == len(want)
    assert digest(df.columns, rows) == digest(cols, want)
    return rows


@pytest.fixture(scope="module")
def odd(tmp_path_factory):
    """Odd rows, and a table with the schemas but no rows."""
    import pyarrow as pa
    import pyarrow.parquet as pq
    out = []
    for keep in (True, False):
        folder = str(tmp_path_factory.mktemp("odd"))
        d = [(*r, i, "clash", i) for i, r in enumerate(DOCS)] if keep else []
        names = ["doc_id", "text", "lang", "source", "n_words", "kept", "__text"]
        kinds = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.int64()]
        pq.write_table(pa.table([pa.array([r[i] for r in d], k) for i, k in enumerate(kinds)], names),
                       f"{folder}/documents.parquet")
        p = [(*r, "clash") for r in PAGES] if keep else []
        pq.write_table(pa.table([pa.array([r[i] for r in p], k) for i, k in enumerate(
            [pa.int64(), pa.string(), pa.string()])], ["page_id", "url", "verdict"]), f"{folder}/pages.parquet")
        c = TURNS if keep else []
        pq.write_table(pa.table([pa.array([r[i] for r in c], k) for i, k in enumerate(
            [pa.int64(), pa.int64(), pa.string(), pa.string()])], ["conv_id", "turn", "role", "text"]),
            f"{folder}/conversations.parquet")
        out.append(folder)
    return out


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_driver_tables(spark, name):
    compare(spark, name, SF, ["documents", "pages", "conversations"])


@pytest.mark.parametrize("name", sorted(ORACLE))
@pytest.mark.parametrize("which", [0, 1])
def test_odd_and_empty_tables(spark, odd, name, which):
    rows = compare(spark, name, odd[which], ["documents", "pages", "conversations"])
    assert bool(rows) == (which == 0)


def test_operators_carry_clashing_columns(spark, odd):
    from strata.llm.mixing import mix
    from strata.llm.quality_rules import quality_rules
    from strata.llm.url_filter import filter_urls
    docs = spark.read.parquet(f"{odd[0]}/documents.parquet")
    for f in (quality_rules, mix):
        out = f(docs)
        assert len(set(out.columns)) == len(out.columns) and set(docs.columns) <= set(out.columns)
        assert len(out.collect()) == docs.count()
    pages = spark.read.parquet(f"{odd[0]}/pages.parquet")
    out = filter_urls(pages)
    assert set(pages.columns) <= set(out.columns) and len(set(out.columns)) == len(out.columns)
    assert len(out.collect()) == pages.count()


def test_contract_rules_by_hand(spark, odd):
    from strata.llm.queries import QUERIES
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in QUERIES["op3_url_filters"](spark, odd[0]).collect()}
    assert got[4] == ("a.example.org", "/es/x", "example.org/es/", "block")
    assert got[5] == ("example.org", "/en/17", "example.org/en/1", "block")
    assert got[6] == ("example.org", "/EN/17", "org/", "allow")
    assert got[7] == ("x.com", "/de/", "com/de/", "block")
    assert got[8] == ("com", "/fr/", "com/fr/", "allow")
    assert got[9] == ("h", "", None, "allow")
    assert got[1] == ("a.org", "", None, "allow")
    assert got[3] == ("", "", None, "allow") and got[2] == ("", "", None, "allow")
    assert got[17] == ("org", "", None, "allow") and got[18] == ("notorg", "/", None, "allow")
    assert got[10][3] == "block" and got[11][3] == "allow"
    assert got[15][3] == "block" and got[16][3] == "allow"


def test_whole_tokens_of_patterns():
    from strata.llm.url_filter import pattern, place_rule
    assert pattern("||ads-track.").tokens == ("ads", "track")
    assert pattern(".exe|").tokens == ("exe",)
    assert pattern("/doubleclick^").tokens == ("doubleclick",)
    assert pattern("*banner").tokens == () and pattern("/ad*zone/").tokens == ()
    assert place_rule("example.org/en/1", "block").tokens == ("example", "org", "en")


def test_rule_without_token_still_runs(spark):
    from strata.llm.url_filter import filter_urls, pattern
    pages = spark.createDataFrame([(1, "http://x.net/mybanners"), (2, "http://x.net/")], "page_id long, url string")
    got = {r.page_id: r.pattern for r in filter_urls(pages, [pattern("*banner*")]).collect()}
    assert got == {1: "*banner*", 2: None}


def test_mix_targets_and_limits(spark):
    """Targets by hand: src weights 1, 2, 3 over 600 words, limits 3x."""
    from strata.llm.mixing import mix
    docs = [(i, "w " * 10, "a") for i in range(50)] + [(100 + i, "w " * 10, "b") for i in range(9)] \
        + [(200, "w " * 10, None)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    rows = mix(df, carry=["doc_id", "source"]).collect()
    # 600 words; weights a 1, b 2, null 3: null stops at 30, then a 190 and b 380, which stops at 270
    by = {}
    for r in rows:
        t = by.setdefault(r.source, [r.target, 0, r.source_size])
        t[1] += r.taken
        assert r.taken <= 3 * r.size
    assert by["b"][0] == pytest.approx(270) and by["a"][0] == pytest.approx(300)
    assert by[None][0] == pytest.approx(30)
    assert sum(t[0] for t in by.values()) == pytest.approx(600)
    for target, taken, _ in by.values():
        assert abs(taken - target) <= 1
    again = mix(df.repartition(3), carry=["doc_id", "source"]).collect()
    assert sorted(map(tuple, again), key=str) == sorted(map(tuple, rows), key=str)


def test_schedule_prefixes_follow_the_weights(spark):
    from strata.llm.mixing import plan, schedule
    sizes = spark.createDataFrame([("a", 10**6), ("b", 10**6), ("c", 10**6)], "source string, size long")
    p = plan(sizes)
    rows = schedule(p, 3000).collect()
    share = {r.sid: (r.hi - r.lo) for r in p.collect()}
    assert len(rows) == 3000
    for n in (100, 1000, 3000):
        for s, w in share.items():
            assert abs(sum(r.slot < n and r.sid == s for r in rows) - n * w) < 6
    for s in share:
        ks = [r.k for r in sorted(rows, key=lambda r: r.slot) if r.sid == s]
        assert ks == list(range(len(ks)))
