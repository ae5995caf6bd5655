"""The corpus pipeline against a brute-force version of each stage."""

import os
import sys

import duckdb
import numpy as np
import pyarrow as pa
import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), "..", ".."))

import corpus_pipeline as P  # noqa: E402
import strata.llm.decontaminate as D  # noqa: E402
from strata.llm import sql  # noqa: E402
from test_simhash import plain_components, plain_fingerprint  # noqa: E402
from test_text_operators import keyed, plain_line_dedup  # noqa: E402

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def distance(item, text):
    """Least edit distance of an item to any part of a text, a row at a time."""
    t = np.frombuffer(text.encode("utf-32-le"), np.int32)
    at = np.arange(len(t) + 1)
    row = np.zeros(len(t) + 1, np.int64)
    for i, c in enumerate(item, 1):
        new = np.concatenate([[i], np.minimum(row[1:] + 1, row[:-1] + (t != ord(c)))])
        row = np.minimum.accumulate(new - at) + at
    return int(row.min())


def brute_force(spark, docs, items):
    """docs: dicts with different ids -> (rows of each stage)."""
    out = []
    con = duckdb.connect()

    def query(text, rows):
        con.register("documents", pa.Table.from_pylist(rows, schema=pa.schema(
            [("doc_id", pa.int64()), ("text", pa.string()), ("lang", pa.string()), ("source", pa.string()),
             ("n_chars", pa.int64())])))
        res = con.execute(text)
        names = [c[0] for c in res.description]
        return {r["doc_id"]: r for r in (dict(zip(names, x)) for x in res.fetchall())}

    kept = query(sql.QUALITY, docs)
    docs = [d for d in docs if kept[d["doc_id"]]["kept"]]
    out.append(docs)
    pairs = [(d["doc_id"], d["text"]) for d in docs]
    keyed(spark, pairs)
    new = {i: (t, n) for i, t, n in plain_line_dedup(pairs)}
    docs = [{**d, "text": new[d["doc_id"]][0],
             "n_chars": len(new[d["doc_id"]][0]) if new[d["doc_id"]][1] else d["n_chars"]} for d in docs]
    docs = [d for d in docs if not new[d["doc_id"]][1] or d["text"].strip(" \t\n\x0b\x0c\r")]
    out.append(docs)
    groups = {i: c for i, _, c in plain_components([(d["doc_id"], plain_fingerprint(d["text"])) for d in docs])}
    docs = [d for d in docs if groups[d["doc_id"]] == d["doc_id"]]
    out.append(docs)
    items = [t for t in map(D.plain, items) if len(t) >= D.MIN_CHARS]
    docs = [d for d in docs if not any(distance(t, D.plain(d["text"])) <= int(D.ERRORS * len(t)) for t in items)]
    out.append(docs)
    mixed = query(sql.MIX, docs)
    out.append([{**d, **{k: v for k, v in mixed[d["doc_id"]].items() if k != "doc_id"}} for d in docs])
    return out


def rows(stage):
    return sorted((tuple(sorted((k, round(v, 6) if isinstance(v, float) else v) for k, v in r.items()))
                   for r in stage), key=str)


def test_every_stage_equals_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    want = brute_force(spark, docs, items)
    assert [len(w) for w in want] == sorted((len(w) for w in want), reverse=True)
    df = spark.read.parquet(f"{SF}/documents.parquet")
    for (name, stage), w in zip(P.STAGES, want):
        df = P.stored(stage(spark, df, SF), "test")
        assert rows(r.asDict() for r in df.collect()) == rows(w), name
        assert df.columns[:5] == COLUMNS
    assert rows(r.asDict() for r in P.run(spark, SF).collect()) == rows(want[-1])


def test_stages_are_the_dealt_ones():
    assert [n for n, _ in P.STAGES] == ["quality rules", "line dedup", "SimHash near-dedup",
                                        "benchmark decontamination", "mixing sources"]


@pytest.mark.parametrize("empty", [False, True])
def test_odd_rows_pass_every_stage(spark, tmp_path, empty):
    """Nulls in any column, repeats, empty and long texts, clashing columns."""
    body = lambda k: " ".join(f"w{k}x{i}" for i in range(60))
    data = [(1, body(1), "en", "a", 1), (1, body(1), "en", "a", 1), (None, body(2), None, None, None),
            (None, body(2), None, None, None), (2, None, "en", "a", 0), (3, "", "en", "a", 0),
            (4, body(1), "en", "b", 1), (5, " ".join(f"v{i}x5" for i in range(30000)), "en", "b", 1), (6, body(7), "en", None, 1)]
    df = spark.createDataFrame([(*r, "kept", 7, "t") for r in data],
                               "doc_id long, text string, lang string, source string, n_chars long, kept string, "
                               "size int, leaks string")
    (df.limit(0) if empty else df).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, body(9)), (None, None), (2, "")], "item_id long, text string").write.parquet(
        f"{tmp_path}/benchmark.parquet")
    out = spark.read.parquet(f"{tmp_path}/documents.parquet")
    names = out.columns
    for name, stage in P.STAGES:
        out = P.stored(stage(spark, out, str(tmp_path)), "odd")
        assert out.columns == names or name == "mixing sources", name
    got = out.collect()
    if empty:
        assert got == []
    else:   # 2, 3 have no words; 4 and the repeats of 1 and of the row without id are copies
        assert sorted((r[0] is None, r[0] or 0) for r in got) == [(False, 1), (False, 5), (False, 6), (True, 0)]
