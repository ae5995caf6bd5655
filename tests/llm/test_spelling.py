"""Spelling variants against a plain search over one-character changes."""

import collections
import random
import re
import zlib

import pyarrow as pa

import strata.llm.spelling as S
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
COLS = "doc_id long, text string"


def plain(rows):
    count = collections.Counter()
    for i, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(x) + 32) if "A" <= x <= "Z" else x for x in run)
            h = zlib.crc32(f"{'' if i is None else i}:{run}".encode())
            if h % 31 == 0:
                run = run[:h % len(run)] + run[h % len(run) + 1:]
            if len(run) >= 7:
                count[run] += 1
    n = {w: c for w, c in count.items() if c >= 2}
    near, like = collections.defaultdict(set), collections.defaultdict(set)
    for w in n:
        for k in range(len(w)):
            like[w[:k] + "*" + w[k + 1:]].add(w)
            if (less := w[:k] + w[k + 1:]) in n:
                near[w].add(less)
                near[less].add(w)
    for own in like.values():
        for w in own:
            near[w] |= own - {w}
    form = {}
    for w in n:
        top = min(near[w], key=lambda x: (-n[x], x), default=None)
        if top and n[top] >= 10 * n[w]:
            form[w] = top
    out = []
    for w in n:
        root = w
        while root in form:
            root = form[root]
        out.append((w, n[w], len(near[w]), form.get(w), n.get(form.get(w)), root))
    return sorted(out, key=str)


def test_query_equals_plain_search(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    out = QUERIES["op13_spelling_variants"](spark, SF)
    got = sorted((tuple(r[c] for c in ("word", "n", "n_near", "form", "form_n", "root")) for r in out.collect()), key=str)
    assert got == plain(rows) and len(got) > 1000


def chained_rows():
    rnd = random.Random(2)
    words = []
    for base in ["organisation", "überfahrt", "abcdefg", "ÀÿÖböße"]:
        words += [base] * 4000
        for _ in range(6):
            w = list(base)
            k = rnd.randrange(len(w))
            w[k:k + rnd.randint(0, 1)] = rnd.choice(["", "x", "y"])
            words += ["".join(w)] * 150
            for _ in range(5):
                v = list(w)
                k = rnd.randrange(len(v))
                v[k:k + rnd.randint(0, 1)] = rnd.choice(["", "x", "z"])
                words += ["".join(v)] * rnd.choice([2, 3, 11])
    # one half that many words share
    words += ["prefix" + "".join(rnd.choices("abc", k=6)) for _ in range(4000)]
    rnd.shuffle(words)
    return [(i, " ".join(words[i::50])) for i in range(50)]


def test_chains_hot_halves_and_odd_rows(spark, monkeypatch):
    rows = chained_rows() + [(None, "WORDING wording Wording"), (None, None), (1, ""), (2, "short words no"),
                             (2, "short words no"), (3, "q" * 3000 + " " + "q" * 3000 + " " + "q" * 2999),
                             (4, "q" * 2999), (5, "Straße×straße÷ straßen_Straßen")]
    want = plain(rows)
    assert any(r[3] != r[5] and r[3] for r in want)
    df = spark.createDataFrame(rows, COLS).selectExpr("*", "1 as word", "2 as n", "'z' as root")
    for chars in (S.CHARS, 2000):       # the second splits large groups
        monkeypatch.setattr(S, "CHARS", chars)
        out = S.spelling_variants(df)
        assert out.columns == ["word", "n", "n_near", "form", "form_n", "root"]
        assert sorted(map(tuple, out.collect()), key=str) == want
    assert S.spelling_variants(df.limit(0)).count() == 0


def test_queries_go_through_in_slices(monkeypatch):
    rnd = random.Random(3)
    words = sorted({"".join(rnd.choices("ab", k=rnd.randint(7, 8))) for _ in range(300)})
    t = pa.table({"half": ["f"] * len(words), "s": [7] * len(words), "part": [""] * len(words),
                  "cell": [0] * len(words), "index": [True] * len(words), "query": [True] * len(words),
                  "word": words, "n": [len(w) for w in words]})
    import numpy as np
    group = np.zeros(len(words), np.int64)
    whole = [r for b in S._searched(t, group) for r in b.to_pylist()]
    monkeypatch.setattr(S, "CELLS", 1000)
    assert [r for b in S._searched(t, group) for r in b.to_pylist()] == whole and len(whole) > 100
