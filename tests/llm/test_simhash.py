"""SimHash groups against brute force over all pairs of fingerprints."""

import random
import re

import pytest
import xxhash

import strata.llm.simhash as S
from strata.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i:i + 3]) for i in range(max(1, len(words) - 2))]
    hs = [xxhash.xxh64_intdigest(s, seed=42) for s in shingles]
    return sum(1 << j for j in range(64) if 2 * sum(h >> j & 1 for h in hs) > len(hs))


def plain_components(rows):
    """rows: (id, fp); the smallest id reachable from each row."""
    fps = sorted({fp for _, fp in rows})
    root = {fp: fp for fp in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for i, a in enumerate(fps):
        for b in fps[i + 1:]:
            if (a ^ b).bit_count() <= 3:
                root[find(a)] = find(b)
    least = {}
    for i, fp in rows:
        if i is not None:
            least[find(fp)] = min(i, least.get(find(fp), i))
    return sorted(((i, f"{fp:016x}", least.get(find(fp))) for i, fp in rows), key=str)


def got(df):
    return sorted(((r.doc_id, f"{r.fp & (1 << 64) - 1:016x}", r.component_id)
                   for r in df.collect()), key=str)


@pytest.mark.parametrize("block", [16, 1 << 20])
def test_fingerprint_of_blocks(monkeypatch, block):
    monkeypatch.setattr(S, "BLOCK", block)
    rnd = random.Random(1)
    for n in (0, 1, 2, 3, 4, 50, 400):
        t = " ".join(rnd.choice(["The", "von", "É", "a", "x y", "Zoo"]) for _ in range(n))
        assert S.fingerprint(t.encode()) == plain_fingerprint(t)
    assert S.fingerprint(None) == S.fingerprint(b" \t\n\x0b") == 0


def test_query_equals_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").collect()
    want = plain_components([(d.doc_id, plain_fingerprint(d.text)) for d in docs])
    rows = QUERIES["op1_simhash_near_dedup"](spark, SF).collect()
    assert sorted(map(tuple, rows), key=str) == want


@pytest.mark.parametrize("run", [8, 4096])
def test_links_of_dense_groups_at_every_level(spark, monkeypatch, run):
    """Groups that share most bits, with runs longer than RUN passed on."""
    monkeypatch.setattr(S, "RUN", run)
    rnd = random.Random(run)
    fps = set()
    for _ in range(6):
        base = rnd.getrandbits(64)
        for _ in range(40):
            x = base
            for _ in range(rnd.randint(0, 6)):
                x ^= 1 << rnd.randrange(64)
            fps.add(x)
    rows = [(i, fp) for i, fp in enumerate(sorted(fps))]
    signed = [(i, fp - (1 << 64) if fp >> 63 else fp) for i, fp in rows]
    df = spark.createDataFrame(signed, "id long, fp long")
    links = S.near_links(df).collect()
    for r in links:
        assert ((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 3
    root = {fp: fp for _, fp in signed}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for r in links:
        root[find(r.a)] = find(r.b)
    mine = {}
    for i, fp in signed:
        mine.setdefault(find(fp), set()).add(i)
    want = {}
    for i, _, c in plain_components(rows):
        want.setdefault(c, set()).add(i)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, want.values()))


def test_nulls_ties_repeats_and_clashing_columns(spark):
    text = "a b c d e f g h"
    rows = [(5, text, 1), (3, text, 1), (3, text, 1), (None, text, 1), (9, None, 1), (8, "", 1),
            (None, "only words of a row without any id at all", 1), (7, "x", 1)]
    df = spark.createDataFrame(rows, "doc_id long, text string, fp int")
    want = plain_components([(r[0], plain_fingerprint(r[1])) for r in rows])
    assert got(S.simhash_groups(df)) == want
    assert got(S.simhash_groups(df.limit(0))) == []
