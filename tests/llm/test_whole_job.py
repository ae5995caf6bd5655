
import os
import random
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import numpy as np

import strata.llm.decontaminate as D
import strata.llm.line_dedup as LD
import strata.llm.substring_dedup as S
import test_text_operators as T
from strata.llm.queries import QUERIES

SF, COLS = T.SF, T.COLS


# ---- op2: repeated runs of lines, by a plain search over all places

def plain_runs(rows):
    """(doc_id, text) to the lines that a search over every two adjacent lines
    with a word finds repeated, and the place of each pair's first occurrence."""
    first, out = {}, {}

    def rank(i, t, s):
        return (i is None, i if i is not None else 0, T.KEY2[i, t], s)

    def pairs(t):
        own, lines = T.worded(t), t.split("\n")
        return [(a, b, "\n".join(lines[a:b + 1])) for (a, _), (b, _) in zip(own, own[1:])]
    for i, t in rows:
        for a, _, p in pairs(t) if t is not None else []:
            first[p] = min(first.get(p, rank(i, t, a)), rank(i, t, a))
    for i, t in rows:
        gone = out.setdefault((i, t), set())
        for a, b, p in pairs(t) if t is not None else []:
            if first[p] != rank(i, t, a):
                own = first[p][:3] == rank(i, t, a)[:3]
                gone |= {x for x in range(a, b + 1) if not (own and x <= first[p][3] + b - a)}
    return out


def runs_between(n, rnd, cases):
    """Pairs of texts that share a run of n lines, and what of the second is to stay."""
    def line():
        return " ".join(str(rnd.getrandbits(20)) for _ in range(4))
    rows, rest = [], {}
    for k in range(0, 2 * cases, 2):
        run = [line() for _ in range(n)]
        for i in (k, k + 1):
            before, after = ([line() for _ in range(rnd.randint(1, 6))] for _ in "ab")
            rows.append((i, "\n".join(before + run + after)))
            rest[i] = "\n".join(before + (run if i == k else []) + after)
    return rows, rest


@pytest.mark.parametrize("n, least", [(2, 0.93), (3, 0.99), (5, 0.99), (10, 0.99), (40, 0.99)])
def test_a_repeated_run_is_removed_whole_whatever_stands_around_it(spark, n, least):
    rows, rest = runs_between(n, random.Random(n), 400)
    got = {r.doc_id: (r.text, r.lines_removed) for r in LD.dedup_lines(spark.createDataFrame(rows, COLS)).collect()}
    whole = sum(got[i] == (t, n * (i % 2)) for i, t in rest.items() if i % 2)
    assert whole >= least * 400
    for i, t in rows:       # first copies stay; what was not removed whole stays whole
        assert got[i] in ((rest[i], n * (i % 2)), (t, 0))


def test_line_dedup_by_plain_run_search(spark):
    """Nothing but repeated runs goes, and nearly all of them do."""
    rows = T.documents(spark)
    T.keyed(spark, rows)
    got = {r.doc_id: r for r in QUERIES["op2_line_dedup"](spark, SF).collect()}
    want = plain_runs(rows)
    gone = sum(r.lines_removed for r in got.values())
    for i, t in rows:
        stay = [x for k, x in enumerate((t or "").split("\n")) if k not in want[i, t]]
        own = (got[i].text or "").split("\n")
        it = iter(own)
        assert all(x in it for x in stay)       # as a subsequence: only repeated lines went
        assert got[i].lines_removed <= len(want[i, t])
    assert gone > 100 and gone >= 0.97 * sum(map(len, want.values()))


def test_a_heading_and_blank_lines_are_no_run(spark):
    rows = [(1, "Introduction\n\nfirst text\n\nsame end\n\nlast same"), (2, "Introduction\n\nother text\n\nsame end\n\nlast same"),
            (3, "\n\n\n"), (4, "\n\n\n"), (5, "one line\n\n"), (6, "one line\n\n")]
    got = {r.doc_id: r.text for r in LD.dedup_lines(spark.createDataFrame(rows, COLS)).collect()}
    assert got == dict(rows) | {2: "Introduction\n\nother text\n"}


def test_line_dedup_odd_rows(spark):
    block = "\n".join(f"shared line {i}" for i in range(12))
    rows = [(5, block), (3, block), (3, block), (9, "new first line\n" + block), (None, block), (None, None),
            (1, ""), (2, "\n\n\n\n"), (4, "\n\n\n\n"), (6, block + "\n" + block), (7, "one line"), (8, "one line"),
            (10, "é " * 50000 + "\n" + block), (11, None), (12, "same\n" * 5 + "end"), (13, "same\nsame"), (14, "same")]
    df = T.keyed(spark, rows).selectExpr("*", "1 as first", "'x' as lines_removed", "2 as n", "3 as begin")
    got = sorted([(r.doc_id, r.text, r.lines_removed) for r in LD.dedup_lines(df).collect()], key=str)
    assert got == T.plain_line_dedup(rows)
    assert (9, "new first line", 12) in got and (12, "same\nsame\nend", 3) in got
    assert LD.dedup_lines(df.limit(0)).count() == 0


# ---- op6: text without white space

def cut(texts):
    """Chunks of each text, all in one batch."""
    raw = [t.encode() for t in texts]
    edge = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    ends = S.cuts(np.frombuffer(b"".join(raw), np.uint8), edge[:-1], edge[1:])
    data = b"".join(raw)
    return [[data[s:e] for s, e in zip([int(edge[k]), *own], own)] for k, own in enumerate(ends)]


@pytest.mark.parametrize("kind, size", [("base64", 20000), ("base64", 900), ("dna", 20000), ("nbsp", 6000), ("emoji", 3000)])
def test_a_shifted_blob_without_white_space_is_found(kind, size):
    rnd = random.Random(kind)
    letters = {"base64": [chr(c) for c in range(48, 112)], "dna": list("ACGT"),
               "emoji": [chr(0x1F600 + k) for k in range(60)],
               "nbsp": ["\u00a0", *"abcdefghij"]}[kind]
    for _ in range(40):
        blob = "".join(rnd.choices(letters, k=size))
        a, b = cut([p * rnd.randint(1, 300) + f"{rnd.random()} =" + blob + "= " + p for p in "xy"])
        common = sum(map(len, set(a) & set(b)))
        ends = 20 * S.ONE_IN_ANY * (4 if kind == "emoji" else 1)      # chunks that reach beyond the blob
        assert common > len(blob.encode()) - ends, (kind, common)
        for c in a + b:
            c.decode()


def test_chunks_of_a_text_do_not_depend_on_its_neighbours():
    rnd = random.Random(4)
    texts = ["".join(rnd.choices("ab ABCDé前", k=rnd.randint(0, 3000))) for _ in range(30)]
    texts += [c * 5000 for c in map(chr, range(33, 127))] + ["", "".join(rnd.choices("ACGT", k=5000)), ""]
    assert cut(texts) == [cut([t])[0] for t in texts]
    assert max(len(c) for t in cut(texts) for c in t) <= S.MAX_CHUNK
    assert max(len(c) for c in cut([chr(k) * 5000 for k in range(33, 127)])) < 10


def test_shifted_blobs_are_removed(spark):
    rnd = random.Random(8)
    blob = "".join(rnd.choices("ABCDEFGHabcdefgh0123+/", k=20000))
    rows = [(1, f"first text {blob} its end"), (2, f"another beginning:{blob}; another end")]
    got = {r.doc_id: r.text for r in S.dedup_substrings(spark.createDataFrame(rows, COLS)).collect()}
    assert got[1] == rows[0][1] and len(got[2]) < 400
    assert got[2].startswith("another beginning:") and got[2].endswith("another end")


# ---- op8: short items

def whole_word_distance(item, text):
    """Least edits from an item to a part of a text, a part's end inside a word
    being one more; by the table."""
    gap = [not D._parts(item[0]), not D._parts(item[-1])]
    cells = [None] * gap[0] + list(item) + [None] * gap[1]
    text = [None, *text, None]
    row = [0] * (len(text) + 1)
    for i, a in enumerate(cells, 1):
        new = [i]
        for j, b in enumerate(text, 1):
            same = (b is None or D._parts(b)) if a is None else a == b
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (not same)))
        row = new
    return min(row)


def test_short_items_are_found_as_whole_words(spark):
    items = [(1, "What is the capital of France?"), (2, "法国的首都是哪里?"), (3, "art"), (4, "日本"), (5, "?!"),
             (6, "Où est l’été ?"), (7, "สวัสดี")]
    rows = [(1, "Q: what is the capital of France? A: Paris"), (2, "问:法国的首都是哪里?巴黎"), (3, "start of the article"),
            (4, "“Art”"), (5, "art"), (6, "在日本的人"), (7, "he asked: où est l’été ?"), (8, "What is teh capital of France"),
            (9, "?!"), (10, "state of the art."), (11, "ครับสวัสดีครับ"), (12, "somewhat is the capital of france")]
    out = D.decontaminate(spark.createDataFrame(rows, COLS), spark.createDataFrame(items, COLS.replace("doc_", "item_")))
    got = {(r.doc.doc_id, x.item_id, x.distance) for r in out.collect() for x in r.leaks}
    assert got == {(1, 1, 0), (2, 2, 0), (4, 3, 0), (5, 3, 0), (6, 4, 0), (7, 6, 0), (8, 1, 2), (10, 3, 0),
                   (11, 7, 0), (12, 1, 1)}


def test_short_items_by_the_table():
    rnd = random.Random(6)
    found = 0
    for _ in range(1500):
        item = D.plain("".join(rnd.choices("aab c前é’", k=rnd.randint(1, 39))))
        if not item:
            continue
        t = list(item)
        for _ in range(rnd.randint(0, 3)):
            k = rnd.randrange(len(t) + 1)
            t[k:k + rnd.randint(0, 1)] = rnd.choice(["", "x", " "])
        text = D.plain("".join(rnd.choices("aab c前é’", k=rnd.randint(0, 9))) + "".join(t) + rnd.choice(["", " ", "a", "a b"]))
        want, most = whole_word_distance(item, text), int(D.ERRORS * len(item))
        got = D.Matcher([(0, item)]).leaks(text)
        assert got == ([{"item_id": 0, "distance": want}] if want <= most and text else []), (item, text)
        found += bool(got)
    assert found > 300
