"""Conversation repair against a plain dynamic program."""

import collections
import hashlib
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

import strata.llm.conversations as C

WS = " \t\n\x0b\x0c\r"
NEXT = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
COLS = "conv_id long, turn long, role string, text string"


def plain_damage(rows):
    out = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        own = out[conv]
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        k = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if k == 0:
            continue
        text = "" if k == 1 else re.sub("[.!?]", "", text) if k == 2 else text
        own += [(turn, "user" if k == 4 else role, text)] * (2 if k == 3 else 1)
    return out


def plain_repair(rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1],
                                       hashlib.sha256(f"{len(r[1])}:{r[1]}{r[2]}".encode()).hexdigest()))
    turns = sorted({t for t, _, _ in rows if t is not None})
    seen, faults = set(), []
    for _, role, text in rows:
        end = text.rstrip(WS)[-1:]
        faults.append("b" if not end else "d" if (role, text) in seen else "t" if end not in ".!?" else "")
        seen.add((role, text))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    best = {"": (0, "", ()), "a": (0, "", ()), "u": (3, "I", ("assistant:",)), "s": (6, "II", ("user:", "assistant:"))}
    for (_, role, text), fault in zip(rows[::-1], faults[::-1]):
        ways = {}
        for q in ("", "s", "u", "a"):
            cost, audit, lines = best[q]
            ways[q] = [(cost + 4, "D" + audit, lines)]
            if fault in ("b", "d"):
                continue
            more = 3 * (fault == "t")
            if (q, role[:1]) in NEXT:
                cost, audit, lines = best[NEXT[q, role[:1]]]
                ways[q].append((cost + more, "K" + audit, (role + ":" + text, *lines)))
            to, name = ("a", "assistant") if q == "u" else ("u", "user")
            cost, audit, lines = best[to]
            ways[q].append((cost + more + 3, "R" + audit, (name + ":" + text, *lines)))

        def least(q, depth=0):
            out = list(ways[q])
            if depth < 3:
                to, name = ("a", "assistant") if q == "u" else ("u", "user")
                cost, audit, lines = least(to, depth + 1)
                out.append((cost + 3, "I" + audit, (name + ":", *lines)))
            return min(out, key=lambda w: w[:2])
        best = {q: least(q) for q in ways}
    cost, audit, lines = best[""]
    gaps = turns[-1] - turns[0] + 1 - len(turns) if turns else 0
    return (gaps, faults.count("b"), faults.count("d"), faults.count("t"), illegal, cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())


def plain(rows):
    return sorted(((conv, *plain_repair(own)) for conv, own in plain_damage(rows).items()), key=str)


def odd_rows():
    rnd = random.Random(1)
    texts = ["a.", "b", "", "c!", " ", "d?\n", "no end", "a.\x0b", "e…", "x " * 5000 + ".", None]
    roles = ["user", "assistant", "system", "tool", "u", "", None, "user", "assistant"]
    rows = [(rnd.choice([1, 2, 3, None, 5]), rnd.choice([None, *range(60)]), rnd.choice(roles), rnd.choice(texts))
            for _ in range(1000)]
    rows += [(7, None, "user", "x.")] * 40 + [(9, 3, None, None)] + [(10, 0, "user", "x")] * 3
    rows += [(8, k, "user" if k % 2 else "assistant", f"t{k}.") for k in range(300)]
    return rows + [(c, t, rnd.choice(roles), rnd.choice(texts)) for c in range(100, 150) for t in range(rnd.randint(1, 7))]


@pytest.mark.parametrize("block", [512, 3])
def test_repair_equals_plain_program(spark, block):
    rows = odd_rows()
    df = spark.createDataFrame(rows, COLS).selectExpr("*", "1 as copies", "2 as digest", "'z' as cost")
    got = C.repaired_damage(df, block)
    assert got.columns == ["conv_id", *[k for k, _ in C.RESULT]]
    assert sorted(map(tuple, got.collect()), key=str) == plain(rows)


def test_a_long_conversation_spreads_over_blocks(spark):
    rows = odd_rows()
    _, slim = C._ordered(C.damaged(spark.createDataFrame(rows, COLS)))
    order = ["conv_id", "turn", "role", "digest"]
    blocks = slim.repartitionByRange(7, *order).sortWithinPartitions(*order).withColumn(
        "pid", F.spark_partition_id()).mapInArrow(C._blocked(16), C._block_schema(slim.schema["conv_id"].dataType))
    got = C._numbered(blocks).select("conv_id", "b", "blocks", "last", F.size("n").alias("rows")).collect()
    most = max(r.blocks for r in got)
    assert most > 10 and max(r.rows for r in got) <= 16
    for conv in {r.conv_id for r in got}:
        own = [r for r in got if r.conv_id == conv]
        assert sorted(r.b for r in own) == list(range(own[0].blocks)) and sum(r.last for r in own) == 1


def test_conversations_without_rows_and_empty_tables(spark):
    gone = [(c, t) for c in range(3000) for t in [0] if zlib.crc32(f"{c}:{t}".encode()) % 20 == 0][:3]
    rows = [(c, t, "user", "a.") for c, t in gone]
    got = sorted(map(tuple, C.repaired_damage(spark.createDataFrame(rows, COLS)).collect()))
    empty = hashlib.sha256(b"").hexdigest()
    assert got == [(c, 0, 0, 0, 0, 0, 0, "", empty) for c, _ in gone]
    assert C.repaired_damage(spark.createDataFrame([], COLS)).count() == 0


def test_repair_without_damage(spark):
    rows = [(1, 0, "system", "s."), (1, 1, "user", "u."), (1, 2, "assistant", "a."), (2, 0, "user", "u."), (2, 2, "user", "v.")]
    got = {r.conv_id: r for r in C.repair(spark.createDataFrame(rows, COLS)).collect()}
    assert (got[1].audit, got[1].cost, got[1].illegal) == ("KKK", 0, 0)
    assert (got[2].audit, got[2].cost, got[2].illegal, got[2].gaps) == ("KR", 3, 1, 1)
