"""SimHash near-duplicate groups through deletion-variant signatures.

Every text gets a 64-bit fingerprint of its word shingles.  Two fingerprints
within ``MAX_BITS`` = 3 differing bits, cut into two halves, have a half that
differs in at most one bit.  So each half is indexed once per bit with that
bit wiped (32 variants a half); fingerprints that share a variant are
candidates and their distance is verified.  Recall is exact.

Work is per distinct fingerprint: thousands of exact copies are one.  Variants
are dealt out by value, sorted, and each run of equal variants is compared in
blocks inside a task, which emits a spanning forest of the run's links, never
all pairs.  A run over ``RUN`` fingerprints is not compared but passed on: its
members agree in one half up to a bit, so the same rule is applied to the
other half (two quarters of 16 bits, then two eighths of 8).  After the third
cut at most 2**11 different fingerprints can share a run, so every group that
a task holds is bounded whatever the data.

Words are ``[^\\x20\\x09-\\x0D]+`` after lower-casing A-Z; shingles of three,
repeats included, joined by a space; a shorter text is one shingle; a text
without words (null and empty included) has fingerprint zero and links like
any other.  Texts are read in blocks cut at white space, so a very long text
needs no more memory than its bytes.

Defined results: rows with a null id are grouped like others and return a null
id; an id that is null never becomes a component id unless a component has no
other; repeated rows return one row each; an empty table gives an empty one.
Other columns are not read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import stored
from .components import components

WIDTH = 3
MAX_BITS = 3
SEED = 42
BLOCK = 1 << 20     # bytes of a text held as words at once
RUN = 4096          # fingerprints of a run compared in one go
#: Segment widths by level; at each level a pair has a segment of this width,
#: among two, that differs in at most one bit.
LEVELS = (32, 16, 8)

_GAP = re.compile(rb"[\x20\x09-\x0d]")


def word_blocks(data: bytes) -> Iterator[list[bytes]]:
    """The words of a text, in lists of about ``BLOCK`` bytes."""
    start = 0
    while len(data) - start > BLOCK and (cut := _GAP.search(data, start + BLOCK)):
        yield data[start:cut.start()].split()
        start = cut.end()
    yield (data[start:] if start else data).split()


def fingerprint(text: bytes | None, width: int = WIDTH) -> int:
    """SimHash of a UTF-8 text, unsigned."""
    ones, n, kept = np.zeros(64, np.int64), 0, []
    digest = xxhash.xxh64_intdigest
    for words in word_blocks((text or b"").lower()):
        words = kept + words
        kept = words[-(width - 1):] if width > 1 else []
        if len(words) < width:
            kept = words
            continue
        joined = b" ".join(words)
        ends = list(accumulate(map(len, words), lambda e, k: e + 1 + k))
        starts = [0, *(e + 1 for e in ends)]
        hashes = np.fromiter((digest(joined[s:e], SEED) for s, e in zip(starts, ends[width - 1:])),
                             np.uint64, len(words) - width + 1)
        for part in np.array_split(hashes, len(hashes) // 65536 + 1):
            ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1,
                                  bitorder="little").sum(axis=0, dtype=np.int64)
        n += len(hashes)
    if not n:
        return digest(b" ".join(kept), SEED) if kept else 0
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keys: list[str], text: str = "text",
                 width: int = WIDTH) -> DataFrame:
    """``keys`` and ``fp`` (the fingerprint's bits as a long) of each row."""

    def run(batches):
        for b in batches:
            texts = b.column(len(keys)).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), width) for t in texts], np.uint64)
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in range(len(keys))),
                                              pa.array(fps.view(np.int64))], [*keys, "fp"])

    d = docs.select(*keys, F.col(text))
    schema = d.select(*keys).schema.add("fp", "long")
    return d.mapInArrow(run, schema)


def _linked(fps: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links among one run's different fingerprints,
    each node beside the one that reached it."""
    left, out = fps, []
    while len(left) > 1:
        front, left = [left[0]], left[1:]
        while front and len(left):
            x = front.pop()
            near = np.bitwise_count(left ^ x) <= max_bits
            if near.any():
                found = left[near]
                out += [(int(x), int(y)) for y in found]
                front += list(found)
                left = left[~near]
    return out


def _links_of_runs(n_keys: int, max_bits: int):
    """mapInArrow function over sorted (k0, .., fp): rows (a, b, k0, ..) that
    are links (no k0) or members of an over-long run (a only)."""

    def rows(a, b, ks):
        cols = [pa.array(np.asarray(a, np.int64)), pa.array(b, pa.int64()), *ks]
        return pa.RecordBatch.from_arrays(cols, ["a", "b", *[f"k{i}" for i in range(n_keys)]])

    def links(pairs):
        none = [pa.nulls(len(pairs), pa.int64())] * n_keys
        x = np.array(pairs, np.int64).reshape(-1, 2)
        return rows(x[:, 0], x[:, 1], none)

    def passed_on(key, fps):
        return rows(fps, [None] * len(fps),
                    [pa.array(np.full(len(fps), k, np.int64)) for k in key])

    def run(batches):
        held, over = None, False      # the run that may go on: array of rows
        for b in batches:
            x = np.column_stack([b.column(i).to_numpy(zero_copy_only=False)
                                 for i in range(n_keys + 1)])
            if not len(x):
                continue
            if held is not None and over and (x[0, :-1] == held[0, :-1]).all():
                n = int(np.argmin((x[:, :-1] == held[0, :-1]).all(axis=1))) \
                    if not (x[-1, :-1] == held[0, :-1]).all() else len(x)
                yield passed_on(held[0, :-1], x[:n, -1])
                x = x[n:]
                if not len(x):
                    continue
                held = None
            elif held is not None:
                x = x if over else np.concatenate([held, x])
                held = None
            over = False
            cut = np.flatnonzero((x[1:, :-1] != x[:-1, :-1]).any(axis=1)) + 1
            starts = np.concatenate([[0], cut])
            held, starts_done = x[starts[-1]:], starts[:-1]
            lengths = np.diff(starts)
            two = starts_done[lengths == 2]
            if len(two):
                p, q = x[two, -1], x[two + 1, -1]
                ok = np.bitwise_count((p ^ q).view(np.uint64)) <= max_bits
                if ok.any():
                    yield rows(p[ok], pa.array(q[ok]), [pa.nulls(int(ok.sum()), pa.int64())] * n_keys)
            for s, m in zip(starts_done[lengths > 2], lengths[lengths > 2]):
                if m > RUN:
                    yield passed_on(x[s, :-1], x[s:s + m, -1])
                elif pairs := _linked(x[s:s + m, -1].view(np.uint64), max_bits):
                    yield links(np.array(pairs, np.uint64).view(np.int64))
            if len(held) > RUN:
                yield passed_on(held[0, :-1], held[:, -1])
                held, over = held[:1], True
        if held is not None and not over and len(held) > 1:
            if pairs := _linked(held[:, -1].view(np.uint64), max_bits):
                yield links(np.array(pairs, np.uint64).view(np.int64))

    return run


def _variants(members: DataFrame, level: int) -> DataFrame:
    """Adds ``k<level>``: the variant of one of the two segments at this level.
    A variant holds its number (segment and wiped bit) and the segment's other
    bits.  Below the first level the segments lie in the half (or quarter)
    that the variant above did not take."""
    width = LEVELS[level]
    d = members.select("*", F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1))).alias("p"))
    base = F.lit(0)
    for i in range(level):
        # number p of the upper variant: p < width took the low segment
        took_low = F.shiftrightunsigned(F.col(f"k{i}"), 32) < LEVELS[i]
        base = base + F.when(took_low, F.lit(LEVELS[i])).otherwise(F.lit(0))
    shift = base + F.when(F.col("p") < width, F.lit(0)).otherwise(F.lit(width))
    low_bits = F.lit((1 << width) - 1).cast("long")
    part = F.call_function("shiftrightunsigned", F.col("fp"), shift.cast("int")).bitwiseAND(low_bits)
    wiped = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("p") % width).cast("int"))
    key = F.shiftleft(F.col("p").cast("long"), 32).bitwiseOR(part.bitwiseAND(F.bitwise_not(wiped)))
    return d.withColumn(f"k{level}", key).drop("p")


def near_links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Links (a, b) that connect what fingerprints at ``max_bits`` or fewer
    differing bits connect, from the different values ``fp``."""
    if not 0 <= max_bits <= MAX_BITS:
        raise ValueError(f"max_bits must be between 0 and {MAX_BITS}")
    members, found = fps.select("fp"), None
    for level in range(len(LEVELS)):
        keys = [f"k{i}" for i in range(level + 1)]
        dealt = (_variants(members, level).repartition(*keys)
                 .sortWithinPartitions(*keys, "fp").select(*keys, "fp"))
        schema = "a long, b long, " + ", ".join(f"{k} long" for k in keys)
        got = stored(dealt.mapInArrow(_links_of_runs(len(keys), max_bits), schema), "runs")
        here = got.where("b is not null").select("a", "b")
        found = here if found is None else found.unionByName(here)
        over = got.where("b is null")
        if over.isEmpty():
            return found
        members = over.select(F.col("a").alias("fp"), *keys)
    raise AssertionError("a run of the last level exceeded its proven bound")


def simhash_groups(docs: DataFrame, *, keys: tuple[str, ...] = ("doc_id",), id_col: str = "doc_id",
                   text: str = "text", width: int = WIDTH, max_bits: int = MAX_BITS) -> DataFrame:
    """``keys``, ``fp``, ``root`` (a component's smallest fingerprint, as a
    signed long) and ``component_id`` (its smallest ``id_col``) of every row."""
    rows = stored(fingerprints(docs, list(keys), text, width), "fingerprints")
    heads = stored(rows.groupBy("fp").agg(F.min(id_col).alias("id")), "heads")
    tree = components(near_links(heads, max_bits), "a", "b")
    placed = heads.join(tree, F.col("fp") == F.col("node"), "left").select(
        "fp", "id", F.coalesce("root", "fp").alias("root"))
    placed = stored(placed, "placed")
    least = stored(placed.groupBy("root").agg(F.min("id").alias("component_id")), "least")
    of_fp = stored(placed.select("fp", "root").join(least, "root").select(
        F.col("fp").alias("f"), "root", "component_id"), "of-fp")
    return rows.join(of_fp, F.col("fp") == F.col("f")).drop("f")
