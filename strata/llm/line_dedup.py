"""De-duplication of repeated runs of lines by content-defined chunks.

Lines with a word are hashed.  A rolling hash over the last ``WINDOW`` of them
says whether a chunk may end at a line: it may, but for one place in
``NOT_ONE_IN``.  The hash sees nothing but these lines, so boundaries do not
shift with what stands before a passage.  A chunk begins at every line and ends
at the next such boundary, two lines on at least (or at the text's end, or
after ``MAX_LINES``).  Chunks whose digest repeats anywhere are compared by
their bytes; their first occurrence, by (doc_id, place in the text), stays, the
others are removed.  Each is then extended, line by line, as far as what
follows up to the next boundary is what follows the copy that stays.

A repeated run is thus removed whole if a boundary lies in it: all runs but one
in NOT_ONE_IN of those of two lines, one in its square of three, and so on.
Nothing is removed that is not part of a repeated run of two lines with a word.

Only line hashes leave the JVM, and only digests are shuffled to find repeats;
counting combines copies within each task before the shuffle.  The joins are
between stored tables, which adaptive execution splits where one chunk fills
many documents.

Defined results: a null or empty text stays as it is; lines without a word
begin and end no chunk, and go where they stand between two that are removed
together; rows without an id come after all others (then by a hash of their
text); rows that agree in id and text are one record repeated and all keep what
it keeps; a repeat that overlaps its own first occurrence (one line three times
or more) loses only what lies beyond it; of runs that overlap, each line stays
somewhere, though not each run in one place; an empty table gives an empty
result; other columns are carried (one named ``lines_removed`` is replaced).
Ids are integers.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import packed, row_key, stored, unpacked

WINDOW = 2              # lines that a boundary depends on
NOT_ONE_IN = 32
MAX_LINES = 32          # with a word, of a chunk and of what follows it
HAS_WORD = r"[^\x20\x09-\x0D]"
_MULTIPLIER = np.uint64(0x9E3779B97F4A7C15)


def rolling(hashes: np.ndarray) -> np.ndarray:
    """Hash of the last WINDOW line hashes at each line."""
    roll = np.zeros(len(hashes), np.uint64)
    for back in range(WINDOW):
        roll[back:] = roll[back:] * _MULTIPLIER + hashes[:len(hashes) - back]
    return roll


def chunks(hashes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
    """(begin, end, follows, digest) of the chunks of texts whose line hashes
    stand one after the other, ``size`` lines each: numbers of lines, the last
    ones included; ``follows`` is the last line before the next boundary."""
    last = np.repeat(np.cumsum(size) - 1, size)
    first = last - np.repeat(size, size) + 1
    line = np.arange(len(hashes))
    at = (rolling(hashes) >> np.uint64(32)) % np.uint64(NOT_ONE_IN) != 0
    at &= line - first >= WINDOW - 1
    places = np.append(np.flatnonzero(at), len(hashes))

    def next_at(i):             # the first boundary from a line on
        return places[np.searchsorted(places, i)]
    begin = line[line < last]
    end = np.minimum(np.minimum(next_at(begin + 1), last[begin]), begin + MAX_LINES - 1)
    follows = np.minimum(np.minimum(next_at(end + 1) - 1, last[begin]), end + MAX_LINES)
    digest = np.zeros(len(begin), np.uint64)
    on = np.arange(len(begin))
    for k in range(MAX_LINES):
        on = on[begin[on] + k <= end[on]]
        if not len(on):
            break
        mixed = hashes[begin[on] + k] ^ hashes[begin[on] + k] >> np.uint64(29)
        digest[on] = (digest[on] + mixed) * _MULTIPLIER
    return begin, end, np.maximum(follows, end), digest


def _chunked(batches):
    for b in batches:
        lines = b.column(2)
        upto = lines.offsets.to_numpy()
        own = slice(upto[0], upto[-1])
        h = lines.values.field(0).to_numpy(zero_copy_only=False).view(np.uint64)[own]
        place = lines.values.field(1).to_numpy(zero_copy_only=False)[own]
        size = np.diff(upto)
        begin, end, follows, digest = chunks(h, size)
        row = pa.array(np.repeat(np.arange(len(size)), size)[begin])
        n = follows - end                   # the lines with a word that follow
        edge = np.concatenate([[0], np.cumsum(n)])
        after = place[np.arange(edge[-1]) - np.repeat(edge[:-1], n) + np.repeat(end + 1, n)]
        yield pa.RecordBatch.from_arrays(
            [b.column(0).take(row), b.column(1).take(row), pa.array(place[begin].astype(np.int32)),
             pa.array((place[end] - place[begin] + 1).astype(np.int32)),
             pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(after.astype(np.int32))),
             pa.array(digest.view(np.int64))],
            ["k1", "k2", "first", "n", "after", "digest"])


def _runs(batches):
    """Removed places as runs: where the lines that stay begin and end."""
    for b in batches:
        begin, end, n = [], [], []
        for gone in b.column(2).to_pylist():
            lines = np.unique(np.concatenate([np.arange(g["at"], g["at"] + g["n"]) for g in gone]))
            step = np.flatnonzero(np.diff(lines) > 1)
            begin.append([0, *(lines[step] + 1).tolist(), int(lines[-1]) + 1])
            end.append([int(lines[0]), *lines[step + 1].tolist(), -1])      # -1: of the text
            n.append(len(lines))
        ints = pa.list_(pa.int32())
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(begin, ints), pa.array(end, ints), pa.array(n, pa.int32())],
            ["k1", "k2", "begin", "end", "n"])


def _with(value, use):
    """``use`` of a value that is computed once per row."""
    return F.transform(F.array(value), use)[0]


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(k1, k2, at, n) of the lines to remove, by row key; ``docs`` has the
    row key columns, __doc_id and __text.  Places may overlap."""
    lines = F.split("__text", "\n")
    worded = F.filter(F.transform(lines, lambda x, i: F.when(
        F.rlike(x, F.lit(HAS_WORD)), F.struct(F.xxhash64(x).alias("h"), i.alias("place")))), F.isnotnull)
    hashed = docs.where("__text is not null").select("__k1", "__k2", worded.alias("lines"))
    found = stored(hashed.mapInArrow(
        _chunked, "k1 long, k2 long, first int, n int, after array<int>, digest long"), "chunks")
    again = stored(found.groupBy("digest").agg(F.count(F.lit(1)).alias("copies"))
                   .where("copies > 1").select(F.col("digest").alias("again")), "again")
    marked = found.join(again, F.col("digest") == F.col("again")).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("first", "n", "after", "digest")).alias("marks"))
    marked = stored(marked, "marked")       # as many as the document has lines

    def cut(x, m):
        """A chunk's text, and the texts of the lines that follow it."""
        edge = F.concat(F.array(m["first"] + m["n"] - 1), m["after"])
        return F.struct(m["first"].alias("first"), m["n"].alias("n"), m["after"].alias("after"), m["digest"].alias("digest"),
                        F.array_join(F.slice(x, m["first"] + 1, m["n"]), "\n").alias("chunk"),
                        F.transform(m["after"], lambda e, i: F.array_join(
                            F.slice(x, edge[i] + 2, e - edge[i]), "\n")).alias("texts"))
    texts = _with(lines, lambda x: F.transform("marks", lambda m: cut(x, m)))
    # texts are dealt out by key at every size, also where the marks would
    # still fit a broadcast: one plan, whose cost is in proportion to the texts
    seen = (docs.join(marked.hint("merge"), (F.col("__k1") == F.col("k1")) & (F.col("__k2") == F.col("k2")))
            .select("__doc_id", "k1", "k2", F.explode(texts).alias("m"))
            .select("__doc_id", "k1", "k2", "m.*"))
    seen = stored(seen, "seen")
    place = F.struct(F.col("__doc_id").isNull().alias("late"), "k1", "k2", "first")
    kept = stored(seen.groupBy(F.col("digest").alias("d"), F.col("chunk").alias("p"))
                  .agg(F.min(F.struct(place.alias("at"), F.col("texts").alias("texts"))).alias("kept"),
                       F.count(F.lit(1)).alias("copies")).where("copies > 1").drop("copies"), "kept")
    at = "kept.at."
    own = ((F.col(at + "late") == F.col("__doc_id").isNull()) & (F.col(at + "k1") == F.col("k1"))
           & (F.col(at + "k2") == F.col("k2")))
    differs = F.array_position(F.zip_with("texts", "kept.texts", lambda a, b: a.eqNullSafe(b)), False)
    same = F.when(differs > 0, differs - 1).otherwise(F.size("texts")).cast("int")
    more = F.when(F.col("same") > 0, F.element_at("after", F.greatest(F.col("same"), F.lit(1)))
                  - F.col("first") - F.col("n") + 1).otherwise(0)
    over = F.when(own, F.least(F.greatest(F.col(at + "first") + F.col("all") - F.col("first"), F.lit(0)), F.col("all"))).otherwise(0)
    return (seen.join(kept, (F.col("digest") == F.col("d")) & (F.col("chunk") == F.col("p")))
            .where(place != F.col("kept.at"))
            .withColumn("same", same).withColumn("all", F.col("n") + more).withColumn("over", over)
            .where("all > over")
            .select("k1", "k2", (F.col("first") + F.col("over")).alias("at"), (F.col("all") - F.col("over")).alias("n")))


def dedup_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its repeated runs of lines, and
    ``lines_removed`` (0 where nothing was)."""
    d = packed(docs, "doc_id", "text")
    d = d.select("*", *row_key(F.col("__doc_id"), F.col("__text")))
    gone = repeated_lines(d).groupBy("k1", "k2").agg(
        F.collect_set(F.struct("at", "n")).alias("gone"))
    ints = "array<int>"
    gone = stored(gone.mapInArrow(_runs, f"k1 long, k2 long, begin {ints}, end {ints}, n int"), "gone")
    out = d.join(gone.hint("merge"), (F.col("__k1") == F.col("k1")) & (F.col("__k2") == F.col("k2")), "left")
    left = _with(F.split("__text", "\n"), lambda x: F.array_join(F.flatten(F.zip_with(
        "begin", "end", lambda a, b: F.slice(x, a + 1, F.when(b < 0, F.size(x)).otherwise(b) - a))), "\n"))
    rest = F.when(F.col("n").isNull(), F.col("__text")).otherwise(left)
    removed = F.coalesce("n", F.lit(0))
    return out.select(*unpacked(docs.columns, ["lines_removed"], text=rest), removed.alias("lines_removed"))
