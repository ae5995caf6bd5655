"""Substring de-duplication with a gear rolling hash.

Texts are cut into variable chunks where a gear hash of the last 16 bytes says
so, at word ends (or, in scripts of three-byte characters, which have no
spaces, between characters), so an insertion moves no boundary but its own.
More than ``JOINED`` bytes without white space (encoded data, joined words) are
cut between any characters, by the hash alone.  Only where the bytes repeat so
that the hash says nothing are there cuts every ``MAX_CHUNK`` bytes.
The fewest chunks from each one on, and up to each one, that make ``MIN_RUN``
bytes are a *window*; windows are compared by a 64-bit digest of their bytes over all documents.  What is
covered by windows that occur elsewhere is a *shared* span.  Windows in a row
that are not the first occurrences, by (doc_id, place), and whose first
occurrences follow each other in one document, are a *removed* span: each stands
there as a whole, in the same words.  So nothing is removed whose only copies
are pieces in different documents.  Where two removed spans would overlap, the
second begins at the first one's end.  Of n windows some n * n / 2**65
agree by chance, far below one at 10**9 windows.

The gear hash is computed for a whole Arrow batch at once.  Windows are counted
with partial aggregation; the joins meet at stored tables, so a passage that a
third of all documents share is split by adaptive execution; a document's
windows come together again only as that document's marks.

Defined results: null and empty texts have no chunks and stay; rows without an
id are ordered after all others by a hash of their text; rows that share an
id are parts of one document; rows that agree in text as well are one record
repeated, with equal results; a copy that overlaps its first occurrence stays; an
empty table gives an empty result; other columns are carried by
``dedup_substrings`` (one named ``removed`` is replaced).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import packed, stored, unpacked

REACH = 16            # bytes that a boundary depends on
ONE_IN = 4            # words per boundary, on average
ONE_IN_WIDE = 16      # three-byte characters per boundary, on average
ONE_IN_ANY = 32       # characters per boundary, on average, beyond JOINED bytes without white space
JOINED = 32           # at least twice REACH, so that no boundary depends on the text before
MAX_CHUNK = 1024      # bytes
MIN_RUN = 112         # bytes, some twenty words
_GEAR = np.random.default_rng(6).integers(0, 1 << 16, 256, dtype=np.uint16)


def gear(data: np.ndarray) -> np.ndarray:
    """Hash of the last REACH bytes at each byte: sum of GEAR[byte] << age,
    in 16 bits, by doubling the reach."""
    h, k = _GEAR[data], 1
    while k < REACH:
        h[k:] = h[k:] + (h[:-k] << np.uint16(k))
        k *= 2
    return h


def cuts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[list[int]]:
    """Chunk ends of each text, given where the texts lie in ``data``."""
    if not len(data):
        return [[] for _ in starts]
    h = gear(data) >> np.uint16(4)
    space = (data == 32) | (data >= 9) & (data <= 13)
    whole = np.ones(len(data), bool)        # a character ends here
    whole[:-1] = data[1:] & 0xC0 != 0x80
    wide = np.zeros(len(data), bool)
    wide[2:] = (data[:-2] >= 0xE0) & (data[2:] & 0xC0 == 0x80)
    wide = wide & whole & (h % np.uint16(ONE_IN_WIDE) == 0)
    cut = space & (h % np.uint16(ONE_IN) == 0) | wide
    cut[_joined(h, space, whole, starts)] = True
    at = np.flatnonzero(cut) + 1
    lo = np.searchsorted(at, starts + REACH, "right")   # none that saw bytes before the text
    hi = np.searchsorted(at, ends, "left")
    out = []
    for s, e, a, b in zip(starts.tolist(), ends.tolist(), lo.tolist(), hi.tolist()):
        own, last = [], s
        for c in [*at[a:b].tolist(), e]:
            while c - last > MAX_CHUNK:
                last = _between(data, last + MAX_CHUNK)
                own.append(last)
            if c > last:
                own.append(c)
                last = c
        out.append(own)
    return out


def _joined(h: np.ndarray, space: np.ndarray, whole: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Where the hash asks for a boundary inside a stretch without white space:
    not in its first JOINED bytes, and not within REACH bytes of another such
    place, which constant bytes would have everywhere."""
    at = np.flatnonzero(whole & (h % np.uint16(ONE_IN_ANY) == 0))
    at = at[np.diff(at, prepend=-REACH - 1) > REACH]
    spaces = np.flatnonzero(space)
    begin = np.concatenate([[0], spaces + 1])[np.searchsorted(spaces, at, "right")]
    begin = np.maximum(begin, starts[np.searchsorted(starts, at, "right") - 1])
    return at[at - begin >= JOINED]


def _between(data: np.ndarray, i: int) -> int:
    """The last place between characters up to ``i``."""
    while data[i] & 0xC0 == 0x80:
        i -= 1
    return i


def _chunked(batches):
    for b in batches:
        texts = b.column(2).cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
        buffer = texts.buffers()[2]
        data = np.frombuffer(buffer, np.uint8)[:offsets[-1]] if buffer else np.zeros(0, np.uint8)
        raw, digest = memoryview(data.tobytes()), xxhash.xxh3_64_intdigest
        size, upto, digests, windows = [], [0], [], [0]
        for s, ends in zip(offsets.tolist(), cuts(data, offsets[:-1], offsets[1:])):
            edge = np.array([s, *ends])
            size += np.diff(edge).tolist()
            upto.append(len(size))
            begin, end = windows_of(edge)
            digests += [digest(raw[a:e]) for a, e in zip(begin.tolist(), end.tolist())]
            windows.append(len(digests))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1),
             pa.ListArray.from_arrays(pa.array(upto, pa.int32()), pa.array(size, pa.int32())),
             pa.ListArray.from_arrays(pa.array(windows, pa.int32()),
                                      pa.array(np.array(digests, np.uint64).view(np.int64)))],
            ["ord", "part", "sizes", "digests"])


def windows_of(edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(begin, end) of the windows, in order, given the chunks' edges."""
    n, k = len(edge), np.arange(len(edge))
    to = np.searchsorted(edge, edge + MIN_RUN)                      # the first end for each begin
    of = np.searchsorted(edge, edge - MIN_RUN, "right") - 1         # the last begin for each end
    pairs = np.unique(np.concatenate([(k * n + to)[to < n], (of * n + k)[of >= 0]]))
    return edge[pairs // n], edge[pairs % n]


def document_order(doc_id: Column, text: Column) -> list[Column]:
    """(ord, part): rank of a row among documents, and its part of the one id."""
    h = F.xxhash64(text)
    late = F.shiftrightunsigned(h, 2).bitwiseOR(F.lit(1 << 62))
    part = (h % F.lit(1 << 31)).cast("int")
    return [F.coalesce(doc_id.cast("long"), late).alias("ord"), part.alias("part")]


def spans_of(chunks: DataFrame) -> DataFrame:
    """(ord, part, shared, removed) of the documents with a shared span: arrays
    of (start, end, first: the ord of the first document that has its first
    window), in bytes.  ``chunks`` is a stored table as made by ``_chunked``."""
    each = chunks.select("ord", "part", F.posexplode("digests").alias("i", "d"))
    first = stored(each.groupBy("d").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("ord", "part", "i")).alias("first"))
                   .where("n > 1").select(F.col("d").alias("again"), "first.*")
                   .withColumnsRenamed({"ord": "ford", "part": "fpart", "i": "fi"}), "again")
    marks = each.join(first, F.col("d") == F.col("again")).groupBy("ord", "part").agg(
        F.sort_array(F.collect_set(F.struct("i", "ford", "fpart", "fi"))).alias("marks"))
    marks = stored(marks.select(F.col("ord").alias("mord"), F.col("part").alias("mpart"),
                                *[F.col(f"marks.{c}").alias(c) for c in ("i", "ford", "fpart", "fi")]), "marks")
    both = chunks.join(marks, (F.col("ord") == F.col("mord")) & (F.col("part") == F.col("mpart")))
    span = "array<struct<start:int,end:int,first:bigint>>"
    found = both.select("ord", "part", "sizes", "i", "ford", "fpart", "fi").mapInArrow(
        _spans, f"ord long, part int, n_bytes int, shared {span}, removed {span}")
    return found.where(F.size("shared") > 0).dropDuplicates(["ord", "part"])


def _spans(batches):
    for b in batches:
        shared, removed, total = [], [], []
        for k in range(b.num_rows):
            size, i, ford, fpart, fi = (b.column(c)[k].values.to_numpy(zero_copy_only=False) for c in range(2, 7))
            edge = np.concatenate([[0], np.cumsum(size)])
            begins, ends = windows_of(edge)
            begin, end = begins[i], ends[i]
            # covered by windows: a new span where one begins beyond the last one's end
            new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
            shared.append(_listed(begin, end, ford, new, len(i)))
            here = (ford == b.column(0)[k].as_py()) & (fpart == b.column(1)[k].as_py())
            apart = np.ones(len(i), bool)       # from a first occurrence in this text
            apart[here] = ends[fi[here]] <= begin[here]
            later = np.flatnonzero(apart)
            new = np.flatnonzero(np.concatenate([[True], (np.diff(i[later]) != 1) | (np.diff(ford[later]) != 0) | (
                np.diff(fpart[later]) != 0) | (np.diff(fi[later]) != 1)])) if len(later) else np.zeros(0, np.int64)
            copy_ends = np.where(here, ends[np.where(here, fi, 0)], -1)
            new = _apart(begin[later], copy_ends[later], new)
            removed.append(_listed(begin[later], end[later], ford[later], new, len(later)))
            total.append(int(edge[-1]))
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("first", pa.int64())]))
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(1), pa.array(total, pa.int32()), pa.array(shared, kind),
             pa.array(removed, kind)], ["ord", "part", "n_bytes", "shared", "removed"])


def _apart(begin: np.ndarray, copy_ends: np.ndarray, new: np.ndarray) -> np.ndarray:
    """``new`` with spans split where their copy in the same text would reach
    into the span itself."""
    out = []
    for a, z in zip(new.tolist(), [*new[1:].tolist(), len(begin)]):
        out.append(a)
        while copy_ends[z - 1] > begin[out[-1]]:
            out.append(out[-1] + int(np.searchsorted(copy_ends[out[-1]:z], begin[out[-1]], "right")))
    return np.array(out, np.int64)


def _listed(begin, end, first, new, n) -> list[dict]:
    """Spans from the windows numbered ``new`` each up to the next, none
    before the end of the one before."""
    out, upto = [], 0
    for a, z in zip(new.tolist(), [*new[1:].tolist(), n]):
        if end[z - 1] > upto:
            out.append({"start": max(int(begin[a]), upto), "end": int(end[z - 1]), "first": int(first[a])})
            upto = int(end[z - 1])
    return out


def find_repeats(docs: DataFrame) -> DataFrame:
    """(ord, part, n_bytes, shared, removed) of the documents that share a span."""
    d = docs.where("text is not null").select(
        *document_order(F.col("doc_id"), F.col("text")), "text")
    chunks = stored(d.mapInArrow(
        _chunked, "ord long, part int, sizes array<int>, digests array<long>"), "chunks")
    return spans_of(chunks)


def dedup_substrings(docs: DataFrame) -> DataFrame:
    """``docs`` with ``text`` less its removed spans, and ``removed`` (null if
    nothing was)."""
    found = stored(find_repeats(docs).where(F.size("removed") > 0).select("ord", "part", "removed"),
                   "removed")
    d = packed(docs, "doc_id", "text")
    o, p = document_order(F.col("__doc_id"), F.col("__text"))
    d = d.select("*", o.alias("__ord"), p.alias("__part"))
    d = d.join(found, (F.col("__ord") == F.col("ord")) & (F.col("__part") == F.col("part")), "left")
    # what lies between the removed spans, by bytes
    ends = F.concat(F.array(F.lit(0)), F.transform("removed", lambda s: s["end"]))
    starts = F.concat(F.transform("removed", lambda s: s["start"]),
                      F.array(F.octet_length("__text")))
    raw = F.col("__text").cast("binary")
    left = F.array_join(F.zip_with(ends, starts, lambda a, b: F.decode(
        F.substring(raw, a + 1, b - a), "UTF-8")), "")
    text = F.when(F.col("removed").isNull(), F.col("__text")).otherwise(left)
    return d.select(*unpacked(docs.columns, ["removed"], text=text), "removed")
