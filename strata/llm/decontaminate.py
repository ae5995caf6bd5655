"""Benchmark decontamination by pigeonhole edit matching.

A test item of m characters may occur in a document with up to
``ERRORS`` * m edits, k.  Cut into k + 1 pieces, at least one piece of it then
occurs unchanged.  One automaton finds all pieces of all items in a text (each
text is read once, whole); around each hit the item is compared by Myers'
bit-parallel distance, which lets the match begin and end anywhere near the
place that the hit implies.  Nothing is sampled or capped: a text that holds no
piece of an item within its budget cannot hold the item.

Items and texts are compared as lower-case words: ASCII other than letters and
digits counts as one space.  Every item that has a character in that form is
matched.  An item of fewer than ``MIN_CHARS`` characters counts only where the
part of the text that it matches begins and ends with words (at a space, an end
of the text, or beside a character of a script without spaces), so that "art"
is not found in "start"; an end inside a word is one edit more.

The automaton goes to every task, so its size is bounded: items are taken in
groups of about ``GROUP_BYTES``, one pass over the documents each.  Between two
groups the result so far is stored, and the group's broadcast and what was stored
before go: a task holds one group's automaton, however many there are.  Documents
are never shuffled or joined, so equal texts, hot sources and passages shared
by many documents spread as the input does.

Defined results: a null or empty text, or an item of null text or without a
letter or digit, matches nothing; repeated rows each get their result; of several places of one item in
a text the best, then the first, is returned; empty tables give empty results;
other columns are carried.
"""

from __future__ import annotations

import unicodedata
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

ERRORS = 0.08
MIN_CHARS = 40        # shorter items have to match whole words
GROUP_BYTES = 1 << 20

# ASCII other than letters and digits becomes a space
_SPACES = bytes(c if c >= 128 or chr(c).isalnum() else 32 for c in range(256))
_GAP = "\0"           # in a pattern: an end of a word; no text holds one
LEAKS = "array<struct<item_id:bigint,distance:int>>"


def plain(text: str) -> str:
    """Lower-case words of a text, one space between."""
    return b" ".join(text.lower().encode().translate(_SPACES).split()).decode()


def _spaceless(c: str) -> bool:
    """A character of a script that puts no space between words."""
    return c >= "\u2e80" or "\u0e00" <= c <= "\u0eff" or "\u1000" <= c <= "\u109f" or "\u1780" <= c <= "\u17ff"


@lru_cache(1 << 16)
def _parts(c: str) -> bool:
    """Whether a word may begin or end beside a character."""
    return _spaceless(c) or not (c.isalnum() or unicodedata.category(c)[0] == "M")


def whole_words(item: str) -> str:
    """The pattern of an item that has to match whole words."""
    return (_GAP * (not _parts(item[0])) + item + _GAP * (not _parts(item[-1])))


def best_match(item: str, text: str, most: int) -> int | None:
    """Least edit distance of ``item`` to any part of ``text``, None if over
    ``most`` (Myers' bit vectors, the whole pattern in one integer).  A gap in
    ``item`` equals whatever parts words."""
    if item in text:
        return 0
    m, masks = len(item), {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    if gaps := masks.get(_GAP):
        for c in set(text):
            if _parts(c):
                masks[c] = masks.get(c, 0) | gaps
    full, top = (1 << m) - 1, 1 << (m - 1)
    up, down, score, best = full, 0, m, m
    for c in text:
        eq = masks.get(c, 0)
        diag = (((eq & up) + up) ^ up) | eq | down
        rise = down | ~(diag | up) & full
        fall = up & diag
        score += bool(rise & top) - bool(fall & top)
        best = min(best, score)
        rise = rise << 1 & full
        fall = fall << 1 & full
        up = fall | ~(diag | rise) & full
        down = rise & diag
    return best if best <= most else None


class Matcher:
    """Finds items in texts."""

    def __init__(self, items: list[tuple[int, str]]):
        self.items = []
        found: dict[str, list[tuple[int, int]]] = {}
        for item_id, text in items:
            text = plain(text)
            if not text:
                continue
            most = int(ERRORS * len(text))
            at = [round(j * len(text) / (most + 1)) for j in range(most + 2)]
            for a, b in zip(at, at[1:]):
                found.setdefault(text[a:b], []).append((len(self.items), a))
            self.items.append((item_id, text if len(text) >= MIN_CHARS else whole_words(text), most,
                               len(text) < MIN_CHARS))
        self.auto = ahocorasick.Automaton()
        for piece, where in found.items():
            self.auto.add_word(piece, (len(piece), where))
        if found:
            self.auto.make_automaton()

    def leaks(self, text: str | None) -> list[dict]:
        """The items in a text: the id and the least distance of each."""
        if not text or not self.items:
            return []
        text = plain(text)
        starts: dict[int, set[int]] = {}
        for end, (size, where) in self.auto.iter(text):
            for item, at in where:
                starts.setdefault(item, set()).add(end + 1 - size - at)
        out, ends = [], f"{_GAP}{text}{_GAP}"
        for item, places in sorted(starts.items()):
            item_id, pattern, most, short = self.items[item]
            best, done = None, []
            for s in sorted(places):    # windows that touch are searched as one
                lo, hi = max(0, s - most), s + len(pattern) + most
                if done and lo <= done[-1][1]:
                    done[-1][1] = hi
                else:
                    done.append([lo, hi])
            for lo, hi in done:
                # of ends, one character more on both sides
                d = best_match(pattern, ends[lo:hi + 2] if short else text[lo:hi], most)
                if d is not None and (best is None or d < best):
                    best = d
                if best == 0:
                    break
            if best is not None:
                out.append({"item_id": item_id, "distance": best})
        return out


def item_groups(items: DataFrame) -> list[list[tuple[int, str]]]:
    """(item_id, text) in groups of about GROUP_BYTES, one at a time."""
    items = items.select("item_id", "text").where("text is not null")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = -(-size // GROUP_BYTES)
    for g in range(n):
        rows = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == g)
        yield sorted(((r.item_id, r.text) for r in rows.collect()), key=str)


def _delete(spark: SparkSession, path: str) -> None:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """``docs`` beside ``leaks``: the items that each text contains, as
    (doc: struct of the columns, leaks)."""
    cols = [F.col(f"`{c}`") for c in docs.columns]
    d = docs.select(F.struct(*cols).alias("doc"),
                    F.array().cast(LEAKS).alias("leaks"))
    place = docs.columns.index("text")
    spark, shared, path = docs.sparkSession, None, None
    for group in item_groups(items):
        if shared is not None:
            before, path = path, scratch_path(spark, "llm-leaks")
            d.write.parquet(path)
            d = spark.read.schema(d.schema).parquet(path)
            shared.destroy()
            if before is not None:
                _delete(spark, before)
        shared = spark.sparkContext.broadcast(group)

        def run(batches, shared=shared):
            matcher = Matcher(shared.value)
            for b in batches:
                texts = b.column(0).field(place)
                more = [had + matcher.leaks(t.as_py())
                        for had, t in zip(b.column(1).to_pylist(), texts)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0), pa.array(more, b.schema.field(1).type)], ["doc", "leaks"])

        d = d.mapInArrow(run, d.schema)
    return d
