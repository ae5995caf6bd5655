"""Grouping of spelling variants by a bit-sliced position index.

Words are counted over all texts.  Two words are near if one inserted, deleted
or replaced character tells them apart; a word's form is the near word that
occurs most, if that occurs ``RATIO`` times as often as the word itself.

*Groups.*  Of two near words, of which the shorter has s characters, either the
first s // 2 are the same or the last s - s // 2 are.  So each word enters the
groups of its first and of its last half, once as the shorter and once as the
longer of two; near words meet in one group at least, and are counted in one
only (the group of last halves leaves out those of equal first halves).

*Index.*  For every position and letter a bit set says which words of a block
have that letter there.  A query goes through its letters once, for all words
of the block in parallel: ``same`` are the words without an error so far,
``replaced``, ``longer`` and ``shorter`` those with one, compared at the same
position, the next one and the one before.  Small groups share a block; a bit
set per group keeps them apart.

Groups are counted first.  One of more than ``CHARS`` characters is split into
k parts, of which every one meets every other in a task of its own, so no task
holds more than one part as index and one as queries.  Of a word's near words
only their number and the most frequent leave a block.  Forms are followed by
joining the table of forms with itself; each form occurs ``RATIO`` times as
often as its word, so the rounds are the logarithm of a logarithm of the
largest count.

Defined results: null and empty texts have no words; a null id reads as empty;
repeated rows count each time; an empty table gives an empty result; other
columns are not used.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import stored

MIN_LETTERS = 7
MIN_COUNT = 2
RATIO = 10
ONE_IN = 31             # occurrences that lose a character
BLOCK = 256             # words of small groups in a block, at least
CHARS = 1 << 19         # characters of a group that is split
CELLS = 1 << 22         # words times queries at a time
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def vocabulary(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n): letter runs of at least MIN_LETTERS that occur MIN_COUNT times,
    A-Z in lower case, less one character of every ONE_IN-th occurrence."""
    run = f"[A-Za-z\\u00C0-\\u00FF]{{{MIN_LETTERS},}}"
    each = docs.select(F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.lit("")).alias("id"),
                       F.explode(F.regexp_extract_all(F.col(f"`{text}`"), F.lit(run), F.lit(0))).alias("run"))
    each = each.select("id", F.translate("run", UPPER, UPPER.lower()).alias("run"))
    h = F.crc32(F.concat("id", F.lit(":"), "run").cast("binary"))
    each = each.select("run", h.alias("h"))
    at = F.col("h") % F.char_length("run")
    less = F.concat(F.substring("run", F.lit(1), at.cast("int")),
                    F.substring("run", at.cast("int") + 2, F.char_length("run")))
    word = F.when(F.col("h") % ONE_IN == 0, less).otherwise(F.col("run"))
    return (each.select(word.alias("word")).where(F.char_length("word") >= MIN_LETTERS)
            .groupBy("word").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= MIN_COUNT))


def _keys(word: Column) -> Column:
    """The groups of a word: which half, length of the shorter of two, half."""
    m = F.char_length(word)

    def of(s: Column) -> list[Column]:
        p = (s / 2).cast("int")
        return [F.struct(F.lit("f").alias("half"), s.alias("s"), F.left(word, p).alias("part")),
                F.struct(F.lit("l").alias("half"), s.alias("s"), F.right(word, s - p).alias("part"))]
    return F.when(m > MIN_LETTERS, F.array(*of(m), *of(m - 1))).otherwise(F.array(*of(m)))


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, top_n, top) of the words with a near word: how many, and
    the most frequent (the first of equals).  ``words`` is a stored table of
    distinct words and their counts n."""
    keyed = words.select("word", "n", F.explode(_keys(F.col("word"))).alias("key")).select("word", "n", "key.*")
    sizes = keyed.groupBy("half", "s", "part").agg(
        F.count(F.lit(1)).alias("words"), F.ceil(F.sum(F.char_length("word")) / CHARS).cast("int").alias("k"))
    sizes = stored(sizes.where("words > 1").drop("words"), "groups")
    keyed = keyed.join(sizes, ["half", "s", "part"])
    own = F.pmod(F.xxhash64("word"), F.col("k")).cast("int")
    several = F.flatten(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.array(
        F.struct((own * F.col("k") + j).alias("cell"), F.lit(True).alias("index"), F.lit(False).alias("query")),
        F.struct((j * F.col("k") + own).alias("cell"), F.lit(False).alias("index"), F.lit(True).alias("query")))))
    both = F.array(F.struct(F.lit(0).alias("cell"), F.lit(True).alias("index"), F.lit(True).alias("query")))
    dealt = keyed.select("half", "s", "part", "word", "n",
                         F.explode(F.when(F.col("k") == 1, both).otherwise(several)).alias("c"))
    dealt = dealt.select("half", "s", "part", "c.cell", "c.index", "c.query", "word", "n")
    group = ["half", "s", "part", "cell"]
    found = dealt.repartition(*group).sortWithinPartitions(*group).mapInArrow(
        _found, "word string, hits long, top_n long, top string")
    best = F.min(F.struct((-F.col("top_n")).alias("n"), F.col("top").alias("word")))
    return found.groupBy("word").agg(F.sum("hits").alias("n_near"), best.alias("best")).select(
        "word", "n_near", (-F.col("best.n")).alias("top_n"), F.col("best.word").alias("top"))


def _found(batches):
    """Near words within each group of a sorted partition, in blocks of whole groups."""
    rest = None
    for b in batches:
        t = pa.Table.from_batches([b])
        rest = t if rest is None else pa.concat_tables([rest, t]).combine_chunks()
        if rest.num_rows < BLOCK:
            continue
        begin = _begins(rest)
        if begin[-1]:
            yield from _blocks(rest.slice(0, begin[-1]), begin[:-1])
            rest = rest.slice(begin[-1]).combine_chunks()
    if rest is not None and rest.num_rows:
        yield from _blocks(rest, _begins(rest))


def _begins(t: pa.Table) -> np.ndarray:
    """Where the groups of a table begin."""
    new = np.zeros(t.num_rows, bool)
    new[0] = True
    for c in range(4):
        x = t.column(c).combine_chunks()
        x = x.dictionary_encode().indices if pa.types.is_string(x.type) else x
        new[1:] |= np.diff(x.to_numpy(zero_copy_only=False)) != 0
    return np.flatnonzero(new)


def _blocks(t: pa.Table, begin: np.ndarray):
    edge = [*begin.tolist(), t.num_rows]
    k = 0
    while k < len(begin):
        to = k + 1
        while to < len(begin) and edge[to + 1] - edge[k] <= BLOCK:
            to += 1
        own = t.slice(edge[k], edge[to] - edge[k])
        group = np.repeat(np.arange(to - k), np.diff(edge[k:to + 1]))
        yield from _searched(own, group)
        k = to


def _bits(flags: np.ndarray) -> np.ndarray:
    """Rows of flags as rows of 64-bit words."""
    wide = -flags.shape[1] % 64
    packed = np.packbits(np.pad(flags, ((0, 0), (0, wide))), axis=1, bitorder="little")
    return packed.view(np.uint64)


def _letters(words: list[str], wide: int) -> np.ndarray:
    """Letters of words by position, 0 beyond the end."""
    out = np.zeros((len(words), wide), np.uint8)
    size = np.array([len(w) for w in words])
    out[np.arange(wide) < size[:, None]] = np.frombuffer("".join(words).encode("latin-1"), np.uint8)
    return out


def _searched(t: pa.Table, group: np.ndarray):
    """(word, hits, top_n, top) of a block's queries among its index words."""
    half, s, index, query = (t.column(c).to_numpy() for c in ("half", "s", "index", "query"))
    word, n = t.column("word").to_pylist(), t.column("n").to_numpy()
    v = np.flatnonzero(index)
    v = np.array(sorted(v.tolist(), key=lambda k: (-n[k], word[k])), np.int64)  # the first hit is the best
    q = np.flatnonzero(query)
    if not len(v) or not len(q):
        return
    size = np.array([len(w) for w in word])
    wide = int(size.max()) + 1
    there = _letters([word[k] for k in v], wide + 1)
    alphabet = np.unique(there)
    number = np.full(256, len(alphabet), np.int64)      # a letter that no index word has
    number[alphabet] = np.arange(len(alphabet))
    step = max(1, CELLS // len(v))
    for a in range(0, len(q), step):
        own = q[a:a + step]
        letter = number[_letters([word[k] for k in own], wide)]

        def at(position):       # by letter, the words that have it there
            flags = np.zeros((len(alphabet) + 1, len(v)), bool)
            if position >= 0:
                flags[:-1] = there[:, position] == alphabet[:, None]
            return _bits(flags)
        same = _bits(group[v] == group[own][:, None])
        replaced, longer, shorter = (np.zeros_like(same) for _ in range(3))
        equal_half, p = np.zeros_like(same), s[own] // 2
        before, here = at(-1), at(0)
        for i in range(wide):
            equal_half[p == i] = same[p == i]
            after, x = at(i + 1), letter[:, i]
            agree = here[x]
            shorter = shorter & before[x] | same
            longer = (longer | same) & after[x]
            replaced = replaced & agree | same & ~agree
            same = same & agree
            before, here = here, after
        near = (replaced | longer | shorter) & ~same
        last = half[own] == "l"
        near[last] &= ~equal_half[last]
        long = size[own] > s[own]       # two longer ones meet in their own group
        near[long] &= _bits((size[v] == s[v])[None])
        rows, cols = np.nonzero(np.unpackbits(near.view(np.uint8), axis=1, bitorder="little"))
        if not len(rows):
            continue
        first = np.flatnonzero(np.diff(rows, prepend=-1))
        hits = np.diff([*first.tolist(), len(rows)])
        top = v[cols[first]]
        yield pa.RecordBatch.from_arrays(
            [pa.array([word[k] for k in own[rows[first]]], pa.string()), pa.array(hits, pa.int64()),
             pa.array(n[top], pa.int64()), pa.array([word[k] for k in top], pa.string())],
            ["word", "hits", "top_n", "top"])


def spelling_variants(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(word, n, n_near, form, form_n, root) of every word of the vocabulary;
    ``root`` is where following forms ends, the word itself if it has none."""
    words = stored(vocabulary(docs, doc_id, text), "words")
    near = words.join(near_words(words), "word", "left")
    is_form = F.col("top_n") >= RATIO * F.col("n")
    near = stored(near.select("word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
                              F.when(is_form, F.col("top")).alias("form"),
                              F.when(is_form, F.col("top_n")).alias("form_n")), "near")
    most = near.agg(F.max("n")).first()[0] or 1
    roots = near.where("form is not null").select("word", F.col("form").alias("root"))
    steps = 1
    while steps < math.log(most, RATIO):        # each doubling of the steps is a round
        on = roots.select(F.col("word").alias("root"), F.col("root").alias("next"))
        roots = stored(roots.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root")),
                       "roots")
        steps *= 2
    return near.join(roots, "word", "left").select(
        "word", "n", "n_near", "form", "form_n", F.coalesce("root", "word").alias("root"))
