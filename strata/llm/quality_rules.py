"""Quality rules with adaptive thresholds.

Base rules (fixed) reject very short texts and texts made of repeated word
windows.  Every other cutoff is learned from the corpus: per document a few
integer metrics are computed, their distribution in each (lang, source) group
is summarised by a mergeable quantile sketch, and a document is rejected if a
metric lies beyond its group's far fence.

The sketch is a histogram over log-spaced integer bins (five significant
bits, so a bin is at most 1/32 wide relative to its value).  Sketches merge
by adding counts, which Spark does with partial aggregation before the
shuffle: a source holding a third of the corpus costs one row per task, group,
metric and bin.  They give the same result in any order of merging, so reruns
agree.  Groups with fewer than ``min_docs`` documents use the merged sketch of
their language, and languages with fewer use that of the whole corpus.

Everything is built from DataFrame functions.  Word windows are hashed and
compared inside the row, without a shuffle.

Defined results: a null text has no words (all counts 0) and fails the base
rules, as an empty one does; null lang or source form groups of their own;
repeated rows each get their verdict; an empty table gives an empty result;
other columns are carried untouched; one named like a result is replaced by it.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..plans.sizing import broadcast_limit, fits, measure
from .common import GAP, packed, stored, unpacked

WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
SYMBOLS = "#*$%&|<>"


@dataclass(frozen=True)
class Fence:
    """Far fences: q3 + k * max(q3 - q1, spread), and q1 - k * (...) below if
    ``two_sided``.  ``spread`` is the least width taken for the middle half,
    in the metric's unit, so that a constant metric does not reject all else."""
    metric: str
    spread: int
    two_sided: bool = False
    k: int = 6


#: Metrics in thousandths; mean word length in thousandths of a character.
FENCES = (
    Fence("symbols", 25),       # symbols per word
    Fence("marks", 25),         # exclamation and question marks per word
    Fence("upper", 50),         # upper-case letters per word character
    Fence("dup_lines", 75),     # lines equal to an earlier one, per line
    Fence("repeats", 50),       # words in repeated windows, per word
    Fence("word_len", 500, two_sided=True),
)


def count_of(text: Column, chars: str) -> Column:
    """How many characters of ``text`` are among ``chars`` (one-byte ones)."""
    rest = text
    for c in chars:
        rest = F.replace(rest, F.lit(c), F.lit(""))
    return F.octet_length(text) - F.octet_length(rest)


def metrics(docs: DataFrame) -> DataFrame:
    """``docs`` packed (see ``common.packed``) beside the counts of each text."""
    d = packed(docs, "text", "lang", "source").withColumn(
        "__text", F.coalesce(F.col("__text"), F.lit("")))
    d = d.withColumn("words", F.filter(F.split("__text", GAP), lambda w: w != ""))
    d = d.withColumn("hashes", F.transform("words", lambda w: F.xxhash64(w)))
    d = d.withColumn("lines", F.filter(F.split("__text", "\n"),
                                       lambda x: F.rlike(x, F.lit(r"[^\x20\x09-\x0D]"))))
    n = F.size("words")
    d = d.select(
        "__row", "__lang", "__source", "hashes",
        n.cast("long").alias("n_words"),
        F.char_length(F.array_join("words", "")).cast("long").alias("word_chars"),
        count_of(F.col("__text"), SYMBOLS).cast("long").alias("n_symbols"),
        count_of(F.col("__text"), "!?").cast("long").alias("n_marks"),
        F.char_length(F.regexp_replace("__text", r"\P{Lu}+", "")).cast("long").alias("n_upper"),
        F.size("lines").cast("long").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"))
    return _repeats(d)


def _repeats(d: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words covered by windows found twice or more."""
    h = F.col("hashes")
    d = d.withColumn("wins", F.when(F.col("n_words") >= WINDOW, F.transform(
        F.sequence(F.lit(0), F.size(h) - WINDOW),
        lambda i: F.xxhash64(*[h[i + j] for j in range(WINDOW)]))))
    # only texts with a repeated window go on to find where its copies are
    w = F.col("wins")
    d = d.withColumn("ranked", F.when(F.size(F.array_distinct(w)) < F.size(w), F.array_sort(
        F.transform(w, lambda x, i: F.struct(x.alias("h"), i.alias("i")))))).drop("wins", "hashes")
    r = F.col("ranked")
    same = lambda j, k: r[j]["h"] == r[k]["h"]
    d = d.withColumn("at", F.array_sort(F.transform(
        F.filter(F.sequence(F.lit(0), F.size(r) - 1),
                 lambda j: ((j > 0) & same(j, F.greatest(j - 1, F.lit(0))))
                 | ((j < F.size(r) - 1) & same(j, F.least(j + 1, F.size(r) - 1)))),
        lambda j: r[j]["i"]))).drop("ranked")
    at = F.col("at")
    covered = F.aggregate(
        F.when(F.size(at) > 1, F.transform(
            F.sequence(F.lit(1), F.size(at) - 1),
            lambda j: F.least(F.lit(WINDOW), at[j] - at[j - 1]))),
        F.lit(WINDOW), lambda acc, x: acc + x)
    return d.withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long")).drop("at")


def _with_values(m: DataFrame) -> DataFrame:
    per = lambda a, b: F.expr(f"1000 * {a} div greatest({b}, 1)")
    return m.withColumns({
        "symbols": per("n_symbols", "n_words"), "marks": per("n_marks", "n_words"),
        "upper": per("n_upper", "word_chars"), "dup_lines": per("n_dup_lines", "n_lines"),
        "repeats": per("n_repeat_words", "n_words"), "word_len": per("word_chars", "n_words"),
        "base_failed": (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))})


def bin_of(v: Column) -> Column:
    """Lower end of the sketch bin that holds the non-negative integer ``v``."""
    low = F.greatest(F.length(F.bin(v)) - 6, F.lit(0))
    return F.call_function("shiftleft", F.call_function("shiftright", v, low), low)


def sketches(m: DataFrame) -> DataFrame:
    """(lang, source, metric, bin, n) of the documents that pass the base
    rules; add up ``n`` over groups to merge their sketches."""
    long = m.where(~F.col("base_failed")).select("__lang", "__source", F.explode(F.array(*[
        F.struct(F.lit(f.metric).alias("metric"), bin_of(F.col(f.metric)).alias("bin"))
        for f in FENCES])).alias("v"))
    return long.groupBy("__lang", "__source", "v.metric", "v.bin").agg(F.count(F.lit(1)).alias("n"))


def _quartiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """(keys, metric, docs, q1, q3) read off the sketches merged by ``keys``."""
    merged = sketch.groupBy(*keys, "metric", "bin").agg(F.sum("n").alias("n"))
    w = Window.partitionBy(*keys, "metric")
    up_to = F.sum("n").over(w.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0))
    c = merged.select(*keys, "metric", "bin", up_to.alias("c"), F.sum("n").over(w).alias("t"))
    return c.groupBy(*keys, "metric").agg(
        F.max("t").alias("docs"),
        F.min(F.when(4 * F.col("c") >= F.col("t"), F.col("bin"))).alias("q1"),
        F.min(F.when(4 * F.col("c") >= 3 * F.col("t"), F.col("bin"))).alias("q3"))


def thresholds(sketch: DataFrame, min_docs: int) -> DataFrame:
    """One row per (lang, source): the fences of each metric, from the finest
    sketch (group, language, corpus) that has ``min_docs`` documents."""
    own = _quartiles(sketch, ["__lang", "__source"])
    lang = _quartiles(sketch, ["__lang"]).select(
        F.col("__lang").alias("l"), F.col("metric").alias("lm"), F.col("docs").alias("ld"),
        F.col("q1").alias("lq1"), F.col("q3").alias("lq3"))
    every = _quartiles(sketch, []).select(
        F.col("metric").alias("am"), F.col("q1").alias("aq1"), F.col("q3").alias("aq3"))
    t = (own.join(lang, F.col("__lang").eqNullSafe(F.col("l")) & (F.col("metric") == F.col("lm")))
         .join(every, F.col("metric") == F.col("am")))
    pick = lambda q: (F.when(F.col("docs") >= min_docs, F.col(q))
                      .when(F.col("ld") >= min_docs, F.col(f"l{q}")).otherwise(F.col(f"a{q}")))
    t = t.select("__lang", "__source", "metric", pick("q1").alias("q1"), pick("q3").alias("q3"))
    out = []
    for f in FENCES:
        width = f.k * F.greatest(F.col("q3") - F.col("q1"), F.lit(f.spread))
        of = F.col("metric") == f.metric
        out.append(F.max(F.when(of, F.col("q3") + width)).alias(f"hi_{f.metric}"))
        if f.two_sided:
            out.append(F.max(F.when(of, F.col("q1") - width)).alias(f"lo_{f.metric}"))
    return t.groupBy("__lang", "__source").agg(*out)


def quality_rules(docs: DataFrame, *, min_docs: int = 200,
                  carry: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns, or those in ``carry``) with the counts, the base
    verdict and ``kept``.  Needs columns text, lang and source."""
    m = metrics(docs)
    carry = docs.columns if carry is None else carry
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    m = _with_values(m.withColumn("__row", F.struct(*unpacked(carry, [*counts, "base_failed", "kept"]),
                                                    F.lit(0).alias("__none"))))
    m = stored(m.select("__row", "__lang", "__source", *counts, "base_failed",
                        *[f.metric for f in FENCES]), "quality")
    t = stored(thresholds(sketches(m), min_docs).select(
        F.col("__lang").alias("tl"), F.col("__source").alias("ts"), "*").drop("__lang", "__source"),
        "thresholds")
    # a row per (lang, source): while they fit, documents are not dealt out by
    # source to meet them; beyond that, adaptive execution splits hot sources
    if fits(*measure(t), broadcast_limit(m.sparkSession)):
        t = F.broadcast(t)
    j = m.join(t, F.col("__lang").eqNullSafe(F.col("tl"))
               & F.col("__source").eqNullSafe(F.col("ts")), "left")
    inside = ~F.col("base_failed")
    for f in FENCES:
        inside &= F.col(f.metric) <= F.col(f"hi_{f.metric}")
        if f.two_sided:
            inside &= F.col(f.metric) >= F.col(f"lo_{f.metric}")
    return j.select(*unpacked(carry, [*counts, "base_failed", "kept"]), *[F.col(c) for c in counts], F.col("base_failed"),
                    F.coalesce(inside, F.lit(False)).alias("kept"))
