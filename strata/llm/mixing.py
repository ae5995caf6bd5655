"""Mixing sources to target weights by a low-discrepancy schedule.

Each source's documents are shuffled (ordered by a keyed hash) and laid end to
end on a line of words, which is cut into equal blocks.  The mix is a sequence
of slots.  Slot i has the golden-ratio point ``frac((i + 1) * phi)``, which is
mapped through the sources' cumulative weights to a source; the slots of a
source are ranked in order, and its k-th slot takes its block ``k mod blocks``,
so every prefix of the mix is close to the weights.  A document is taken as
often as the blocks that cover it are.

Targets: sources by code point (null last) weigh 1, 2, 3, repeating, and share
100 % of all words; a target stops at ``MAX_EPOCHS`` times its source's size,
and the excess is shared again by weight until none is above.

Everything is DataFrame functions.  A hot source is never one task: shuffles
are by (source, hash bucket) for documents and by (source, run of slots) for
slots, running sums over the buckets and runs join the parts, and pieces of
documents meet slots by (source, block).  What one window sees whole is one
row per source, or per bucket of a source.

Defined results: a null source is a source of its own, the last; a null text
has size 0 and takes nothing, as does every text without words; rows that
repeat an id keep their own place on the line; a null id is ordered like an
empty one; an empty table gives an empty mix.  Other columns are carried; one
named like a result is replaced by it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import GAP, packed, stored, unpacked

MAX_EPOCHS = 3
PHI = 0.6180339887498949
BLOCK_WORDS = 16384      # words of a block, at most
MIN_BLOCKS = 2048        # blocks of a source, at least (of a word at least)
RUN = 65536              # slots ranked together
CELLS = 4096             # equal cells that a point is looked up by
SEED = "mix-1"
RESULTS = ["size", "source_size", "target", "taken", "first_slot"]
BUCKET_DIGITS = 3        # hexadecimal digits of the hash that deal out a source


def words_in(text: Column) -> Column:
    """Number of words in a text (null: 0)."""
    pieces = F.split(F.coalesce(text, F.lit("")), GAP)
    return F.size(F.filter(pieces, lambda w: w != "")).cast("long")


def source_targets(sizes: DataFrame) -> DataFrame:
    """(source, source_size, weight, target) from (source, size) rows."""
    s = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    s = s.withColumn("weight", (F.row_number().over(by_name) - 1) % 3 + 1)
    # Sources reach their limit in order of limit / weight.  With the first k
    # at their limits the rest share what is left by weight; the right k is
    # the first at which the next source stays within its limit.
    s = s.withColumn("cap", MAX_EPOCHS * F.col("source_size"))
    order = Window.orderBy(F.col("cap") / F.col("weight"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    s = s.withColumn("level", (F.sum("source_size").over(every)
                               - F.coalesce(F.sum("cap").over(before), F.lit(0)))
                     / (F.sum("weight").over(every)
                        - F.coalesce(F.sum("weight").over(before), F.lit(0))))
    # The level rises up to the first source within its limit, then falls.
    within = F.col("level") * F.col("weight") <= F.col("cap")
    final = F.max(F.when(within, F.col("level"))).over(every)
    return s.select("source", "source_size", "weight",
                    F.least(F.col("cap").cast("double"), final * F.col("weight")).alias("target"))


def plan(sizes: DataFrame, block_words: int = BLOCK_WORDS,
         min_blocks: int = MIN_BLOCKS) -> DataFrame:
    """``source_targets`` with each source's number (``sid``), ``blocks``, its
    ``quota`` in whole words, the words of its blocks (``long``, one more in the
    first ``extra``) and the span ``lo`` .. ``hi`` of points that it
    owns.  Spans are in proportion to target / block size, that is to slots."""
    t = source_targets(sizes)
    size = F.col("source_size")
    t = t.withColumn("blocks", F.greatest(
        F.ceil(size / F.lit(block_words)), F.least(size, F.lit(min_blocks)))).withColumn(
        "quota", F.round("target").cast("long"))
    t = t.withColumn("blocks", F.greatest("blocks", F.lit(1))).withColumns({
        "long": F.expr("source_size div blocks"), "extra": F.expr("source_size % blocks")})
    t = t.withColumn("slots", F.when(size > 0, F.col("target") * F.col("blocks") / size)
                     .otherwise(F.lit(0.0)))
    w = Window.orderBy(F.col("source").isNull(), F.col("source"))
    upto = F.sum("slots").over(w.rowsBetween(Window.unboundedPreceding, 0))
    # in the same order as the running sum, so that reruns agree to the bit
    total = F.sum("slots").over(w.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    t = t.withColumn("hi", upto / total).withColumn("total", total)
    return t.withColumn("sid", F.row_number().over(w) - 1).withColumn(
        "lo", F.coalesce(F.lag("hi").over(w), F.lit(0.0)))


def schedule(plan_: DataFrame, slots: int) -> DataFrame:
    """(sid, k, slot): the k-th slot (from 0) of each source among the first
    ``slots`` of the mix."""
    spark = plan_.sparkSession
    # each source beside the cells that its span touches
    cells = plan_.where("slots > 0").select("sid", "lo", "hi", F.explode(F.sequence(
        F.floor(F.col("lo") * CELLS), F.least(F.floor(F.col("hi") * CELLS), F.lit(CELLS - 1))
    )).alias("cell"))
    x = (F.col("id") + 1) * F.lit(PHI)
    s = spark.range(slots).select(F.col("id").alias("slot"), (x - F.floor(x)).alias("point"))
    s = s.withColumn("cell", F.floor(F.col("point") * CELLS))
    s = s.join(cells, "cell").where((F.col("point") >= F.col("lo")) & (F.col("point") < F.col("hi")))
    s = s.select("sid", "slot", F.expr(f"slot div {RUN}").alias("run"))
    runs = s.groupBy("sid", "run").agg(F.count(F.lit(1)).alias("n"))
    before = F.sum("n").over(Window.partitionBy("sid").orderBy("run")
                             .rowsBetween(Window.unboundedPreceding, -1))
    runs = runs.select("sid", "run", F.coalesce(before, F.lit(0)).alias("before"))
    rank = F.row_number().over(Window.partitionBy("sid", "run").orderBy("slot"))
    return s.withColumn("rank", rank).join(runs, ["sid", "run"]).select(
        "sid", (F.col("before") + F.col("rank") - 1).alias("k"), "slot")


def edge(block: Column) -> Column:
    """First word of a block on its source's line: the blocks are equal but
    for one word, the longer ones (``extra`` of them) first."""
    return block * F.col("long") + F.least(block, F.col("extra"))


def block_of(word: str) -> Column:
    """The block that holds a word of the line."""
    return F.expr(f"CASE WHEN {word} < extra * (long + 1) THEN {word} div (long + 1) "
                  f"ELSE extra + ({word} - extra * (long + 1)) div long END")


def placed(docs: DataFrame, plan_: DataFrame) -> DataFrame:
    """``docs`` (__doc_id, __source, __tie, size, ..) with the plan's columns
    and each row's place ``at`` on its source's line."""
    place = F.md5(F.concat(F.lit(SEED), F.coalesce(F.col("__doc_id").cast("string"), F.lit(""))))
    d = docs.withColumn("place", place).withColumn("bucket", F.substring("place", 1, BUCKET_DIGITS))
    sums = d.groupBy("__source", "bucket").agg(F.sum("size").alias("n"))
    up_to = Window.unboundedPreceding
    before = F.sum("n").over(Window.partitionBy("__source").orderBy("bucket").rowsBetween(up_to, -1))
    sums = sums.select(F.col("__source").alias("s"), F.col("bucket").alias("b"),
                       F.coalesce(before, F.lit(0)).alias("before"))
    sums = sums.join(plan_, F.col("s").eqNullSafe(F.col("source"))).drop("source")
    here = F.sum("size").over(Window.partitionBy("__source", "bucket")
                              .orderBy("place", "__doc_id", "size", "__tie").rowsBetween(up_to, -1))
    d = d.withColumn("here", F.coalesce(here, F.lit(0)))
    d = d.join(sums, F.col("__source").eqNullSafe(F.col("s")) & (F.col("bucket") == F.col("b")))
    return d.withColumn("at", F.col("before") + F.col("here")).withColumn(
        "to", F.col("at") + F.col("size")).drop("s", "b", "before", "here", "place", "bucket")


def mix(docs: DataFrame, *, block_words: int = BLOCK_WORDS, min_blocks: int = MIN_BLOCKS,
        carry: list[str] | None = None) -> DataFrame:
    """``docs`` (its columns, or those in ``carry``) with size, source_size,
    target, taken and first_slot (the slot of the mix that first takes a word
    of it; null if none does).  Needs columns doc_id, text and source.  Carry
    keys rather than texts: rows are sorted and joined on the way."""
    carry = docs.columns if carry is None else carry
    d = packed(docs, "doc_id", "source", "text")
    d = d.select(F.struct(*unpacked(carry, RESULTS), F.lit(0).alias("__none")).alias("__row"), "__doc_id", "__source",
                 F.xxhash64("__text").alias("__tie"), words_in(F.col("__text")).alias("size"))
    d = stored(d, "sizes")
    p = stored(plan(d.select(F.col("__source").alias("source"), "size"), block_words, min_blocks),
               "plan")
    total = p.agg(F.max("total")).first()[0] or 0.0
    # some more than the quotas need, so that no source is left short by the
    # schedule's small unevenness; what is beyond a quota is cut below
    slots = schedule(p, int(total * 1.05) + 1024 if total else 0)
    s = slots.join(p.select("sid", "source_size", "blocks", "long", "extra", "quota"), "sid")
    s = s.withColumn("block", F.col("k") % F.col("blocks"))
    s = s.withColumn("first", edge(F.col("block")))
    done = F.expr("(k div blocks) * source_size") + F.col("first")
    last = F.least(edge(F.col("block") + 1), F.col("first") + F.col("quota") - done)
    s = s.select("sid", "block", "slot", "first", last.alias("last")
                 ).where(F.col("last") > F.col("first"))
    # at most MAX_EPOCHS rows of a block
    given = s.groupBy("sid", "block").agg(
        F.collect_list(F.struct("first", "last", "slot")).alias("gives"))
    d = stored(placed(d, p.drop("weight", "total", "lo", "hi", "slots")), "placed")
    pieces = d.where("size > 0").select("sid", "at", "to", F.explode(F.sequence(
        block_of("at"), block_of("(to - 1)"))).alias("block"))
    none = F.lit(0).cast("long")
    over = lambda g: F.greatest(none, F.least(g["last"], F.col("to"))
                                - F.greatest(g["first"], F.col("at")))
    met = pieces.join(given, ["sid", "block"]).select(
        "sid", "at", F.aggregate("gives", none, lambda a, g: a + over(g)).alias("taken"),
        F.array_min(F.transform(F.filter("gives", lambda g: over(g) > 0),
                                lambda g: g["slot"])).alias("slot"))
    taken = met.groupBy(F.col("sid").alias("tsid"), F.col("at").alias("tat")).agg(
        F.sum("taken").alias("taken"), F.min("slot").alias("slot"))
    out = d.join(taken, (F.col("size") > 0) & (F.col("sid") == F.col("tsid"))
                 & (F.col("at") == F.col("tat")), "left")
    return out.select(*unpacked(carry, RESULTS), "size", "source_size", "target",
                      F.coalesce("taken", none).alias("taken"), F.col("slot").alias("first_slot"))
