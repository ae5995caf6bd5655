"""Repair of conversation structure at the least cost of edits.

A conversation's rows, by turn, are to read (a system row, then) user and
assistant rows by turns: role initials ``(s?(ua)+)?``.  Keeping a row costs 0,
giving it the role user or assistant 3, deleting it 4, inserting an empty row of
either role 3, and a truncated row that is not deleted 3 more; blank rows and
repeats have to be deleted.  Of the cheapest edits those are made whose
initials (Keep, Rerole, Delete, Insert) come first in ASCII order.

*Order.*  Equal rows are counted before anything is shuffled by conversation.
The others are dealt out by ranges of (conversation, turn, role, digest of role
and text), so a conversation of any length spreads over tasks, and cut into
*blocks* of ``ROWS`` at most.

*Costs.*  Between rows there are four states: nothing yet, after the system row,
after a user row, after an assistant row.  A block's cheapest costs from state
to state are a matrix; where a conversation has several blocks, products of
2, 4, 8... of them in a row (minimum of sums) give each block the costs from its
end to the conversation's.

*Path.*  A node is a row and a state.  Its arcs on a cheapest path lead to the
next nodes.  Nodes are ranked by the initials of the next 1, 2, 4... edits
(a rank is that of the pair of ranks here and where the pointer leads), and of
its arcs each node follows the one of the least initial and target rank; from a
node, an initial leads to one node only, so each string of initials has one
end, which is the doubled pointer.  The pointers give each block's exit for
every entry, and composed exits of 2, 4, 8... blocks give each block its entry.

*Result.*  Edits meet the rows' texts sorted by conversation; a task reads them
in a stream, as the digest of a conversation asks for, and holds of one
conversation its audit string only.

Defined results: a null role or text is one space, null turns come first and
count as no turn, a null conversation id is an id; rows of one turn follow each
other by role, then by digest; a conversation without rows has zeros and empty
strings; the initial of an empty role is empty; an empty table gives an empty
result; other columns are not used.
"""

from __future__ import annotations

from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import stored

ROWS = 512              # of a block
SLICE = 1 << 16         # rows solved at a time
SPACE = " \t\n\x0b\x0c\r"
NEVER = np.int64(1 << 50)
START, S, U, A = range(4)
INSERTED = np.array([U, U, A, U])           # the state that an inserted or rerolled row leads to
AT_END = np.array([0, 6, 3, 0], np.int64)   # inserts that complete a conversation
CLOSING = ("", "ua", "a", "")
NAMES = {"u": "user", "a": "assistant"}
BLANK, REPEAT, OPEN = 1, 2, 3


def damaged(rows: DataFrame) -> DataFrame:
    """Conversation rows (conv_id, turn, role, text, copies) with faults by
    crc32 of ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2
    removes its sentence ends, 3 repeats it, 4 makes its role user."""
    def filled(c):
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    fault = F.crc32(F.concat(filled("conv_id"), F.lit(":"), filled("turn")).cast("binary")) % 20
    d = rows.select("conv_id", "turn", filled("role").alias("role"), filled("text").alias("text"),
                    fault.alias("fault")).where("fault <> 0")
    text = F.when(F.col("fault") == 1, "").when(F.col("fault") == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
    return d.select("conv_id", "turn", F.when(F.col("fault") == 4, "user").otherwise(F.col("role")).alias("role"),
                    text.alias("text"), F.when(F.col("fault") == 3, 2).otherwise(1).alias("copies"))


def _ordered(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The distinct rows with their texts, and as slim rows with fault and n."""
    n = F.sum("copies" if "copies" in rows.columns else F.lit(1)).cast("long").alias("n")
    one = rows.select("conv_id", F.col("turn").cast("long").alias("turn"),
                      *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")],
                      *(["copies"] if "copies" in rows.columns else []))
    one = one.groupBy("conv_id", "turn", "role", "text").agg(n)
    digest = F.sha2(F.concat(F.char_length("role").cast("string"), F.lit(":"), F.col("role"), F.col("text")), 256)
    last = F.right(F.rtrim("text", F.lit(SPACE)), F.lit(1))
    one = stored(one.withColumn("digest", digest), "turns")
    slim = one.select("conv_id", "turn", "role", "digest", "n", last.alias("last"))
    place = F.struct(F.col("turn").isNotNull(), F.coalesce("turn", F.lit(0)))
    first = stored(slim.groupBy(F.col("conv_id").alias("c"), F.col("digest").alias("d")).agg(
        F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1"), "first")
    met = slim.join(first, F.col("conv_id").eqNullSafe(F.col("c")) & (F.col("digest") == F.col("d")), "left")
    fault = (F.when(F.col("last") == "", BLANK).when(F.col("first") != place, REPEAT)
             .when(~F.col("last").isin(".", "!", "?"), OPEN).otherwise(0))
    return one, met.select("conv_id", "turn", "role", "digest", "n", fault.alias("fault"))


# ---- blocks

def _block_schema(conv: T.DataType) -> T.StructType:
    text, long, number = T.ArrayType(T.StringType()), T.ArrayType(T.LongType()), T.ArrayType(T.IntegerType())
    return T.StructType([T.StructField(k, v) for k, v in (
        ("conv_id", conv), ("pid", T.IntegerType()), ("k", T.IntegerType()), ("turn", long), ("role", text),
        ("digest", text), ("n", long), ("fault", number), ("costs", long))])


def _blocked(rows: int):
    """Blocks of a sorted partition, each with its matrix of costs."""
    def run(batches):
        before, k = None, -1
        for t in batches:
            if not t.num_rows:
                continue
            conv = t.column(0).to_pylist()
            new = [i for i in range(1, len(conv)) if conv[i] != conv[i - 1]]
            k = k if k >= 0 and conv[0] == before else -1
            begin, ks = [], []
            for a, z in zip([0, *new], [*new, len(conv)]):
                for at in range(a, z, rows):
                    k += 1
                    begin.append(at)
                    ks.append(k)
                k = k if z == len(conv) else -1
            before = conv[-1]
            yield _matrices(pa.Table.from_batches([t]), begin, ks)
    return run


def _kinds(roles: list[str]) -> np.ndarray:
    return np.array(["sua".find(r[0]) + 1 if r else 0 for r in roles], np.int64)


def _prices(kind, fault, n):
    """Costs of a row's ways: to the system, user and assistant state, and of deleting it."""
    forced = (fault == BLANK) | (fault == REPEAT)
    base = np.where(forced, NEVER, 4 * (n - 1) + 3 * (fault == OPEN))
    return (np.minimum(base + np.where(kind == S, 0, NEVER), NEVER), np.minimum(base + 3 * (kind != U), NEVER),
            np.minimum(base + 3 * (kind != A), NEVER), 4 * n)


def _matrices(t: pa.Table, begin: list[int], ks: list[int]) -> pa.RecordBatch:
    kind, fault, n = _kinds(t.column("role").to_pylist()), t.column("fault").to_numpy(), t.column("n").to_numpy()
    to_s, to_u, to_a, gone = _prices(kind, fault, n)
    start = np.array(begin)
    size = np.diff([*begin, t.num_rows])
    c = np.full((len(start), 4, 4), NEVER)
    c[:, range(4), range(4)] = 0
    for i in range(size.max()):
        on = np.flatnonzero(size > i)
        r = start[on] + i
        x = c[on]
        s, u, a, d = (w[r][:, None] for w in (to_s, to_u, to_a, gone))
        x[:, :, U] = np.minimum(x[:, :, U], 3 + np.minimum(np.minimum(x[:, :, START], x[:, :, S]), x[:, :, A]))
        x[:, :, A] = np.minimum(x[:, :, A], 3 + x[:, :, U])
        y = x + d[:, :, None]
        y[:, :, S] = np.minimum(y[:, :, S], x[:, :, START] + s)
        y[:, :, U] = np.minimum(y[:, :, U], np.minimum(np.minimum(x[:, :, START], x[:, :, S]), x[:, :, A]) + u)
        y[:, :, A] = np.minimum(y[:, :, A], x[:, :, U] + a)
        c[on] = np.minimum(y, NEVER)
    edge = pa.array([*begin, t.num_rows], pa.int32())
    cut = {name: pa.ListArray.from_arrays(edge, t.column(name).combine_chunks())
           for name in ("turn", "role", "digest", "n", "fault")}
    at = pa.array(begin)
    return pa.RecordBatch.from_arrays(
        [t.column("conv_id").combine_chunks().take(at), t.column("pid").combine_chunks().take(at), pa.array(ks, pa.int32()),
         *cut.values(), pa.array(c.reshape(-1, 16).tolist(), pa.list_(pa.int64()))],
        ["conv_id", "pid", "k", *cut, "costs"])


# ---- paths within blocks

def _paths(blocks: pa.RecordBatch):
    """(first row of each block, size, price arrays, arcs) solved by slices: yields
    (numbers of the blocks, sizes, solution) with at most SLICE rows or one block."""
    size = np.diff(blocks.column(blocks.schema.get_field_index("n")).offsets.to_numpy())
    upto = np.cumsum(size)
    k = 0
    while k < len(size):
        to = max(k + 1, int(np.searchsorted(upto, upto[k] - size[k] + SLICE, "right")))
        yield k, to, size[k:to]
        k = to


def _solve(kind, fault, n, size, end):
    """Least-path arcs of some blocks; ``end`` has the costs from each block's
    last state on.  Nodes are numbered by layer (one more than rows) and state.

    Returns (begin of each block's layers, initials and targets of the chosen
    arcs, doubled pointers)."""
    begin = np.concatenate([[0], np.cumsum(size + 1)])[:-1]
    layers = int((size + 1).sum())
    row = np.ones(layers, bool)
    row[begin + size] = False               # a block's last layer has no row
    to_s, to_u, to_a, gone = (np.full(layers, NEVER) for _ in range(4))
    to_s[row], to_u[row], to_a[row], gone[row] = _prices(kind, fault, n)
    g = np.full((layers, 4), NEVER)
    g[begin + size] = end
    for i in range(int(size.max()) - 1, -1, -1):
        r = begin[size > i] + i
        x, s, u, a, d = g[r + 1], to_s[r], to_u[r], to_a[r], gone[r]
        h = x + d[:, None]
        h[:, START] = np.minimum(np.minimum(h[:, START], s + x[:, S]), u + x[:, U])
        h[:, S] = np.minimum(h[:, S], u + x[:, U])
        h[:, A] = np.minimum(h[:, A], u + x[:, U])
        h[:, U] = np.minimum(h[:, U], a + x[:, A])
        hu = h[:, U].copy()
        h[:, U] = np.minimum(hu, 3 + h[:, A])
        h[:, A] = np.minimum(h[:, A], 3 + hu)
        h[:, START] = np.minimum(h[:, START], 3 + h[:, U])
        h[:, S] = np.minimum(h[:, S], 3 + h[:, U])
        g[r] = np.minimum(h, NEVER)
    at = np.flatnonzero(row)
    kinds = np.zeros(layers, np.int64)
    kinds[row] = kind
    none = layers * 4
    target = np.full((4, layers, 4), none)  # by initial: D, I, K, R
    price = np.stack([to_s, to_u, to_a], 1)
    for q in range(4):
        node = at * 4 + q
        t = INSERTED[q]
        ok = g[at, q] == gone[at] + g[at + 1, q]
        target[0, at[ok], q] = node[ok] + 4
        ok = g[at, q] == 3 + g[at, t]
        target[1, at[ok], q] = at[ok] * 4 + t
        same = kinds[at] == t
        ok = same & (g[at, q] == price[at, t - 1] + g[at + 1, t])
        target[2, at[ok], q] = (at[ok] + 1) * 4 + t
        ok = ~same & (g[at, q] == price[at, t - 1] + g[at + 1, t])
        target[3, at[ok], q] = (at[ok] + 1) * 4 + t
    ok = (kinds[at] == S) & (g[at, START] == to_s[at] + g[at + 1, S])
    target[2, at[ok], START] = (at[ok] + 1) * 4 + S
    target = target.reshape(4, none)
    initial = (target != none).argmax(0)    # the least one
    there = (target != none).any(0)
    pointer = np.where(there, target[initial, np.arange(none)], np.arange(none))
    rank = np.where(there, initial + 1, 0)
    doubled = [pointer]
    while True:
        # ranks of twice as many edits
        rank = np.unique(rank * (none + 1) + rank[doubled[-1]], return_inverse=True)[1]
        more = doubled[-1][doubled[-1]]
        if (more == doubled[-1]).all():
            break
        doubled.append(more)
    # of its arcs, the least by initial and rank of the target
    key = np.where(target == none, 5 * (none + 1), np.arange(4)[:, None] * (none + 1) + np.append(rank, 0)[target])
    initial = key.argmin(0)
    assert (np.where(there, target[initial, np.arange(none)], np.arange(none)) == pointer).all()
    return begin, np.where(there, initial, -1), doubled


def _columns(blocks, k, to, names):
    return [blocks.column(blocks.schema.get_field_index(c)).slice(k, to - k).flatten() for c in names]


def _exits(batches):
    """The state in which a block is left, for each one of entry."""
    for b in batches:
        out = []
        for k, to, size in _paths(b):
            role, fault, n, end = _columns(b, k, to, ("role", "fault", "n", "end"))
            begin, _, doubled = _solve(_kinds(role.to_pylist()), fault.to_numpy(), n.to_numpy(), size,
                                       end.to_numpy().reshape(-1, 4))
            out += (doubled[-1][begin[:, None] * 4 + np.arange(4)] % 4).tolist()
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(out, pa.list_(pa.int32()))],
                                         ["conv_id", "b", "exits"])


def _edits(batches):
    """What becomes of each row: the inserts before it, its own edit, the role
    it gets, and the inserts after a conversation's last row."""
    for blocks in batches:
        for k, to, size in _paths(blocks):
            turn, role, digest, n, fault, end = _columns(
                blocks, k, to, ("turn", "role", "digest", "n", "fault", "end"))
            entry, last = (blocks.column(blocks.schema.get_field_index(c)).slice(k, to - k).to_numpy(zero_copy_only=False)
                           for c in ("entry", "last"))
            begin, initial, doubled = _solve(_kinds(role.to_pylist()), fault.to_numpy(), n.to_numpy(), size,
                                             end.to_numpy().reshape(-1, 4))
            on = np.zeros(len(initial), bool)
            on[begin * 4 + entry] = True
            for pointer in reversed(doubled):
                on[pointer[on]] = True
            on, initial = on.reshape(-1, 4), initial.reshape(-1, 4)
            row = np.ones(len(on), bool)
            row[begin + size] = False
            inserts = (on & (initial == 1)).sum(1)[row]
            state = (on & (initial != 1)).argmax(1)
            out = state[begin + size]       # of each block
            edit = initial[np.arange(len(on)), state][row]
            state = state[row]
            before = np.where(inserts == 2, "ua", np.where(inserts == 0, "", np.where(state == U, "u", "a")))
            named = np.where(edit == 3, np.where(INSERTED[state] == U, "user", "assistant"), "")
            after = np.full(int(size.sum()), "", "<U2")
            after[np.cumsum(size) - 1] = np.where(last, np.array(CLOSING)[out], "")
            conv = blocks.column(0).slice(k, to - k).take(pa.array(np.repeat(np.arange(to - k), size)))
            yield pa.RecordBatch.from_arrays(
                [conv, turn, role, digest, pa.array(np.zeros(len(edit), np.int32)), n, fault,
                 pa.array(before.tolist(), pa.string()), pa.array(["DIKR"[e] for e in edit.tolist()], pa.string()),
                 pa.array(named.tolist(), pa.string()), pa.array(after.tolist(), pa.string())],
                ["conv_id", "turn", "role", "digest", "kind", "n", "fault", "before", "edit", "named", "after"])


# ---- blocks of one conversation

def _numbered(blocks: DataFrame) -> DataFrame:
    """Blocks with their number b in the conversation and whether they are its
    last; only (conversation, partition) pairs meet by conversation."""
    by = stored(blocks.groupBy("conv_id", "pid").agg(F.count(F.lit(1)).alias("c")), "by")
    by = by.select(F.col("conv_id").alias("conv"), F.col("pid").alias("p"), "c", F.expr(
        "sum(c) over (partition by conv_id order by pid) - c").alias("first"), F.expr(
        "sum(c) over (partition by conv_id)").alias("blocks"))
    b = blocks.join(by, F.col("conv_id").eqNullSafe(F.col("conv")) & (F.col("pid") == F.col("p")))
    return b.withColumn("b", F.col("first") + F.col("k")).withColumn("last", F.col("b") + 1 == F.col("blocks"))


def _beside(df: DataFrame, step: int, name: str) -> DataFrame:
    """``df`` with the value ``name`` of the block ``step`` further on."""
    other = df.select(F.col("conv_id").alias("oc"), (F.col("b") - step).alias("ob"), F.col(name).alias("other"))
    return df.join(other, F.col("conv_id").eqNullSafe(F.col("oc")) & (F.col("b") == F.col("ob")), "left").drop("oc", "ob")


def _ends(numbered: DataFrame, most: int) -> DataFrame:
    """(conv_id, b, end): costs from each state after a block to the end."""
    m = numbered.select("conv_id", "b", "costs")
    step = 1
    product = F.expr("transform(sequence(0, 15), i -> least(1125899906842624, array_min(transform(sequence(0, 3), "
                     "j -> costs[(i div 4) * 4 + j] + other[j * 4 + i % 4]))))")
    while step < most:
        m = stored(_beside(m, step, "costs").select("conv_id", "b", F.when(
            F.col("other").isNull(), F.col("costs")).otherwise(product).alias("costs")), "costs")
        step *= 2
    at_end = F.array(*[F.lit(int(x)) for x in AT_END]).cast("array<bigint>")
    whole = m.withColumn("at_end", at_end).select("conv_id", (F.col("b") - 1).alias("b"), F.expr(
        "transform(sequence(0, 3), i -> array_min(transform(sequence(0, 3), "
        "j -> costs[i * 4 + j] + at_end[j])))").alias("end"))
    return whole.where("b >= 0")


def _entries(exits: DataFrame, most: int) -> DataFrame:
    """(conv_id, b, entry): the state in which each block but the first begins."""
    x, step = exits, 1
    while step < most:
        x = stored(_beside(x, -step, "exits").select("conv_id", "b", F.when(
            F.col("other").isNull(), F.col("exits")).otherwise(F.expr(
                "transform(other, q -> exits[q])")).alias("exits")), "exits")
        step *= 2
    return x.select("conv_id", (F.col("b") + 1).alias("b"), F.element_at("exits", 1).alias("entry"))


def _with_ends(blocks: DataFrame) -> DataFrame:
    """Blocks with ``end``, ``entry`` and ``last``."""
    at_end = F.array(*[F.lit(int(x)) for x in AT_END]).cast("array<bigint>")
    numbered = stored(_numbered(blocks), "numbered")
    most = numbered.agg(F.max("blocks")).first()[0] or 1
    if most == 1:
        return numbered.withColumns({"end": at_end, "entry": F.lit(START)})

    def on(df, name, otherwise):
        df = df.select(F.col("conv_id").alias("oc"), F.col("b").alias("ob"), name)
        return lambda to: to.join(df, F.col("conv_id").eqNullSafe(F.col("oc")) & (F.col("b") == F.col("ob")), "left"
                                  ).drop("oc", "ob").withColumn(name, F.coalesce(name, otherwise))
    several = numbered.where("blocks > 1")
    with_end = stored(on(_ends(several, most), "end", at_end)(numbered), "ends")
    exits = with_end.where("blocks > 1").select("conv_id", "b", "role", "fault", "n", "end").mapInArrow(
        _exits, T.StructType([blocks.schema["conv_id"], T.StructField("b", T.LongType()),
                              T.StructField("exits", T.ArrayType(T.IntegerType()))]))
    return on(_entries(stored(exits, "exits"), most), "entry", F.lit(START))(with_end)


# ---- result

RESULT = [("gaps", T.LongType()), ("blank", T.LongType()), ("duplicate", T.LongType()), ("truncated", T.LongType()),
          ("illegal", T.LongType()), ("cost", T.LongType()), ("audit", T.StringType()), ("repaired_sha256", T.StringType())]


class _Conversation:
    """One conversation as it passes in order."""

    def __init__(self, conv):
        self.conv, self.turns, self.low, self.high = conv, 0, None, None
        self.count = [0, 0, 0, 0]
        self.illegal = self.cost = 0
        self.initial, self.audit, self.hash, self.any = None, [], sha256(), False

    def line(self, role, text):
        self.hash.update((("\n" if self.any else "") + role + ":" + text).encode())
        self.any = True

    def row(self, turn, role, n, fault, before, edit, named, after, text):
        if turn is not None and turn != self.high:
            self.low, self.high = turn if self.low is None else self.low, turn
            self.turns += 1
        first = fault if fault != BLANK else 0
        self.count[BLANK if fault == BLANK else REPEAT] += n if fault in (BLANK, REPEAT) else n - 1
        if first == OPEN:
            self.count[OPEN] += 1
        initial = role[:1]
        legal = ("su", "ua", "au")
        if self.initial is not None and self.initial + initial not in legal:
            self.illegal += 1
        self.illegal += n - 1
        self.initial = initial
        for x in before:
            self.line(NAMES[x], "")
        if edit != "D":
            self.line(named or role, text)
        for x in after:
            self.line(NAMES[x], "")
        self.audit.append("I" * len(before) + edit + "D" * (n - 1) + "I" * len(after))
        self.cost += 3 * len(before + after) + 4 * (n - 1) + {"D": 4, "K": 0, "R": 3}[edit] + 3 * (edit != "D" and fault == OPEN)

    def result(self):
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (self.conv, gaps, self.count[BLANK], self.count[REPEAT], self.count[OPEN], self.illegal, self.cost,
                "".join(self.audit), self.hash.hexdigest())


def _assembled(schema):
    def run(batches):
        now, plan = None, None
        for b in batches:
            done = []
            for conv, turn, role, kind, n, fault, before, edit, named, after, text in zip(
                    *(b.column(c).to_pylist() for c in range(b.num_columns))):
                if kind == 0:
                    plan = (turn, role, n, fault, before, edit, named, after)
                    if now is None or now.conv != conv:
                        done += [now.result()] if now else []
                        now = _Conversation(conv)
                else:
                    now.row(*plan, text)
            if done:
                yield _rows(done, schema)
        if now:
            yield _rows([now.result()], schema)
    return run


def _rows(rows, schema):
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema.names)


def repair(rows: DataFrame, block: int = ROWS) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit,
    repaired_sha256) of every conversation in ``rows`` (conv_id, turn, role,
    text and, if there, copies: how often a row stands in its place)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    texts, slim = _ordered(rows)
    conv = rows.schema["conv_id"]
    order = ["conv_id", "turn", "role", "digest"]
    sorted_rows = slim.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("pid", F.spark_partition_id())
    blocks = stored(sorted_rows.mapInArrow(_blocked(block), _block_schema(conv.dataType)), "blocks")
    plan = T.StructType([conv] + [T.StructField(k, v) for k, v in (
        ("turn", T.LongType()), ("role", T.StringType()), ("digest", T.StringType()), ("kind", T.IntegerType()),
        ("n", T.LongType()), ("fault", T.IntegerType()), ("before", T.StringType()), ("edit", T.StringType()),
        ("named", T.StringType()), ("after", T.StringType()))])
    solved = _with_ends(blocks).select("conv_id", "turn", "role", "digest", "n", "fault", "end", "entry", "last")
    edits = solved.mapInArrow(_edits, plan)
    both = edits.withColumn("text", F.lit(None).cast("string")).unionByName(
        texts.select(*order, F.lit(1).alias("kind"), "text"), allowMissingColumns=True)
    both = both.repartition("conv_id").sortWithinPartitions(*order, "kind").drop("digest")
    schema = T.StructType([conv] + [T.StructField(k, v) for k, v in RESULT])
    return both.mapInArrow(_assembled(to_arrow_schema(schema)), schema)


def repaired_damage(rows: DataFrame, block: int = ROWS) -> DataFrame:
    """The repair of damaged conversations, with every original conversation."""
    found = repair(damaged(rows), block)
    every = rows.select(F.col("conv_id").alias("c")).distinct()
    nothing = {"audit": F.lit(""), "repaired_sha256": F.sha2(F.lit("").cast("binary"), 256)}
    out = every.join(found, F.col("c").eqNullSafe(F.col("conv_id")), "left")
    return out.select(F.col("c").alias("conv_id"), *[
        F.coalesce(k, nothing.get(k, F.lit(0).cast("long"))).alias(k) for k, _ in RESULT])
