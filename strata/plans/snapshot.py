"""History tables as versioned Parquet snapshots, merged on read.

Layout under a table root (any shared file system Spark writes to)::

    data/run=<n>/part=base/      all versions open as of run n (FULL load, compaction)
    data/run=<n>/part=shut/      all versions closed as of run n (compaction)
    data/run=<n>/part=new/       versions opened by run n that it does not close
    data/run=<n>/part=closed/    versions closed by run n, with the run that opened them and their place
    data/run=<n>/part=ranges/    key ranges of the run's base and shut parts
    _versions/v<n>.json          pointer: version, base, parts to read, key columns, stream batch

A run writes its parts and only then its pointer; the highest pointer is
current.  A pointer is written under another name and renamed, never replaced:
a reader sees all of it or none, and of two writers of one version the second
fails.  A run takes a number above every pointer and every run folder, so what a
failed run left behind is neither read nor written over.

With key columns (``cluster``) the base and shut parts are dealt out by ranges
of the first of them, one folder ``kr=<i>`` each, sorted by all of them and with
Bloom filters on them; a hot key spreads over several ranges.  ``touched`` says
which ranges hold keys of a batch, so a run reads these folders and no others.

An incremental run writes what it opens and what it closes and nothing else;
its cost follows the batch, not the history.  The open versions at version v
are ``base`` and every ``new`` part since, less the ``closed`` parts since.  A
closed version names its place, the file and row that it was read from; places
are broadcast as a bit for each stored row, so no wide row is shuffled for them.
What a run opens and closes itself is in its ``closed`` part alone, with an empty
file name.  Closed versions without a file name, of runs that noted no places, are
matched on the opening run and all business columns (equal rows opened by one run
close together).  ``compact`` writes them as a new base, and all closed
versions as a new shut part, so what a reader opens does not grow with the
number of runs.  The pointer names the parts; nothing is listed or probed.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import END_DATE
from .sizing import broadcast_limit, fits, measure

RUN = "__run"            # the run that opened a version
FILE, ROW = "__file", "__row"    # where a stored open version is: file below data/, row in it
CARRIED = {RUN: "long", FILE: "string", ROW: "long"}
BLOCK, WORD = 12, 6      # 2 ** 12 rows are a row of ``places``, 2 ** 6 a word of bits
KEY_RANGE = "kr"
BASE, NEW, CLOSED, SHUT, RANGES = "base", "new", "closed", "shut", "ranges"
MAX_RANGES = 512         # of a part; what ``touched`` brings to the driver is bounded by it
SAMPLE_PER_RANGE = 100   # rows to cut the ranges by, as many as Spark's range exchange takes


@dataclass(frozen=True)
class Pointer:
    version: int
    base: int
    closed_from: int
    batch_id: int | None = None    # last stream micro-batch folded in ...
    stream_id: str | None = None   # ... of this stream
    new: tuple[int, ...] = ()      # runs since the base that opened versions
    closed: tuple[int, ...] = ()   # runs since the shut part that closed versions
    shut: int | None = None        # run of the shut part
    cluster: tuple[str, ...] = ()  # key columns that the base and shut parts are dealt out by


class VersionExists(RuntimeError):
    """Another writer has published this version."""


def _p(root: str, *parts: str) -> str:
    return "/".join([root.rstrip("/"), *parts])


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def _names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if there is no such folder."""
    fs, p = _fs(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(p)] if fs.exists(p) else []


def _numbers(names: list[str], prefix: str, suffix: str = "") -> list[int]:
    """The n of names ``<prefix>n<suffix>``, ascending."""
    out = []
    for name in names:
        if name.startswith(prefix) and name.endswith(suffix):
            n = name[len(prefix):len(name) - len(suffix)]
            if n.isdigit():
                out.append(int(n))
    return sorted(out)


def versions(spark: SparkSession, root: str) -> list[int]:
    """Published versions, ascending."""
    return _numbers(_names(spark, _p(root, "_versions")), "v", ".json")


def current(spark: SparkSession, root: str) -> Pointer | None:
    """The highest pointer; None only if the table has none.  A pointer that
    cannot be read is an error, not an absent table."""
    found = versions(spark, root)
    return _pointer(spark, root, found[-1]) if found else None


def _pointer(spark: SparkSession, root: str, version: int) -> Pointer:
    path = _p(root, "_versions", f"v{version}.json")
    text = "".join(r[0] for r in spark.read.text(path, wholetext=True).take(1))
    try:
        return Pointer(**{k: tuple(v) if isinstance(v, list) else v for k, v in json.loads(text).items()})
    except (ValueError, TypeError) as e:
        raise RuntimeError(f"unreadable version pointer {path}") from e


def _switch(spark: SparkSession, root: str, ptr: Pointer) -> None:
    """Publish a pointer: written whole under another name, then renamed, which
    fails if the name exists."""
    jvm = spark.sparkContext._jvm
    fs, final = _fs(spark, _p(root, "_versions", f"v{ptr.version}.json"))
    part = jvm.org.apache.hadoop.fs.Path(_p(root, "_versions", f"_{uuid.uuid4().hex}"))
    out = fs.create(part, False)
    try:
        out.write(bytearray(json.dumps(asdict(ptr)).encode()))
    finally:
        out.close()
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(part), fs.makeQualified(final), none)
    except Exception as e:
        fs.delete(part, False)
        if fs.exists(final):
            raise VersionExists(f"version {ptr.version} of {root} exists") from e
        raise


def _require(spark: SparkSession, root: str, ptr: Pointer | None) -> Pointer:
    ptr = ptr or current(spark, root)
    if ptr is None:
        raise FileNotFoundError(f"no history table at {root}")
    return ptr


def _next_run(spark: SparkSession, root: str) -> int:
    used = versions(spark, root) + _numbers(_names(spark, _p(root, "data")), "run=")
    return max(used, default=-1) + 1


def _folders(root: str, run: int, part: str, ranges: set[int] | None) -> list[str]:
    path = _p(root, "data", f"run={run}", f"part={part}")
    return [path] if ranges is None else [_p(path, f"{KEY_RANGE}={r}") for r in sorted(ranges)]


def _rows(spark: SparkSession, root: str, folders: list[str], schema: T.StructType,
          has_run: bool, ranged: bool = False) -> DataFrame:
    """Rows of part folders with the columns CARRIED, as the parts hold them or else
    their run and where they are."""
    fields = [f for f in schema.fields if f.name not in CARRIED]
    carried = [T.StructField(RUN, T.LongType()), T.StructField(FILE, T.StringType()), T.StructField(ROW, T.LongType())]
    if not folders:
        return spark.createDataFrame([], T.StructType([*fields, *carried]))
    if has_run:
        return spark.read.schema(T.StructType([*fields, *carried])).parquet(*folders)
    at = [T.StructField("run", T.LongType()), T.StructField("part", T.StringType()),
          *[T.StructField(KEY_RANGE, T.IntegerType())] * ranged]
    d = spark.read.option("basePath", _p(root, "data")).schema(T.StructType([*fields, *at])).parquet(*folders)
    # the path may hold folders of other names; below data/ none is named so
    file = F.substring_index("_metadata.file_path", "/data/", -1)
    return d.select(*[F.col(f"`{f.name}`") for f in fields], F.col("run").alias(RUN), file.alias(FILE),
                    F.col("_metadata.row_index").alias(ROW))


def _place_of(row: Column) -> tuple[Column, Column, Column]:
    """Block, word and bit of a row's place."""
    word = F.shiftright(row.bitwiseAND(F.lit((1 << BLOCK) - 1)), WORD).cast("int")
    return F.shiftright(row, BLOCK), word, row.bitwiseAND(F.lit((1 << WORD) - 1)).cast("int")


def places(rows: DataFrame) -> DataFrame:
    """The places of ``rows`` (FILE, ROW; those without left out), a row for each file and
    2 ** BLOCK rows of it: its words hold a bit per row (null: none)."""
    block, word, bit = _place_of(F.col(ROW))
    bits = (rows.where(F.col(ROW).isNotNull()).select(FILE, block.alias("block"), word.alias("w"), bit.alias("bit"))
            .groupBy(FILE, "block", "w").agg(F.expr("bit_or(shiftleft(1L, bit))").alias("bits")))
    words = [F.max(F.when(F.col("w") == i, F.col("bits"))) for i in range(1 << BLOCK - WORD)]
    return bits.groupBy(FILE, "block").agg(F.array(*words).alias("words"))


def at_places(rows: DataFrame, found: DataFrame, how: str) -> DataFrame:
    """``rows`` (with FILE, ROW) that are (``how`` left_semi) or are not (left_anti)
    at the places ``found``, which are broadcast: about a bit for each stored row."""
    block, word, bit = _place_of(F.col(ROW))
    found = found.select(F.col(FILE).alias("__f"), F.col("block").alias("__b"), F.col("words").alias("__w"))
    on = (F.col(FILE) == F.col("__f")) & (block == F.col("__b")) & (F.getbit(F.get("__w", word), bit) == 1)
    return rows.join(F.broadcast(found), on, how)


def with_keys(rows: DataFrame, batch: DataFrame, keys: list[str]) -> DataFrame:
    """Stored ``rows`` (with FILE, ROW) whose keys, nulls equal, ``batch`` has.  Only
    keys and places are shuffled for it."""
    narrow = rows.select(*[F.col(f"`{k}`") for k in keys], FILE, ROW).alias("m")
    some = batch.select(*[F.col(f"`{k}`") for k in keys]).distinct().alias("b")
    on = reduce(lambda x, y: x & y, [F.col(f"m.`{k}`").eqNullSafe(F.col(f"b.`{k}`")) for k in keys])
    return at_places(rows, places(narrow.join(some, on, "left_semi")), "left_semi")


def table_schema(spark: SparkSession, root: str, ptr: Pointer) -> T.StructType:
    """Columns of a stored history (from the base part, which every version has)."""
    found = spark.read.parquet(_p(root, "data", f"run={ptr.base}", f"part={BASE}")).schema
    return T.StructType([f for f in found.fields if f.name not in (*CARRIED, KEY_RANGE)])


def _below(bounds: Column, n: int, x: Column, equal: bool) -> Column:
    """How many of ``n`` ascending bounds are less than ``x`` (``equal``: or equal to
    it), by a binary search: about log2(n) comparisons a row."""
    if not n:
        return F.lit(0)
    steps = F.array(*[F.lit(1 << i) for i in reversed(range(n.bit_length()))])
    at = lambda i: F.get(bounds, i - 1)  # noqa: E731 - null beyond the last

    def half(found, step):      # holds x, too, which is evaluated once
        i = found["i"] + step
        before = at(i) <= found["x"] if equal else at(i) < found["x"]
        return F.struct(F.when(before, i).otherwise(found["i"]).alias("i"), found["x"].alias("x"))
    return F.aggregate(steps, F.struct(F.lit(0).alias("i"), x.alias("x")), half, lambda found: found["i"])


def touched(spark: SparkSession, root: str, ptr: Pointer, batches: list[DataFrame]) -> dict[str, set[int]] | None:
    """The ranges of the base and shut parts that may hold keys of the batches;
    None if the parts have no ranges.  Each key is placed among the bounds of the
    (at most MAX_RANGES) ranges of a part, where it stands, without a shuffle; only
    places come to the driver, about two per range at most."""
    key = ptr.cluster[0] if ptr.cluster else None
    batches = [b for b in batches if b is not None]
    if key is None or not all(key in b.columns for b in batches):
        return None
    out = {}
    for part, run in ((BASE, ptr.base), (SHUT, ptr.shut)):
        out[part] = set()
        if run is None or not batches:
            continue
        ranges = spark.read.parquet(_p(root, "data", f"run={run}", f"part={RANGES}")).where(F.col("of") == part)
        found = ranges.orderBy("low", "high").collect()
        held = [r for r in found if r.low is not None]
        for b in batches:
            k, kind = F.col(f"`{key}`"), b.schema[key].dataType
            if kind != ranges.schema["low"].dataType:     # of another order: all may hold its keys
                out[part] = {r.kr for r in found}
                break
            first, last = (_below(F.array(*[F.lit(getattr(r, end)).cast(kind) for r in held]), len(held), k, end == "low")
                           for end in ("high", "low"))
            spans = b.select(F.when(k.isNotNull(), first).alias("first"),
                             F.when(k.isNotNull(), last).alias("last")).distinct().collect() if found else []
            for s in spans:
                out[part] |= {r.kr for r in found if r.nulls} if s.first is None else \
                    {r.kr for r in held[s.first:s.last]}
    return out


def open_with_run(spark: SparkSession, root: str, schema: T.StructType | None = None,
                  ptr: Pointer | None = None, ranges: dict[str, set[int]] | None = None) -> DataFrame:
    """Open versions with the run that opened each and its place (CARRIED); of the
    base only the ``ranges`` given."""
    ptr = _require(spark, root, ptr)
    schema = schema or table_schema(spark, root, ptr)
    parts = {ptr.base: _rows(spark, root, _folders(root, ptr.base, BASE, ranges and ranges[BASE]), schema, False,
                             bool(ptr.cluster))}
    for r in ptr.new:
        new = _rows(spark, root, _folders(root, r, NEW, None), schema, False)
        parts[r] = parts[r].unionByName(new) if r in parts else new
    union = lambda found: reduce(lambda a, b: a.unionByName(b), found)
    since = [r for r in ptr.closed if r > ptr.base]
    if not since:
        return union(parts.values())
    gone = _rows(spark, root, [x for r in since for x in _folders(root, r, CLOSED, None)], schema, True)
    open_rows = lambda found: at_places(union(found), places(gone.select(FILE, ROW)), "left_anti")
    unplaced = gone.where(F.col(FILE).isNull())
    seen = unplaced.agg(*[F.bool_or(F.col(RUN) == r) for r in parts]).first()
    runs = {r for r, found in zip(parts, seen) if found}
    if not runs:
        return open_rows(parts.values())
    names = [f.name for f in schema.fields if f.name != END_DATE and f.name not in CARRIED]
    unplaced = unplaced.select(*[F.col(f"`{c}`") for c in [*names, RUN]])
    if fits(*measure(unplaced), broadcast_limit(spark)):
        unplaced = F.broadcast(unplaced)
    # one struct, nulls equal: columns on their own would be two join keys each
    same = F.struct(*[F.col(f"o.`{c}`") for c in [*names, RUN]]) == F.struct(*[F.col(f"g.`{c}`") for c in [*names, RUN]])
    some = open_rows([parts[r] for r in sorted(runs)]).alias("o").join(unplaced.alias("g"), same, "left_anti")
    rest = [p for r, p in parts.items() if r not in runs]
    return some.unionByName(open_rows(rest)) if rest else some


def read_open(spark: SparkSession, root: str, schema: T.StructType | None = None,
              ptr: Pointer | None = None) -> DataFrame:
    """Open versions of the current (or given) version."""
    return open_with_run(spark, root, schema, ptr).drop(*CARRIED)


def read_closed(spark: SparkSession, root: str, schema: T.StructType | None = None,
                ptr: Pointer | None = None, ranges: dict[str, set[int]] | None = None) -> DataFrame:
    """Closed versions visible at the current (or given) version; of the shut
    part only the ``ranges`` given."""
    ptr = _require(spark, root, ptr)
    schema = schema or table_schema(spark, root, ptr)
    out = None
    if ptr.shut is not None:
        out = _rows(spark, root, _folders(root, ptr.shut, SHUT, ranges and ranges[SHUT]), schema, False,
                    bool(ptr.cluster)).drop(*CARRIED)
    if ptr.closed or out is None:
        rows = _rows(spark, root, [x for r in ptr.closed for x in _folders(root, r, CLOSED, None)], schema, True).drop(*CARRIED)
        out = rows if out is None else out.unionByName(rows)
    return out


def read_history(spark: SparkSession, root: str, schema: T.StructType | None = None,
                 ptr: Pointer | None = None, open_only: bool = False) -> DataFrame:
    """Open plus visible closed versions."""
    ptr = _require(spark, root, ptr)
    rows = read_open(spark, root, schema, ptr)
    return rows if open_only else rows.unionByName(read_closed(spark, root, schema, ptr))


def _cuts(rows: DataFrame, key: str, n: int) -> list[Column]:
    """Ascending bounds (k, s) that deal rows out in ``n`` about equal ranges, from
    a random sample of a bounded size.  Only the key is read for it; ``s`` stands
    for the hash that spreads the rows of one key and is as uniform."""
    if n < 2:
        return []
    kind = rows.schema[key].dataType
    i = F.monotonically_increasing_id()
    sample = (rows.select(F.col(f"`{key}`").alias("k"), i.alias("i"))
              .select("k", F.xxhash64(F.lit(1), "i").alias("s"), F.xxhash64(F.lit(2), "i").alias("o"))
              .orderBy("o").limit(SAMPLE_PER_RANGE * n))
    tiles = (sample.select("k", "s", F.ntile(n).over(Window.orderBy("k", "s")).alias("t"))
             .groupBy("t").agg(F.max(F.struct("k", "s")).alias("at")).orderBy("t"))
    last = tiles.collect()[:-1]
    return [F.struct(F.lit(r.at.k).cast(kind).alias("k"), F.lit(r.at.s).cast("long").alias("s")) for r in last]


def _write_whole(spark: SparkSession, root: str, run: int, part: str, rows: DataFrame,
                 cluster: tuple[str, ...], ranges: int | None) -> None:
    """Write a base or shut part, by key ranges if there are key columns."""
    path = _p(root, "data", f"run={run}", f"part={part}")
    rows = rows.drop(*CARRIED)
    if not cluster:
        rows.write.parquet(path)
        return
    n = max(1, min(MAX_RANGES, ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))))
    keys = [F.col(f"`{c}`") for c in cluster]
    spread = F.xxhash64(*[F.col(f"`{c}`") for c in rows.columns])     # the rows of a hot key
    cuts = _cuts(rows, cluster[0], n)
    at = F.struct(keys[0].alias("k"), spread.alias("s"))
    w = (rows.withColumn(KEY_RANGE, _below(F.array(*cuts), len(cuts), at, False)).repartitionById(n, F.col(KEY_RANGE))
         .sortWithinPartitions(KEY_RANGE, *keys).write.partitionBy(KEY_RANGE)
         .option("parquet.bloom.filter.adaptive.enabled", "true"))
    for c in cluster:
        w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)
    if not _names(spark, path) or _names(spark, path) == ["_SUCCESS"]:
        # no row: an empty range still holds the columns
        rows.limit(0).write.mode("append").parquet(_p(path, f"{KEY_RANGE}=0"))
    key = F.col(f"`{cluster[0]}`")
    (spark.read.parquet(path).groupBy(KEY_RANGE).agg(
        F.min(key).alias("low"), F.max(key).alias("high"), F.count(F.when(key.isNull(), 1)).alias("nulls"))
     .select(F.lit(part).alias("of"), F.col(KEY_RANGE).alias("kr"), "low", "high", "nulls")
     .coalesce(1).write.mode("append").parquet(_p(root, "data", f"run={run}", f"part={RANGES}")))


def _publish(spark: SparkSession, root: str, parts: dict[str, DataFrame | None], prev: Pointer | None,
             fresh: bool, batch_id: int | None, stream_id: str | None,
             cluster: tuple[str, ...] = (), ranges: int | None = None) -> Pointer:
    n = _next_run(spark, root)
    if prev is not None and versions(spark, root)[-1] != prev.version:
        raise VersionExists(f"{root} has moved on from version {prev.version}")
    fresh = fresh or prev is None
    base = BASE in parts
    out = None
    for name, rows in parts.items():
        if rows is None:
            continue
        if name in (BASE, SHUT):
            _write_whole(spark, root, n, name, rows, cluster, ranges)
            continue
        rows = rows.withColumns({c: F.lit(n if c == RUN else None).cast(kind) for c, kind in CARRIED.items()
                                 if c not in rows.columns})
        rows = rows.withColumn("part", F.lit(name))
        out = rows if out is None else out.unionByName(rows)
    if out is not None:
        out.write.mode("append" if base else "errorifexists").partitionBy("part").parquet(_p(root, "data", f"run={n}"))
    written = [part for part in (NEW, CLOSED) if parts.get(part) is not None
               and exists(spark, _p(root, "data", f"run={n}", f"part={part}"))]
    shut = n if parts.get(SHUT) is not None else None if fresh else prev.shut
    closed = () if fresh or shut == n else prev.closed
    if batch_id is None and prev is not None:
        batch_id, stream_id = prev.batch_id, prev.stream_id
    new = Pointer(n, n if base else prev.base, n if fresh else prev.closed_from, batch_id, stream_id,
                  (*(() if base else prev.new), *[n] * (NEW in written)), (*closed, *[n] * (CLOSED in written)),
                  shut, tuple(cluster) if base else prev.cluster)
    _switch(spark, root, new)
    return new


def publish(spark: SparkSession, root: str, open_rows: DataFrame,
            closed_rows: DataFrame | None = None, fresh: bool = False, batch_id: int | None = None,
            stream_id: str | None = None, ptr: Pointer | None = None, cluster=(),
            ranges: int | None = None) -> Pointer:
    """Write a new base (all open rows) and newly closed rows, and switch to it.

    ``fresh`` (a FULL load) hides every earlier closed run.  ``cluster`` names
    the key columns to deal the base out by, in ``ranges`` ranges of the first
    (default: as many as shuffle partitions, MAX_RANGES at most).
    """
    prev = ptr or current(spark, root)
    return _publish(spark, root, {BASE: open_rows, CLOSED: closed_rows}, prev, fresh, batch_id, stream_id,
                    tuple(cluster), ranges)


def publish_delta(spark: SparkSession, root: str, opened: DataFrame, closing: DataFrame,
                  ptr: Pointer, batch_id: int | None = None, stream_id: str | None = None) -> Pointer:
    """Write only what a run opens and closes.  ``closing`` carries ``RUN``
    (null: opened by this very run) and, if known, the place of each."""
    n = _next_run(spark, root)
    closing = closing.withColumn(RUN, F.coalesce(F.col(RUN), F.lit(n).cast("long")))
    return _publish(spark, root, {NEW: opened.drop(*CARRIED), CLOSED: closing}, ptr, False, batch_id, stream_id)


def compact(spark: SparkSession, root: str, ranges: int | None = None) -> Pointer:
    """Write the open versions as a new base and the closed ones as a new shut
    part; the history stays the same."""
    ptr = _require(spark, root, None)
    shut = read_closed(spark, root, ptr=ptr) if ptr.closed or ptr.shut is not None else None
    return _publish(spark, root, {BASE: read_open(spark, root, ptr=ptr), SHUT: shut}, ptr, False, None, None,
                    ptr.cluster, ranges)


def vacuum(spark: SparkSession, root: str, keep: int = 2, closed: bool = False) -> list[str]:
    """Delete base and new parts (with ``closed`` also closed and shut parts)
    that none of the last ``keep`` versions reads.

    Pointers are never touched; older versions can no longer be read
    afterwards.  Returns the deleted folders.
    """
    found = versions(spark, root)
    if not found or keep < 1:
        return []
    kept = [_pointer(spark, root, v) for v in found[-keep:]]
    read = {(p.base, x) for p in kept for x in (BASE, RANGES)} | {(r, NEW) for p in kept for r in p.new}
    read |= {(r, CLOSED) for p in kept for r in p.closed} | {(p.shut, x) for p in kept for x in (SHUT, RANGES)}
    gone = []
    for run in _numbers(_names(spark, _p(root, "data")), "run="):
        for part in (BASE, NEW, RANGES, *((CLOSED, SHUT) if closed else ())):
            path = _p(root, "data", f"run={run}", f"part={part}")
            # a run beyond the last pointer may be in the making
            if run < found[-1] and (run, part) not in read and drop_table(spark, path):
                gone.append(path)
    return gone


def drop_table(spark: SparkSession, path: str) -> bool:
    """Drop a path-based table if it exists (staging clean-up)."""
    fs, p = _fs(spark, path)
    return bool(fs.exists(p) and fs.delete(p, True))


def replace_table(df: DataFrame, path: str) -> DataFrame:
    """Drop-and-create of a staging or target table: overwrite, then read back."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_open(history: DataFrame) -> tuple[DataFrame, DataFrame]:
    return (history.filter(F.col(END_DATE).isNull()),
            history.filter(F.col(END_DATE).isNotNull()))
