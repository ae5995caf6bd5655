"""Pipe-delimited feed text: positional, all-string reads against a spec.

Reads are plain CSV scans (splittable, one task per ``maxPartitionBytes``
slice of each file).  Columns map by position to the spec; the header line of
every file is skipped, not matched.  Malformed lines never fail the read
(PERMISSIVE): short lines are null-filled, up to two surplus fields land in the
two technical columns (the typed projection recomputes them), a quoted field
may hold the delimiter.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import FeedSpec

CORRUPT = "_corrupt_record"


def read_delimited(spark: SparkSession, paths, schema: T.StructType, header: bool = True,
                   sep: str = "|", quote: str | None = '"',
                   corrupt_column: str | None = None, encoding: str | None = None) -> DataFrame:
    """All-string scan of delimited text with an explicit schema.

    ``encoding`` for raw published files that are not UTF-8 (e.g.
    ``ISO-8859-1``); text landed by this package is UTF-8.
    """
    if corrupt_column:
        schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_column, T.StringType(), True)])
    r = (spark.read.schema(schema)
         .option("header", header).option("sep", sep).option("mode", "PERMISSIVE"))
    if encoding:
        r = r.option("encoding", encoding)
    if quote is not None:
        r = r.option("quote", quote if quote else "\u0000")
    if corrupt_column:
        r = r.option("columnNameOfCorruptRecord", corrupt_column)
    if isinstance(paths, str):
        paths = [paths]
    return r.csv(list(paths))


def read_feed_files(spark: SparkSession, paths, spec: FeedSpec, **kw) -> DataFrame:
    """Raw feed rows: spec columns + the two technical columns, all strings."""
    return read_delimited(spark, paths, spec.raw_schema(with_tech=True), **kw)


def ragged_report(raw: DataFrame, spec: FeedSpec) -> DataFrame:
    """Per-line shape flags of a raw read: short (last spec column missing) and
    surplus (fields beyond the spec parked in the technical columns)."""
    last = spec.names[-1]
    return raw.select(
        "*",
        F.col(f"`{last}`").isNull().alias("short_line"),
        (F.col("start_date").isNotNull() | F.col("end_date").isNotNull()).alias("surplus_fields"))


def read_feed(spark: SparkSession, root: str, spec: FeedSpec, load: str, record: bool = False, **kw) -> DataFrame:
    """Every file of one feed and load kind under a ``feed=/load=`` landing root.

    Names the exact folder, so no other is listed; a folder that does not
    exist holds no rows.  With ``record`` the rows are those of the layout alone
    and column ``CORRUPT`` holds the whole line wherever its fields are not as
    many as the layout's, else null."""
    schema = spec.raw_schema(with_tech=not record)
    path = f"{root.rstrip('/')}/feed={spec.name}/load={load}"
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    if not p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p):
        return spark.createDataFrame([], schema.add(CORRUPT, T.StringType()) if record else schema)
    df = read_delimited(spark, path, schema, **({**kw, "corrupt_column": CORRUPT} if record else kw))
    return df.drop("archive")     # the folder of the archive that a file came from


HEADS, PLACE = "__heads", "__place"


def _headed(header: str | None, flag: int | None, parts: int):
    """Lines of one task with their place, and a header line at place 0 of every
    partition they fill: ``header``, or the first line flagged as one (further
    flagged lines go)."""
    def run(batches):
        seen, place = set(), 0
        for b in batches:
            if not b.num_rows:
                continue
            columns = b.columns
            at = columns[len(columns) - parts:] if parts else []
            key = (pc.binary_join_element_wise(*[pc.coalesce(c.cast(pa.string()), pa.scalar("")) for c in at], "\0")
                   if at else pa.repeat(pa.scalar(""), b.num_rows))
            lines, places = columns[0], np.arange(place, place + b.num_rows) + 1
            place += b.num_rows
            if flag is None:
                new = [k for k in pc.unique(key).to_pylist() if k not in seen]
                first = [pc.index(key, pa.scalar(k)).as_py() for k in new]
                seen.update(new)
                if first:
                    take = pa.array(first)
                    yield pa.RecordBatch.from_arrays(
                        [pa.repeat(pa.scalar(header), len(first)), pa.array(np.zeros(len(first), np.int64)),
                         *[c.take(take) for c in at]], ["line", PLACE, *[f"p{i}" for i in range(parts)]])
                keep = slice(None)
            else:
                keep = np.ones(b.num_rows, bool)
                for i in np.flatnonzero(columns[flag].to_numpy(zero_copy_only=False)).tolist():
                    k = key[i].as_py()
                    keep[i] = k not in seen
                    places[i] = 0
                    seen.add(k)
            out = pa.RecordBatch.from_arrays([lines, pa.array(places), *at],
                                             ["line", PLACE, *[f"p{i}" for i in range(parts)]])
            yield out if flag is None else out.filter(pa.array(keep))
    return run


def _writer(lines: DataFrame, mode: str, compression: str | None):
    w = lines.write.mode(mode).option("lineSep", "\n")
    return w.option("compression", compression) if compression else w


def land_lines(lines: DataFrame, path: str, header: str | None = None, partition_by=(),
               mode: str = "overwrite", replace_partitions: bool = False, compression: str | None = None) -> None:
    """Write lines of text (column ``line``) as they are, byte for byte in UTF-8,
    each with a line feed, in their order; every output file starts with a
    header line.  That is ``header``, or, if it is None, the first line of a
    partition that column ``is_header`` flags in a task's rows (its other flagged
    lines, headers of further members, are not written).  With
    ``replace_partitions`` only the partitions that ``lines`` fills are
    overwritten.  ``compression`` names a codec for the files, which readers know by
    their names; a file then is one task's to read."""
    if header is not None and not partition_by:
        # a task's rows are one file: its first line carries the header
        first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
        line = F.when(first, F.concat_ws("\n", F.lit(header), "line")).otherwise(F.col("line"))
        _writer(lines.select(line.alias("line")), mode, compression).text(path)
        return
    flag = [] if header is not None else [F.col("is_header").alias(HEADS)]
    slim = lines.select("line", *flag, *[F.col(c).alias(f"p{i}") for i, c in enumerate(partition_by)])
    kinds = [T.StructField(f"p{i}", lines.schema[c].dataType) for i, c in enumerate(partition_by)]
    schema = T.StructType([T.StructField("line", T.StringType()), T.StructField(PLACE, T.LongType()), *kinds])
    names = [F.col(f"p{i}").alias(c) for i, c in enumerate(partition_by)]
    out = slim.mapInArrow(_headed(header, 1 if flag else None, len(partition_by)), schema)
    # a writer of partitions sorts by them; with the place, lines keep their order
    out = out.select("line", PLACE, *names).sortWithinPartitions(*partition_by, PLACE).drop(PLACE)
    w = _writer(out, mode, compression)
    if replace_partitions:
        w = w.option("partitionOverwriteMode", "dynamic")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.text(path)
