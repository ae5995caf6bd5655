"""Zip archives -> text lines, tasks by runs of members.

A first pass reads only the archives' central directories and deals their
members out in runs of about ``SPLIT_BYTES`` (expanded), in their order; each
run is then one piece of work, whose task opens the archive and reads just those
members by their offsets.  A small archive is one run, a large one fills many
tasks, and no task holds an archive: members are read in blocks and lines leave
in batches.  Landed text is splittable again.  A single member is deflated as one
stream, so it stays with one task.

Tasks open archives as files of a folder that all machines see, or by
``open_file``.  Archives of another file system without ``open_file`` go through
``binaryFile``, one task each, which holds an archive (at most 2 GB) as one value.

Text is kept as it is: bytes are decoded as UTF-8 unless another encoding is
named, and bytes that the encoding cannot hold fail the job.
"""

from __future__ import annotations

import zipfile
from collections.abc import Callable
from typing import BinaryIO

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

LINE_SCHEMA = T.StructType([
    T.StructField("archive", T.StringType()),
    T.StructField("member", T.StringType()),
    T.StructField("line_no", T.LongType()),
    T.StructField("line", T.StringType()),
])
RUN_SCHEMA = T.StructType([
    T.StructField("path", T.StringType()),
    T.StructField("first", T.LongType()),
    T.StructField("end", T.LongType()),
    T.StructField("bytes", T.LongType()),
])
BLOCK_BYTES = 4 << 20
SPLIT_BYTES = 128 << 20


def _line_blocks(member, keep_cr: bool):
    """Lists of whole lines (bytes, without their ends) of an open member."""
    end = b"" if keep_cr else b"\r"
    rest = b""
    while block := member.read(BLOCK_BYTES):
        *lines, rest = (rest + block).split(b"\n")
        if lines:
            yield [x.removesuffix(end) for x in lines]
    if rest:
        yield [rest.removesuffix(end)]


def _text(lines: list[bytes], encoding: str) -> pa.Array:
    if encoding.lower().replace("-", "") == "utf8":
        return pa.array(lines, pa.binary()).cast(pa.string())     # checked, not copied
    return pa.array([x.decode(encoding) for x in lines], pa.string())


def _member_lines(zf: zipfile.ZipFile, members: list, archive: str, encoding: str, keep_cr: bool):
    for info in members:
        done = 0
        with zf.open(info) as member:
            for lines in _line_blocks(member, keep_cr):
                n = len(lines)
                yield pa.RecordBatch.from_arrays(
                    [pa.repeat(pa.scalar(archive), n), pa.repeat(pa.scalar(info.filename), n),
                     pa.array(range(done, done + n), pa.int64()), _text(lines, encoding)], LINE_SCHEMA.names)
                done += n


def _members(zf: zipfile.ZipFile) -> list:
    return [i for i in zf.infolist() if not i.is_dir()]


def _name(path: str) -> str:
    return path.rsplit("/", 1)[-1]


def _expand(batches, encoding: str, keep_cr: bool):
    for b in batches:
        for path, content in zip(b.column(0), b.column(1)):
            with zipfile.ZipFile(pa.BufferReader(content.as_buffer())) as zf:
                yield from _member_lines(zf, _members(zf), _name(path.as_py()), encoding, keep_cr)


def open_shared(path: str) -> BinaryIO:
    """A file of a folder that all machines see, by the path Spark lists."""
    if path.startswith("file:"):
        path = "/" + path[len("file:"):].lstrip("/")
    return open(path, "rb")


def member_runs(sizes: list[int], split_bytes: int) -> list[tuple[int, int, int]]:
    """(first, end, bytes) of successive runs of members; a run ends once it
    holds ``split_bytes``."""
    runs, first, held = [], 0, 0
    for i, n in enumerate(sizes):
        held += n
        if held >= split_bytes or i == len(sizes) - 1:
            runs.append((first, i + 1, held))
            first, held = i + 1, 0
    return runs


def _runs(batches, split_bytes: int, open_file):
    for b in batches:
        for path in b.column(0).to_pylist():
            with open_file(path) as f, zipfile.ZipFile(f) as zf:
                runs = member_runs([i.file_size for i in _members(zf)], split_bytes)
            first, end, size = zip(*runs) if runs else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [pa.array([path] * len(runs), pa.string()), *[pa.array(x, pa.int64()) for x in (first, end, size)]],
                RUN_SCHEMA.names)


def _expand_runs(batches, encoding: str, keep_cr: bool, open_file):
    for b in batches:
        for r in b.to_pylist():
            with open_file(r["path"]) as f, zipfile.ZipFile(f) as zf:
                yield from _member_lines(zf, _members(zf)[r["first"]:r["end"]], _name(r["path"]), encoding, keep_cr)


def _scheme(spark: SparkSession, path: str) -> str:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).getUri().getScheme()


def archive_lines(spark: SparkSession, path: str, glob: str = "*.zip",
                  encoding: str = "utf-8", keep_cr: bool = False, split_bytes: int = SPLIT_BYTES,
                  open_file: Callable[[str], BinaryIO] | None = None) -> DataFrame:
    """(archive, member, line_no, line) for every line of every zip member,
    without its end (a line feed, before it a carriage return unless
    ``keep_cr``).

    ``open_file`` opens, in a task, an archive by the path Spark lists it under,
    as a seekable stream; by default a file of a shared folder."""
    files = (spark.read.format("binaryFile").option("pathGlobFilter", glob)
             .option("recursiveFileLookup", "true").load(path))
    if open_file is None and _scheme(spark, path) != "file":
        return files.select("path", "content").mapInArrow(lambda it: _expand(it, encoding, keep_cr), LINE_SCHEMA)
    opened = open_file or open_shared
    runs = files.select("path").mapInArrow(lambda it: _runs(it, split_bytes, opened), RUN_SCHEMA)
    n, size = runs.agg(F.count(F.lit(1)), F.sum("bytes")).first()
    tasks = max(min(n, spark.sparkContext.defaultParallelism), -(-(size or 0) // split_bytes), 1)
    return runs.repartition(tasks).mapInArrow(
        lambda it: _expand_runs(it, encoding, keep_cr, opened), LINE_SCHEMA)
