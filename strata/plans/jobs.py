"""Whole jobs: FULL load, incremental (ADD / CHANGE) load, merge, multi-feed run.

Each job is a handful of DataFrame statements; the only driver work is the
loop over feeds and the snapshot pointer switch.

Text lands as UTF-8 with a header line in every file and is read that way by
default; ``**read`` of the loaders (``header``, ``encoding``, ``quote``,
``corrupt_column``) is for text landed by others, and ``rejects`` (a
``RejectChannel``) for lines that do not fit their layout.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.checks import enforce_widths, spec_widths
from ..operators.merge import MergeKeys, merge_parts
from ..operators.typed import typed
from ..functions import (file_stem, landing_key, load_filter, load_folder, member_name,
                         route_load, route_table, url_basename)
from ..sources.archives import archive_lines
from ..sources.delimited import land_lines, read_feed
from ..sources.rejects import RejectChannel
from ..specs import FEED_ORDER, FEEDS, FeedSpec
from . import snapshot
from .tables import create_table, replace_rows

LOAD_FULL, LOAD_ADD, LOAD_CHANGE = "FUL", "add", "change"
#: Incremental runs since the last base after which a run writes a new one.
COMPACT_AFTER = 50


def published_files(links: DataFrame, load_type: str = "FUL",
                    prefix: str = "landing/") -> DataFrame:
    """Routed download list from a link index (name, url): links of the
    wanted load type whose text lacks the excluded token, with the file
    name, feed, load kind after unzip, and landing key."""
    from ..sources.links import kept_links
    f = url_basename("url")
    landed = member_name(f)
    return (kept_links(links).filter(load_filter("name", load_type))
            .select("name", "url", f.alias("filename"), file_stem(f).alias("stem"),
                    route_table(f).alias("feed"), route_load(landed).alias("load"),
                    landing_key(prefix, route_table(f), load_folder(route_load(landed)),
                                landed).alias("landing_key")))


def routed_lines(spark: SparkSession, archives_root: str, glob: str = "*.zip",
                 encoding: str = "utf-8") -> DataFrame:
    """Every line of every published archive, as it is, with its feed and load
    kind (routed by the archive's name); ``is_header``: a member's first."""
    lines = archive_lines(spark, archives_root, glob, encoding, keep_cr=True)
    return lines.select(route_table("archive").alias("feed"),
                        route_load(member_name("archive")).alias("load"),
                        "archive", "member", "line_no", "line", (F.col("line_no") == 0).alias("is_header"))


def land_archives(spark: SparkSession, archives_root: str, landing: str, glob: str = "*.zip",
                  encoding: str = "utf-8") -> None:
    """Expand and route published archives and land their lines under
    ``feed=/load=/archive=`` in one pass over the archives.

    An archive that lands again replaces what it landed before and nothing
    else.  A landed file holds the bytes of its archive's members (as UTF-8; a
    last line gets its line feed), from the second member on without the header
    line; every file starts with one, which the loaders skip."""
    routed = routed_lines(spark, archives_root, glob, encoding)
    land_lines(routed, landing, partition_by=("feed", "load", "archive"), replace_partitions=True)


def typed_batch(spark: SparkSession, landing: str, spec: FeedSpec, load: str, as_of,
                rejects: RejectChannel | None = None, **read) -> DataFrame:
    """Scan one feed/load folder and type it (FULL loads also apply the
    feed's extra raw not-null rule).  Lines that do not fit the layout are
    written to the channel ``rejects``, if there is one, in the same pass."""
    raw = read_feed(spark, landing, spec, load, record=rejects is not None, **read)
    if rejects is not None:
        raw = rejects.route(raw, spec, load)
    return typed(raw, spec, as_of=as_of, full_load=(load == LOAD_FULL))


def _within_widths(rows: DataFrame, spec: FeedSpec, enforce: str | None) -> DataFrame:
    return enforce_widths(rows, spec_widths(spec), enforce) if enforce else rows


def full_load(spark: SparkSession, landing: str, spec: FeedSpec, table_root: str, as_of,
              enforce: str | None = None, **read) -> snapshot.Pointer:
    """Replace the history with the FULL files, every row an open version.

    ``enforce`` applies the declared widths: "fail" on an over-long value (as a
    width-checked target does), "null" it; None loads it."""
    rows = _within_widths(typed_batch(spark, landing, spec, LOAD_FULL, as_of, **read), spec, enforce)
    return snapshot.publish(spark, table_root, rows, None, fresh=True, cluster=spec.keys)


def declared_load(spark: SparkSession, landing: str, spec: FeedSpec, load: str, as_of, name: str,
                  root: str, **read) -> None:
    """Replace the catalog table ``name`` with one load's typed rows (FULL, ADD or
    CHANGE).  It is created in the layout's declared types under ``root`` if need
    be; a value over its declared width fails the load and the table stays."""
    create_table(spark, name, spec, root)
    replace_rows(spark, typed_batch(spark, landing, spec, load, as_of, **read), name, spec, root)


@dataclass
class Staged:
    add: DataFrame
    change: DataFrame


def incremental_load(spark: SparkSession, landing: str, spec: FeedSpec, as_of,
                     staging_root: str | None = None, enforce: str | None = None, **read) -> Staged:
    """Type the ADD and CHANGE folders; optionally replace staging tables.
    ``enforce`` as for the FULL load."""
    add = _within_widths(typed_batch(spark, landing, spec, LOAD_ADD, as_of, **read), spec, enforce)
    chg = _within_widths(typed_batch(spark, landing, spec, LOAD_CHANGE, as_of, **read), spec, enforce)
    if staging_root:
        add_path, chg_path = staging_paths(staging_root, spec)
        add = snapshot.replace_table(add, add_path)
        chg = snapshot.replace_table(chg, chg_path)
    return Staged(add, chg)


def merge_into(spark: SparkSession, table_root: str, add: DataFrame | None,
               change: DataFrame | None, mk: MergeKeys, as_of, null_safe: bool = False,
               broadcast_limit: int | None = None, batch_id: int | None = None,
               collation: str | None = None, stream_id: str | None = None,
               compact_after: int = COMPACT_AFTER) -> snapshot.Pointer:
    """Merge one ADD + CHANGE batch into a stored history and publish the next
    version: what the run opens and closes is written, the rest stays where it
    is.  After ``compact_after`` such runs the open rows become a new base.

    Of a history dealt out by key ranges only those are read that hold keys of
    the batch (under a collation keys may match across ranges: all are)."""
    ptr = snapshot.current(spark, table_root)
    ranges = snapshot.touched(spark, table_root, ptr, [add, change]) if ptr and collation is None \
        and ptr.cluster[:1] and ptr.cluster[0] in mk.keys else None
    open_rows = snapshot.open_with_run(spark, table_root, ptr=ptr, ranges=ranges)
    closed = snapshot.read_closed(spark, table_root, ptr=ptr, ranges=ranges)
    parts = merge_parts(open_rows, add, change, mk, as_of, null_safe, broadcast_limit,
                        closed=closed, collation=collation,
                        carry={c: F.lit(None).cast(kind) for c, kind in snapshot.CARRIED.items()},
                        changes_only=True, with_keys=snapshot.with_keys if collation is None else None)
    new_now = F.col(snapshot.RUN).isNull()
    # what ADD opens and CHANGE closes is written as closed alone, so it has no place
    closing = parts.closing.withColumn(snapshot.FILE, F.when(new_now, F.lit("")).otherwise(F.col(snapshot.FILE)))
    new = snapshot.publish_delta(spark, table_root, parts.opened_to_stay(new_now), closing, ptr,
                                 batch_id=batch_id, stream_id=stream_id)
    if new.version - new.base >= compact_after:
        new = snapshot.compact(spark, table_root)
    return new


def staging_paths(staging_root: str, spec: FeedSpec) -> tuple[str, str]:
    base = staging_root.rstrip("/")
    return f"{base}/{spec.name}_staging_ADD", f"{base}/{spec.name}_staging_CHANGE"


def run_feed(spark: SparkSession, landing: str, table_root: str, spec: FeedSpec, as_of,
             full: bool = False, staging_root: str | None = None, enforce: str | None = None,
             **read) -> snapshot.Pointer:
    """One feed: optional FULL replace, then ADD/CHANGE staged and merged.
    ``enforce`` applies the declared widths to all three.

    With ``staging_root`` the typed batches are written as staging tables
    (replaced each run), merged from there, and dropped once the merge has
    succeeded; otherwise they are persisted for the merge and released.
    """
    if full:
        full_load(spark, landing, spec, table_root, as_of, enforce, **read)
    staged = incremental_load(spark, landing, spec, as_of, staging_root, enforce, **read)
    if staging_root:
        ptr = merge_into(spark, table_root, staged.add, staged.change, MergeKeys.of(spec), as_of)
        for path in staging_paths(staging_root, spec):
            snapshot.drop_table(spark, path)
        return ptr
    add = staged.add.persist(StorageLevel.MEMORY_AND_DISK)
    chg = staged.change.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return merge_into(spark, table_root, add, chg, MergeKeys.of(spec), as_of)
    finally:
        add.unpersist()
        chg.unpersist()


def for_each_feed(fn, names, parallel: bool = True) -> dict:
    """Run ``fn(name)`` per feed.  Feeds touch disjoint tables, so their jobs
    are submitted concurrently from driver threads and Spark's scheduler
    interleaves their tasks; small feeds no longer wait for large ones."""
    names = list(names)
    if not parallel or len(names) < 2:
        return {n: fn(n) for n in names}
    from concurrent.futures import ThreadPoolExecutor
    with ThreadPoolExecutor(max_workers=len(names)) as pool:
        futures = {n: pool.submit(fn, n) for n in names}
        return {n: futures[n].result() for n in names}


def multi_feed_run(spark: SparkSession, landing: str, tables_root: str, as_of,
                   full: bool = False, feeds=FEED_ORDER, parallel: bool = True,
                   staging_root: str | None = None, enforce: str | None = None, **read) -> dict:
    """Every feed: optional FULL replace, then ADD + CHANGE merge, under the
    declared widths if ``enforce``; returns the published pointer per feed."""
    return for_each_feed(
        lambda name: run_feed(spark, landing, f"{tables_root.rstrip('/')}/{name}", FEEDS[name],
                              as_of, full, staging_root, enforce, **read), feeds, parallel)
