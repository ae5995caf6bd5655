"""Incremental loads as a Structured Streaming query.

A file-source stream watches a ``feed=/load=`` landing root.  Each micro-batch
holds the newly landed ADD and CHANGE files; ``foreachBatch`` types them and
merges them into the stored history in statement order (ADD first, then
CHANGE), publishing one snapshot version per micro-batch.

Exactly once: the id of the stream and of its micro-batch are stored in the
snapshot pointer together with the version that the batch produced, so a batch
replayed after a failure (its commit not yet logged by the stream) is
recognised and skipped.  The stream's own checkpoint (its id, offsets, seen
files) is kept with the table unless another place is given, so a later start
goes on where the last one ended.  A stream with a new checkpoint has a new id;
none of its batches is taken for one that was folded in before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.merge import MergeKeys
from ..operators.typed import typed
from ..plans import jobs, snapshot
from ..specs import FeedSpec


def feed_stream(spark: SparkSession, landing: str, spec: FeedSpec, header: bool = True,
                max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming raw rows of one feed's ADD and CHANGE folders."""
    schema = T.StructType(list(spec.raw_schema(with_tech=True).fields)
                          + [T.StructField("feed", T.StringType()),
                             T.StructField("load", T.StringType())])
    r = (spark.readStream.schema(schema).option("header", header).option("sep", "|")
         .option("mode", "PERMISSIVE"))
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", str(max_files_per_trigger))
    df = r.csv(landing).drop("archive")
    return df.filter((F.col("feed") == spec.name) & F.col("load").isin("add", "change"))


def merge_batch(spark: SparkSession, table_root: str, spec: FeedSpec, as_of,
                null_safe: bool = False):
    """The foreachBatch body: type, split by load kind, merge, publish.
    ``as_of``: a date, or a function of the batch id, for a stream that runs
    over days."""
    mk = MergeKeys.of(spec)

    def run(batch: DataFrame, batch_id: int) -> None:
        stream_id = batch.sparkSession.sparkContext.getLocalProperty("sql.streaming.queryId")
        ptr = snapshot.current(spark, table_root)
        if ptr is not None and ptr.batch_id is not None and ptr.stream_id == stream_id \
                and batch_id <= ptr.batch_id:
            return  # already folded in before a restart
        batch = batch.persist()
        try:
            if batch.isEmpty():
                return  # e.g. only FULL files arrived: nothing to merge, no version
            add = typed(batch.filter(F.col("load") == "add"), spec)
            chg = typed(batch.filter(F.col("load") == "change"), spec)
            day = as_of(batch_id) if callable(as_of) else as_of
            jobs.merge_into(spark, table_root, add, chg, mk, day, null_safe,
                            batch_id=batch_id, stream_id=stream_id)
        finally:
            batch.unpersist()
    return run


def start_merge_stream(spark: SparkSession, landing: str, spec: FeedSpec, table_root: str,
                       as_of, checkpoint: str | None = None, available_now: bool = True,
                       processing_time: str | None = None, null_safe: bool = False,
                       header: bool = True,
                       max_files_per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream.  ``available_now`` drains what has landed and stops
    (a scheduled incremental run); otherwise it polls every
    ``processing_time``, and ``as_of`` has to be a function."""
    if processing_time and not available_now and not callable(as_of):
        raise ValueError("a polling stream runs over days: as_of has to be a function of the batch id")
    checkpoint = checkpoint or f"{table_root.rstrip('/')}/_stream/{spec.name}"
    w = (feed_stream(spark, landing, spec, header, max_files_per_trigger).writeStream
         .foreachBatch(merge_batch(spark, table_root, spec, as_of, null_safe))
         .option("checkpointLocation", checkpoint))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
