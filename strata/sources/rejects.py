"""Reject channel: lines that do not fit their layout, kept beside the load.

The scan puts the whole line into a record column wherever its fields are not as
many as the layout's.  One write, partitioned by whether a row has such a record,
stores the rows that fit and the rejects in the same pass over the text, and the
counts are observed on the way; nothing is scanned twice.

By default a channel only records: the load goes on with every row, short lines
null-filled and surplus fields cut, as it does without a channel.  With
``drop=True`` rejects are left out of the load.  A blank line is no record.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..specs import FeedSpec
from .delimited import CORRUPT

REJECTED = "rejected"


@dataclass
class RejectChannel:
    """Rejects under ``<root>/feed=<feed>/load=<load>``, replaced by every run.

    ``counts`` holds per (feed, load) how many ``lines`` were read, how many of
    them ``rejected``, and how many of those lack the layout's last column
    (``short_lines``) or not (``surplus_lines``)."""
    root: str
    drop: bool = False
    counts: dict[tuple[str, str], dict[str, int]] = field(default_factory=dict)

    def path(self, spec: FeedSpec, load: str) -> str:
        return f"{self.root.rstrip('/')}/feed={spec.name}/load={load}"

    def route(self, raw: DataFrame, spec: FeedSpec, load: str) -> DataFrame:
        """The rows to load of ``raw`` (read with its records); writes the channel."""
        bad, last = F.col(CORRUPT).isNotNull(), F.col(f"`{spec.names[-1]}`")
        seen = Observation()
        rows = raw.observe(seen, F.count(F.lit(1)).alias("lines"), F.count_if(bad).alias("rejected"),
                           F.count_if(bad & last.isNull()).alias("short_lines"),
                           F.count_if(bad & last.isNotNull()).alias("surplus_lines"))
        rows.withColumn(REJECTED, bad).write.mode("overwrite").partitionBy(REJECTED).parquet(self.path(spec, load))
        self.counts[spec.name, load] = dict(seen.get)
        stored = self._stored(raw.sparkSession, spec, load)
        return (stored.where(~F.col(REJECTED)) if self.drop else stored).drop(CORRUPT, REJECTED)

    def rejected(self, spark: SparkSession, spec: FeedSpec, load: str) -> DataFrame:
        """The rejected rows as they were parsed, and ``record``, the whole line."""
        return (self._stored(spark, spec, load).where(REJECTED).drop(REJECTED)
                .withColumnRenamed(CORRUPT, "record"))

    def _stored(self, spark: SparkSession, spec: FeedSpec, load: str) -> DataFrame:
        schema = spec.raw_schema(with_tech=False).add(CORRUPT, T.StringType()).add(REJECTED, T.BooleanType())
        return spark.read.schema(schema).parquet(self.path(spec, load))
