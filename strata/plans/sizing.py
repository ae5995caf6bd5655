"""Broadcast only what has been measured.

``measure`` runs one aggregate over a (small, usually key-only) DataFrame to
get its exact row count and its bytes in Spark's row format.  Only when that
``fits`` the limit does the caller mark the frame for broadcast; otherwise its
join is a shuffle join (sort-merge, with AQE skew splitting).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

DEFAULT_LIMIT = 64 * 1024 * 1024   # bytes of measured rows
ROW_OVERHEAD = 24                   # per-row bytes on top of the row (hash map entry, row header)
LIMIT_CONF = "strata.broadcast.maxBytes"


def broadcast_limit(spark: SparkSession) -> int:
    v = spark.conf.get(LIMIT_CONF, None)
    return int(v) if v else DEFAULT_LIMIT


def measure(df: DataFrame) -> tuple[int, int]:
    """Exact (rows, bytes) of ``df`` in one pass."""
    if not df.columns:
        return df.count(), 0
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(row_bytes(df)).alias("b")).first()
    return int(r["n"]), int(r["b"] or 0)


def row_bytes(df: DataFrame):
    """Bytes of a row in Spark's binary format: the null bits, eight bytes per
    column, and the octets of strings and other variable types, padded to
    eight."""
    fixed = 8 * ((len(df.columns) + 63) // 64) + 8 * len(df.columns)
    var = []
    for c, t in df.dtypes:
        if t in FIXED:
            continue
        x = F.col(f"`{c}`")
        n = F.octet_length(x if t.startswith("string") or t == "binary" else x.cast("string"))
        var.append(F.coalesce(F.ceil(n / 8) * 8, F.lit(0)))
    return reduce(lambda a, b: a + b, var, F.lit(fixed))


# Types held in a row's fixed part.
FIXED = {"boolean", "tinyint", "smallint", "int", "date", "float", "bigint", "double", "timestamp",
         "timestamp_ntz"}


def measure_all(frames: list[DataFrame]) -> list[tuple[int, int]]:
    """Exact (rows, bytes) of several frames in a single job."""
    parts = []
    for i, df in enumerate(frames):
        parts.append(df.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n"),
                            F.sum(row_bytes(df)).cast("long").alias("b")))
    out = reduce(lambda a, b: a.unionByName(b), parts).collect()
    got = {r["i"]: (int(r["n"]), int(r["b"] or 0)) for r in out}
    return [got[i] for i in range(len(frames))]


def max_rows_per_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One-row frame: the largest number of rows sharing one key (exact; a
    hash aggregate on the key columns, partial before the shuffle)."""
    return (df.groupBy(*[F.col(f"`{k}`") for k in keys]).count()
            .agg(F.coalesce(F.max("count"), F.lit(0)).alias("m")))


def measure_with_multiplicity(frames: list[DataFrame], keyed: DataFrame,
                              keys: list[str]) -> tuple[list[tuple[int, int]], int]:
    """``measure_all`` plus the largest key multiplicity of ``keyed``, in the
    same single job."""
    parts = []
    for i, df in enumerate(frames):
        parts.append(df.agg(F.lit(i).alias("i"), F.count(F.lit(1)).alias("n"),
                            F.sum(row_bytes(df)).cast("long").alias("b")))
    parts.append(max_rows_per_key(keyed, keys).select(
        F.lit(-1).alias("i"), F.col("m").cast("long").alias("n"), F.lit(0).cast("long").alias("b")))
    out = reduce(lambda a, b: a.unionByName(b), parts).collect()
    got = {r["i"]: (int(r["n"]), int(r["b"] or 0)) for r in out}
    return [got[i] for i in range(len(frames))], got[-1][0]


def fits(rows: int, payload: int, limit: int) -> bool:
    return payload + rows * ROW_OVERHEAD <= limit
