"""Helpers shared by the corpus operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path

#: A word is a longest run of characters other than space, \t, \n, \v, \f, \r.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet under ``spark.checkpoint.dir`` and read back.

    Cuts the lineage in a folder that driver and executors share, so a lost
    executor costs at most the tasks of the stage in flight; columns that a
    later step does not use are not read again.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def packed(docs: DataFrame, *used: str) -> DataFrame:
    """All columns of ``docs`` as one struct ``__row`` beside copies of the
    ``used`` ones named ``__<name>``: whatever other columns are called, they
    cannot clash with an operator's own."""
    return docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row"),
                       *[F.col(f"`{c}`").alias(f"__{c}") for c in used])


def unpacked(columns: list[str], results: list[str] = (), **new: Column) -> list[Column]:
    """The columns that ``packed`` put away, for a select; ``new`` values take
    the place of columns of that name, and columns named like one of the
    operator's ``results`` are left out, the result replaces them."""
    return [new[c].alias(c) if c in new else F.col("__row").getField(c).alias(c)
            for c in columns if c not in results]


def row_key(doc_id: Column, text: Column) -> list[Column]:
    """Identity of a document row where ids may be null or repeated: the id
    (null is replaced by 0 and told apart by the second value) and a hash of
    the text.  Rows that agree on all of these are one record repeated."""
    return [F.coalesce(doc_id, F.lit(0)).alias("__k1"),
            F.xxhash64(doc_id.isNull(), F.coalesce(text, F.lit("")), text.isNull()).alias("__k2")]
