"""Corpus pipeline: quality rules, line de-duplication, near-duplicate
removal, benchmark decontamination, mixing sources to target weights.

Each stage takes (spark, docs, sf_dir); its result is written as Parquet under
``spark.checkpoint.dir`` and read back as the next stage's input, so a lost
executor never reaches behind the stage in flight.  All stages but the last
return the columns of the documents; the last adds how often each document is
taken.  Any null, repeated id, extra column or empty table that the operators
define a result for passes through the stages; where a stage brings its
verdict back to the documents it does so by id and a hash of the text, so rows
that agree in both are one record.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from strata.llm.common import packed, row_key, stored, table, unpacked
from strata.llm.decontaminate import decontaminate
from strata.llm.line_dedup import dedup_lines
from strata.llm.mixing import RESULTS, mix
from strata.llm.quality_rules import quality_rules
from strata.llm.simhash import MAX_BITS, WIDTH, simhash_groups

HAS_WORD = r"[^\x20\x09-\x0D]"


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base and the adaptive rules."""
    judged = quality_rules(docs.select(F.struct("*").alias("doc"), "text", "lang", "source"),
                           carry=["doc"])
    return judged.where("kept").select("doc.*")


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents less their repeated line chunks; those that nothing is left of
    go (all they held stays elsewhere).  ``n_chars`` follows the text."""
    cleaned = dedup_lines(docs.select(F.struct("*").alias("doc"), "doc_id", "text"))
    left = cleaned.where((F.col("lines_removed") == 0) | F.rlike("text", F.lit(HAS_WORD)))
    new = {"text": F.col("text"), "n_chars": F.when(
        F.col("lines_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType))
        .otherwise(F.col("doc.n_chars")) if "n_chars" in docs.columns else None}
    return left.select(*[new[c].alias(c) if new.get(c) is not None
                         else F.col("doc").getField(c).alias(c) for c in docs.columns])


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group: the one of the smallest id
    (null last), among equal ids the smallest text hash."""
    d = packed(docs, "doc_id", "text")
    d = d.select("*", *row_key(F.col("__doc_id"), F.col("__text")))
    groups = simhash_groups(d, keys=("__doc_id", "__k1", "__k2"), id_col="__doc_id",
                            text="__text", width=WIDTH, max_bits=MAX_BITS)
    first = F.min(F.struct(F.col("__doc_id").isNull(), "__k1", "__k2")).alias("w")
    stay = stored(groups.groupBy("root").agg(first).select(
        F.col("w.__k1").alias("k1"), F.col("w.__k2").alias("k2")), "stay")
    # repeated records are combined within each task before they are dealt out
    once = d.select("__row", "__k1", "__k2").dropDuplicates(["__k1", "__k2"])
    kept = once.join(stay, (F.col("__k1") == F.col("k1")) & (F.col("__k2") == F.col("k2")), "left_semi")
    return kept.select(*unpacked(docs.columns))


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that contain no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark")).where(
        F.size("leaks") == 0).select("doc.*")


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with size, source_size, target, taken and first_slot.  Only
    keys go through the schedule; repeated records share what they are given
    evenly."""
    d = packed(docs, "doc_id", "text", "source")
    d = d.select("*", *row_key(F.col("__doc_id"), F.col("__text")))
    slim = mix(d.select("__k1", "__k2", F.col("__doc_id").alias("doc_id"),
                        F.col("__text").alias("text"), F.col("__source").alias("source")),
               carry=["__k1", "__k2", "source"])
    slim = stored(slim.groupBy(F.col("__k1").alias("k1"), F.col("__k2").alias("k2"),
                               F.col("source").alias("s")).agg(
        *[F.max(c).alias(c) for c in ("size", "source_size", "target")],
        F.expr("sum(taken) div count(1)").alias("taken"), F.min("first_slot").alias("first_slot")), "mix")
    out = d.join(slim, (F.col("__k1") == F.col("k1")) & (F.col("__k2") == F.col("k2"))
                 & F.col("__source").eqNullSafe(F.col("s")))
    return out.select(*unpacked(docs.columns, RESULTS), *RESULTS)


STAGES = [
    ("quality rules", quality_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_duplicate_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources", mixing_stage),
]

#: Fingerprints, content-defined chunks and edit distances are beyond SQL;
#: tests/llm/test_pipeline.py holds the result against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = stored(docs, f"stage{k}")
    return docs
