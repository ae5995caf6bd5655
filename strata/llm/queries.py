"""One registered query per corpus operator, over its whole driver table, and
DuckDB SQL for those that SQL can express."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sql
from .common import table
from .conversations import repaired_damage
from .cotraining import classify
from .decontaminate import decontaminate
from .langid import identify
from .line_dedup import dedup_lines
from .mixing import mix
from .pieces import round_trip
from .pii import replace_private
from .quality_rules import quality_rules
from .simhash import simhash_groups
from .spelling import spelling_variants
from .substring_dedup import find_repeats
from .url_filter import filter_urls

QUERIES: dict = {}
ORACLE: dict[str, str] = {
    "op3_url_filters": sql.URLS,
    "op7_mix_sources": sql.MIX,
    "op10_quality_rules": sql.QUALITY,
    "op12_conversation_repair": sql.CONVERSATIONS,
    "op13_spelling_variants": sql.SPELLING,
}


def query(f):
    QUERIES[f.__name__] = f
    return f


@query
def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base verdict and adaptive verdict of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    return quality_rules(docs, carry=["doc_id"])


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    groups = simhash_groups(table(spark, sf_dir, "documents"))
    return groups.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
                         "component_id")


@query
def op7_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    return mix(docs, carry=["doc_id"])


@query
def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Host, path, deciding rule and verdict of every page."""
    return filter_urls(table(spark, sf_dir, "pages").select("page_id", "url")).drop("url")


@query
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predicted language of every document."""
    return identify(table(spark, sf_dir, "documents"))


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document less its repeated line chunks."""
    return dedup_lines(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that share spans with others: the spans (bytes) and those to
    remove, each with the first document that has it."""
    found = find_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    doc_id = F.when(F.col("ord") < 1 << 62, F.col("ord")).alias("doc_id")
    return found.select(doc_id, "n_bytes", "shared", "removed")


@query
def op8_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every benchmark item found in a document, with its edit distance."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    d = decontaminate(docs, table(spark, sf_dir, "benchmark"))
    return d.select("doc.doc_id", F.explode("leaks").alias("leak")).select("doc_id", "leak.*")


@query
def op9_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text of every document with surrogates for personal data."""
    return replace_private(table(spark, sf_dir, "documents").select("doc_id", "text"))


@query
def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Calibrated quality of every document by text, by metadata and by both."""
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Number and digest of every text's ids, and digest of what they decode to."""
    from public_tokenizers import path
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return round_trip(docs, path("piece_bpe_32k.model"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults of every damaged conversation, and its cheapest repair."""
    return repaired_damage(table(spark, sf_dir, "conversations"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its near words, form and root."""
    return spelling_variants(table(spark, sf_dir, "documents"))
