"""Catalog tables with the layout's declared types.

Tables are created from ``FeedSpec.ddl``: text columns are ``VARCHAR(n)``, and
Spark checks the widths whenever rows are written (a value that is too long
only by trailing blanks is cut to the width, any other fails the write).
Rows go in by position, as an INSERT from a view does.

A table keeps its files in a folder of its root.  INSERT OVERWRITE would delete
the old rows before it has checked the new ones; so a load is written to a
folder of its own, and the table is pointed there once the write has succeeded.
The folder before stays, for queries that still read it; older ones go.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from ..specs import FeedSpec


def _folder(root: str) -> str:
    return f"{root.rstrip('/')}/rows-{uuid.uuid4().hex[:12]}"


def location(spark: SparkSession, name: str) -> str:
    """Folder of the table's present rows."""
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {name}").where("col_name = 'Location'")
    return rows.first()["data_type"]


def create_table(spark: SparkSession, name: str, spec: FeedSpec, root: str) -> None:
    """Table ``name`` in the layout's declared types under ``root``, unless it
    exists; its files stay when it is dropped."""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({spec.ddl()}) USING parquet LOCATION '{_folder(root)}'")


def replace_rows(spark: SparkSession, rows: DataFrame, name: str, spec: FeedSpec, root: str) -> None:
    """``rows`` in place of the table's, column by column in their order; a write
    that fails leaves the table as it was."""
    before, new, at = location(spark, name), f"{name}_{uuid.uuid4().hex[:12]}", _folder(root)
    spark.sql(f"CREATE TABLE {new} ({spec.ddl()}) USING parquet LOCATION '{at}'")
    try:
        rows.write.insertInto(new)
    finally:
        spark.sql(f"DROP TABLE {new}")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{at}'")
    _forget(spark, root, keep=(before, at))


def insert_select(spark: SparkSession, name: str, view: str) -> None:
    """Appends all rows of a view or table, by position."""
    spark.table(view).write.insertInto(name)


def _forget(spark: SparkSession, root: str, keep) -> None:
    kept = {k.rstrip("/").rsplit("/", 1)[-1] for k in keep}
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    for s in fs.listStatus(path):
        if s.getPath().getName().startswith("rows-") and s.getPath().getName() not in kept:
            fs.delete(s.getPath(), True)
