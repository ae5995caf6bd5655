"""Raw (all-string) feed rows -> typed, filtered, version-stamped rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import parse_date, parse_date_drop_time, text_to_int
from ..specs import END_DATE, START_DATE, ColumnSpec, FeedSpec


def q(name: str) -> Column:
    """Column by name, quoted (names such as `udi-di` carry a hyphen)."""
    return F.col(f"`{name}`")


def typed_column(c: ColumnSpec) -> Column:
    if c.kind == "date":
        e = parse_date_drop_time(q(c.name)) if c.drop_time else parse_date(q(c.name))
    elif c.kind == "int":
        e = text_to_int(q(c.name))
    else:
        e = q(c.name).cast("string")
    return e.alias(c.name)


def typed_columns(spec: FeedSpec) -> list[Column]:
    return [typed_column(c) for c in spec.columns]


def lower_rename(df: DataFrame, spec: FeedSpec | None = None) -> DataFrame:
    """Lower-case every column name, then apply the feed's alias renames."""
    df = df.toDF(*[c.lower() for c in df.columns])
    for old, new in (spec.renames if spec else ()):
        df = df.withColumnRenamed(old, new)
    return df


def required_filter(spec: FeedSpec, full_load: bool = False) -> Column:
    """The key must be present; FULL loads may require more raw columns.

    Binds to the *raw* strings: a present but unparseable date passes and
    becomes null after typing.
    """
    cond = q(spec.first_key).isNotNull()
    if full_load:
        for name in spec.required:
            cond = cond & q(name).isNotNull()
    return cond


def as_date(as_of) -> Column:
    if isinstance(as_of, (dt.date, dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(as_of).cast("date")


def stamp_columns(as_of) -> list[Column]:
    return [as_date(as_of).alias(START_DATE), F.lit(None).cast("date").alias(END_DATE)]


def stamp(df: DataFrame, as_of, columns: list[str] | None = None) -> DataFrame:
    """Open a version: start_date = as_of, end_date = null."""
    cols = [q(c) for c in (columns or [c for c in df.columns
                                       if c not in (START_DATE, END_DATE)])]
    return df.select(*cols, *stamp_columns(as_of))


def typed(raw: DataFrame, spec: FeedSpec, as_of=None, full_load: bool = False,
          require: bool = True) -> DataFrame:
    """Filter on raw strings, then one projection typing every spec column.

    With ``as_of`` the two version columns are appended.  One ``select`` keeps
    the whole step inside a single codegen stage right after the scan.
    """
    if require:
        raw = raw.filter(required_filter(spec, full_load))
    cols = typed_columns(spec)
    if as_of is not None:
        cols += stamp_columns(as_of)
    return raw.select(*cols)
