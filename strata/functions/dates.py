"""Lenient date parsing: first successful format wins, bad text becomes null.

Everything is a built-in expression (stays inside whole-stage codegen) and
gives the same answer with ANSI mode on or off: ``try_to_timestamp`` returns
null where plain ``to_timestamp`` would raise under ANSI.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# The accepted day formats, tried in this order (month-first
# wins for ambiguous text such as 03/04/2020).
DATE_FORMATS = ("MM/dd/yyyy", "yyyy/MM/dd", "dd/MM/yyyy")


# What text of a format's fields looks like at least.
_FIELDS = {"MM": "(0[1-9]|1[0-2])", "dd": "(0[1-9]|[12][0-9]|3[01])", "yyyy": "[+-]?[0-9]{4,}"}


def _shape(fmt: str) -> str | None:
    """A pattern that all text of the format has; None if it has other fields."""
    parts = re.split(r"([A-Za-z]+)", fmt)
    if not all(p in _FIELDS for p in parts[1::2]):
        return None
    return "^" + "".join(_FIELDS[p] if i % 2 else re.escape(p) for i, p in enumerate(parts)) + "$"


def _try_date(c: Column, fmt: str) -> Column:
    """The parse of one format; text without its shape is not tried, for a failed
    try costs an exception, far more than the parse."""
    day = F.try_to_timestamp(c, F.lit(fmt)).cast("date")
    shape = _shape(fmt)
    return day if shape is None else F.when(c.rlike(shape), day)


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def parse_date(c, formats=DATE_FORMATS) -> Column:
    """coalesce over formats of try_to_timestamp(c, fmt) cast to date."""
    c = _col(c)
    return F.coalesce(*[_try_date(c, f) for f in formats])


def drop_time(c) -> Column:
    """Keep the text before the first blank (`12/25/2020 10:00` -> `12/25/2020`)."""
    return F.split(_col(c), " ").getItem(0)


def parse_date_drop_time(c, formats=DATE_FORMATS) -> Column:
    return parse_date(drop_time(c), formats)
