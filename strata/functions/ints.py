"""Text -> int with the non-ANSI cast rules, correct under either ANSI setting.

Rules of the non-ANSI string->int cast: control characters and blanks around
the value are ignored, an optional sign, decimal digits, and an optional
fractional part made only of digits that is truncated away; a lone `.`
(optionally signed) reads as 0; anything else, or a value outside the int
range, is null.  Plain ``try_cast`` differs (it rejects `1.0`), so the integral
part is cut out first and only that is cast.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_SHAPE = r"^[\x00-\x20]*([+-]?)([0-9]*)(\.[0-9]*)?[\x00-\x20]*$"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def text_to_int(c) -> Column:
    c = _col(c)
    shaped = c.rlike(_SHAPE)
    sign = F.regexp_extract(c, _SHAPE, 1)
    digits = F.regexp_extract(c, _SHAPE, 2)
    point = F.regexp_extract(c, _SHAPE, 3)
    lenient = (F.when(shaped & (digits != ""), F.concat(sign, digits).try_cast("int"))
                .when(shaped & (point != ""), F.lit(0))
                .otherwise(F.lit(None).cast("int")))
    # A value the strict cast accepts reads the same under both rules, so the
    # regex path only runs for the rest (coalesce is evaluated lazily).
    return F.coalesce(c.try_cast("int"), lenient)
