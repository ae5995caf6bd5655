"""Declared-width checks for string columns (targets declare `nvarchar(n)`).

``width_report`` counts over-long values per column in one aggregate pass;
``enforce_widths`` applies the target's rule inside the projection: fail the
job on the first over-long value (as a width-checked table insert does),
null it, or flag the row.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..specs import FeedSpec


def width_report(df: DataFrame, widths, table_name: str = "") -> DataFrame:
    """(tbl, col, width, rows_over, max_len) per declared column."""
    widths = list(widths)
    aggs = []
    for col, w in widths:
        n = F.length(F.col(f"`{col}`"))
        aggs += [F.count(F.when(n > w, 1)).alias(f"{col}__over"), F.max(n).alias(f"{col}__max")]
    r = df.agg(*aggs)
    stack = ", ".join(f"'{c}', {w}, `{c}__over`, `{c}__max`" for c, w in widths)
    return r.selectExpr(f"'{table_name}' AS tbl",
                        f"stack({len(widths)}, {stack}) AS (col, width, rows_over, max_len)")


def spec_widths(spec: FeedSpec) -> list[tuple[str, int]]:
    return [(c.name, c.width) for c in spec.columns if c.kind == "string" and c.width]


def enforce_widths(df: DataFrame, widths, mode: str = "fail") -> DataFrame:
    """mode: 'fail' raises on an over-long value, 'null' nulls it, 'flag'
    adds a boolean `width_ok` column."""
    widths = dict(widths)
    if mode == "flag":
        ok = reduce(lambda a, b: a & b,
                    [F.coalesce(F.length(F.col(f"`{c}`")) <= w, F.lit(True)) for c, w in widths.items()],
                    F.lit(True))
        return df.withColumn("width_ok", ok)
    cols = []
    for c in df.columns:
        e = F.col(f"`{c}`")
        if c in widths:
            over = F.length(e) > widths[c]
            if mode == "fail":
                e = F.when(over, F.raise_error(F.lit(f"value too long for {c} (max {widths[c]})"))
                           ).otherwise(e)
            elif mode == "null":
                e = F.when(over, F.lit(None).cast("string")).otherwise(e)
            else:
                raise ValueError(mode)
        cols.append(e.alias(c))
    return df.select(*cols)
