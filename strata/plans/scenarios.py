"""Merge inputs derived from the driver tables.

Each table is cut into history / ADD / CHANGE by a case digit of one column,
so every row of the table takes part and each digit exercises one merge case
(untouched, changed, null->value, unchanged, ADD blocked by an open or a
closed version, plain ADD, ADD then CHANGE the same day).  No row is dropped
or sampled: the derivation is one projection + filter per part, so the work
grows with the table.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.merge import MergeKeys
from ..specs import END_DATE, START_DATE

# Fixed dates of the scenario.
HISTORY_START = "2024-01-01"
HISTORY_CLOSED = "2024-02-01"
AS_OF = "2024-03-01"


@dataclass(frozen=True)
class TrioSpec:
    table: str
    keys: tuple[str, ...]
    case_col: str
    values: tuple[str, str, str]   # v0 (text), v1 (text), v2 (number)
    carry: tuple[str, ...] = ()    # further value columns, carried unchanged
    # Optional derived source: name -> (Spark expression builder, SQL expression)
    derived: tuple = ()

    @property
    def mk(self) -> MergeKeys:
        return MergeKeys(list(self.keys), list(self.values) + list(self.carry))


ORDERS_TRIO = TrioSpec("orders", ("o_orderkey",), "o_orderkey",
                       ("o_orderstatus", "o_orderpriority", "o_totalprice"))
LINEITEM_TRIO = TrioSpec("lineitem", ("l_orderkey", "l_linenumber"), "l_partkey",
                         ("l_returnflag", "l_linestatus", "l_quantity"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@dataclass
class Trio:
    history: DataFrame
    add: DataFrame
    change: DataFrame
    mk: MergeKeys


def trio(spark: SparkSession, sf_dir: str, t: TrioSpec) -> Trio:
    v0, v1, v2 = t.values
    src = table(spark, sf_dir, t.table)
    case = F.pmod(F.col(t.case_col), F.lit(10)).alias("_d")
    if t.derived:
        base = src.select(*[build().alias(name) for name, build, _ in t.derived], case)
    else:
        base = src.select(*t.keys, *t.values, *t.carry, case)
    d: Column = F.col("_d")
    carry = [F.col(f"`{c}`") for c in t.carry]
    history = (base.filter(d < 8)
               .select(*t.keys, v0,
                       F.when(d == 3, F.lit(None).cast("string")).otherwise(F.col(v1)).alias(v1),
                       v2, *carry,
                       F.lit(HISTORY_START).cast("date").alias(START_DATE),
                       F.when(d == 7, F.lit(HISTORY_CLOSED).cast("date"))
                        .otherwise(F.lit(None).cast("date")).alias(END_DATE)))
    add = base.filter(d >= 6).select(*t.keys, *t.values, *carry)
    change = (base.filter(d.isin(2, 3, 4, 7, 9))
              .select(*t.keys,
                      F.when(d == 2, F.lit("Z")).otherwise(F.col(v0)).alias(v0),
                      v1,
                      F.when(d == 9, F.col(v2) + 1).otherwise(F.col(v2)).alias(v2),
                      *carry))
    return Trio(history, add, change, t.mk)


def lower_v1(tr: Trio, t: TrioSpec, digit: int = 4) -> Trio:
    """CHANGE with v1 lower-cased on one case digit: a difference in letter
    case only, which a case-insensitive collation does not see."""
    v1 = t.values[1]
    d = F.pmod(F.col(t.case_col), F.lit(10))
    chg = tr.change.withColumn(v1, F.when(d == digit, F.lower(F.col(v1))).otherwise(F.col(v1)))
    return Trio(tr.history, tr.add, chg, tr.mk)


def trio_sql(t: TrioSpec, lower_v1_digit: int | None = None) -> str:
    """The same three inputs as DuckDB CTEs (main0, add_b, chg); optionally
    CHANGE lower-cases v1 on one case digit (see ``lower_v1``)."""
    v0, v1, v2 = t.values
    v1_chg = (v1 if lower_v1_digit is None
              else f"CASE WHEN _d = {lower_v1_digit} THEN lower({v1}) ELSE {v1} END AS {v1}")
    k = ", ".join(t.keys)
    cr = "".join(f", {q(c)}" for c in t.carry)
    if t.derived:
        cols = ", ".join(f"{sql} AS {q(name)}" for name, _, sql in t.derived)
    else:
        cols = f"{k}, {v0}, {v1}, {v2}{cr}"
    return f"""base AS (SELECT {cols}, ({t.case_col} % 10) AS _d FROM {t.table}),
main0 AS (SELECT {k}, {v0}, CASE WHEN _d = 3 THEN NULL ELSE {v1} END AS {v1}, {v2}{cr},
                 DATE '{HISTORY_START}' AS start_date,
                 CASE WHEN _d = 7 THEN DATE '{HISTORY_CLOSED}' ELSE CAST(NULL AS DATE) END AS end_date
          FROM base WHERE _d < 8),
add_b AS (SELECT {k}, {v0}, {v1}, {v2}{cr} FROM base WHERE _d >= 6),
chg AS (SELECT {k}, CASE WHEN _d = 2 THEN 'Z' ELSE {v0} END AS {v0}, {v1_chg},
               CASE WHEN _d = 9 THEN {v2} + 1 ELSE {v2} END AS {v2}{cr}
        FROM base WHERE _d IN (2, 3, 4, 7, 9))"""


def q(name: str) -> str:
    """SQL identifier, quoted when needed (layouts have names like `udi-di`)."""
    return name if name.replace("_", "").isalnum() else f'"{name}"'


def layout_columns(spec) -> list[tuple]:
    """A feed layout filled from ``events``, typed: (column, Spark expression
    builder, SQL).  Keys from the event and user ids, text columns from the
    event type and properties, ints from the value, dates from the timestamp
    (shifted by column position)."""
    out = []
    for i, c in enumerate(spec.columns):
        if c.is_key:
            src = ("event_id", "user_id")[spec.keys.index(c.name) % 2]
            out.append((c, lambda s=src: F.col(s).cast("string"), f"CAST({src} AS VARCHAR)"))
        elif c.kind == "string" and i % 3 < 2:
            src = ("event_type", "props")[i % 3]
            out.append((c, lambda s=src: F.col(s), src))
        elif c.kind == "string":
            out.append((c, lambda i=i: F.concat(F.col("event_type"), F.lit(f"_{i}")), f"event_type || '_{i}'"))
        elif c.kind == "int":
            out.append((c, lambda i=i: (F.floor("value") % 1000 + i).cast("int"),
                        f"CAST(CAST(floor(value) AS BIGINT) % 1000 + {i} AS INTEGER)"))
        else:
            out.append((c, lambda i=i: F.date_add(F.to_date("ts"), i), f"CAST(ts AS DATE) + {i}"))
    return out


def feed_from_events(spec, case_col: str = "event_id") -> TrioSpec:
    """``layout_columns`` as merge inputs.  The first two text columns of the
    layout play v0 and v1, its first int (or date) v2."""
    texts = [c.name for c in spec.columns if not c.is_key and c.kind == "string"]
    nums = [c.name for c in spec.columns if not c.is_key and c.kind == "int"] or \
        [c.name for c in spec.columns if not c.is_key and c.kind == "date"]
    v0, v1, v2 = texts[0], texts[1], nums[0]   # v2 + 1: next int, or next day
    derived = [(c.name, build, sql) for c, build, sql in layout_columns(spec)]
    derived.append((case_col, lambda: F.col(case_col), case_col))
    carry = tuple(n for n in spec.values if n not in (v0, v1, v2))
    return TrioSpec("events", tuple(spec.keys), case_col, (v0, v1, v2), carry, tuple(derived))
