"""Plain-SQL statements of the merge steps, for checking against DuckDB.

These restate the three merge statements (insert new ADD keys, close
changed open rows, insert CHANGE EXCEPT open rows) as CTEs over the scenario
inputs of ``scenarios.trio_sql``.
"""

from __future__ import annotations

from .scenarios import AS_OF, TrioSpec, q, trio_sql


def _keys_eq(keys, a, b):
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in keys)


def _diff(values, a, b, null_safe, nocase=()):
    op = "IS DISTINCT FROM" if null_safe else "<>"
    return " OR ".join(f"{a}.{q(v)} {op} {b}.{q(v)}" + (" COLLATE NOCASE" if v in nocase else "")
                       for v in values)


def merge_ctes(t: TrioSpec, null_safe: bool = False, nocase: tuple[str, ...] = (),
               lower_v1_digit: int | None = None) -> str:
    """``nocase``: text columns compared case-insensitively (also in EXCEPT)."""
    keys, values = list(t.keys), list(t.values) + list(t.carry)
    biz = ", ".join(q(c) for c in keys + values)
    mbiz = ", ".join(f"m.{q(c)}" for c in keys + values)
    ebiz = ", ".join(f"{c} COLLATE NOCASE AS {c}" if c in nocase else q(c) for c in keys + values)
    return f"""WITH {trio_sql(t, lower_v1_digit)},
ins_add AS (SELECT a.* FROM add_b a
            WHERE NOT EXISTS (SELECT 1 FROM main0 m WHERE {_keys_eq(keys, 'm', 'a')})),
main1 AS (SELECT * FROM main0
          UNION ALL SELECT {biz}, DATE '{AS_OF}' AS start_date, CAST(NULL AS DATE) AS end_date FROM ins_add),
main2 AS (SELECT {mbiz}, m.start_date,
                 CASE WHEN m.end_date IS NULL AND EXISTS (
                        SELECT 1 FROM chg c WHERE {_keys_eq(keys, 'c', 'm')}
                          AND ({_diff(values, 'c', 'm', null_safe, nocase)}))
                      THEN DATE '{AS_OF}' ELSE m.end_date END AS end_date
          FROM main1 m),
ins_chg AS (SELECT {ebiz} FROM chg EXCEPT SELECT {ebiz} FROM main2 WHERE end_date IS NULL),
merged AS (SELECT * FROM main2
           UNION ALL SELECT {biz}, DATE '{AS_OF}' AS start_date, CAST(NULL AS DATE) AS end_date FROM ins_chg)"""


def merge_sql(t: TrioSpec, null_safe: bool = False, nocase: tuple[str, ...] = (),
              lower_v1_digit: int | None = None) -> str:
    return merge_ctes(t, null_safe, nocase, lower_v1_digit) + "\nSELECT * FROM merged"
