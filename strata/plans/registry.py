"""Registered queries: one per operator of the inventory, each paired with an
equivalent DuckDB statement over the same parquet tables.

Every query reads whole driver tables (or data Spark derives from them).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import (file_stem, landing_key, load_filter, load_folder, member_name,
                         parse_date, parse_date_drop_time, route_load, route_table,
                         text_to_int, url_basename)
from ..operators.checks import enforce_widths, width_report
from ..operators.merge import (diff_condition, except_changed, key_condition, merge,
                               merge_parts, new_key_rows, open_versions)
from ..operators.typed import lower_rename, stamp, typed
from ..sources.archives import archive_lines
from ..sources.delimited import read_feed, read_feed_files
from ..sources.jdbc import jdbc_append, jdbc_read
from ..sources.links import anchor_links, kept_links, table_links
from . import feedfiles as FF
from .oracle import merge_ctes, merge_sql
from ..specs import FEED_ORDER, FEEDS, make_spec
from .scenarios import AS_OF, LINEITEM_TRIO, ORDERS_TRIO, feed_from_events, lower_v1, table, trio

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


# --- merge family (orders trio unless noted) --------------------------------

@register("history_merge", merge_sql(ORDERS_TRIO))
def q_history_merge(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    return merge(t.history, t.add, t.change, keys=t.mk.keys, values=t.mk.values, as_of=AS_OF)


@register("history_merge_dups", merge_sql(LINEITEM_TRIO))
def q_history_merge_dups(spark, sf_dir):
    t = trio(spark, sf_dir, LINEITEM_TRIO)
    return merge(t.history, t.add, t.change, keys=t.mk.keys, values=t.mk.values, as_of=AS_OF)


@register("history_merge_null_safe", merge_sql(ORDERS_TRIO, null_safe=True))
def q_history_merge_null_safe(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    return merge(t.history, t.add, t.change, keys=t.mk.keys, values=t.mk.values,
                 as_of=AS_OF, null_safe=True)


@register("history_merge_nocase",
          merge_sql(ORDERS_TRIO, nocase=("o_orderstatus", "o_orderpriority"), lower_v1_digit=4))
def q_history_merge_nocase(spark, sf_dir):
    """Merge under a case-insensitive collation: CHANGE rows that differ only
    in letter case neither close a version nor open one."""
    t = lower_v1(trio(spark, sf_dir, ORDERS_TRIO), ORDERS_TRIO)
    return merge(t.history, t.add, t.change, keys=t.mk.keys, values=t.mk.values,
                 as_of=AS_OF, collation="UTF8_LCASE")


@register("insert_new_keys",
          merge_ctes(ORDERS_TRIO) + "\nSELECT *, DATE '" + AS_OF
          + "' AS start_date, CAST(NULL AS DATE) AS end_date FROM ins_add")
def q_insert_new_keys(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    return stamp(new_key_rows(t.add, t.history, t.mk.keys), AS_OF, t.mk.business)


@register("union_append", merge_ctes(ORDERS_TRIO) + "\nSELECT * FROM main1")
def q_union_append(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    ins = stamp(new_key_rows(t.add, t.history, t.mk.keys), AS_OF, t.mk.business)
    return t.history.unionByName(ins)


@register("close_changed", merge_ctes(ORDERS_TRIO) + "\nSELECT * FROM main2")
def q_close_changed(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    return merge_parts(t.history, t.add, t.change, t.mk, AS_OF).updated


@register("except_changed", merge_ctes(ORDERS_TRIO) + "\nSELECT * FROM ins_chg")
def q_except_changed(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    main2 = merge_parts(t.history, t.add, t.change, t.mk, AS_OF).updated
    return except_changed(main2, t.change, t.mk)


@register("open_versions",
          merge_ctes(ORDERS_TRIO) + "\nSELECT * FROM merged WHERE end_date IS NULL")
def q_open_versions(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    return open_versions(merge(t.history, t.add, t.change, keys=t.mk.keys,
                               values=t.mk.values, as_of=AS_OF))


_DIFF_SQL = (merge_ctes(ORDERS_TRIO) + """
SELECT m.o_orderkey, m.start_date,
       (c.o_orderstatus <> m.o_orderstatus OR c.o_orderpriority <> m.o_orderpriority
        OR c.o_totalprice <> m.o_totalprice) AS differs,
       (c.o_orderstatus IS DISTINCT FROM m.o_orderstatus
        OR c.o_orderpriority IS DISTINCT FROM m.o_orderpriority
        OR c.o_totalprice IS DISTINCT FROM m.o_totalprice) AS differs_null_safe
FROM main0 m JOIN chg c ON c.o_orderkey = m.o_orderkey""")


@register("diff_predicate", _DIFF_SQL)
def q_diff_predicate(spark, sf_dir):
    t = trio(spark, sf_dir, ORDERS_TRIO)
    keys, values = t.mk.keys, t.mk.values
    return (t.history.alias("m").join(t.change.alias("c"), key_condition(keys, "m", "c"), "inner")
            .select(F.col("m.o_orderkey").alias("o_orderkey"), F.col("m.start_date").alias("start_date"),
                    diff_condition(values, "m", "c").alias("differs"),
                    diff_condition(values, "m", "c", null_safe=True).alias("differs_null_safe")))


# --- scalar typing ------------------------------------------------------------


def _date_text(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    k, ts = F.col("o_orderkey"), F.col("o_orderdate")
    d = F.pmod(k, 5)
    raw = (F.when(d == 0, F.date_format(ts, "MM/dd/yyyy"))
           .when(d == 1, F.date_format(ts, "yyyy/MM/dd"))
           .when(d == 2, F.date_format(ts, "dd/MM/yyyy"))
           .when(d == 3, F.date_format(ts, "yyyy-MM-dd"))
           .otherwise(F.lit("")))
    return o.select(k, ts, d.alias("_d"), raw.alias("raw"))


_DATE_TEXT_SQL = """WITH t AS (
  SELECT o_orderkey, o_orderdate, o_orderkey % 5 AS _d,
         CASE o_orderkey % 5 WHEN 0 THEN strftime(o_orderdate, '%m/%d/%Y')
                             WHEN 1 THEN strftime(o_orderdate, '%Y/%m/%d')
                             WHEN 2 THEN strftime(o_orderdate, '%d/%m/%Y')
                             WHEN 3 THEN strftime(o_orderdate, '%Y-%m-%d')
                             ELSE '' END AS raw
  FROM orders)"""


@register("date_multiformat", _DATE_TEXT_SQL + f"""
SELECT o_orderkey, raw, {FF.date_sql('raw')} AS parsed FROM t""")
def q_date_multiformat(spark, sf_dir):
    t = _date_text(spark, sf_dir)
    return t.select("o_orderkey", "raw", parse_date("raw").alias("parsed"))


@register("date_drop_time", _DATE_TEXT_SQL.replace("ELSE '' END AS raw", "ELSE '' END AS raw0")
          + """,
u AS (SELECT o_orderkey, CASE WHEN _d < 3 THEN raw0 || ' ' || strftime(o_orderdate, '%H:%M:%S')
                              ELSE raw0 END AS raw FROM t)
SELECT o_orderkey, raw, """ + FF.date_sql("raw") + " AS plain, "
          + FF.date_sql("split_part(raw, ' ', 1)") + " AS parsed FROM u")
def q_date_drop_time(spark, sf_dir):
    t = _date_text(spark, sf_dir)
    raw = F.when(F.col("_d") < 3, F.concat(F.col("raw"), F.lit(" "),
                                           F.date_format("o_orderdate", "HH:mm:ss"))
                 ).otherwise(F.col("raw"))
    u = t.select("o_orderkey", raw.alias("raw"))
    return u.select("o_orderkey", "raw", parse_date("raw").alias("plain"),
                    parse_date_drop_time("raw").alias("parsed"))


@register("int_cast", """WITH t AS (
  SELECT l_orderkey, l_linenumber, CAST(CAST(floor(l_quantity) AS BIGINT) AS VARCHAR) AS q FROM lineitem),
u AS (SELECT l_orderkey, l_linenumber,
             CASE l_linenumber % 4 WHEN 0 THEN q WHEN 1 THEN q || '.0'
                                   WHEN 2 THEN ' ' || q || ' ' ELSE 'x' || q END AS raw FROM t)
SELECT l_orderkey, l_linenumber, raw, """ + FF.int_sql("raw") + " AS parsed FROM u")
def q_int_cast(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    q = F.floor("l_quantity").cast("bigint").cast("string")
    d = F.pmod(F.col("l_linenumber"), 4)
    raw = (F.when(d == 0, q).when(d == 1, F.concat(q, F.lit(".0")))
           .when(d == 2, F.concat(F.lit(" "), q, F.lit(" "))).otherwise(F.concat(F.lit("x"), q)))
    u = li.select("l_orderkey", "l_linenumber", raw.alias("raw"))
    return u.select("l_orderkey", "l_linenumber", "raw", text_to_int("raw").alias("parsed"))


# --- typed projection over raw feed rows ----------------------------------------

def _raw_orders(spark, sf_dir):
    f = FF._fields(table(spark, sf_dir, "orders"))
    return f.select(F.col("f0").alias("o_orderkey"), F.col("f1").alias("o_custkey"),
                    F.col("f2").alias("o_orderstatus"), F.col("f3").alias("o_orderdate"),
                    F.col("f4").alias("o_orderpriority"))


@register("typed_projection", FF.RAW_PLAIN_SQL + f"\nSELECT {FF.typed_select_sql()} FROM raw")
def q_typed_projection(spark, sf_dir):
    view = "orders_feed_raw_vw"
    _raw_orders(spark, sf_dir).createOrReplaceTempView(view)
    return typed(spark.table(view), FF.ORDERS_FEED, require=False)


@register("required_key", FF.RAW_PLAIN_SQL
          + f"\nSELECT {FF.typed_select_sql()} FROM raw WHERE o_orderkey IS NOT NULL")
def q_required_key(spark, sf_dir):
    return typed(_raw_orders(spark, sf_dir), FF.ORDERS_FEED)


@register("required_raw_date", FF.RAW_PLAIN_SQL + f"\nSELECT {FF.typed_select_sql()} FROM raw "
          "WHERE o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL")
def q_required_raw_date(spark, sf_dir):
    return typed(_raw_orders(spark, sf_dir), FF.ORDERS_FEED, full_load=True)


@register("version_stamp", FF.RAW_PLAIN_SQL + f"\nSELECT {FF.typed_select_sql(AS_OF)} FROM raw "
          "WHERE o_orderkey IS NOT NULL")
def q_version_stamp(spark, sf_dir):
    return typed(_raw_orders(spark, sf_dir), FF.ORDERS_FEED, as_of=AS_OF)


# --- delimited text scans ----------------------------------------------------------

_RAW_COLS = "o_orderkey, o_custkey, o_orderstatus, o_orderdate, o_orderpriority, start_date, end_date"


def _folder(root, load="FUL"):
    return f"{root}/feed={FF.ORDERS_FEED.name}/load={load}"


@register("pipe_csv_scan", FF.RAW_PLAIN_SQL + f"\nSELECT {_RAW_COLS} FROM raw")
def q_pipe_csv_scan(spark, sf_dir):
    root = FF.land_orders(spark, sf_dir)
    return read_feed_files(spark, _folder(root), FF.ORDERS_FEED)


@register("ragged_rows", FF.RAW_RAGGED_SQL + f"\nSELECT {_RAW_COLS} FROM raw")
def q_ragged_rows(spark, sf_dir):
    root = FF.land_orders(spark, sf_dir, ragged=True)
    return read_feed_files(spark, _folder(root), FF.ORDERS_FEED)


_TEXT = FEEDS["foitext_text"]


@register("lower_rename", "SELECT " + ", ".join(f'{q} AS "{n}"' for n, _, q in FF.layout_text_columns(_TEXT))
          + " FROM events")
def q_lower_rename(spark, sf_dir):
    """Header-named read (no inference: every column a string) of the text
    feed, whose published name of one column differs from the target's."""
    root = FF.land_layout_from_events(spark, sf_dir, _TEXT)
    df = spark.read.option("header", True).option("sep", "|").csv(f"{root}/feed={_TEXT.name}/load=FUL")
    return lower_rename(df, _TEXT)


_LOADS = ("FUL", "add", "change")


@register("folder_scan", FF.RAW_PLAIN_SQL + f"\nSELECT {_RAW_COLS} FROM raw WHERE _k % 3 = 1")
def q_folder_scan(spark, sf_dir):
    root = FF.land_orders(spark, sf_dir, loads=_LOADS)
    return read_feed(spark, root, FF.ORDERS_FEED, "add")


@register("landing_write", FF.RAW_PLAIN_SQL + """
SELECT 'orders_feed' AS feed,
       CASE _k % 3 WHEN 0 THEN 'FUL' WHEN 1 THEN 'add' ELSE 'change' END AS load,
       concat_ws('|', COALESCE(o_orderkey, ''), COALESCE(o_custkey, ''), COALESCE(o_orderstatus, ''),
                 COALESCE(o_orderdate, ''), COALESCE(o_orderpriority, '')) AS line
FROM raw""")
def q_landing_write(spark, sf_dir):
    root = FF.land_orders(spark, sf_dir, loads=_LOADS)
    # read back as plain text with the partition columns; header lines dropped
    back = spark.read.text(root)
    return (back.filter(F.col("value") != FF.HEADER)
            .select(F.col("feed"), F.col("load"), F.col("value").alias("line")))


@register("staging_replace", FF.RAW_PLAIN_SQL + f"\nSELECT {FF.typed_select_sql(AS_OF)} FROM raw "
          "WHERE _k % 3 = 1 AND o_orderkey IS NOT NULL")
def q_staging_replace(spark, sf_dir):
    from ..session import scratch_path
    from .snapshot import replace_table
    root = FF.land_orders(spark, sf_dir, loads=_LOADS)
    staging = scratch_path(spark, "staging") + "/orders_feed_staging_ADD"
    add = typed(read_feed(spark, root, FF.ORDERS_FEED, "add"), FF.ORDERS_FEED, as_of=AS_OF)
    chg = typed(read_feed(spark, root, FF.ORDERS_FEED, "change"), FF.ORDERS_FEED, as_of=AS_OF)
    replace_table(chg, staging)          # an earlier staging content ...
    return replace_table(add, staging)   # ... is dropped, not appended to


@register("full_load", FF.RAW_PLAIN_SQL + f"\nSELECT {FF.typed_select_sql(AS_OF)} FROM raw "
          "WHERE o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL")
def q_full_load(spark, sf_dir):
    from ..session import scratch_path
    from . import jobs, snapshot
    root = FF.land_orders(spark, sf_dir)
    tbl = scratch_path(spark, "table")
    jobs.full_load(spark, root, FF.ORDERS_FEED, tbl, AS_OF)
    return snapshot.read_history(spark, tbl)


@register("incremental_load", FF.RAW_PLAIN_SQL + f"""
SELECT CASE WHEN _k % 3 = 1 THEN 'add' ELSE 'change' END AS load, {FF.typed_select_sql(AS_OF)}
FROM raw WHERE _k % 3 IN (1, 2) AND o_orderkey IS NOT NULL""")
def q_incremental_load(spark, sf_dir):
    from . import jobs
    root = FF.land_orders(spark, sf_dir, loads=_LOADS)
    st = jobs.incremental_load(spark, root, FF.ORDERS_FEED, AS_OF)
    return (st.add.select(F.lit("add").alias("load"), "*")
            .unionByName(st.change.select(F.lit("change").alias("load"), "*")))


# --- stored history -------------------------------------------------------------------

@register("history_scan", "WITH " + merge_ctes(ORDERS_TRIO)[5:].split(",\nins_add")[0]
          + "\nSELECT * FROM main0")
def q_history_scan(spark, sf_dir):
    from ..session import scratch_path
    from . import snapshot
    t = trio(spark, sf_dir, ORDERS_TRIO)
    tbl = scratch_path(spark, "history")
    open_rows, closed_rows = snapshot.split_open(t.history)
    snapshot.publish(spark, tbl, open_rows, closed_rows, fresh=True)
    return snapshot.read_history(spark, tbl)


_FOUR_FEEDS_SQL = "\nUNION ALL\n".join(
    f"""SELECT '{feed}' AS feed, COUNT(*) + COUNT(*) FILTER (WHERE event_id % 4 = 0) AS total_rows,
       COUNT(*) AS open_rows, COUNT(*) FILTER (WHERE event_id % 4 = 0) AS closed_rows FROM events"""
    for feed in FEED_ORDER)


@register("multi_feed_run", _FOUR_FEEDS_SQL)
def q_multi_feed_run(spark, sf_dir):
    """The whole job on the four published layouts: FULL load, ADD of keys that
    exist, CHANGE of every fourth event, through staging tables."""
    from ..session import scratch_path
    from . import jobs, snapshot
    landing, tables = scratch_path(spark, "landing"), scratch_path(spark, "tables")
    for feed in FEED_ORDER:
        FF.land_layout_from_events(spark, sf_dir, FEEDS[feed], landing, incremental=True)
    jobs.multi_feed_run(spark, landing, tables, AS_OF, full=True, staging_root=scratch_path(spark, "staging"))
    out = None
    for feed in FEED_ORDER:
        h = snapshot.read_history(spark, f"{tables}/{feed}")
        c = h.agg(F.lit(feed).alias("feed"), F.count(F.lit(1)).alias("total_rows"),
                  F.count(F.when(F.col("end_date").isNull(), 1)).alias("open_rows"),
                  F.count(F.when(F.col("end_date").isNotNull(), 1)).alias("closed_rows"))
        out = c if out is None else out.unionByName(c)
    return out


def _row_digest(names) -> str:
    """md5 of a row's columns as text, in SQL of both engines."""
    quoted = [f"coalesce(CAST({{q}}{n}{{q}} AS STRING), '~')" for n in names]
    return "md5(concat_ws('|', " + ", ".join(quoted) + "))"


def _contents_sql(feed):
    spec = FEEDS[feed]
    last, key = FF.last_text(spec), spec.keys[0]
    digest = _row_digest(spec.names).format(q='"').replace("AS STRING", "AS VARCHAR")
    typed_rows = FF.layout_typed_sql(spec, AS_OF)
    changed = f"""SELECT * REPLACE ("{last}" || ' changed' AS "{last}") FROM t WHERE CAST({key} AS BIGINT) % 4 = 0"""
    return f"""SELECT '{feed}' AS feed, row_digest, start_date, end_date FROM (
  WITH t AS ({typed_rows})
  SELECT {digest} AS row_digest, start_date,
         CASE WHEN CAST({key} AS BIGINT) % 4 = 0 THEN DATE '{AS_OF}' END AS end_date FROM t
  UNION ALL
  SELECT {digest}, start_date, end_date FROM ({changed}))"""


@register("multi_feed_contents", "\nUNION ALL\n".join(map(_contents_sql, FEED_ORDER)))
def q_multi_feed_contents(spark, sf_dir):
    """The whole job on the four published layouts, every version by a digest of
    all its columns.  Half of the ADD keys are new, half exist; some of the new
    ones are changed in the same run."""
    from ..session import scratch_path
    from . import jobs, snapshot
    landing, tables = scratch_path(spark, "landing"), scratch_path(spark, "tables")
    for feed in FEED_ORDER:
        FF.land_layout_from_events(spark, sf_dir, FEEDS[feed], landing, incremental=True, held_back=True)
    jobs.multi_feed_run(spark, landing, tables, AS_OF, full=True, staging_root=scratch_path(spark, "staging"),
                        enforce="fail")
    out = None
    for feed in FEED_ORDER:
        h = snapshot.read_history(spark, f"{tables}/{feed}")
        c = h.select(F.lit(feed).alias("feed"), F.expr(_row_digest(FEEDS[feed].names).format(q="`")).alias("row_digest"),
                     "start_date", "end_date")
        out = c if out is None else out.unionByName(c)
    return out


def _stored_merge(spark, sf_dir, compacted):
    from ..session import scratch_path
    from . import jobs, snapshot
    t = trio(spark, sf_dir, ORDERS_TRIO)
    tbl = scratch_path(spark, "history")
    open_rows, closed_rows = snapshot.split_open(t.history)
    snapshot.publish(spark, tbl, open_rows, closed_rows, fresh=True, cluster=t.mk.keys)
    jobs.merge_into(spark, tbl, t.add, t.change, t.mk, AS_OF)
    if compacted:
        snapshot.compact(spark, tbl)
    return snapshot.read_history(spark, tbl)


@register("stored_merge", merge_sql(ORDERS_TRIO))
def q_stored_merge(spark, sf_dir):
    """A stored history, merged on read after an incremental run."""
    return _stored_merge(spark, sf_dir, False)


@register("stored_merge_compacted", merge_sql(ORDERS_TRIO))
def q_stored_merge_compacted(spark, sf_dir):
    """The same history after its open rows became a new base."""
    return _stored_merge(spark, sf_dir, True)


@register("staging_drop", FF.RAW_PLAIN_SQL + f"""
SELECT {FF.typed_select_sql(AS_OF)} FROM raw
WHERE _k % 3 = 0 AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL
UNION ALL
SELECT {FF.typed_select_sql(AS_OF)} FROM raw WHERE _k % 3 = 1 AND o_orderkey IS NOT NULL
UNION ALL
SELECT * FROM (SELECT DISTINCT {FF.typed_select_sql(AS_OF)} FROM raw
               WHERE _k % 3 = 2 AND o_orderkey IS NOT NULL)""")
def q_staging_drop(spark, sf_dir):
    """A run through staging tables, which are gone once it has succeeded."""
    from ..session import scratch_path
    from . import jobs, snapshot
    root = FF.land_orders(spark, sf_dir, loads=_LOADS)
    tbl, staging = scratch_path(spark, "table"), scratch_path(spark, "staging")
    jobs.run_feed(spark, root, tbl, FF.ORDERS_FEED, AS_OF, full=True, staging_root=staging)
    for path in jobs.staging_paths(staging, FF.ORDERS_FEED):
        if snapshot.exists(spark, path):
            raise AssertionError(f"{path} was not dropped")
    return snapshot.read_history(spark, tbl)


# --- width check --------------------------------------------------------------------


# Declared widths checked against two driver tables.
WIDTHS = (("documents", "text", 4000), ("documents", "source", 50), ("documents", "lang", 50),
          ("part", "p_name", 50), ("part", "p_type", 25), ("part", "p_brand", 10))


@register("width_check", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS tbl, '{c}' AS col, {w} AS width, "
    f"COUNT(*) FILTER (WHERE length({c}) > {w}) AS rows_over, MAX(length({c})) AS max_len FROM {t}"
    for t, c, w in WIDTHS))
def q_width_check(spark, sf_dir):
    out = None
    for tbl in dict.fromkeys(t for t, _, _ in WIDTHS):
        r = width_report(table(spark, sf_dir, tbl), [(c, w) for t, c, w in WIDTHS if t == tbl], tbl)
        out = r if out is None else out.unionByName(r)
    return out.select("tbl", "col", F.col("width").cast("int").alias("width"),
                      F.col("rows_over").cast("long").alias("rows_over"),
                      F.col("max_len").cast("int").alias("max_len"))


@register("width_enforce", """
SELECT doc_id, length(text) <= 4000 AS width_ok,
       CASE WHEN length(text) <= 4000 THEN text END AS text FROM documents""")
def q_width_enforce(spark, sf_dir):
    """Over-long texts flagged, and nulled, by the declared width."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    flagged = enforce_widths(d, [("text", 4000)], "flag")
    return enforce_widths(flagged, [("text", 4000)], "null")


# --- routing of published files ------------------------------------------------------

LANDING_PREFIX = "landing/"


@register("load_filter", "WITH " + FF.NAMES_SQL + """
SELECT event_id, name,
       NOT (lower(name) LIKE '%change.zip' OR lower(name) LIKE '%add.zip') AS keep_full,
       (lower(name) LIKE '%change.zip' OR lower(name) LIKE '%add.zip') AS keep_inc
FROM names""")
def q_load_filter(spark, sf_dir):
    n = FF.published_names(spark, sf_dir)
    return n.select("event_id", "name", load_filter("name", "FUL").alias("keep_full"),
                    load_filter("name", "INC").alias("keep_inc"))


@register("file_stem", "WITH " + FF.NAMES_SQL + """
SELECT event_id, name, split_part(name, '.', 1) AS stem,
       split_part(name, '.', 1) || '.txt' AS landed FROM names""")
def q_file_stem(spark, sf_dir):
    n = FF.published_names(spark, sf_dir)
    return n.select("event_id", "name", file_stem("name").alias("stem"),
                    member_name("name").alias("landed"))


@register("route_table", "WITH " + FF.NAMES_SQL + f"\nSELECT event_id, name, {FF.ROUTE_SQL} AS feed FROM names")
def q_route_table(spark, sf_dir):
    n = FF.published_names(spark, sf_dir)
    return n.select("event_id", "name", route_table("name").alias("feed"))


@register("route_load", "WITH " + FF.NAMES_SQL + """,
l AS (SELECT event_id, split_part(name, '.', 1) || '.txt' AS landed FROM names)
SELECT event_id, landed, """ + FF.LOAD_SQL + """ AS load,
       CASE """ + FF.LOAD_SQL + """ WHEN 'change' THEN 'INC/change/' WHEN 'add' THEN 'INC/add/'
            ELSE 'FUL/' END AS folder FROM l""")
def q_route_load(spark, sf_dir):
    n = FF.published_names(spark, sf_dir).select("event_id", member_name("name").alias("landed"))
    return n.select("event_id", "landed", route_load("landed").alias("load"),
                    load_folder(route_load("landed")).alias("folder"))


@register("landing_key", "WITH " + FF.NAMES_SQL + """,
l AS (SELECT event_id, name, split_part(name, '.', 1) || '.txt' AS landed FROM names)
SELECT event_id, '""" + LANDING_PREFIX + "' || " + FF.ROUTE_SQL + """ || '/'
       || CASE """ + FF.LOAD_SQL + """ WHEN 'change' THEN 'INC/change/' WHEN 'add' THEN 'INC/add/'
               ELSE 'FUL/' END || landed AS landing_key
FROM l""")
def q_landing_key(spark, sf_dir):
    n = FF.published_names(spark, sf_dir)
    landed = member_name("name")
    return n.select("event_id", landing_key(LANDING_PREFIX, route_table("name"),
                                            load_folder(route_load(landed)), landed)
                    .alias("landing_key"))


# --- link index from pages ----------------------------------------------------------


# an anchor as DuckDB sees it: what stands between "<a " and "</a>"
_LINKS_SQL = """WITH a AS (
  SELECT page_id, unnest(string_split(html, '<a ')[2:]) AS x,
         generate_subscripts(string_split(html, '<a ')[2:], 1) - 1 AS pos FROM pages),
links AS (SELECT page_id, CAST(pos AS INTEGER) AS pos,
                 split_part(substr(x, instr(x, '>') + 1), '</a>', 1) AS name,
                 split_part(split_part(x, 'href="', 2), '"', 1) AS url FROM a)"""


@register("link_index", _LINKS_SQL + "\nSELECT * FROM links")
def q_link_index(spark, sf_dir):
    return anchor_links(table(spark, sf_dir, "pages"))


@register("link_exclude", "WITH " + FF.INDEX_LINKS_SQL
          + "\nSELECT page_id, name, url FROM links WHERE NOT contains(name, 'problem')")
def q_link_exclude(spark, sf_dir):
    """Every anchor of the index pages but those of the excluded family and of
    cells that are no file's."""
    links = table_links(FF.index_pages(spark, sf_dir))
    return kept_links(links).select("page_id", "name", "url")


@register("url_basename", "SELECT page_id, url, regexp_extract(url, '[^/]*$') AS basename FROM pages")
def q_url_basename(spark, sf_dir):
    p = table(spark, sf_dir, "pages")
    return p.select("page_id", "url", url_basename("url").alias("basename"))


# --- archives ------------------------------------------------------------------------


@register("archive_expand", "WITH " + FF.DOCUMENT_LINES_SQL + "\nSELECT line FROM lines")
def q_archive_expand(spark, sf_dir):
    """Every document's text, accents and all, through zip archives."""
    lines = archive_lines(spark, FF.zip_documents(spark, sf_dir))
    return lines.filter(F.col("line_no") > 0).select("line")


# --- JDBC ----------------------------------------------------------------------------


JDBC_ORDERS = make_spec("jdbc_orders", """
o_orderkey int key
o_orderstatus nvarchar(1)
o_orderpriority nvarchar(15)
""")


@register("jdbc_append", """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority
FROM orders""")
def q_jdbc_append(spark, sf_dir):
    """Typed rows appended over JDBC and read back (an embedded in-memory
    database inside the driver JVM: no server, no port)."""
    import uuid
    url = f"jdbc:derby:memory:strata{uuid.uuid4().hex[:8]};create=true"
    props = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus",
                                              "o_totalprice", "o_orderpriority")
    jdbc_append(o, url, "ORDERS_COPY", props, num_partitions=8, spec=JDBC_ORDERS)
    back = jdbc_read(spark, url, "ORDERS_COPY", props)
    return back.toDF(*[c.lower() for c in back.columns])


# --- incremental loads as a stream -------------------------------------------------

@register("stream_merge", FF.RAW_PLAIN_SQL + f"""
SELECT {FF.typed_select_sql(AS_OF)} FROM raw
WHERE _k % 3 = 0 AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL
UNION ALL
SELECT {FF.typed_select_sql(AS_OF)} FROM raw WHERE _k % 3 = 1 AND o_orderkey IS NOT NULL
UNION ALL
SELECT * FROM (SELECT DISTINCT {FF.typed_select_sql(AS_OF)} FROM raw
               WHERE _k % 3 = 2 AND o_orderkey IS NOT NULL)""")
def q_stream_merge(spark, sf_dir):
    """FULL load, then the ADD and CHANGE folders drained by a file stream
    whose micro-batches are merged into the history."""
    from ..session import scratch_path
    from ..streaming import start_merge_stream
    from . import jobs, snapshot
    root = FF.land_orders(spark, sf_dir, loads=_LOADS)
    tbl = scratch_path(spark, "stream-table")
    jobs.full_load(spark, root, FF.ORDERS_FEED, tbl, AS_OF)
    q = start_merge_stream(spark, root, FF.ORDERS_FEED, tbl, AS_OF)
    q.awaitTermination()
    return snapshot.read_history(spark, tbl)


@register("stream_merge_restart", FF.RAW_PLAIN_SQL + f"""
SELECT {FF.typed_select_sql(AS_OF)} FROM raw
WHERE _k % 3 = 0 AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL
UNION ALL
SELECT {FF.typed_select_sql(AS_OF)} FROM raw WHERE _k % 3 = 1 AND o_orderkey IS NOT NULL
UNION ALL
SELECT * FROM (SELECT DISTINCT {FF.typed_select_sql(AS_OF)} FROM raw
               WHERE _k % 3 = 2 AND o_orderkey IS NOT NULL)""")
def q_stream_merge_restart(spark, sf_dir):
    """FULL load; the ADD files arrive and a first stream folds them in; the
    CHANGE files arrive and a second start of the stream goes on from there."""
    from ..session import scratch_path
    from ..sources.delimited import land_lines
    from ..streaming import start_merge_stream
    from . import jobs, snapshot
    source = FF.land_orders(spark, sf_dir, loads=_LOADS)
    landing, tbl = scratch_path(spark, "landing"), scratch_path(spark, "stream-table")
    for load in _LOADS:
        lines = (spark.read.text(f"{source}/feed={FF.ORDERS_FEED.name}/load={load}")
                 .filter(F.col("value") != FF.HEADER).select(
                     F.col("value").alias("line"), F.lit(FF.ORDERS_FEED.name).alias("feed"), F.lit(load).alias("load")))
        land_lines(lines, landing, FF.HEADER, partition_by=("feed", "load"), mode="append")
        if load == "FUL":
            jobs.full_load(spark, landing, FF.ORDERS_FEED, tbl, AS_OF)
        else:
            start_merge_stream(spark, landing, FF.ORDERS_FEED, tbl, AS_OF).awaitTermination()
    return snapshot.read_history(spark, tbl)


@register("archive_landing", "WITH " + FF.DOCUMENT_LINES_SQL + """
SELECT 'foitext_text' AS feed,
       CASE doc_id % 3 WHEN 0 THEN 'FUL' WHEN 1 THEN 'add' ELSE 'change' END AS load, line FROM lines""")
def q_archive_landing(spark, sf_dir):
    """Archives of every document -> expanded, routed by name -> landed by feed
    and load kind, twice -> read back."""
    from ..session import scratch_path
    from . import jobs
    archives, landing = FF.zip_documents(spark, sf_dir), scratch_path(spark, "landing")
    for _ in range(2):
        jobs.land_archives(spark, archives, landing)
    back = spark.read.text(landing).filter(F.col("value") != FF.DOCUMENT_HEADER)
    return back.select("feed", "load", F.col("value").alias("line"))


@register("landing_bytes", "WITH " + FF.EXACT_LINES_SQL + """
SELECT CASE doc_id % 3 WHEN 0 THEN 'FUL' WHEN 1 THEN 'add' ELSE 'change' END AS load,
       hex(encode(line)) AS line_hex, count(*) AS lines FROM lines GROUP BY ALL""")
def q_landing_bytes(spark, sf_dir):
    """Lines with blanks at both ends, tabs, quotes, control characters and
    carriage returns, and empty lines, through archives and landing; the bytes
    of the landed lines, how often each occurs."""
    from ..session import scratch_path
    from . import jobs
    landing = scratch_path(spark, "landing")
    jobs.land_archives(spark, FF.zip_exact(spark, sf_dir), landing)
    back = spark.read.option("lineSep", "\n").text(landing).filter(F.col("value") != FF.DOCUMENT_HEADER)
    line_hex = F.hex(F.col("value").cast("binary")).alias("line_hex")
    return back.groupBy("load", line_hex).agg(F.count(F.lit(1)).alias("lines"))


@register("archive_full_load", FF.RAW_PLAIN_SQL + f"\nSELECT {FF.typed_select_sql(AS_OF)} FROM raw "
          "WHERE _k % 3 = 0 AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL")
def q_archive_full_load(spark, sf_dir):
    """Archives landed twice, then a FULL load, all by defaults."""
    from dataclasses import replace

    from ..session import scratch_path
    from . import jobs, snapshot
    archives, landing = FF.zip_orders(spark, sf_dir), scratch_path(spark, "landing")
    for _ in range(2):
        jobs.land_archives(spark, archives, landing)
    tbl = scratch_path(spark, "table")
    jobs.full_load(spark, landing, replace(FF.ORDERS_FEED, name="mdrfoi_event"), tbl, AS_OF)
    return snapshot.read_history(spark, tbl)


@register("published_files", "WITH " + FF.INDEX_LINKS_SQL + """,
f AS (SELECT name, url, regexp_extract(url, '[^/]*$') AS filename FROM links
      WHERE NOT contains(name, 'problem')
        AND NOT (lower(name) LIKE '%change.zip' OR lower(name) LIKE '%add.zip')),
g AS (SELECT name, url, filename, split_part(filename, '.', 1) AS stem,
             split_part(filename, '.', 1) || '.txt' AS landed FROM f)
SELECT name, url, filename, stem,
       CASE WHEN contains(filename, 'mdrfoi') THEN 'mdrfoi_event'
            WHEN contains(filename, 'patient') THEN 'patient'
            WHEN contains(filename, 'dev') THEN 'foidev_device'
            WHEN contains(filename, 'foitext') THEN 'foitext_text'
            ELSE 'notfound' END AS feed,
       """ + FF.LOAD_SQL + """ AS load,
       '""" + LANDING_PREFIX + """' || CASE WHEN contains(filename, 'mdrfoi') THEN 'mdrfoi_event'
            WHEN contains(filename, 'patient') THEN 'patient'
            WHEN contains(filename, 'dev') THEN 'foidev_device'
            WHEN contains(filename, 'foitext') THEN 'foitext_text'
            ELSE 'notfound' END || '/'
       || CASE """ + FF.LOAD_SQL + """ WHEN 'change' THEN 'INC/change/' WHEN 'add' THEN 'INC/add/'
               ELSE 'FUL/' END || landed AS landing_key
FROM g""")
def q_published_files(spark, sf_dir):
    """Index pages of every event -> links -> exclusion -> FULL load filter ->
    routing."""
    from . import jobs
    return jobs.published_files(table_links(FF.index_pages(spark, sf_dir)), "FUL", LANDING_PREFIX)


@register("link_table_rule", "WITH " + FF.INDEX_LINKS_SQL
          + "\nSELECT page_id, CAST(pos AS INTEGER) AS pos, name, url FROM links")
def q_link_table_rule(spark, sf_dir):
    """The published-index rule over an index page of every event: other tables,
    header rows, cells without an anchor, entities, unclosed anchors and nested
    tables."""
    return table_links(FF.index_pages(spark, sf_dir))


# --- wide layouts: the published feed specs filled from `events` -------------------

WIDE_EVENT = feed_from_events(FEEDS["mdrfoi_event"])      # 82 columns, 80 compared
WIDE_DEVICE = feed_from_events(FEEDS["foidev_device"])    # 31 columns, hyphenated names


@register("wide_merge", merge_sql(WIDE_EVENT))
def q_wide_merge(spark, sf_dir):
    """The event feed's full layout merged: an 80-column difference test and
    an 82-column EXCEPT, restricted to the open rows of CHANGE keys."""
    t = trio(spark, sf_dir, WIDE_EVENT)
    return merge(t.history, t.add, t.change, keys=t.mk.keys, values=t.mk.values, as_of=AS_OF)


@register("wide_merge_device", merge_sql(WIDE_DEVICE))
def q_wide_merge_device(spark, sf_dir):
    t = trio(spark, sf_dir, WIDE_DEVICE)
    return merge(t.history, t.add, t.change, keys=t.mk.keys, values=t.mk.values, as_of=AS_OF)


@register("ragged_report", FF.RAW_RAGGED_SQL + """
SELECT o_orderkey, o_orderpriority IS NULL AS short_line,
       (start_date IS NOT NULL OR end_date IS NOT NULL) AS surplus_fields FROM raw""")
def q_ragged_report(spark, sf_dir):
    """Per-line shape of a ragged feed: short (last layout column missing)
    and surplus (fields beyond the layout, parked in the version columns)."""
    from ..sources.delimited import ragged_report
    root = FF.land_orders(spark, sf_dir, ragged=True)
    raw = read_feed_files(spark, _folder(root), FF.ORDERS_FEED)
    return ragged_report(raw, FF.ORDERS_FEED).select("o_orderkey", "short_line", "surplus_fields")


@register("ragged_rejects", f"""WITH {FF.FIELDS_SQL},
rejected AS (
  SELECT concat_ws('|', COALESCE(f0, ''), COALESCE(f1, ''),
                   CASE _k % 7 WHEN 0 THEN COALESCE(f2, '')
                   WHEN 1 THEN concat_ws('|', COALESCE(f2, ''), COALESCE(f3, ''), COALESCE(f4, ''), 'x1', 'y1')
                   ELSE concat_ws('|', '"' || COALESCE(f2, ''), COALESCE(f3, ''), COALESCE(f4, '')) END) AS record,
         _k % 7 <> 1 AS short_line
  FROM fields WHERE _k % 7 IN (0, 1, 3))
SELECT record, short_line, (SELECT count(*) FROM orders) AS lines, count(*) OVER () AS rejected,
       count(*) FILTER (WHERE short_line) OVER () AS short_lines,
       count(*) FILTER (WHERE NOT short_line) OVER () AS surplus_lines
FROM rejected""")
def q_ragged_rejects(spark, sf_dir):
    """FULL load of a ragged feed that drops what does not fit the layout: the
    rejected lines, whole, and the counts observed by the load."""
    from ..session import scratch_path
    from ..sources.rejects import RejectChannel
    from . import jobs
    root, channel = FF.land_orders(spark, sf_dir, ragged=True), RejectChannel(scratch_path(spark, "rejects"), drop=True)
    jobs.full_load(spark, root, FF.ORDERS_FEED, scratch_path(spark, "table"), AS_OF, rejects=channel)
    counts, = channel.counts.values()
    out = channel.rejected(spark, FF.ORDERS_FEED, jobs.LOAD_FULL)
    return out.select("record", F.col("o_orderpriority").isNull().alias("short_line"),
                      *[F.lit(n).cast("long").alias(c) for c, n in counts.items()])


@register("ragged_strict_load", FF.RAW_RAGGED_SQL + f"""
SELECT {FF.typed_select_sql(AS_OF)} FROM raw
WHERE _k % 7 NOT IN (0, 1, 3) AND o_orderkey IS NOT NULL AND o_orderdate IS NOT NULL""")
def q_ragged_strict_load(spark, sf_dir):
    """What such a load keeps: the lines with as many fields as the layout."""
    from ..session import scratch_path
    from ..sources.rejects import RejectChannel
    from . import jobs, snapshot
    root, tbl = FF.land_orders(spark, sf_dir, ragged=True), scratch_path(spark, "table")
    jobs.full_load(spark, root, FF.ORDERS_FEED, tbl, AS_OF,
                   rejects=RejectChannel(scratch_path(spark, "rejects"), drop=True))
    return snapshot.read_history(spark, tbl)


_LOADED = FF.layout_typed_sql(_TEXT, AS_OF)


@register("declared_tables", f"""SELECT * FROM ({_LOADED})
UNION ALL SELECT * FROM ({_LOADED.replace('FROM events)', 'FROM events WHERE event_id % 5 = 0)')})""")
def q_declared_tables(spark, sf_dir):
    """FULL and ADD loads of the text feed into catalog tables of the declared
    types, then the ADD table's rows inserted by position into the FULL one."""
    import uuid

    from ..session import scratch_path
    from . import jobs, tables
    root = FF.land_layout_from_events(spark, sf_dir, _TEXT, incremental=True)
    run, at = uuid.uuid4().hex[:12], scratch_path(spark, "declared")
    full, add = f"declared_full_{run}", f"declared_add_{run}"
    try:
        jobs.declared_load(spark, root, _TEXT, jobs.LOAD_FULL, AS_OF, full, f"{at}-full")
        jobs.declared_load(spark, root, _TEXT, jobs.LOAD_ADD, AS_OF, add, f"{at}-add")
        tables.insert_select(spark, full, add)
        out = spark.read.schema(spark.table(full).schema).parquet(tables.location(spark, full))
    finally:
        for name in (full, add):
            spark.sql(f"DROP TABLE IF EXISTS {name}")
    return out


@register("wide_full_load", FF.layout_typed_sql(FEEDS["mdrfoi_event"], AS_OF))
def q_wide_full_load(spark, sf_dir):
    """The event feed's published 82-column layout end to end: the whole
    `events` table landed as pipe text and FULL-loaded (rotating date formats,
    a date with a time part, ints as text), then read back."""
    return _full_load_of(spark, sf_dir, FEEDS["mdrfoi_event"])


def _full_load_of(spark, sf_dir, spec):
    from ..session import scratch_path
    from . import jobs, snapshot
    root, tbl = FF.land_layout_from_events(spark, sf_dir, spec), scratch_path(spark, f"table-{spec.name}")
    jobs.full_load(spark, root, spec, tbl, AS_OF)
    return snapshot.read_history(spark, tbl)


def _layout_full_load(feed):
    def q(spark, sf_dir):
        return _full_load_of(spark, sf_dir, FEEDS[feed])
    q.__doc__ = f"FULL load of the published {feed} layout from landed `events` text."
    return q


for _feed, _name in (("foidev_device", "full_load_device"), ("foitext_text", "full_load_text"),
                     ("patient", "full_load_patient")):
    register(_name, FF.layout_typed_sql(FEEDS[_feed], AS_OF))(_layout_full_load(_feed))
