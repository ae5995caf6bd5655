"""Feed text derived from the driver tables, plus the SQL that reads the
same rows back out of the tables.

``orders`` becomes a pipe-delimited feed whose date column cycles through the
accepted formats (and through a missing and an unparseable value), whose key
is sometimes missing, and -- in the ragged variant -- whose lines are
sometimes short, long, quoted around a delimiter, or open a quote that never
closes.  Every order yields exactly one line.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_path
from ..sources.delimited import land_lines
from ..specs import make_spec
from .scenarios import layout_columns, table

# Spec of the orders feed used by the text-scan scenarios.
ORDERS_FEED = make_spec("orders_feed", """
o_orderkey nvarchar(20) key
o_custkey int
o_orderstatus nvarchar(1)
o_orderdate date
o_orderpriority nvarchar(15)
""", required=("o_orderdate",))
HEADER = "|".join(c.upper() for c in ORDERS_FEED.names)


def _fields(o: DataFrame) -> DataFrame:
    k = F.col("o_orderkey")
    ts = F.col("o_orderdate")
    fmt = (F.when(F.pmod(k, 3) == 0, F.date_format(ts, "MM/dd/yyyy"))
           .when(F.pmod(k, 3) == 1, F.date_format(ts, "yyyy/MM/dd"))
           .otherwise(F.date_format(ts, "dd/MM/yyyy")))
    date_txt = (F.when(F.pmod(k, 13) == 0, F.lit(None).cast("string"))
                .when(F.pmod(k, 17) == 0, F.lit("unknown"))
                .otherwise(fmt))
    return o.select(
        k.alias("_k"),
        F.when(F.pmod(k, 11) == 0, F.lit(None).cast("string")).otherwise(k.cast("string")).alias("f0"),
        F.col("o_custkey").cast("string").alias("f1"),
        F.col("o_orderstatus").alias("f2"),
        date_txt.alias("f3"),
        F.col("o_orderpriority").alias("f4"))


def _join(*cols: Column) -> Column:
    return F.concat_ws("|", *[F.coalesce(c, F.lit("")) for c in cols])


def orders_lines(spark: SparkSession, sf_dir: str, ragged: bool = False) -> DataFrame:
    """One text line per order (column ``line``)."""
    f = _fields(table(spark, sf_dir, "orders"))
    f0, f1, f2, f3, f4 = (F.col(c) for c in ("f0", "f1", "f2", "f3", "f4"))
    plain = _join(f0, f1, f2, f3, f4)
    if not ragged:
        return f.select(plain.alias("line"))
    d = F.pmod(F.col("_k"), 7)
    line = (F.when(d == 0, _join(f0, f1, f2))                                   # short
            .when(d == 1, _join(f0, f1, f2, f3, f4, F.lit("x1"), F.lit("y1")))  # surplus
            .when(d == 2, _join(f0, f1, f2, f3, F.concat(F.lit('"'), f4, F.lit('|q"'))))  # quoted
            .when(d == 3, _join(f0, f1, F.concat(F.lit('"'), f2), f3, f4))      # open quote
            .otherwise(plain))
    return f.select(line.alias("line"))


def land_orders(spark: SparkSession, sf_dir: str, ragged: bool = False,
                loads=("FUL",), name: str = "landing") -> str:
    """Write the orders feed under ``feed=orders_feed/load=<kind>`` in a new
    scratch folder (below the shared checkpoint folder); returns the root.

    With several load kinds each order lands in exactly one of them, by its
    key, so the folders partition the table.
    """
    root = scratch_path(spark, name)
    lines = orders_lines(spark, sf_dir, ragged)
    o = table(spark, sf_dir, "orders")
    if len(loads) == 1:
        lines = lines.withColumn("feed", F.lit(ORDERS_FEED.name)).withColumn("load", F.lit(loads[0]))
    else:
        f = _fields(o)
        kind = F.element_at(F.array(*[F.lit(x) for x in loads]),
                            (F.pmod(F.col("_k"), len(loads)) + 1).cast("int"))
        f0, f1, f2, f3, f4 = (F.col(c) for c in ("f0", "f1", "f2", "f3", "f4"))
        lines = f.select(_join(f0, f1, f2, f3, f4).alias("line"),
                         F.lit(ORDERS_FEED.name).alias("feed"), kind.alias("load"))
    land_lines(lines, root, HEADER, partition_by=("feed", "load"))
    return root


# --- SQL twins ----------------------------------------------------------------

FIELDS_SQL = """fields AS (
  SELECT o_orderkey AS _k,
         CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE CAST(o_orderkey AS VARCHAR) END AS f0,
         CAST(o_custkey AS VARCHAR) AS f1,
         o_orderstatus AS f2,
         CASE WHEN o_orderkey % 13 = 0 THEN NULL
              WHEN o_orderkey % 17 = 0 THEN 'unknown'
              WHEN o_orderkey % 3 = 0 THEN strftime(o_orderdate, '%m/%d/%Y')
              WHEN o_orderkey % 3 = 1 THEN strftime(o_orderdate, '%Y/%m/%d')
              ELSE strftime(o_orderdate, '%d/%m/%Y') END AS f3,
         o_orderpriority AS f4
  FROM orders)"""


def date_sql(x: str) -> str:
    """The three-format lenient parse in DuckDB terms (inputs are zero-padded)."""
    return (f"COALESCE(CAST(TRY_STRPTIME({x}, '%m/%d/%Y') AS DATE), "
            f"CAST(TRY_STRPTIME({x}, '%Y/%m/%d') AS DATE), "
            f"CAST(TRY_STRPTIME({x}, '%d/%m/%Y') AS DATE))")


def int_sql(x: str) -> str:
    return (f"TRY_CAST(NULLIF(regexp_extract({x}, '^[ \\t]*([+-]?[0-9]+)(\\.[0-9]*)?[ \\t]*$', 1), '') "
            f"AS INTEGER)")


# Raw strings as a reader sees them, plain lines.
RAW_PLAIN_SQL = f"""WITH {FIELDS_SQL},
raw AS (SELECT f0 AS o_orderkey, f1 AS o_custkey, f2 AS o_orderstatus, f3 AS o_orderdate,
               f4 AS o_orderpriority, CAST(NULL AS VARCHAR) AS start_date,
               CAST(NULL AS VARCHAR) AS end_date, _k FROM fields)"""

# Raw strings of the ragged variant.
RAW_RAGGED_SQL = f"""WITH {FIELDS_SQL},
raw AS (
  SELECT f0 AS o_orderkey, f1 AS o_custkey,
         CASE WHEN _k % 7 = 3 THEN f2 || '|' || COALESCE(f3, '') || '|' || COALESCE(f4, '')
              ELSE f2 END AS o_orderstatus,
         CASE WHEN _k % 7 IN (0, 3) THEN NULL ELSE f3 END AS o_orderdate,
         CASE WHEN _k % 7 IN (0, 3) THEN NULL
              WHEN _k % 7 = 2 THEN f4 || '|q'
              ELSE f4 END AS o_orderpriority,
         CASE WHEN _k % 7 = 1 THEN 'x1' END AS start_date,
         CASE WHEN _k % 7 = 1 THEN 'y1' END AS end_date,
         _k
  FROM fields)"""


def typed_select_sql(stamp: str | None = None) -> str:
    cols = [("o_orderkey", "o_orderkey"), (int_sql("o_custkey"), "o_custkey"),
            ("o_orderstatus", "o_orderstatus"), (date_sql("o_orderdate"), "o_orderdate"),
            ("o_orderpriority", "o_orderpriority")]
    s = ", ".join(f"{e} AS {n}" for e, n in cols)
    if stamp:
        s += f", DATE '{stamp}' AS start_date, CAST(NULL AS DATE) AS end_date"
    return s


# --- archives -------------------------------------------------------------------

def _local(path: str) -> str:
    if path.startswith("file:"):
        path = path[len("file:"):]
        while path.startswith("//"):
            path = path[1:]
        return path
    if "://" in path:
        raise NotImplementedError("zip fixtures are written with POSIX file IO; "
                                  f"{path!r} is not a local or mounted path")
    return path


LINES_PER_ARCHIVE = 100_000
ROWS_AT_ONCE = 500
DOCUMENT_HEADER = "DOC_ID|TEXT"
# What stands before and after a line, by doc_id % 5; SQL of both engines.
_EXACT = ("CASE doc_id % 5 WHEN 0 THEN '  ' WHEN 1 THEN {char}(9) WHEN 2 THEN '\"' WHEN 3 THEN {char}(1) ELSE '' END, x, "
          "CASE doc_id % 5 WHEN 0 THEN ' ' WHEN 1 THEN {char}(9) WHEN 2 THEN '  ' WHEN 3 THEN {char}(13) ELSE '' END")


def zip_lines(spark: SparkSession, lines: DataFrame, header: str, prefix: str) -> str:
    """Pack ``lines`` (columns line, kind: 0 base, 1 ADD, 2 CHANGE) into zip
    files named like published ones (``<prefix><part>.zip``, ``..Add.zip``,
    ``..change.zip``), one member each with a header line, as many as the lines
    need; returns the folder.  Written by the tasks themselves, each file under
    a name of its own first, so a task that runs twice changes nothing."""
    import os
    import zipfile

    import pyarrow as pa
    import pyarrow.compute as pc
    from pyspark.sql import types as T

    root = scratch_path(spark, "archives")
    local = _local(root)
    suffixes = ("", "Add", "change")

    def write(batches):
        from pyspark import TaskContext
        task = TaskContext.get()
        os.makedirs(local, exist_ok=True)
        out = {}
        for b in batches:
            # a few rows at a time: a worker holds a batch and little more
            for rows in (b.slice(i, ROWS_AT_ONCE) for i in range(0, b.num_rows, ROWS_AT_ONCE)):
                for kind in pc.unique(rows.column(1)).drop_null().to_pylist():
                    name = f"{prefix}{task.partitionId():05d}{suffixes[kind]}"
                    if name not in out:
                        path = os.path.join(local, f".{name}-{task.taskAttemptId()}")
                        zf = zipfile.ZipFile(path, "w", compression=zipfile.ZIP_DEFLATED)
                        member = zf.open(name + ".txt", "w")
                        member.write((header + "\n").encode())
                        out[name] = [path, zf, member, 0]
                    g = rows.column(0).filter(pc.equal(rows.column(1), kind)).to_pylist()
                    out[name][2].write(("\n".join(g) + "\n").encode())
                    out[name][3] += len(g)
        for name, (path, zf, member, _) in out.items():
            member.close()
            zf.close()
            os.replace(path, os.path.join(local, name + ".zip"))
        yield pa.RecordBatch.from_arrays([pa.array(list(out), pa.string()),
                                          pa.array([x[3] for x in out.values()], pa.int64())], ["archive", "lines"])

    schema = T.StructType([T.StructField("archive", T.StringType()), T.StructField("lines", T.LongType())])
    n = max(4, -(-lines.count() // LINES_PER_ARCHIVE))
    lines.select("line", "kind").repartition(n).mapInArrow(write, schema).count()
    return root


def zip_orders(spark: SparkSession, sf_dir: str) -> str:
    """The orders feed as archives named like the event feed's, the load kind
    of an order by ``o_orderkey % 3``."""
    f = _fields(table(spark, sf_dir, "orders"))
    lines = f.select(_join(*[F.col(f"f{i}") for i in range(5)]).alias("line"),
                     F.pmod(F.col("_k"), 3).cast("int").alias("kind"))
    return zip_lines(spark, lines, HEADER, "mdrfoi")


def zip_documents(spark: SparkSession, sf_dir: str) -> str:
    """Every document as one line (``doc_id|text`` with line ends as spaces) of
    the text feed's archives, the load kind by ``doc_id % 3``: text in four
    languages with their accents."""
    d = table(spark, sf_dir, "documents")
    line = F.concat_ws("|", F.col("doc_id").cast("string"), F.regexp_replace("text", r"[\r\n]", " "))
    return zip_lines(spark, d.select(line.alias("line"), F.pmod("doc_id", F.lit(3)).cast("int").alias("kind")),
                     DOCUMENT_HEADER, "foitext")


def zip_exact(spark: SparkSession, sf_dir: str) -> str:
    """Every line of every document as a line of the text feed's archives,
    between what the document's id gives: blanks, tabs, quotes, a control
    character, a carriage return at the end."""
    d = table(spark, sf_dir, "documents").where("text is not null")
    line = F.expr(f"concat({_EXACT.format(char='char')})")
    lines = d.select("doc_id", F.explode(F.split("text", "\n")).alias("x")).select(
        line.alias("line"), F.pmod("doc_id", F.lit(3)).cast("int").alias("kind"))
    return zip_lines(spark, lines, DOCUMENT_HEADER, "foitext")


DOCUMENT_LINES_SQL = r"""lines AS (SELECT doc_id,
  CAST(doc_id AS VARCHAR) || '|' || regexp_replace(text, '[\r\n]', ' ', 'g') AS line FROM documents)"""


EXACT_LINES_SQL = f"""lines AS (SELECT doc_id, concat({_EXACT.format(char='chr')}) AS line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x FROM documents))"""


# --- file names for routing -----------------------------------------------------------

def published_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One published file name per event: feed token by ``event_id % 5``
    (upper-cased when ``% 7 = 0``), load kind by ``% 3``, extension by ``% 2``."""
    e = table(spark, sf_dir, "events").select("event_id")
    i = F.col("event_id")
    tok = F.element_at(F.array(*[F.lit(t) for t in ("mdrfoi", "patient", "foidev", "foitext", "misc")]),
                       (F.pmod(i, 5) + 1).cast("int"))
    tok = F.when(F.pmod(i, 7) == 0, F.upper(tok)).otherwise(tok)
    kind = F.element_at(F.array(F.lit(""), F.lit("Add"), F.lit("change")), (F.pmod(i, 3) + 1).cast("int"))
    ext = F.when(F.pmod(i, 2) == 0, F.lit(".zip")).otherwise(F.lit(".txt"))
    return e.select(i, F.concat(tok, i.cast("string"), kind, ext).alias("name"))


NAMES_SQL = """names AS (
  SELECT event_id,
         (CASE WHEN event_id % 7 = 0 THEN upper(tok) ELSE tok END) || CAST(event_id AS VARCHAR)
         || CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN 'Add' ELSE 'change' END
         || CASE WHEN event_id % 2 = 0 THEN '.zip' ELSE '.txt' END AS name
  FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'mdrfoi' WHEN 1 THEN 'patient'
                                           WHEN 2 THEN 'foidev' WHEN 3 THEN 'foitext'
                                           ELSE 'misc' END AS tok FROM events))"""

ROUTE_SQL = """CASE WHEN contains(name, 'mdrfoi') THEN 'mdrfoi_event'
                    WHEN contains(name, 'patient') THEN 'patient'
                    WHEN contains(name, 'dev') THEN 'foidev_device'
                    WHEN contains(name, 'foitext') THEN 'foitext_text'
                    ELSE 'notfound' END"""

LOAD_SQL = """CASE WHEN lower(landed) LIKE '%change.txt' THEN 'change'
                   WHEN lower(landed) LIKE '%add.txt' THEN 'add' ELSE 'FUL' END"""


# --- published index pages, one per event ----------------------------------------------

AREA = "https://files.example/area/"


def index_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An index page per event: a table of another class, then the index table
    with a header row, the row of the event's file and a row without a link.
    By event id, the file's name holds the excluded token (9), an entity (13),
    its anchor is not closed (17), its cell has no anchor (11), its table is
    nested in a cell of another (19)."""
    n = published_names(spark, sf_dir)
    i = F.col("event_id")
    every = lambda k: F.pmod(i, F.lit(k)) == 0
    named = F.when(every(9), F.concat(F.lit("problem"), "name")).otherwise(F.col("name"))
    shown = F.when(every(13), F.concat(named, F.lit(" &amp;lt;new"))).otherwise(named)
    anchor = F.concat(F.lit(f'<b><a class="x" href="{AREA}'), named, F.lit('">'), shown,
                      F.when(every(17), "").otherwise("</a></b> 2 MB"))
    cell = F.when(every(11), shown).otherwise(anchor)
    row = F.concat(F.lit("<tr><td>"), cell, F.lit('</td><td><a href="/no">second</a></td></tr>'))
    rows = F.when(every(19), F.concat(F.lit("<tr><td>more<table>"), row, F.lit("</table></td></tr>"))).otherwise(row)
    html = F.concat(F.lit('<table class="other"><tr><td></td></tr><tr><td><a href="/no">no.zip</a></td></tr></table>'
                          '<table class="big table"><tr><th>File</th></tr>'), rows,
                    F.lit("<tr><td>none</td></tr></table>"))
    return n.select(i.alias("page_id"), html.alias("html"))


# A nested table's row is found twice: by the row around it and by itself.
INDEX_LINKS_SQL = NAMES_SQL + f""",
cells AS (SELECT event_id, CASE WHEN event_id % 9 = 0 THEN 'problem' || name ELSE name END AS named FROM names),
links AS (SELECT event_id AS page_id, pos, named || CASE WHEN event_id % 13 = 0 THEN ' &lt;new' ELSE '' END AS name,
                 '{AREA}' || named AS url
          FROM cells, (VALUES (0), (1)) AS t(pos)
          WHERE event_id % 11 <> 0 AND (pos = 0 OR event_id % 19 = 0)
          UNION ALL  -- the row around a nested table without a file's link finds that table's other link
          SELECT event_id, 0, 'second', '/no' FROM names WHERE event_id % 11 = 0 AND event_id % 19 = 0)"""


# --- a published layout as text, filled from `events` -------------------------------

_FMT_SPARK = ("MM/dd/yyyy", "yyyy/MM/dd", "dd/MM/yyyy")
_FMT_SQL = ("%m/%d/%Y", "%Y/%m/%d", "%d/%m/%Y")


def layout_text_columns(spec) -> list[tuple[str, object, str]]:
    """Per layout column: (name, Spark text expression builder, SQL text): the
    typed columns of ``layout_columns`` written out, dates in one of the three
    accepted formats (by position); a date carrying a time part gets the
    event's time appended.
    """
    out = []
    for i, (c, build, sql) in enumerate(layout_columns(spec)):
        if c.kind == "int":
            text, text_sql = lambda b=build: b().cast("string"), f"CAST({sql} AS VARCHAR)"
        elif c.kind == "date":
            text = lambda b=build, f=_FMT_SPARK[i % 3]: F.date_format(b(), f)
            text_sql = f"strftime({sql}, '{_FMT_SQL[i % 3]}')"
            if c.drop_time:
                text = lambda t=text: F.concat(t(), F.lit(" "), F.date_format("ts", "HH:mm:ss"))
                text_sql += " || ' ' || strftime(ts, '%H:%M:%S')"
        else:
            text, text_sql = build, sql
        out.append((c.name, text, text_sql))
    return out


def last_text(spec) -> str:
    return [c.name for c in spec.columns if c.kind == "string" and not c.is_key][-1]


EVENTS_PER_FILE = 250_000


def land_layout_from_events(spark: SparkSession, sf_dir: str, spec, root: str | None = None,
                            incremental: bool = False, held_back: bool = False) -> str:
    """Land the whole `events` table as one feed's pipe text (FULL); returns the
    root.  ``incremental`` adds an ADD folder with every fifth event and a CHANGE
    folder with every fourth, its last text column changed.  ``held_back`` leaves
    every tenth event out of FULL, so half of the ADD keys are new; else all
    exist."""
    root = root or scratch_path(spark, f"landing-{spec.name}")
    cols = layout_text_columns(spec)
    last = last_text(spec)
    e = table(spark, sf_dir, "events")

    n = -(-e.count() // EVENTS_PER_FILE)     # dealt out narrow, as they are wide as text
    e = e.repartitionByRange(max(n, spark.sparkContext.defaultParallelism), "event_id", F.xxhash64(*e.columns))
    old = {new: old for old, new in spec.renames}
    header = "|".join(old.get(n, n).upper() for n in spec.names)

    def land(rows, load, changed=False):
        values = [F.concat(build(), F.lit(" changed")) if changed and name == last else build()
                  for name, build, _ in cols]
        land_lines(rows.select(_join(*values).alias("line")), f"{root}/feed={spec.name}/load={load}", header,
                   mode="append", compression="gzip")

    land(e.where("event_id % 10 <> 0") if held_back else e, "FUL")
    if incremental:
        land(e.where("event_id % 5 = 0"), "add")
        land(e.where("event_id % 4 = 0"), "change", True)
    return root


def layout_typed_sql(spec, as_of: str) -> str:
    """SQL twin: the typed FULL-load rows of ``land_layout_from_events``."""
    cols = layout_text_columns(spec)
    raw = ", ".join(f'{sql} AS "{name}"' for name, _, sql in cols)
    typed_cols = []
    for c in spec.columns:
        n = f'"{c.name}"'
        if c.kind == "date":
            typed_cols.append(f"{date_sql(f'split_part({n}, chr(32), 1)' if c.drop_time else n)} AS {n}")
        elif c.kind == "int":
            typed_cols.append(f"{int_sql(n)} AS {n}")
        else:
            typed_cols.append(n)
    req = " AND ".join(f'"{r}" IS NOT NULL' for r in (spec.first_key,) + tuple(spec.required))
    return (f"WITH raw AS (SELECT {raw} FROM events)\n"
            f"SELECT {', '.join(typed_cols)}, DATE '{as_of}' AS start_date, "
            f"CAST(NULL AS DATE) AS end_date FROM raw WHERE {req}")
