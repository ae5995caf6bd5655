"""File-name routing: which feed and load kind a published file belongs to.

All are plain column expressions, so routing a listing of millions of files is
one projection with no shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Routing tokens, tested in this order, case-sensitive; the
# first that the file name contains decides the feed.
ROUTES = (("mdrfoi", "mdrfoi_event"), ("patient", "patient"),
          ("dev", "foidev_device"), ("foitext", "foitext_text"))
UNROUTED = "notfound"

# Load kinds by lower-cased name suffix, and their folders.
LOAD_SUFFIXES = (("change.txt", "change"), ("add.txt", "add"))
LOAD_FULL = "FUL"
LOAD_FOLDERS = {"change": "INC/change/", "add": "INC/add/", "FUL": "FUL/"}
INC_ARCHIVE_SUFFIXES = ("change.zip", "add.zip")
EXCLUDED_LINK_TOKEN = "problem"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def url_basename(url) -> Column:
    """Text after the last `/`."""
    return F.substring_index(_col(url), "/", -1)


def file_stem(name) -> Column:
    """Text before the first `.`."""
    return F.substring_index(_col(name), ".", 1)


def member_name(archive_name) -> Column:
    """Archive `mdrfoiAdd.zip` lands as `mdrfoiAdd.txt`."""
    return F.concat(file_stem(archive_name), F.lit(".txt"))


def route_table(name) -> Column:
    name = _col(name)
    expr = None
    for token, feed in ROUTES:
        expr = (F.when(name.contains(token), F.lit(feed)) if expr is None
                else expr.when(name.contains(token), F.lit(feed)))
    return expr.otherwise(F.lit(UNROUTED))


def route_load(name) -> Column:
    """Load kind of a landed text file: `change`, `add` or `FUL`."""
    low = F.lower(_col(name))
    expr = None
    for suffix, kind in LOAD_SUFFIXES:
        expr = (F.when(low.endswith(suffix), F.lit(kind)) if expr is None
                else expr.when(low.endswith(suffix), F.lit(kind)))
    return expr.otherwise(F.lit(LOAD_FULL))


def load_folder(load) -> Column:
    load = _col(load)
    expr = None
    for kind, folder in LOAD_FOLDERS.items():
        expr = (F.when(load == kind, F.lit(folder)) if expr is None
                else expr.when(load == kind, F.lit(folder)))
    return expr


def landing_key(prefix: str, table, folder, file) -> Column:
    """`prefix + table + '/' + folder + file`."""
    return F.concat(F.lit(prefix), _col(table), F.lit("/"), _col(folder), _col(file))


def is_incremental_archive(name) -> Column:
    low = F.lower(_col(name))
    return low.endswith(INC_ARCHIVE_SUFFIXES[0]) | low.endswith(INC_ARCHIVE_SUFFIXES[1])


def load_filter(name, load_type: str = "FUL") -> Column:
    """FUL keeps base archives; INC keeps add/change archives."""
    inc = is_incremental_archive(name)
    return ~inc if load_type == "FUL" else inc


def link_kept(name) -> Column:
    """Links whose text lacks the excluded token (case-sensitive)."""
    return ~_col(name).contains(EXCLUDED_LINK_TOKEN)
