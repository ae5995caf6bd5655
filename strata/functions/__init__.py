from .dates import DATE_FORMATS, drop_time, parse_date, parse_date_drop_time
from .ints import text_to_int
from .routing import (file_stem, is_incremental_archive, landing_key, link_kept,
                      load_filter, load_folder, member_name, route_load, route_table,
                      url_basename)

__all__ = ["DATE_FORMATS", "drop_time", "parse_date", "parse_date_drop_time",
           "text_to_int", "file_stem", "is_incremental_archive", "landing_key",
           "link_kept", "load_filter", "load_folder", "member_name", "route_load",
           "route_table", "url_basename"]
