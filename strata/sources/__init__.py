from .archives import archive_lines
from .delimited import land_lines, ragged_report, read_delimited, read_feed, read_feed_files
from .jdbc import jdbc_append, jdbc_read
from .links import anchor_links, kept_links, parse_index_table, table_links

__all__ = ["archive_lines", "land_lines", "ragged_report", "read_delimited",
           "read_feed", "read_feed_files", "jdbc_append", "jdbc_read", "anchor_links",
           "kept_links", "parse_index_table", "table_links"]
