from .merge import (MergeKeys, MergeParts, diff_condition, except_changed, key_condition, merge,
                    merge_parts, new_key_rows, open_versions)
from .typed import (as_date, lower_rename, required_filter, stamp, stamp_columns, typed,
                    typed_column, typed_columns)

__all__ = ["MergeKeys", "MergeParts", "diff_condition", "except_changed",
           "key_condition", "merge", "merge_parts", "new_key_rows", "open_versions",
           "as_date", "lower_rename", "required_filter", "stamp",
           "stamp_columns", "typed", "typed_column", "typed_columns"]
