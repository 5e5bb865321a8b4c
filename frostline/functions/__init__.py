"""Column functions (Catalyst expressions; no UDFs)."""

from .naming import (clean_sql_name, clean_sql_name_text, dscr_to_table_name, path_stem,
                     table_name_from_path, table_name_from_path_text)
from .scalars import (blank_to_null, blanks_to_null, flags_to_tags, mm_yyyy_to_yyyy_mm, number_text,
                      one_hot_class, pg_substr, round_half_even_smallint, safe_boolean, typed_null)

__all__ = [
    "blank_to_null", "blanks_to_null", "clean_sql_name", "clean_sql_name_text", "dscr_to_table_name",
    "flags_to_tags", "mm_yyyy_to_yyyy_mm", "number_text", "one_hot_class", "path_stem", "pg_substr",
    "round_half_even_smallint", "safe_boolean", "table_name_from_path", "table_name_from_path_text",
    "typed_null",
]
