"""DataFrame operators: lookups and overlays, metadata views, profiling,
checks, ordering and size-checked broadcasts."""

from .checks import not_null_violations, primary_key_violations, truncated_header
from .codes import CodeLookup, overlay_code_list, overlay_dictionary
from .inventory import (ambiguous_items, code_list_shared, code_list_summary, code_list_variable,
                        mod_item_summary, page_name_pairs, page_tables, shared_descriptions,
                        table_pages)
from .ordering import pg_order_by, pg_sort_keys, with_sort_position
from .profile import profile, schema_report

__all__ = [
    "CodeLookup", "ambiguous_items", "code_list_shared", "code_list_summary",
    "code_list_variable", "mod_item_summary", "not_null_violations", "overlay_code_list",
    "overlay_dictionary", "page_name_pairs", "page_tables", "pg_order_by", "pg_sort_keys",
    "primary_key_violations", "profile", "schema_report", "shared_descriptions", "table_pages",
    "truncated_header", "with_sort_position",
]
