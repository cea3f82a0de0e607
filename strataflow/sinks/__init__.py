from .buckets import bucketed_table, create_bucketed, is_bucketed, merge_buckets, rows_of_keys
from .files import add_to_days, among, append, overwrite, overwrite_days, overwrite_days_sorted, overwrite_partitioned, stored_rows, write_csv
from .tables import merge_into, plan_text, preview, replace_table, save_query, stage_then_attach

__all__ = [
    "add_to_days",
    "among",
    "append",
    "bucketed_table",
    "create_bucketed",
    "is_bucketed",
    "merge_buckets",
    "merge_into",
    "overwrite",
    "overwrite_days",
    "overwrite_days_sorted",
    "overwrite_partitioned",
    "plan_text",
    "preview",
    "replace_table",
    "rows_of_keys",
    "save_query",
    "stage_then_attach",
    "stored_rows",
    "write_csv",
]
