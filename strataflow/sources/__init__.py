from .catalog import attach_files, attach_files_sql, load_csv, load_parquet, table
from .files import (
    csv_delivery,
    drop_void_columns,
    json_lines,
    parquet,
    split_malformed,
    with_delivery_date,
)

__all__ = [
    "attach_files",
    "attach_files_sql",
    "csv_delivery",
    "drop_void_columns",
    "json_lines",
    "load_csv",
    "load_parquet",
    "parquet",
    "split_malformed",
    "table",
    "with_delivery_date",
]
