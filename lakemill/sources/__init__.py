from lakemill.sources.files import (
    files_as_table,
    ingest_stamp,
    read_csv,
    read_documents,
    read_flat_csv,
    read_index,
    read_parquet,
    read_table,
)
from lakemill.sources.split_csv import read_split_csv

__all__ = [
    "files_as_table",
    "ingest_stamp",
    "read_csv",
    "read_documents",
    "read_flat_csv",
    "read_index",
    "read_parquet",
    "read_split_csv",
    "read_table",
]
