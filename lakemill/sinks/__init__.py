from lakemill.sinks.files import (
    convert_csv,
    convert_each_csv,
    export_parquet,
    write_csv,
    write_flat_csv,
    write_flat_parquet,
    write_path,
)
from lakemill.sinks.tables import (
    append_table,
    cluster_table,
    comment_on,
    create_schema,
    create_table,
    empty_table_like,
    register_external,
    replace_table,
    zorder_table,
)

__all__ = [
    "append_table",
    "cluster_table",
    "comment_on",
    "convert_csv",
    "convert_each_csv",
    "create_schema",
    "create_table",
    "empty_table_like",
    "export_parquet",
    "register_external",
    "replace_table",
    "write_csv",
    "write_flat_csv",
    "write_flat_parquet",
    "write_path",
    "zorder_table",
]
