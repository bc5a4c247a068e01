from lakemill.streaming.ingest import (
    arriving_documents,
    arriving_files,
    bulk_load,
    drain_into,
    ingest_available,
    load_new_files,
    run_into,
)
from lakemill.streaming.shapes import ingest_shapes

__all__ = [
    "arriving_documents",
    "arriving_files",
    "bulk_load",
    "drain_into",
    "ingest_available",
    "ingest_shapes",
    "load_new_files",
    "run_into",
]
