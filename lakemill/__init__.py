"""Medallion and document analytics as plain Spark plans.

Every operator takes and returns DataFrames; nothing is collected and no Python
function runs per row.  Sub-packages:

* ``functions``  column expressions (safe casts, dates, names, URL parts)
* ``sources``    files, documents, indexes and tables as DataFrames
* ``sinks``      table and path writers, table maintenance
* ``operators``  reusable relational building blocks
* ``plans``      the bronze, silver, gold, quality and mission plans built from them
* ``streaming``  incremental ingestion
* ``catalogue``  the queries served over the driver tables, with their SQL oracles
"""
