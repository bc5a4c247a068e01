"""Operators of a training-data pipeline, one module each, and their queries.

Nothing outside this package imports it.  An operator selects the columns it needs by name, so
further columns of any name do no harm; null texts count as empty unless its docstring says otherwise.
"""
