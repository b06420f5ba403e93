"""Training-data operators: one module per operator, one query per operator.

Nothing else in the library imports this subpackage.  ``catalog`` holds the
registered queries and their DuckDB twins.
"""
