"""Training-data pipeline operators.

Nothing else in the library imports this package; ``queries`` holds the
registered queries and their SQL.  Every operator takes and returns DataFrames,
picks the columns it needs by name (other columns never reach it) and states in
its docstring what it returns for nulls, empty and very long texts, ties,
repeated rows and empty tables.
"""
