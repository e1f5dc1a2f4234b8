"""Training-data operators on DataFrames.

Each module holds one operator with its own general interface;
``gridcast.llm.queries`` binds them to the given tables.
"""
