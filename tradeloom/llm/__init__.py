"""Training-data operators on document tables: scans, filters, de-duplication, mixing, packing and files.

Nothing else in the library imports this package. Every operator takes and returns
DataFrames; :mod:`tradeloom.llm.queries` applies each to its whole table.
"""
