"""Training-data operators: packing, filters, near-duplicates, quality, search, archives.

Nothing outside this package imports it. Every operator takes and returns
DataFrames, accepts NULL in any column and empty tables, and keeps columns
it does not know. A result column replaces an input column of that name.
"""
