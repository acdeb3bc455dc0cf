"""Training-data operators: dedup, tokenising, packing, scoring, scanning.

Nothing else in the library imports this subpackage.  Each module holds one
operator with a general interface (any frame, any column names); the module
``queries`` applies the operators to the given tables.
"""
