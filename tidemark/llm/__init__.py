"""Training-data operators: near-duplicates, packing, scoring, filtering, sharding and mixing.

Nothing outside this subpackage imports it.  Every operator takes a DataFrame and the
names of the columns it needs, ignores all other columns, and returns a DataFrame.
"""
