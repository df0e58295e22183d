"""tablesmith: supervised-learning work on tables, written as Spark jobs.

The library profiles, fills, derives, bins, encodes, splits, fits, stacks, votes and
scores. Every function takes column names as arguments and returns a DataFrame, a Column
or a fitted object whose state is a bounded handful of numbers.
"""
