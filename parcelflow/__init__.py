"""Property-listing feeds on Spark: decode, time, summarise, land, derive, check.

Every operator is a function from DataFrame to DataFrame (or from Column to
Column) that works on batch tables and on Structured Streaming alike.  Clocks
are parameters, so results can be checked.
"""
