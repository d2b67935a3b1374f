"""Expressions. All run in the JVM; none is a Python UDF.

Wide projections are put together as SQL text and handed over in one call,
since a call into the JVM for every operator adds up to seconds per query.
Functions that say `SQL` take and give such text; `F.expr` makes a column of it.
"""
