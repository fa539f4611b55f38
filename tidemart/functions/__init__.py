"""Cleaning rules. Every function takes and returns Spark SQL expressions as text.

A layer passes all its rules to one ``selectExpr``, which costs the driver one call and
leaves the whole expression to Catalyst. Arguments are column names or expressions.
"""
