"""Keyed draws and scalar rules as Spark SQL expressions.

The functions take column names (or any SQL expression) and return SQL text for ``F.expr`` /
``selectExpr``: a rule reaches the JVM in one call, however many operators it has.
"""
