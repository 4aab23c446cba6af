"""Expressions: time features, KPIs and exact rounding.

Every function returns SQL expression text, for ``selectExpr``, ``expr`` and ``spark.sql``, and
takes such text (a column name is one) as arguments. A text is one call to the JVM; the same
expression built from Column objects is hundreds, which took longer than running the query.
"""
