"""Fragments of Spark SQL, as text: numbers, upstream lists, buckets and rendered lines.

Each function takes SQL expressions and returns one, for ``selectExpr`` and ``expr``.
Text is parsed by Spark in one go, where building the same expression from Python
columns costs a round trip to the JVM for every node.
"""
