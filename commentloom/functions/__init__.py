"""Scalar functions as Spark SQL text.

Each takes SQL expressions (a column name, mostly) and gives a SQL expression, to be used in
``selectExpr`` or ``expr``. A whole plan step then costs one call into the JVM, however many
keywords its expressions hold.
"""


def quote(text: str) -> str:
    """A SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"
