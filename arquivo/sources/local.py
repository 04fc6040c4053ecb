"""Small fixed tables as Spark local relations.

``createDataFrame`` on a Python list goes through a Python RDD; an inline
``VALUES`` table is resolved to a ``LocalRelation`` instead, which the planner
broadcasts without running a job. Only for small tables of fixed size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession


def _lit(v, typ: str) -> str:
    if v is None:
        return f"CAST(NULL AS {typ})"
    if isinstance(v, bool):
        return "TRUE" if v else "FALSE"
    if isinstance(v, int):
        return f"CAST({v} AS {typ})"
    if isinstance(v, (list, tuple)):
        inner = typ[len("array<"):-1]
        items = ", ".join(_lit(x, inner) for x in v)
        return f"CAST(array({items}) AS {typ})"
    s = str(v).replace("\\", "\\\\").replace("'", "\\'")
    return f"'{s}'"


def local_table(spark: SparkSession, rows: Sequence[Sequence], schema: list[tuple[str, str]]) -> DataFrame:
    """A DataFrame over ``rows`` with ``schema`` [(name, sql type)], as a LocalRelation."""
    names = ", ".join(f"`{n}`" for n, _ in schema)
    values = ",\n".join(
        "(" + ", ".join(_lit(v, t) for v, (_, t) in zip(row, schema)) + ")" for row in rows
    )
    casts = ", ".join(f"CAST(`{n}` AS {t}) AS `{n}`" for n, t in schema)
    return spark.sql(f"SELECT {casts} FROM VALUES {values} AS t({names})")
