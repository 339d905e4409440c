"""Query registry and the portable result contract.

Each query declares its output once as ``name:type`` words, and both the Spark
result and the SQL twin are projected to exactly those columns and types:
``i`` long, ``s`` text, ``b`` boolean, ``d`` date or timestamp as ISO text,
``fN`` double rounded to N digits.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


class Query(NamedTuple):
    name: str
    spec: str
    build: Callable[[SparkSession, str], DataFrame]
    sql: str | None

    def run(self, spark: SparkSession, folder: str) -> DataFrame:
        return portable(self.build(spark, folder), self.spec)


REGISTRY: dict[str, Query] = {}


def fields(spec: str):
    return [w.rsplit(":", 1) for w in spec.split()]


def portable(df: DataFrame, spec: str) -> DataFrame:
    def out(name, kind):
        c = F.col(name)
        if kind[0] == "f":
            c = F.round(c.cast("double"), int(kind[1:])) + F.lit(0.0)
        else:
            c = c.cast({"i": "long", "s": "string", "b": "boolean", "d": "string"}[kind])
        return c.alias(name)
    return df.select(*[out(n, k) for n, k in fields(spec)])


def portable_sql(sql: str, spec: str) -> str:
    def out(name, kind):
        if kind[0] == "f":
            return f"ROUND(CAST({name} AS DOUBLE), {kind[1:]}) + 0.0 AS {name}"
        return f"CAST({name} AS {dict(i='BIGINT', s='VARCHAR', b='BOOLEAN', d='VARCHAR')[kind]}) AS {name}"
    return f"SELECT {', '.join(out(n, k) for n, k in fields(spec))} FROM ({sql}) AS result"


def query(name: str, spec: str, sql: str | None = None):
    """Register ``build(spark, folder)`` under a name with its output and SQL twin."""
    def register(build):
        assert name not in REGISTRY, name
        REGISTRY[name] = Query(name, spec, build, portable_sql(sql, spec) if sql else None)
        return build
    return register
