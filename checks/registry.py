"""Registered queries: a Spark callable, its output contract and its SQL twin.

The contract lists the output columns by type and is applied to both sides:
``s`` string, ``i`` int, ``l`` bigint, ``f`` double rounded to 6 decimals,
``d`` date, ``t`` timestamp, ``b`` boolean.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from checks.adapters import cte_chain
from checks.chain import Chain
from checks.views import VIEWS

_SPARK = {"s": "string", "i": "int", "l": "bigint", "d": "date", "t": "timestamp", "b": "boolean"}
_DUCK = {"s": "VARCHAR", "i": "INTEGER", "l": "BIGINT", "d": "DATE", "t": "TIMESTAMP",
         "b": "BOOLEAN"}

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
BUILDERS: dict[str, Callable[[Chain], DataFrame]] = {}


def parse(contract: str) -> list[tuple[str, str]]:
    columns = []
    for group in contract.split(";"):
        kind, *names = group.split()
        columns += [(name, kind) for name in names]
    return columns


def conform(df: DataFrame, contract: str) -> DataFrame:
    def one(name: str, kind: str):
        if kind == "f":
            return (F.round(F.col(name).cast("double"), 6) + F.lit(0.0)).alias(name)
        return F.col(name).cast(_SPARK[kind]).alias(name)

    return df.select(*[one(n, k) for n, k in parse(contract)])


def conform_sql(sql: str, contract: str) -> str:
    def one(name: str, kind: str) -> str:
        if kind == "f":
            return f"round(CAST({name} AS DOUBLE), 6) + 0.0 AS {name}"
        return f"CAST({name} AS {_DUCK[kind]}) AS {name}"

    body = cte_chain(sql, VIEWS)
    return f"SELECT {', '.join(one(n, k) for n, k in parse(contract))} FROM (\n{body}\n) result"


def query(name: str, contract: str, sql: str | None = None):
    """Register ``fn(chain) -> DataFrame`` under ``name``.

    A query starts a chain of its own; a builder runs on one whose tables may be stored.
    """
    def register(fn: Callable[[Chain], DataFrame]):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return conform(fn(Chain(spark, sf_dir)), contract)

        run.__name__ = name
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = run
        BUILDERS[name] = lambda chain: conform(fn(chain), contract)
        if sql is not None:
            ORACLES[name] = conform_sql(sql, contract)
        return fn

    return register


def load() -> None:
    from checks import (queries_basic, queries_climate, queries_indices,  # noqa: F401
                        queries_refresh, queries_tables)
