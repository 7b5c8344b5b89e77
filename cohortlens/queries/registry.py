"""Registered queries and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"{name} is registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def t_two_sided_sql(t: str, df: str) -> str:
    """Two-sided Student tail for whole-number df as a finite trigonometric sum."""
    th = f"atan(abs({t}) / sqrt({df}))"
    odd = (
        f"(2/pi()) * ({th} + CASE WHEN {df} > 1 THEN sin({th}) * list_sum(list_transform(range(0, CAST(({df}-1)/2 AS BIGINT)),"
        f" lambda k: sqrt(pi())/2 * exp(lgamma(k+1) - lgamma(k+1.5)) * pow(cos({th}), 2*k+1))) ELSE 0 END)"
    )
    even = (
        f"sin({th}) * list_sum(list_transform(range(0, CAST({df}/2 AS BIGINT)),"
        f" lambda k: exp(lgamma(k+0.5) - lgamma(k+1)) / sqrt(pi()) * pow(cos({th}), 2*k)))"
    )
    return f"(1 - (CASE WHEN CAST({df} AS BIGINT) % 2 = 1 THEN {odd} ELSE {even} END))"


def bh_sql(source: str, p: str, by: str = "") -> str:
    """Rows of ``source`` with a BH-adjusted column ``fdr``."""
    part = f"PARTITION BY {by}" if by else ""
    return f"""(SELECT * EXCLUDE (_r, _m), CASE WHEN {p} IS NOT NULL THEN LEAST(1.0, MIN(_r) OVER ({part} ORDER BY {p} DESC NULLS FIRST
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)) END AS fdr
      FROM (SELECT *, CASE WHEN {p} IS NOT NULL THEN {p} * _m / COUNT({p}) OVER ({part} ORDER BY {p}
        RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) END AS _r
      FROM (SELECT *, COUNT({p}) OVER ({part}) AS _m FROM {source})))"""
