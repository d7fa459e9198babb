"""Names, Spark plans and SQL counterparts of the registered queries."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Plan = Callable[[SparkSession, str], DataFrame]

PLANS: dict[str, Plan] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan under its function name, with the SQL giving the same table."""

    def add(plan: Plan) -> Plan:
        name = plan.__name__
        if name in PLANS:
            raise ValueError(f"query {name} is registered twice")
        PLANS[name] = plan
        if sql is not None:
            SQL[name] = sql
        return plan

    return add
