"""Registry of named queries: a Spark plan and, where SQL can say it, the same query as ANSI SQL."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forumlens.session import pin_conf
from forumlens.sources import sample_tables

Plan = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    name: str
    run: Plan
    sql: str | None


CATALOG: dict[str, Query] = {}


def query(name: str, sql: str | None = None) -> Callable[[Plan], Plan]:
    """Register a plan. `{meta}`, `{posts}` and `{threads}` in the SQL stand for the CTEs of the derived posts."""

    def register(plan: Plan) -> Plan:
        if name in CATALOG:
            raise ValueError(f"query {name!r} is registered twice")

        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return comparable(plan(pin_conf(spark), sf_dir))

        text = sql
        if text is not None:
            text = text.replace("{meta}", sample_tables.META_SQL).replace("{posts}", sample_tables.POSTS_SQL)
            text = text.replace("{threads}", sample_tables.THREADS_SQL).strip()
        CATALOG[name] = Query(name, run, text)
        return plan

    return register


def comparable(df: DataFrame) -> DataFrame:
    """Integers as bigint and doubles rounded to 6, so that results compare across engines."""
    columns = []
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        column = F.col(f"`{field.name}`")
        if kind in ("tinyint", "smallint", "int"):
            column = column.cast("long").alias(field.name)
        elif kind in ("double", "float"):
            column = F.round(column.cast("double"), 6).alias(field.name)
        columns.append(column)
    return df.select(*columns)
