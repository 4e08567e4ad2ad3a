"""Figures over facts. Money is summed as decimals, so that no order of addition shows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _money(c: str) -> Column:
    return F.col(c).cast("decimal(18,4)")


def revenue_by_month(rows: DataFrame, at: str, amount: str) -> DataFrame:
    return rows.groupBy(F.trunc(F.to_date(at), "month").alias("month")).agg(F.round(F.sum(_money(amount)), 2).cast("double").alias("revenue"), F.count("*").alias("orders"))


def top(rows: DataFrame, by: str, amount: str, n: int) -> DataFrame:
    return rows.groupBy(by).agg(F.round(F.sum(_money(amount)), 2).cast("double").alias("revenue")).orderBy(F.desc("revenue"), by).limit(n)


def distribution(rows: DataFrame, by: str) -> DataFrame:
    return rows.groupBy(F.col(by).alias("value")).agg(F.count("*").alias("n"))


def average(rows: DataFrame, amount: str) -> DataFrame:
    return rows.agg(F.round(F.avg(_money(amount)), 2).cast("double").alias("average_order_value"))
