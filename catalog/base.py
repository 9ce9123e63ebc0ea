"""Shared helpers of the registered queries."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from voxspark.session import spread


@dataclass(frozen=True)
class Query:
    run: Callable[[SparkSession, str], DataFrame]
    sql: str | None = None


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A table whose rows cost much to process, spread over all cores."""
    return spread(table(spark, sf_dir, name))


def second_text(c: Column | str) -> Column:
    return F.date_format(c, "yyyy-MM-dd HH:mm:ss")


SQL_SECOND = "'%Y-%m-%d %H:%M:%S'"


class Registry(dict):
    """name -> Query, filled by a decorator."""

    def add(self, name: str, sql: str | None = None):
        def keep(fn):
            if name in self:
                raise KeyError(f"registered twice: {name}")
            self[name] = Query(fn, sql)
            return fn

        return keep
