"""Registered queries: name -> (DataFrame function, SQL that gives the same rows)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The input tables of a data folder, read when first named."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def __getattr__(self, name: str) -> DataFrame:
        table = self.spark.read.parquet(f"{self.folder}/{name}.parquet")
        self.__dict__[name] = table  # the schema is read from the files once
        return table


def query(sql: str | None = None, name: str | None = None):
    """Register a function of `Tables`; its name is the query's name."""

    def register(build: Callable[[Tables], DataFrame]):
        key = name or build.__name__
        QUERIES[key] = lambda spark, folder: build(Tables(spark, folder))
        if sql is not None:
            ORACLES[key] = sql
        return build

    return register


def load_all() -> tuple[dict[str, Query], dict[str, str]]:
    """Import every query module and return both registries."""
    from strataflow.queries import keyed, marts, payloads, quality, reports, runs, scalars, storage  # noqa: F401

    return dict(QUERIES), dict(ORACLES)
