"""Registers queries with their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def rounded(x: str, digits: int) -> str:
    """DuckDB's expression of a double rounded as Spark does: its decimal digits, half away from zero, and no negative zero."""
    return f"cast(round(cast(cast({x} as varchar) as decimal(38, 15)), {digits}) as double)"


class Kit:
    """Queries and oracles of one module."""

    def __init__(self):
        self.queries: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
        self.oracles: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None, dates: str = ""):
        """Register ``f(read)``, where ``read`` gives a table by name, under ``name``.

        ``dates`` lists date columns; they are reported as ISO text, which every client compares alike.
        """
        listed = dates.split()

        def run(f, spark, sf_dir):
            found = f(Tables(spark, sf_dir))
            return found.withColumns({d: found[d].cast("string") for d in listed}) if listed else found

        def register(f):
            self.queries[name] = lambda spark, sf_dir: run(f, spark, sf_dir)
            if sql:
                swap = ", ".join(f"cast({d} as varchar) as {d}" for d in listed)
                self.oracles[name] = f"select * replace ({swap}) from ({sql}) as found" if listed else sql
            return f

        return register


class Tables:
    """The tables of one scale folder; calling gives a frame."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def __call__(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
