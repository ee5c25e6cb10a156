"""Reading source systems over JDBC, split into parallel ranges."""

from __future__ import annotations

import os
from collections.abc import Callable, Mapping
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, DataFrameReader, SparkSession

from clientlens.config import SourceTable
from clientlens.functions.times import as_utc
from clientlens.operators.incremental import change_window


@dataclass(frozen=True)
class Connection:
    """How to reach one source system; the password is read from the environment."""

    url: str
    driver: str
    user: str
    password_env: str
    partitions: int = 16
    fetch_size: int = 10000

    @classmethod
    def from_mapping(cls, raw: Mapping) -> Connection:
        sizes = {k: int(raw[k]) for k in ("partitions", "fetch_size") if k in raw}
        return cls(raw["jdbc_url"], raw["driver"], raw["user"], raw["password_env"], **sizes)

    def options(self) -> dict[str, str]:
        password = os.environ.get(self.password_env)
        if not password:
            raise RuntimeError(f"environment variable {self.password_env} is not set")
        return {
            "url": self.url,
            "driver": self.driver,
            "user": self.user,
            "password": password,
            "fetchsize": str(self.fetch_size),
        }


def range_options(column: str, low, high, partitions: int) -> dict[str, str]:
    """Options that split a scan into ranges of a date, timestamp or number column.

    Spark gives rows outside the bounds to the outer ranges and NULLs to the first one, so
    bounds only shape the split and never lose rows.
    """
    return {
        "partitionColumn": column,
        "lowerBound": str(low),
        "upperBound": str(high),
        "numPartitions": str(partitions),
    }


def _reader(spark: SparkSession, connection: Connection) -> DataFrameReader:
    return spark.read.format("jdbc").options(**connection.options())


def read_table(
    spark: SparkSession, connection: Connection, table: str, split_column: str | None = None
) -> DataFrame:
    """A whole source table; with a split column, read as parallel ranges between its extremes."""
    reader = _reader(spark, connection).option("dbtable", table)
    if split_column is not None:
        extremes = f"(SELECT MIN({split_column}) AS lo, MAX({split_column}) AS hi FROM {table}) b"
        low, high = _reader(spark, connection).option("dbtable", extremes).load().first()
        if low is not None and low != high:
            reader = reader.options(**range_options(split_column, low, high, connection.partitions))
    return reader.load()


def read_changes(
    spark: SparkSession, connection: Connection, table: str, column: str, last: datetime, now: datetime
) -> DataFrame:
    """Rows changed in a window, read as parallel ranges of the change time within it. The window
    itself is a filter that Spark pushes to the source, into each range's query."""
    bounds = [f"{as_utc(t):%Y-%m-%d %H:%M:%S}" for t in (last, now)]
    reader = _reader(spark, connection).option("dbtable", table)
    rows = reader.options(**range_options(column, *bounds, connection.partitions)).load()
    names = {c.lower(): c for c in rows.columns}
    return change_window(rows, names[column.lower()], last, now)


def jdbc_source(
    spark: SparkSession, connections: Mapping[str, Connection]
) -> Callable[[SourceTable, datetime | None, datetime], DataFrame]:
    """A reader for the ingest job: whole tables by their split column, changes by their time."""

    def read(table: SourceTable, last: datetime | None, now: datetime) -> DataFrame:
        connection = connections[table.source]
        if table.change_column is None or last is None:
            return read_table(spark, connection, table.name, table.partition_column)
        return read_changes(spark, connection, table.name, table.change_column, last, now)

    return read
