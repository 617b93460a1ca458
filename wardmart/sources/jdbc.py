"""JDBC tables. Address and credentials come from the caller's configuration."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class JdbcConnection:
    url: str
    driver: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    # Rows per batch and the most connections a load may open at a time.
    batch_size: int = 10_000
    max_connections: int = 32
    properties: Mapping[str, str] = field(default_factory=dict, repr=False)

    def options(self, table: str) -> dict[str, str]:
        found = {"url": self.url, "dbtable": table, "driver": self.driver}
        if self.user is not None:
            found["user"] = self.user
        if self.password is not None:
            found["password"] = self.password
        return {**found, **self.properties}

    def write_options(self, table: str) -> dict[str, str]:
        return {**self.options(table), "batchsize": str(self.batch_size),
                "numPartitions": str(self.max_connections)}


@dataclass(frozen=True)
class KeyRange:
    """Splits a read into ``parts`` queries over an even range of a numeric column."""

    column: str
    lower: int
    upper: int
    parts: int

    def options(self) -> dict[str, str]:
        return {"partitionColumn": self.column, "lowerBound": str(self.lower),
                "upperBound": str(self.upper), "numPartitions": str(self.parts)}


def read_table(spark: SparkSession, connection: JdbcConnection, table: str,
               split: KeyRange | None = None) -> DataFrame:
    """A table; with ``split`` it is read by several connections at once."""
    options = connection.options(table) | (split.options() if split else {})
    return spark.read.format("jdbc").options(**options).load()


def _dealt(df: DataFrame, connection: JdbcConnection) -> DataFrame:
    """One partition for each connection. Left to the writer's own limit, all work before
    the write would run in that few tasks."""
    return df.repartition(connection.max_connections)


def append_table(df: DataFrame, connection: JdbcConnection, table: str) -> None:
    """Insert all rows. Each partition is one transaction, so a failed load may leave
    some of them behind; load by absent keys to make a rerun complete it."""
    _dealt(df, connection).write.format("jdbc").options(
        **connection.write_options(table)).mode("append").save()


def replace_table(df: DataFrame, connection: JdbcConnection, table: str) -> None:
    """Empty the table, then insert: its definition, keys included, stays."""
    options = connection.write_options(table) | {"truncate": "true"}
    _dealt(df, connection).write.format("jdbc").options(**options).mode("overwrite").save()
