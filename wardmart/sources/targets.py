"""Where gold tables go: a Parquet folder per table or a JDBC table."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wardmart.operators.bitmaps import is_whole, key_bitmaps, merged, not_in
from wardmart.operators.quality import require_none
from wardmart.operators.upsert import absent_rows, one_per_key
from wardmart.sources import files, jdbc, published


class Target(Protocol):
    def read(self, spark: SparkSession, table: str) -> DataFrame | None: ...
    def append(self, df: DataFrame, table: str) -> None: ...
    def replace(self, df: DataFrame, table: str) -> None: ...


@dataclass(frozen=True)
class ParquetTarget:
    root: str

    def path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/{table}"

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        return files.read_parquet_if_exists(spark, self.path(table))

    def append(self, df: DataFrame, table: str) -> None:
        files.write_parquet(df, self.path(table), "append")

    def replace(self, df: DataFrame, table: str) -> None:
        files.write_parquet(df, self.path(table), "overwrite")


@dataclass(frozen=True)
class IndexedParquetTarget(ParquetTarget):
    """Parquet tables with a stored index of their whole-number keys.

    The index is a table of bitmaps beside the rows, published with a fingerprint of the files
    it covers: their names, sizes and times. A load whose files still match reads the index
    and no row of the target. After a load that stopped half way, or a change from outside,
    they do not match, and the index is built anew from the key column.
    """

    def _index_path(self, table: str) -> str:
        return f"{self.root.rstrip('/')}/_keys/{table}"

    def _fingerprint(self, spark: SparkSession, table: str) -> str:
        copy = published.current(spark, self.path(table))
        path = copy.path if copy else self.path(table)
        return f"{path}|{published.fingerprint(spark, [path])}"

    def held_keys(self, spark: SparkSession, table: str, key: str) -> DataFrame | None:
        """The index of ``table``, built anew if it does not cover its files; None without a table."""
        rows = self.read(spark, table)
        if rows is None:
            return None
        made_from = f"{key}|{self._fingerprint(spark, table)}"
        copy = published.current(spark, self._index_path(table))
        if copy is None or copy.made_from != made_from:
            # Distinct first: a key that the target repeats very often is one row in each task.
            keys = key_bitmaps(rows.select(key).distinct(), key)
            copy = published.publish(keys, self._index_path(table), made_from)
        return published.opened(spark, copy)

    def insert_absent(self, df: DataFrame, table: str, key: str, unique: bool) -> None:
        """Append the rows whose key is not held, then publish the grown index."""
        spark = df.sparkSession
        held = self.held_keys(spark, table, key)
        rows = df if unique else one_per_key(df, key)
        # All keys of the load are held afterwards, whichever of its rows were added.
        keys = key_bitmaps(rows, key)
        self.append(rows if held is None else not_in(rows, key, held), table)
        made_from = f"{key}|{self._fingerprint(spark, table)}"
        published.publish(keys if held is None else merged(held, keys), self._index_path(table), made_from)


@dataclass(frozen=True)
class JdbcTarget:
    """Tables of a database; they exist there already, with their keys.

    ``splits`` names the key range of a table that is to be read by several connections.
    """

    connection: jdbc.JdbcConnection
    splits: Mapping[str, jdbc.KeyRange] = field(default_factory=dict)

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        return jdbc.read_table(spark, self.connection, table, self.splits.get(table))

    def append(self, df: DataFrame, table: str) -> None:
        jdbc.append_table(df, self.connection, table)

    def replace(self, df: DataFrame, table: str) -> None:
        jdbc.replace_table(df, self.connection, table)


LOAD_MODES = ("append", "replace", "insert_if_absent")


def load(df: DataFrame, target: Target, table: str, key: str,
         mode: str = "insert_if_absent", unique: bool = False) -> None:
    """Load one table. ``insert_if_absent`` is safe to run again, after a failure too.

    It refuses rows without a key, as the target's primary key would: they could not be
    found again, so that each run would add them once more.
    """
    if mode == "append":
        target.append(df, table)
    elif mode == "replace":
        target.replace(df, table)
    elif mode == "insert_if_absent":
        require_none(df.filter(F.col(key).isNull()).select(key), f"rows of {table} without a key")
        if isinstance(target, IndexedParquetTarget) and is_whole(df, key):
            target.insert_absent(df, table, key, unique)
            return
        held = target.read(df.sparkSession, table)
        target.append(absent_rows(df, held, key, unique), table)
    else:
        raise ValueError(f"load mode {mode!r} is not one of {LOAD_MODES}")
