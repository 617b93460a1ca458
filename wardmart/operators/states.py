"""Column profiles that add up over deliveries.

A delivery's state is how often each value of each column occurs in it. States are stored
once per delivery, so that a profile of all deliveries so far reads states and not the rows
of earlier deliveries. A delivery that arrives again replaces its own state.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmart.operators.profile import Profile, counted_values

_STATE = "column string, value string, n bigint"


def value_states(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """column, value as text and n of all non-null values; NaN counts as missing. One pass,
    counted before the shuffle."""
    columns = list(dict.fromkeys(columns))
    counts, number = counted_values(df, columns)
    name = F.coalesce(*[F.when(F.col("__set") == number[c], F.lit(c)) for c in columns])
    value = F.coalesce(*[F.col(c).cast("string") for c in columns])
    found = counts.select(name.alias("column"), value.alias("value"), F.col("__n").alias("n"))
    return found.where("value is not null")


def profile_of_states(states: DataFrame, kinds: Mapping[str, T.DataType], modes: Sequence[str],
                      means: Sequence[str] = ()) -> DataFrame:
    """``column_profile`` of the rows that ``states`` count; ``kinds`` are the columns' types."""
    total = states.groupBy("column", "value").agg(F.sum("n").alias("n"))

    def of(c: str, value):
        return F.when(F.col("column") == c, value)

    def typed(c: str):
        return F.col("value").try_cast(kinds[c])

    found = [
        F.min_by(typed(c), of(c, F.struct((-F.col("n")).alias("n"), typed(c).alias("v")))).alias(f"mode_{c}")
        for c in modes]
    averages = [
        F.try_divide(F.sum(of(c, typed(c).cast("double") * F.col("n"))), F.sum(of(c, F.col("n")))).alias(f"mean_{c}")
        for c in means]
    return total.agg(*found, *averages)


class Deliveries:
    """The stored states of one table's columns, by delivery."""

    def __init__(self, path: str):
        self.path = path.rstrip("/")

    def add(self, delivery: str, df: DataFrame, columns: Sequence[str]) -> None:
        """Store the state of one delivery, in place of an earlier one of the same name. Only
        its own folder is replaced, when the new state is complete."""
        # A row that counts nothing: without any, the earlier state would not be replaced.
        marker = df.sparkSession.createDataFrame([("", "", 0)], _STATE)
        (value_states(df, columns).unionAll(marker).withColumn("delivery", F.lit(delivery)).write
         .mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("delivery").parquet(self.path))

    def states(self, spark: SparkSession) -> DataFrame:
        return spark.read.schema(f"{_STATE}, delivery string").parquet(self.path)

    def profiled(self, delivery: str):
        """Stands for ``Profile`` in a cleaner: what it is given is stored as ``delivery``, and
        the statistics are those of all deliveries together."""
        def make(df: DataFrame, modes: Sequence[str], means: Sequence[str] = ()) -> Profile:
            self.add(delivery, df, [*modes, *means])
            kinds = {c: df.schema[c].dataType for c in [*modes, *means]}
            return Profile.of_row(profile_of_states(self.states(df.sparkSession), kinds, modes, means))
        return make
