"""CSV and Parquet reads and writes on any path Spark can reach."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wardmart.operators.rejects import rejected_values
from wardmart.sources import published


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None,
             rejected: str | None = None) -> DataFrame:
    """CSV with a header. Without a schema, types are inferred.

    With one, its columns are found by name wherever they stand and cast in the same pass;
    a field that is no value of its type becomes null. Other columns follow as text, and a
    missing one is an error. ``rejected`` names a last column that keeps the text of such
    fields, as ``operators.rejects`` has it.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        return reader.option("inferSchema", True).csv(path)
    rows = reader.csv(path)
    missing = [c for c in schema.names if c not in rows.columns]
    if missing:
        raise ValueError(f"the header of {path} lacks {missing}")
    others = [_quoted(c) for c in rows.columns if c not in schema.names]
    raw = {f.name: F.col(_quoted(f.name)) for f in schema}
    typed = {f.name: raw[f.name].try_cast(f.dataType) for f in schema}
    kept = [] if rejected is None else [rejected_values(
        {f.name: (raw[f.name], typed[f.name]) for f in schema if not isinstance(f.dataType, T.StringType)}
    ).alias(rejected)]
    return rows.select(*[c.alias(name) for name, c in typed.items()], *others, *kept)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def read_parquet(spark: SparkSession, path: str,
                 schema: T.StructType | None = None) -> DataFrame:
    """Parquet; a known schema saves the job that reads one from the files.

    Of a table that is published copy by copy, the current one.
    """
    copy = published.current(spark, path)
    if copy is not None:
        return published.opened(spark, copy)
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_parquet_if_exists(spark: SparkSession, path: str) -> DataFrame | None:
    """The table at ``path``; None where there is no folder or no file in it."""
    if not published.exists(spark, path):
        return None
    try:
        return read_parquet(spark, path)
    except AnalysisException as e:
        if e.getCondition() == "UNABLE_TO_INFER_SCHEMA":
            return None
        raise


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """``overwrite``, ``append``, or ``ignore``: do nothing when the path exists.

    Overwriting publishes a new copy (``sources.published``): the last good one stays readable
    until the new one is complete. ``append`` adds to the current copy.
    """
    if mode == "overwrite":
        copy = published.current(df.sparkSession, path)
        published.publish(df, path, buckets=copy.buckets if copy else None)
        return
    if mode == "append":
        copy = published.current(df.sparkSession, path)
        if copy is not None and copy.buckets is not None:
            raise ValueError(f"{path} is bucketed; replace it instead")
        path = copy.path if copy else path
    df.write.mode(mode).parquet(path)
