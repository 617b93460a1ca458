"""Tables that are replaced as a whole without losing the last good copy.

Each replacement is written to a new folder below the table's own. Only when it is complete,
a row in the table's ledger names it, and readers take the folder that the latest row names.
A write that fails half way takes its own folder with it and leaves the last copy as it was; one
whose driver dies leaves a folder that no row names.
The ledger also keeps what a copy was made from, so that a run can tell whether it is still
current, and how it is bucketed.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

LEDGER = "_published"
_ROW = "number long, folder string, at double, made_from string, bucket_columns array<string>, buckets int"


@dataclass(frozen=True)
class Buckets:
    """Rows with equal ``columns`` share one of ``number`` files, so that joins and
    aggregations on these columns need no shuffle."""

    columns: tuple[str, ...]
    number: int


@dataclass(frozen=True)
class Copy:
    """One published copy of a table."""

    number: int
    path: str
    made_from: str | None
    buckets: Buckets | None

    @property
    def table(self) -> str:
        """The name a bucketed copy has in the session's catalog."""
        return "wardmart_" + uuid.uuid5(uuid.NAMESPACE_URL, self.path).hex


def _place(spark: SparkSession, path: str):
    """A path and its file system, as Spark reaches them."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _place(spark, path)
    return fs.exists(place)


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below ``path``."""
    fs, place = _place(spark, path)
    return fs.getContentSummary(place).getLength()


def copies(spark: SparkSession, path: str) -> list[Copy]:
    """All published copies, the current one first; empty if there is no ledger."""
    path = path.rstrip("/")
    if not exists(spark, f"{path}/{LEDGER}"):
        return []
    rows = spark.read.schema(_ROW).json(f"{path}/{LEDGER}").collect()
    return [Copy(r.number, f"{path}/{r.folder}", r.made_from,
                 Buckets(tuple(r.bucket_columns), r.buckets) if r.buckets else None)
            for r in sorted(rows, key=lambda r: (r.number, r.folder), reverse=True)]


def current(spark: SparkSession, path: str) -> Copy | None:
    return next(iter(copies(spark, path)), None)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def _declared(spark: SparkSession, copy: Copy) -> None:
    """Makes a bucketed copy known to this session's catalog; its files stay where they are."""
    if spark.catalog.tableExists(copy.table):
        return
    schema = spark.read.parquet(copy.path).schema
    columns = ", ".join(f"{_quoted(f.name)} {f.dataType.simpleString()}" for f in schema)
    keys = ", ".join(map(_quoted, copy.buckets.columns))
    location = copy.path.replace("\\", "\\\\").replace("'", "\\'")
    spark.sql(f"create table if not exists {copy.table} ({columns}) using parquet clustered by ({keys}) "
              f"sorted by ({keys}) into {copy.buckets.number} buckets location '{location}'")


def opened(spark: SparkSession, copy: Copy) -> DataFrame:
    if copy.buckets is None:
        return spark.read.parquet(copy.path)
    _declared(spark, copy)
    return spark.table(copy.table)


def publish(df: DataFrame, path: str, made_from: str | None = None, buckets: Buckets | None = None,
            check: Callable[[], None] | None = None, keep: int = 2) -> Copy:
    """Write ``df`` as the table's next copy and make it the current one.

    ``check`` runs after the write and before the copy counts; if it raises, the last copy
    stays. Two writers at once both finish; the later number counts, then the folder's name.
    The last ``keep`` copies stay: who reads the one before is not disturbed.
    """
    spark, path = df.sparkSession, path.rstrip("/")
    before = copies(spark, path)
    number = before[0].number + 1 if before else 1
    folder = f"copy-{number:08d}-{uuid.uuid4().hex}"
    copy = Copy(number, f"{path}/{folder}", made_from, buckets)
    try:
        if buckets is None:
            df.write.parquet(copy.path)
        else:
            # Dealt by the bucket's own hash first, each bucket is one file and not one a task.
            (df.repartition(buckets.number, *buckets.columns).write
             .bucketBy(buckets.number, *buckets.columns).sortBy(*buckets.columns)
             .option("path", copy.path).saveAsTable(copy.table))
        if check is not None:
            check()
    except Exception:
        _remove(spark, copy)
        raise
    row = spark.range(0, 1, 1, 1).select(
        F.lit(number).cast("long").alias("number"), F.lit(folder).alias("folder"), F.lit(time.time()).alias("at"),
        F.lit(made_from).cast("string").alias("made_from"),
        *([F.array(*map(F.lit, buckets.columns)).alias("bucket_columns"), F.lit(buckets.number).alias("buckets")]
          if buckets else []))
    row.write.mode("append").json(f"{path}/{LEDGER}")
    _prune(spark, [copy, *before], keep)
    return copy


def _prune(spark: SparkSession, made: Sequence[Copy], keep: int) -> None:
    """Delete the copies that follow the last ``keep``. Folders that no row names stay: another
    writer may be at work in them."""
    for copy in made[keep:keep + 8]:  # older ones went with earlier calls
        _remove(spark, copy)


def _remove(spark: SparkSession, copy: Copy) -> None:
    if copy.buckets is not None:
        spark.sql(f"drop table if exists {copy.table}")
    fs, folder = _place(spark, copy.path)
    fs.delete(folder, True)


def fingerprint(spark: SparkSession, paths: Sequence[str]) -> str:
    """Names, sizes and times of the files below ``paths``, hashed; their contents are not read."""
    found = spark.read.format("binaryFile").load(list(paths)).select("path", "length", "modificationTime")
    one = found.agg(F.count("*").alias("n"), F.sum(F.xxhash64(*found.columns).cast("decimal(38,0)")).alias("s")).first()
    return f"{one.n}:{one.s}"
