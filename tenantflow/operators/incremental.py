"""Incremental sync from a high-water mark, and the change feed."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.model import IncrementSpec
from tenantflow.operators.binding import bind
from tenantflow.operators.upsert import upsert


def max_marker(target: DataFrame, local_field: str) -> DataFrame:
    """The highest marker of the target, as a frame of one row."""
    return target.agg(F.max(local_field).alias("max_value"))


def read_marker(target: DataFrame, local_field: str) -> str | None:
    """The highest marker as text; one value, so that it can go into a source filter."""
    return max_marker(target, local_field).select(F.col("max_value").cast("string")).first()[0]


def _plain_kind(kind: T.DataType | None) -> T.DataType | None:
    """The type as which the footers of Parquet files give the maximum, if they do."""
    if isinstance(kind, T.TimestampNTZType):
        return T.LongType()  # microseconds, as the files hold them
    exact = isinstance(kind, T.IntegralType | T.DateType | T.FloatType | T.DoubleType)
    return kind if exact else None


def footer_marker(spark: SparkSession, path: str, local_field: str) -> DataFrame:
    """:func:`max_marker` of a Parquet folder from the footers of its files alone.

    The aggregate is pushed into the scan, so no row is read. Texts, decimals and instants
    with a time zone have no usable maximum there; their column is read, and no other. The
    files must have the same columns in the same order, as those of one table have.
    """
    table = spark.read.parquet(path)
    files = table.inputFiles()
    columns = spark.read.parquet(files[0]).schema if files else T.StructType([])
    kind = columns[local_field].dataType if local_field in columns.names else None
    plain = _plain_kind(kind)
    if plain is None:
        return max_marker(table, local_field)
    # The footers are read by the place of a column, so all columns are declared.
    declared = T.StructType([T.StructField(f.name, plain if f.name == local_field else f.dataType) for f in columns])
    sources = spark.conf.get("spark.sql.sources.useV1SourceList")
    spark.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    # Aggregates are pushed by the newer kind of reader, which is chosen as the frame is made.
    spark.conf.set("spark.sql.sources.useV1SourceList", ",".join(s for s in sources.split(",") if s != "parquet"))
    try:
        stored = spark.read.schema(declared).parquet(path)
    finally:
        spark.conf.set("spark.sql.sources.useV1SourceList", sources)
    highest = max_marker(stored, local_field)
    if plain == kind:
        return highest
    epoch = F.lit("1970-01-01").cast("timestamp_ntz")
    return highest.select(F.timestamp_add("MICROSECOND", F.col("max_value"), epoch).alias("max_value"))


def read_footer_marker(spark: SparkSession, path: str, local_field: str) -> str | None:
    """:func:`footer_marker` as text. Where a file has no value, and so no maximum, the column is read."""
    as_text = F.col("max_value").cast("string")
    try:
        return footer_marker(spark, path, local_field).select(as_text).first()[0]
    except (PySparkException, Py4JJavaError) as error:
        if "No min/max found" not in str(error):
            raise
        return read_marker(spark.read.parquet(path), local_field)


def newer_than(
    df: DataFrame, field: str, marker: str | None, inclusive: bool = False
) -> DataFrame:
    """Rows past the marker, compared in the type of the column; all rows without one.

    The marker is a literal, so the filter reaches file footers and remote databases.
    ``inclusive`` also takes rows that share the marker, for sources where such rows
    arrive late; the keyed load makes taking them twice harmless.
    """
    if marker is None:
        return df
    bound = F.lit(marker).cast(df.schema[field].dataType)
    return df.filter(F.col(field) >= bound if inclusive else F.col(field) > bound)


@dataclass(frozen=True)
class SyncResult:
    """The target after a sync, the rows it announces and the marker it started from."""

    table: DataFrame
    changes: DataFrame | None
    old_marker: str | None


def change_feed(target: DataFrame, local_field: str, old_marker: str | None) -> DataFrame:
    """Target rows newer than the marker from before the load."""
    return newer_than(target, local_field, old_marker)


def incremental_sync(
    source: DataFrame,
    target: DataFrame,
    increment: IncrementSpec | None,
    keys: Sequence[str],
    order_by: Sequence[str],
    target_columns: Sequence[str] | None = None,
    inclusive: bool = False,
) -> SyncResult:
    """Load source rows past the target's marker; without markers, all of them.

    A full load replaces the target, as it starts from a cleared table.
    """
    target_columns = list(target_columns or source.columns)
    if increment is None:
        return SyncResult(bind(source, target_columns), None, None)
    marker = read_marker(target, increment.local_field)
    delta = bind(
        newer_than(source, increment.remote_field, marker, inclusive), target_columns
    )
    table = upsert(target, delta, keys, order_by)
    changes = change_feed(table, increment.local_field, marker)
    return SyncResult(table, changes if increment.notify_change else None, marker)
