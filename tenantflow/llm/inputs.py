"""What the operators of this package share: reading tables, column checks, text batches."""

from __future__ import annotations

from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def default_tokenizer() -> str:
    """The vocabulary file that the queries use; every operator takes its path."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def parallelism(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def fresh_name(df: DataFrame, wanted: str) -> str:
    """A column name that ``df`` does not have, whatever the case of its letters."""
    taken = {name.lower() for name in df.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def texts_of(column: pa.Array) -> list[str]:
    """The texts of an Arrow column as Python strings; null counts as empty."""
    return [text or "" for text in column.to_pylist()]


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def record_batch(schema: pa.Schema, columns: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [
            column if isinstance(column, pa.Array) else pa.array(column, field.type)
            for column, field in zip(columns, schema, strict=True)
        ],
        schema=schema,
    )
