"""Refresh signals as a stream."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession


def kafka_options(servers: str, topic: str, extra: Mapping[str, str] | None = None) -> dict:
    """Options of the signal topic; a new query starts with the signals to come."""
    return {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": "latest",
        **(extra or {}),
    }


def read_kafka(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.readStream.format("kafka").options(**options).load()


def read_folder(spark: SparkSession, path: str) -> DataFrame:
    """Signals from text files, one message per line."""
    return spark.readStream.format("text").load(path)
