"""Writes of messages to a topic."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame

from tenantflow.session import staged


def kafka_options(servers: str, topic: str, extra: Mapping[str, str] | None = None) -> dict:
    return {"kafka.bootstrap.servers": servers, "topic": topic, **(extra or {})}


def send(messages: DataFrame, options: Mapping[str, str]) -> None:
    """Write ``value``, and ``key`` where there is one.

    The messages are fixed before the first is sent. A task that is repeated sends the
    same text with the same event id again, so that receivers can tell copies.
    """
    columns = [c for c in ("key", "value") if c in messages.columns]
    fixed = staged(messages.select(*columns), "messages")
    fixed.write.format("kafka").options(**options).save()
