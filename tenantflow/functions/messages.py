"""JSON messages: refresh signals and change events."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.model import SIGNAL_SCHEMA

#: Names of events are made unique in this namespace; another one makes other ids.
EVENT_NAMESPACE = uuid.uuid5(uuid.NAMESPACE_URL, "urn:tenantflow:change-event")

_SEPARATOR = "\x1f"


def signal_value(org_code: Column, dw_name: Column, time: Column) -> Column:
    """Refresh signal as JSON text."""
    stamp = F.date_format(time, "yyyy-MM-dd HH:mm:ss")
    return F.to_json(
        F.struct(org_code.alias("org_code"), dw_name.alias("dw_name"), stamp.alias("time"))
    )


def parse_signals(messages: DataFrame, value: str = "value") -> DataFrame:
    """Signals from JSON text; text that names no tenant is left out."""
    parsed = F.from_json(F.col(value).cast("string"), SIGNAL_SCHEMA)
    return (
        messages.select(parsed.alias("signal"))
        .select("signal.*")
        .filter(F.col("org_code").isNotNull())
    )


def latest_signals(signals: DataFrame) -> DataFrame:
    """One signal per tenant: the one with the latest time."""
    newest = F.max_by(F.struct("dw_name", "time"), F.struct("time", "dw_name"))
    return (
        signals.groupBy("org_code")
        .agg(newest.alias("newest"))
        .select("org_code", "newest.dw_name", "newest.time")
    )


def named_uuid(name: Column, namespace: uuid.UUID = EVENT_NAMESPACE) -> Column:
    """The name-based UUID (version 5) of a text."""
    digest = F.sha1(F.concat(F.unhex(F.lit(namespace.hex)), F.encode(name, "UTF-8")))
    place = F.pmod(F.conv(F.substring(digest, 17, 1), 16, 10).cast("int"), F.lit(4)) + 1
    variant = F.substring(F.lit("89ab"), place, F.lit(1))
    return F.concat(
        F.substring(digest, 1, 8), F.lit("-"), F.substring(digest, 9, 4), F.lit("-5"),
        F.substring(digest, 14, 3), F.lit("-"), variant, F.substring(digest, 18, 3), F.lit("-"),
        F.substring(digest, 21, 12),
    )


def event_value(title: str, body: Column, tenant: Column, content: Column) -> Column:
    """Change event envelope as JSON text; ``targets`` is empty for "everyone".

    The id follows from title, tenant and content, so that a batch which is sent again
    sends the same events, and their readers can tell.
    """
    parts = [F.lit(title), F.coalesce(tenant, F.lit("")), F.to_json(content)]
    return F.to_json(
        F.struct(
            F.lit(title).alias("title"),
            body.alias("body"),
            F.lit("json").alias("mime"),
            named_uuid(F.concat_ws(_SEPARATOR, *parts)).alias("uuid"),
            F.array().cast("array<string>").alias("targets"),
        )
    )
