"""Job specifications, tenant references and the fixed schemas."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import types as T

#: Values of ``database_type``; the first is the default.
DATABASE_TYPES = ("sql_server", "sybase", "mysql", "oracle")

#: Job modes, one folder per mode in a definition tree.
JOB_MODES = ("dr", "stock", "ss", "plan")

DEFAULT_FETCH_SIZE = 1024

SIGNAL_SCHEMA = T.StructType(
    [
        T.StructField("org_code", T.StringType()),
        T.StructField("dw_name", T.StringType()),
        T.StructField("time", T.StringType()),
    ]
)

INCREMENT_SCHEMA = T.StructType(
    [
        T.StructField("remote_field", T.StringType()),
        T.StructField("local_field", T.StringType()),
        T.StructField("notify_change", T.BooleanType()),
    ]
)

JOB_META_SCHEMA = T.StructType(
    [
        T.StructField("target_columns", T.ArrayType(T.StringType())),
        T.StructField("target_tables", T.ArrayType(T.StringType())),
        T.StructField("fetch_size", T.IntegerType()),
        T.StructField("task_priority", T.IntegerType()),
        T.StructField("increment_config", INCREMENT_SCHEMA),
        T.StructField("preferred_db_config_name", T.StringType()),
    ]
)


@dataclass(frozen=True)
class TenantRef:
    """A tenant and the name of its warehouse database."""

    org_code: str
    dw_name: str

    @classmethod
    def with_default_warehouse(cls, org_code: str) -> TenantRef:
        return cls(org_code, f"{org_code}DW")


@dataclass(frozen=True)
class IncrementSpec:
    """Marker columns of an incremental job."""

    remote_field: str
    local_field: str
    notify_change: bool = False

    @classmethod
    def from_config(cls, config: Mapping | None) -> IncrementSpec | None:
        """``None``, an empty map or a map with one field only mean full load."""
        config = config or {}
        if config.get("remote_field") is None or config.get("local_field") is None:
            return None
        return cls(
            config["remote_field"], config["local_field"], bool(config.get("notify_change"))
        )


@dataclass(frozen=True)
class SyncSpec:
    """One sync job: what is bound to which columns, and how it is loaded.

    ``keys`` are the unique keys of the target and ``order_by`` the columns that
    say which of two batch rows with one key is the later; both are needed for an
    incremental job only. ``inclusive`` also takes rows that share the marker.
    """

    org_code: str
    name: str
    target_tables: tuple[str, ...]
    target_columns: tuple[str, ...]
    mode: str = "ss"
    bind: str = "position"
    clear_before_load: bool = False
    increment: IncrementSpec | None = None
    keys: tuple[str, ...] = ()
    order_by: tuple[str, ...] = ()
    partition_by: tuple[str, ...] = ()
    task_priority: int = 0
    source_tag: str = "default"
    fetch_size: int = DEFAULT_FETCH_SIZE
    inclusive: bool = False

    def __post_init__(self) -> None:
        if self.mode not in JOB_MODES:
            raise ValueError(f"unknown mode {self.mode!r}, expected one of {JOB_MODES}")
        if not self.target_tables:
            raise ValueError(f"{self.name}: no target table")
        if self.bind not in ("position", "name"):
            raise ValueError(f"{self.name}: bind must be 'position' or 'name'")
        if self.increment and self.clear_before_load:
            raise ValueError(
                f"{self.name}: clearing the target before an incremental load would lose "
                "every row older than the marker"
            )
        if self.increment and not (self.keys and self.order_by):
            raise ValueError(f"{self.name}: an incremental job needs keys and order_by")
