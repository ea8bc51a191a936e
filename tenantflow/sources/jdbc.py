"""Options for reading and writing databases over JDBC.

Hosts, users and passwords come from the caller; none has a default.
"""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tenantflow.model import DATABASE_TYPES, DEFAULT_FETCH_SIZE

# JDBC URL forms and driver classes by database type.
URL_FORMS = {
    "sql_server": "jdbc:jtds:sqlserver://{host}:{port};DatabaseName={database}",
    "sybase": "jdbc:sybase:Tds:{host}:{port}?ServiceName={database}",
    "mysql": "jdbc:mysql://{host}:{port}/{database}",
    "oracle": "jdbc:oracle:thin:@{host}:{port}:{sid}",
}
DRIVERS = {
    "sql_server": "net.sourceforge.jtds.jdbc.Driver",
    "sybase": "com.sybase.jdbc4.jdbc.SybDriver",
    "mysql": "com.mysql.cj.jdbc.Driver",
    "oracle": "oracle.jdbc.OracleDriver",
}
WAREHOUSE_URL_PROPERTIES = {"useUnicode": "true", "characterEncoding": "utf-8"}

_IDENTIFIER = re.compile(r"[A-Za-z0-9_]+")


def identifier(name: str) -> str:
    if not _IDENTIFIER.fullmatch(name):
        raise ValueError(f"{name!r} is not a plain identifier")
    return name


def table_name(name: str) -> str:
    """A checked name of a table, perhaps with its database before it."""
    return ".".join(identifier(part) for part in name.split("."))


@dataclass(frozen=True)
class RangePartitions:
    """Bounds that split one table into parallel reads; rows outside still come along."""

    column: str
    lower: object
    upper: object
    count: int


def connection_options(config: Mapping) -> dict[str, str]:
    """URL, driver and credentials of one database; SQL Server where no type is given."""
    kind = config.get("database_type") or DATABASE_TYPES[0]
    if kind not in URL_FORMS:
        raise ValueError(f"unknown database type {kind!r}, expected one of {DATABASE_TYPES}")
    parts = {"database": "", **config}
    return {
        "url": URL_FORMS[kind].format(**parts),
        "driver": DRIVERS[kind],
        "user": str(config["username"]),
        "password": str(config["password"]),
    }


def warehouse_options(config: Mapping, dw_name: str, session: str | None = None) -> dict[str, str]:
    """A tenant's warehouse as a sink.

    A Spark write has no session statement, so variables to set travel in the URL.
    """
    options = connection_options({**config, "database_type": "mysql", "database": dw_name})
    properties = dict(WAREHOUSE_URL_PROPERTIES)
    if session:
        properties["sessionVariables"] = session
    joined = "&".join(f"{name}={value}" for name, value in properties.items())
    return {**options, "url": f"{options['url']}?{joined}"}


def read_options(
    connection: Mapping[str, str],
    table: str | None = None,
    query: str | None = None,
    partitions: RangePartitions | None = None,
    fetch_size: int | None = DEFAULT_FETCH_SIZE,
    session: str | None = None,
) -> dict[str, str]:
    """Reader options for a table or a query, optionally split by range."""
    if (table is None) == (query is None):
        raise ValueError("give a table or a query")
    options = dict(connection)
    if fetch_size:
        options["fetchsize"] = str(fetch_size)
    if session:
        options["sessionInitStatement"] = session
    if partitions is None:
        options["dbtable" if table else "query"] = table or query
        return options
    # A split read takes no "query" option, so the query becomes a derived table.
    options["dbtable"] = table or f"({query}) tmp"
    options["partitionColumn"] = partitions.column
    options["lowerBound"] = str(partitions.lower)
    options["upperBound"] = str(partitions.upper)
    options["numPartitions"] = str(partitions.count)
    return options


def read(spark: SparkSession, options: Mapping[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()


def read_parts(
    spark: SparkSession, connection: Mapping[str, str], query: str, conditions: Sequence[str]
) -> DataFrame:
    """A query as one read whose tasks take the rows of one condition each.

    The conditions must exclude each other and cover all rows.
    """
    options = {name: value for name, value in connection.items() if name != "url"}
    return spark.read.jdbc(
        connection["url"], f"({query}) tmp", predicates=list(conditions), properties=options
    )


def write_options(
    connection: Mapping[str, str], table: str, batch_size: int | None = None
) -> dict[str, str]:
    """Writer options; an overwrite empties the table and keeps its definition."""
    options = {**connection, "dbtable": table, "truncate": "true"}
    if batch_size:
        options["batchsize"] = str(batch_size)
    return options


def write(df: DataFrame, options: Mapping[str, str], mode: str) -> None:
    """``mode`` is ``overwrite`` for a full refresh or ``append``."""
    df.write.format("jdbc").options(**options).mode(mode).save()
