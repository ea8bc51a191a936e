"""One query over the databases of many tenants."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import partial
from string import Template

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantflow.model import TenantRef
from tenantflow.sources import jdbc
from tenantflow.sources.jdbc import identifier
from tenantflow.sources.literals import literal
from tenantflow.sources.splits import Splits, read_split

#: Tenants of one server whose query is sent as one text, and databases asked at a time.
TENANTS_PER_QUERY = 64
CONNECTIONS = 16

#: The tag that stands for the tenant's own warehouse.
TENANT_TAG = "retailer"

# Fixed value: the place of the marker condition in a source query.
_MARKER_PLACE = re.compile(r"\{\{\s*max_condition_pit\s*\}\}")


class SourceRegistry:
    """Connection settings by tag."""

    def __init__(self, settings: Mapping[str, Mapping]) -> None:
        self._settings = {tag: dict(values) for tag, values in settings.items()}

    def settings_for(self, tenant: TenantRef, tag: str | None = None) -> dict:
        """A copy of the settings of a tag; the tenant tag gets the tenant's database."""
        tag = tag or TENANT_TAG
        settings = dict(self._settings[tag])
        if tag == TENANT_TAG:
            settings["database"] = tenant.dw_name
        return settings


def render_remote(
    template: str, tenant: TenantRef, params: Mapping | None = None, dialect: str | None = None
) -> str:
    """SQL text for a remote database.

    ``${dw_name}`` is a checked identifier, ``${org_code}`` and all parameters are
    literals.
    """
    values = {name: literal(value, dialect) for name, value in (params or {}).items()}
    return Template(template).substitute(
        values, dw_name=identifier(tenant.dw_name), org_code=literal(tenant.org_code, dialect)
    )


def render_marker(
    query: str,
    field: str | None,
    marker: str | None,
    inclusive: bool = False,
    dialect: str | None = None,
) -> tuple[str, bool]:
    """The query with the marker condition in its place, and whether it has such a place.

    Without a marker every row is wanted.
    """
    condition = "1=1"
    if field is not None and marker is not None:
        column = ".".join(identifier(part) for part in field.split("."))
        condition = f"{column} {'>=' if inclusive else '>'} {literal(marker, dialect)}"
    text, places = _MARKER_PLACE.subn(lambda _: condition, query)
    return text, places > 0


def query_tenant(
    spark: SparkSession, template: str, tenant: TenantRef, params: Mapping | None = None
) -> DataFrame:
    """A query on Spark tables, with ``:org_code``, ``:dw_name`` and the parameters bound.

    Names are bound with ``IDENTIFIER(:dw_name || '...')``, values as they are.
    """
    bound = {"org_code": tenant.org_code, "dw_name": identifier(tenant.dw_name)}
    return spark.sql(template, args={**(params or {}), **bound})


def _united(frames: Sequence[DataFrame]) -> DataFrame:
    """The union of frames, made in pairs to keep the plan flat."""
    while len(frames) > 1:
        paired = [a.unionByName(b) for a, b in zip(frames[::2], frames[1::2], strict=False)]
        frames = paired + frames[len(frames) - len(frames) % 2 :]
    return frames[0]


def scan_tenants(
    tenants: Sequence[TenantRef], read: Callable[[TenantRef], DataFrame]
) -> DataFrame:
    """The rows of every tenant, tagged by ``org_code``.

    ``read`` returns one tenant's rows. All scans are tasks of one stage; a large
    tenant is split by what its own scan is split by (files, range partitions), so
    tenants need not be of one size.
    """
    if not tenants:
        raise ValueError("no tenants to scan")
    return _united([read(t).withColumn("org_code", F.lit(t.org_code)) for t in tenants])


def scan_tenant_databases(
    spark: SparkSession,
    registry: SourceRegistry,
    tenants: Sequence[TenantRef],
    template: str,
    params: Mapping | None = None,
    tag: str | None = None,
    partitions: Callable[[TenantRef], jdbc.RangePartitions | Splits | None] = lambda tenant: None,
) -> DataFrame:
    """:func:`scan_tenants` over JDBC, with ranges or splits for the tenants that need them.

    A query that names its database by ``${dw_name}`` is the same wherever on a server it
    runs, so the other tenants of a server are read by one query for
    ``TENANTS_PER_QUERY`` of them, with a task for each. Spark asks for the columns of
    each query once, of ``CONNECTIONS`` queries at a time.
    """
    if not tenants:
        raise ValueError("no tenants to scan")
    names_database = "dw_name" in Template(template).get_identifiers()
    reads: list[Callable[[], DataFrame]] = []
    by_server: dict[tuple, list[tuple[TenantRef, dict]]] = {}
    for tenant in tenants:
        settings = registry.settings_for(tenant, tag)
        split = partitions(tenant)
        if names_database and split is None:
            server = tuple(sorted((k, str(v)) for k, v in settings.items() if k != "database"))
            by_server.setdefault(server, []).append((tenant, settings))
        else:
            reads.append(partial(_read_tenant, spark, settings, tenant, template, params, split))
    for group in by_server.values():
        for at in range(0, len(group), TENANTS_PER_QUERY):
            reads.append(partial(_read_server, spark, group[at : at + TENANTS_PER_QUERY], template, params))
    with ThreadPoolExecutor(CONNECTIONS) as pool:
        return _united(list(pool.map(lambda read: read(), reads)))


def _read_tenant(
    spark: SparkSession,
    settings: Mapping,
    tenant: TenantRef,
    template: str,
    params: Mapping | None,
    split: jdbc.RangePartitions | Splits | None,
) -> DataFrame:
    dialect = settings.get("database_type")
    query = render_remote(template, tenant, params, dialect)
    connection = jdbc.connection_options(settings)
    if isinstance(split, Splits):
        found = read_split(spark, connection, query, split, dialect)
    else:
        found = jdbc.read(spark, jdbc.read_options(connection, query=query, partitions=split))
    return found.withColumn("org_code", F.lit(tenant.org_code))


def _read_server(
    spark: SparkSession,
    group: Sequence[tuple[TenantRef, Mapping]],
    template: str,
    params: Mapping | None,
) -> DataFrame:
    """The rows of tenants on one server, by a remote union with a number for each tenant."""
    settings = group[0][1]
    dialect = settings.get("database_type")
    texts = [
        f"SELECT q{k}.*, {k} AS tenant_number FROM ({render_remote(template, t, params, dialect)}) q{k}"
        for k, (t, _) in enumerate(group)
    ]
    conditions = [f"tenant_number = {k}" for k in range(len(group))]
    connection = jdbc.connection_options(settings)
    found = jdbc.read_parts(spark, connection, " UNION ALL ".join(texts), conditions)
    codes = F.array(*[F.lit(t.org_code) for t, _ in group])
    return found.withColumn("org_code", F.get(codes, F.col("tenant_number").cast("int"))).drop("tenant_number")
