"""One scan over the data of many tenants, by Spark's interface for sources in Python.

The rows of a tenant come from a function of the caller, which may ask a database, a service
or files. The plan has one scan whatever the number of tenants, with a task for each; filters
on the tenant choose tasks, other simple comparisons are handed to the function.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import datasource as ds
from pyspark.sql import types as T

from tenantflow.model import TenantRef

#: A comparison that the source may apply: (column, operator, value).
Comparison = tuple[str, str, object]

#: Batches of a tenant's rows, without ``org_code``. All comparisons hold for the rows that
#: are wanted; they are checked again, so the function may ignore them.
Fetch = Callable[[str, str, Sequence[Comparison]], Iterable[pa.RecordBatch]]


def scan_fetched(
    spark: SparkSession, tenants: Sequence[TenantRef], fetch: Fetch, schema: T.StructType, name: str = "tenants"
) -> DataFrame:
    """The rows of every tenant, tagged by ``org_code``.

    ``fetch`` and what it uses must be known to the executors; ``schema`` is that of its rows.
    """
    if not tenants:
        raise ValueError("no tenants to scan")
    # Plain values and local classes travel to the executors with the plan.
    refs = [(t.org_code, t.dw_name) for t in tenants]
    full = T.StructType([*schema.fields, T.StructField("org_code", T.StringType())])
    operators = {
        ds.EqualTo: "=", ds.GreaterThan: ">", ds.GreaterThanOrEqual: ">=", ds.LessThan: "<", ds.LessThanOrEqual: "<=",
    }

    class TenantPartition(ds.InputPartition):
        def __init__(self, org_code: str, dw_name: str) -> None:
            super().__init__(org_code)
            self.org_code, self.dw_name = org_code, dw_name

    class TenantReader(ds.DataSourceReader):
        def __init__(self) -> None:
            self.wanted: set[str] | None = None
            self.comparisons: list[Comparison] = []

        def pushFilters(self, filters: list[ds.Filter]) -> Iterable[ds.Filter]:  # noqa: N802
            for f in filters:
                column = ".".join(getattr(f, "attribute", ()))
                values = {f.value} if isinstance(f, ds.EqualTo) else set(f.value) if isinstance(f, ds.In) else None
                if column == "org_code" and values is not None:
                    self.wanted = values if self.wanted is None else self.wanted & values
                elif type(f) in operators and column != "org_code":
                    self.comparisons.append((column, operators[type(f)], f.value))
                yield f

        def partitions(self) -> list[ds.InputPartition]:
            return [TenantPartition(*ref) for ref in refs if self.wanted is None or ref[0] in self.wanted]

        def read(self, partition: ds.InputPartition) -> Iterable[pa.RecordBatch]:
            for batch in fetch(partition.org_code, partition.dw_name, self.comparisons):
                code = pa.array([partition.org_code] * batch.num_rows, pa.string())
                yield pa.RecordBatch.from_arrays([*batch.columns, code], names=[*batch.schema.names, "org_code"])

    class TenantSource(ds.DataSource):
        @classmethod
        def name(cls) -> str:
            return name

        def schema(self) -> T.StructType:
            return full

        def reader(self, schema: T.StructType) -> ds.DataSourceReader:
            return TenantReader()

    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(TenantSource)
    return spark.read.format(name).load()
