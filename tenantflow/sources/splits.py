"""Parts of about equal size of a remote table whose ids are unevenly spread.

Equal ranges between the least and the highest id leave most rows to few tasks where ids come
in runs. Here the bounds are quantiles of a sample, such as an earlier copy of the column.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantflow.sources import jdbc
from tenantflow.sources.literals import literal


@dataclass(frozen=True)
class Splits:
    """Points, in rising order, that cut a column into parts."""

    column: str
    points: tuple[int | float | dt.date, ...]

    def conditions(self, dialect: str | None = None) -> list[str]:
        """One condition a part. They exclude each other; nulls belong to the first part."""
        column = jdbc.identifier(self.column)
        bounds = [literal(p, dialect) for p in self.points]
        if not bounds:
            return ["1=1"]
        between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(bounds, bounds[1:], strict=False)]
        return [f"{column} < {bounds[0]} OR {column} IS NULL", *between, f"{column} >= {bounds[-1]}"]


def equal_parts(sample: DataFrame, column: str, count: int, accuracy: int = 100_000) -> Splits:
    """Splits of ``column`` into ``count`` parts with about as many rows of the sample each.

    One value is never split, so a value that fills several parts makes fewer of them.
    ``accuracy`` bounds the error of a point to the rows of the sample divided by it.
    """
    shares = [k / count for k in range(1, count)]
    if not shares:
        return Splits(column, ())
    found = sample.agg(F.percentile_approx(column, shares, accuracy)).first()[0]
    return Splits(column, tuple(sorted(set(found or []))))


def read_split(
    spark: SparkSession, connection: Mapping[str, str], query: str, splits: Splits, dialect: str | None = None
) -> DataFrame:
    """A query as one read with a task for each part."""
    return jdbc.read_parts(spark, connection, query, splits.conditions(dialect))
