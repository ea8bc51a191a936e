"""Binding of extract output to target columns."""

from __future__ import annotations

import warnings
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame


def bind(df: DataFrame, target_columns: Sequence[str], by: str = "position") -> DataFrame:
    """Give the columns of ``df`` the names and the order of the target.

    By position, the n-th column gets the n-th name. A name that occurs on both
    sides at different places is reported, since that binding swaps data.
    """
    target_columns = list(target_columns)
    if by == "name":
        missing = [c for c in target_columns if c not in df.columns]
        if missing:
            raise ValueError(f"extract lacks the target columns {missing}")
        return df.select(*target_columns)
    if by != "position":
        raise ValueError(f"unknown binding {by!r}")
    if len(df.columns) != len(target_columns):
        raise ValueError(
            f"extract has {len(df.columns)} columns, target has {len(target_columns)}"
        )
    moved = [
        c for c, t in zip(df.columns, target_columns, strict=True) if c != t and c in target_columns
    ]
    if moved:
        warnings.warn(f"bound by position under another name: {moved}", stacklevel=2)
    return df.toDF(*target_columns)


def union_statements(
    frames: Sequence[DataFrame], target_columns: Sequence[str], by: str = "position"
) -> DataFrame:
    """One frame from the statements of a job, in their order, duplicates kept."""
    return reduce(DataFrame.unionAll, [bind(f, target_columns, by) for f in frames])
