"""Frames cached until a block ends, and dimensions cached for one day."""

from __future__ import annotations

from collections.abc import Callable, Mapping
from contextlib import ExitStack

from pyspark.sql import DataFrame


def cached_until(end: ExitStack, df: DataFrame) -> DataFrame:
    """``df`` cached until ``end`` closes, with whatever else was given to it."""
    end.callback(df.unpersist)
    return df.persist()


class DimensionsOfDay:
    """Dimensions of tenants on one day, read when first asked for.

    ``readers`` has for each name a function ``(day_key, org_code) -> DataFrame``. Asking
    for another day releases the frames of the day before.
    """

    def __init__(self, readers: Mapping[str, Callable[[int, str], DataFrame]]) -> None:
        self._readers = dict(readers)
        self._day: int | None = None
        self._of_day = ExitStack()
        self._frames: dict[tuple[str, str], DataFrame] = {}

    def get(self, name: str, org_code: str, day_key: int) -> DataFrame:
        read = self._readers[name]
        if day_key != self._day:
            self.release()
            self._day = day_key
        wanted = name, org_code
        if wanted not in self._frames:
            self._frames[wanted] = cached_until(self._of_day, read(day_key, org_code))
        return self._frames[wanted]

    def release(self) -> None:
        self._of_day.close()
        self._frames = {}
