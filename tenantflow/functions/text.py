"""Text expressions that carry the source databases' rules into Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def non_blank(text: Column) -> Column:
    """True for text other than spaces.

    The source collation pads with spaces, so blanks equal the empty text there.
    """
    return F.trim(text) != ""


def first_phone(*candidates: Column, length: int = 11) -> Column:
    """The first candidate with the length of a phone number, else null."""
    return F.coalesce(*[F.when(F.length(c) == length, c) for c in candidates])


def value_or(text: Column, fallback: Column) -> Column:
    """``text``, or ``fallback`` where it is null or empty (one thing in Oracle)."""
    return F.coalesce(F.nullif(text, F.lit("")), fallback)


def card_state(status: Column) -> Column:
    """``'0'`` for a card with status ``'1'``, ``'1'`` for all others and null."""
    return F.when(status == "1", "0").otherwise("1")


def default_warehouse(org_code: Column) -> Column:
    return F.concat(org_code, F.lit("DW"))


def canonical_hash(entries: Column) -> Column:
    """Hash of a map that does not depend on the order of its entries."""
    return F.sha2(F.to_json(F.array_sort(F.map_entries(entries))), 256)


def collated(df: DataFrame, *columns: str, collation: str = "UTF8_LCASE") -> DataFrame:
    """``df`` with text columns that compare as the source database does, such as without case."""
    return df.withColumns({c: F.collate(F.col(c), collation) for c in columns})


def plain_text(df: DataFrame, *columns: str) -> DataFrame:
    """The columns as texts that compare by their bytes again; spellings stay."""
    return collated(df, *columns, collation="UTF8_BINARY")
