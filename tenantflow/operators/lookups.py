"""Joins of a large frame with a frame that holds one row per key.

Every join of this engine that shuffles has this form, so the two scale questions
are answered once, here: may the key side be broadcast, and what happens to a key
that holds a large part of all rows. Both questions cost a small job each and are asked only
where the large side reads enough for the answer to matter; any other join is left to Spark,
which broadcasts by its own estimate and splits skewed partitions as it runs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: A left side that reads no more is shuffled in less time than the questions take.
SMALL_BYTES = 64 * 1024 * 1024

#: A side is broadcast only when it was measured to be within both limits.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 * 1024 * 1024

#: A key with more than this share of the rows, and more than this many, is dealt to
#: several tasks. At most ``1 / HOT_SHARE`` keys can be that frequent.
HOT_SHARE = 0.01
HOT_ROWS = 1_000_000

#: Parts to which the rows of a hot key are dealt.
SALTS = 64

_SALT = "lookup_join_salt"
_SKETCH_ITEMS = 8192
_FIXED_WIDTH = (T.NumericType, T.BooleanType, T.DatetimeType, T.AnyTimeType)


def _holds_map(kind: T.DataType) -> bool:
    """Whether values of a type cannot be hashed."""
    if isinstance(kind, T.ArrayType):
        return _holds_map(kind.elementType)
    if isinstance(kind, T.StructType):
        return any(_holds_map(f.dataType) for f in kind)
    return isinstance(kind, T.MapType | T.VariantType)


def reads_little(df: DataFrame) -> bool:
    """Whether the sources of ``df`` hold at most ``SMALL_BYTES``, by the sizes of their files.

    Sources whose size Spark does not know, such as databases, hold more.
    """
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    total = sum(int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size()))
    return total <= SMALL_BYTES


def payload(df: DataFrame) -> tuple[int, int]:
    """Rows and data bytes of ``df``, measured in one aggregation."""
    fixed = [f.name for f in df.schema if isinstance(f.dataType, _FIXED_WIDTH)]
    text = [f.name for f in df.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    nested = [c for c in df.columns if c not in fixed and c not in text]
    lengths = [F.octet_length(c) for c in text]
    lengths += [F.octet_length(F.to_json(F.struct(c))) for c in nested]
    row_bytes = F.lit(8 * len(df.columns))
    for length in lengths:
        row_bytes = row_bytes + F.coalesce(length, F.lit(0))
    [(rows, size)] = df.agg(F.count(F.lit(1)), F.sum(row_bytes.cast("long"))).collect()
    return rows, size or 0


def fits_broadcast(
    df: DataFrame, sized_by: DataFrame | None = None, max_rows: int | None = None
) -> bool:
    """Whether ``df`` was measured to be small enough to broadcast.

    ``sized_by`` is a frame with at least as many rows that is cheaper to count,
    such as the plain scan ``df`` is derived from. When it is within the limit the
    frame itself is measured, so it never decides in favour alone.
    """
    max_rows = BROADCAST_ROWS if max_rows is None else max_rows
    if sized_by is not None and sized_by.count() > max_rows:
        return False
    rows, size = payload(df)
    return rows <= max_rows and size <= BROADCAST_BYTES


def key_hash(df: DataFrame, keys: Sequence[str]) -> Column | None:
    """A hash that is equal for equal keys, under their collations; ``None`` where there is none.

    Spark hashes the bytes of a text, which differ for texts that only a collation calls equal.
    """
    parts = []
    for key in keys:
        kind = df.schema[key].dataType
        if isinstance(kind, T.StringType) and kind.collation not in ("UTF8_BINARY", "UTF8_LCASE"):
            return None
        lower = isinstance(kind, T.StringType) and kind.collation == "UTF8_LCASE"
        parts.append(F.lower(key) if lower else F.col(key))
    return F.xxhash64(*parts)


def hot_key_hashes(df: DataFrame, keys: Sequence[str], share: float | None = None) -> list[int]:
    """Hashes of the keys that hold more than ``share`` of the rows and ``HOT_ROWS`` rows.

    One pass over the key columns feeds a frequent-items sketch of fixed size, so
    nothing is shuffled per key. Which keys are found changes the plan only, never
    a result.
    """
    share = HOT_SHARE if share is None else share
    most = int(1 / share) + 1
    top = F.expr(f"approx_top_k(key_hash, {most}, {max(_SKETCH_ITEMS, 8 * most)})")
    own = key_hash(df, keys)
    if own is None:
        return []
    hashed = df.select(own.alias("key_hash"))
    [(total, frequent)] = hashed.agg(F.count(F.lit(1)), top).collect()
    least = max(share * total, HOT_ROWS)
    return [item["item"] for item in frequent or [] if item["count"] > least]


def lookup_join(
    left: DataFrame,
    right: DataFrame,
    on: str | Sequence[str],
    how: str = "inner",
    sized_by: DataFrame | None = None,
    keys_from: DataFrame | None = None,
    fits: bool | None = None,
    max_broadcast_rows: int | None = None,
) -> DataFrame:
    """Join ``left`` with ``right``, which holds at most one row per key.

    Text keys match under their collation, which must be the same on both sides.
    ``how`` is ``inner``, ``left``, ``left_semi`` or ``left_anti``; for the last two
    ``right`` may repeat keys. The result has the columns of ``left`` and then the rest
    of ``right``. Where ``left`` reads little, Spark plans the join. Else a ``right`` of
    checked size is broadcast and ``left`` is not shuffled; beyond that both sides are
    shuffled on the key, and the rows of hot keys are dealt to ``SALTS`` parts by a hash of the whole row; the key rows they
    need are repeated in each part. ``left`` is read once for the join in either case.

    ``fits`` is the outcome of an earlier :func:`fits_broadcast` on a frame that bounds
    ``right``, and saves measuring again.

    Hot keys are looked for in ``left``, or in ``keys_from`` where ``left`` is costly
    and derived from a frame with much the same keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    for key in keys:
        if left.schema[key].dataType != right.schema[key].dataType:
            raise TypeError(f"{key} has different types on the two sides of the join")
    semi = how in ("left_semi", "left_anti")
    if semi:
        right = right.select(*keys)
    columns = [*left.columns, *[c for c in right.columns if c not in keys]]

    if fits is None:
        if reads_little(left):
            return left.join(right, keys, how).select(*columns)
        fits = fits_broadcast(right, sized_by, max_broadcast_rows)
    if fits:
        return left.join(F.broadcast(right), keys, how).select(*columns)

    if semi:
        right = right.distinct()
    hot = hot_key_hashes(left if keys_from is None else keys_from, keys)
    if not hot:
        return left.join(right, keys, how).select(*columns)
    is_hot = key_hash(left, keys).isin(hot)
    hashable = [f.name for f in left.schema if not _holds_map(f.dataType)]
    spread = F.when(is_hot, F.pmod(F.xxhash64(*hashable), F.lit(SALTS))).otherwise(0)
    every = F.when(is_hot, F.sequence(F.lit(0), F.lit(SALTS - 1))).otherwise(F.array(F.lit(0)))
    salted = left.withColumn(_SALT, spread.cast("int"))
    met = right.withColumn(_SALT, F.explode(every))
    return salted.join(met, [*keys, _SALT], how).select(*columns)
