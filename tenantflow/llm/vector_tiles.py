"""Whole-number vectors, and searches of a set of queries in all rows by tiles.

A search meets every query with every row of the same length. The rows are cut into blocks,
the queries into groups, and a tile is one group with one band of blocks. Both sides of a
tile are dealt to one task by its number, so that work is even whatever the data hold; a
task keeps one group and reads its blocks one after the other, in one shuffle and without a
join. Sizes of blocks, groups and bands are bounded; only their number grows.

A search takes two rounds. The first one gives each query a first threshold from one band,
the second one starts from there, so that tiles far from a query return nothing for it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import parallelism, record_batch
from tenantflow.session import staged

BLOCK_ROWS = 2048
GROUP_ROWS = 4096
#: Blocks of a band, so that a tile reads 131,072 rows at most.
BAND_BLOCKS = 64
_TILES_A_JOB = 50_000
#: Whole numbers up to here are exact in double precision.
EXACT = 1 << 53
_LONG = (1 << 63) - 1
#: Below every score.
NO_SCORE = -_LONG


def whole_vectors(embeddings: DataFrame, *columns: Column, scale: int = 256) -> DataFrame:
    """The given columns, dims and x = floor(scale * component) of usable vectors.

    Null vectors and vectors with null or non-finite components have no row. What leaves the
    range of long counts as its limit.
    """
    usable = F.forall("embedding", lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) < float("inf")))
    x = F.transform("embedding", lambda e: F.floor(e.cast("double") * scale))
    return embeddings.where(F.col("embedding").isNotNull() & usable).select(
        *columns, F.size("embedding").alias("dims"), x.alias("x")
    )


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """An Arrow array of lists of ``dims`` long values each, as rows."""
    return np.asarray(column.flatten()).astype(np.int64, copy=False).reshape(len(column), dims)


def _packed(x: np.ndarray) -> bytes:
    """The type of the numbers, one character, and the numbers in the smallest type that holds them."""
    for kind in ("h", "i"):
        if not x.size or np.abs(x).max() <= np.iinfo(kind).max and x.min() > np.iinfo("q").min:
            return kind.encode() + x.astype(kind).tobytes()
    return b"q" + x.tobytes()


def unpacked(raw: bytes, dims: int, rows: int) -> np.ndarray:
    return np.frombuffer(raw, chr(raw[0]), offset=1).reshape(rows, dims)


def longs(raw: bytes) -> np.ndarray:
    return np.frombuffer(raw, np.int64)


def inner_products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact: in doubles where no sum can leave their whole numbers, else in long, cut to its range."""
    most = [float(np.abs(m.astype(np.float64)).max()) if m.size else 0.0 for m in (a, b)]
    if most[0] * most[1] * max(a.shape[1], 1) < EXACT:
        return a.astype(np.float64) @ b.astype(np.float64).T
    return np.clip(a.astype(object) @ b.astype(object).T, NO_SCORE, _LONG).astype(np.int64)


def best_of(query: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the first ``k`` of each query, by falling score, then id."""
    order = np.lexsort((ids, -score, query))
    ordered = query[order]
    rank = np.arange(len(order)) - np.searchsorted(ordered, ordered, "left")
    return order[rank < k]


def kth_scores(n: int, query: np.ndarray, score: np.ndarray, k: int, least: np.ndarray) -> np.ndarray:
    """Per query the least of its ``k`` scores, where it has so many; ``least`` if that is more."""
    lowest = np.full(n, _LONG, np.int64)
    np.minimum.at(lowest, query, score)
    full = np.bincount(query, minlength=n) >= k
    return np.maximum(least, np.where(full, lowest, NO_SCORE))


@dataclass(frozen=True)
class Block:
    """Rows to search: identifiers, labels and vectors."""

    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    lists: np.ndarray | None


@dataclass(frozen=True)
class Group:
    """Queries: numbers, identifiers, labels, vectors, and the values that a search gave them."""

    number: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    x: np.ndarray
    given: list[list[list[int]] | None]


_ROW = T.StructType(
    [
        T.StructField("no", T.LongType()),
        T.StructField("dims", T.IntegerType()),
        T.StructField("n", T.IntegerType()),
        T.StructField("numbers", T.BinaryType()),
        T.StructField("ids", T.BinaryType()),
        T.StructField("labels", T.BinaryType()),
        T.StructField("x", T.BinaryType()),
        T.StructField("lists", T.BinaryType()),
        T.StructField("given", T.ArrayType(T.ArrayType(T.ArrayType(T.LongType())))),
    ]
)
_ROW_ARROW = to_arrow_schema(_ROW)


def blocks_of(vectors: DataFrame, n_rows: int, with_lists: bool = False, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Blocks of rows (id, label, dims, x), numbered without order; each of one length.

    ``with_lists`` adds, per dimension, the places of the rows by rising value.
    """

    def block(dims: int, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, no: int) -> pa.RecordBatch:
        lists = None
        if with_lists:
            lists = np.argsort(x, axis=0, kind="stable").T.astype(np.uint16 if len(x) < 1 << 16 else np.uint32).tobytes()
        values = (no, dims, len(ids), None, ids.tobytes(), labels.tobytes(), _packed(x), lists, None)
        return record_batch(_ROW_ARROW, [[value] for value in values])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple]] = {}  # one unfinished block; rows come sorted by length
        for batch in batches:
            lengths = np.asarray(batch.column(2))
            for dims in np.unique(lengths).tolist():
                chosen = batch.filter(pa.array(lengths == dims))
                part = tuple(np.asarray(chosen.column(c)).astype(np.int64) for c in (0, 1)) + (matrix(chosen.column(3), dims),)
                for other in [d for d in held if d != dims]:
                    yield block(other, *(np.concatenate(c) for c in zip(*held.pop(other), strict=True)), no)
                    no += 1
                parts = [*held.pop(dims, []), part]
                ids, labels, x = (np.concatenate(c) for c in zip(*parts, strict=True))
                for start in range(0, len(ids), block_rows):
                    piece = tuple(c[start : start + block_rows] for c in (ids, labels, x))
                    if len(piece[0]) == block_rows:
                        yield block(dims, *piece, no)
                        no += 1
                    else:
                        held[dims] = [piece]
        for dims, parts in held.items():
            yield block(dims, *(np.concatenate(c) for c in zip(*parts, strict=True)), no)
            no += 1

    n_parts = max(1, -(-n_rows // block_rows) // 16, min(parallelism(vectors.sparkSession), -(-n_rows // block_rows)))
    dealt = vectors.select("id", "label", "dims", "x").repartition(n_parts).sortWithinPartitions("dims")
    return dealt.mapInArrow(cut, _ROW)


def numbered_queries(queries: DataFrame, cluster: Column, group_rows: int = GROUP_ROWS) -> tuple[DataFrame, DataFrame, int]:
    """Queries with number and group; (dims, first, groups); the number of groups.

    Groups hold queries of one length and cluster, ``group_rows`` on the average. Lengths and
    clusters are few, their counts go to the driver.
    """
    spark = queries.sparkSession
    queries = staged(queries.withColumn("cluster", cluster).withColumn("number", F.monotonically_increasing_id()), "queries")
    firsts, by_dims, first = [], {}, 0
    for row in queries.groupBy("dims", "cluster").count().orderBy("dims", "cluster").collect():
        n = -(-row["count"] // group_rows)
        firsts.append((row.dims, row.cluster, first, n))
        by_dims[row.dims] = (by_dims.get(row.dims, (first, 0))[0], first + n)
        first += n
    parts = spark.createDataFrame(firsts, "dims int, cluster int, first long, n long")
    group = F.col("first") + F.pmod(F.xxhash64("number"), F.col("n"))
    dealt = queries.join(F.broadcast(parts), ["dims", "cluster"]).withColumn("group", group).drop("first", "n", "cluster")
    ranges = [(dims, start, end) for dims, (start, end) in by_dims.items()]
    return dealt, spark.createDataFrame(ranges, "dims int, first long, end long"), first


def groups_of(queries: DataFrame) -> DataFrame:
    """One row for each group of (number, id, label, dims, x, group, given)."""

    def pack(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        dims = table.column("dims")[0].as_py()
        flat = [np.asarray(table.column(c).combine_chunks()).astype(np.int64) for c in ("number", "id", "label")]
        x = matrix(table.column("x").combine_chunks(), dims)
        values = (
            table.column("group")[0].as_py(), dims, len(x), *(c.tobytes() for c in flat), _packed(x), None,
            table.column("given").to_pylist(),
        )
        return pa.Table.from_batches([record_batch(_ROW_ARROW, [[value] for value in values])])

    columns = queries.select("number", "id", "label", "dims", "x", "group", "given")
    return columns.groupBy("group").applyInArrow(pack, _ROW)


@dataclass(frozen=True)
class Tiles:
    """The tiles of some blocks and groups."""

    blocks: DataFrame
    ranges: DataFrame
    n_groups: int
    bands: int

    @classmethod
    def of(cls, blocks: DataFrame, ranges: DataFrame, n_groups: int) -> Tiles:
        blocks = staged(blocks, "vector-blocks")
        n_blocks = blocks.count()
        wanted = -(-parallelism(blocks.sparkSession) // max(n_groups, 1))
        return cls(blocks, ranges, n_groups, max(1, -(-n_blocks // BAND_BLOCKS), min(n_blocks, 2 * wanted)))

    def search(self, groups: DataFrame, work: Callable[[Group], object], schema: T.StructType, first: bool) -> DataFrame:
        """Rows of ``work(group).finish()`` after ``.read(block)`` for each block of a tile.

        ``first`` chooses one tile of each group, else the others.
        """
        arrow = to_arrow_schema(schema)
        bands = F.lit(self.bands).cast("long")
        own = F.col("group") % bands
        band = F.pmod(F.xxhash64("no"), bands)
        of_group = groups.withColumn("group", F.col("no")).withColumn("band", F.explode(F.sequence(F.lit(0).cast("long"), bands - 1)))
        of_block = (
            self.blocks.join(F.broadcast(self.ranges), "dims")
            .withColumn("group", F.explode(F.sequence(F.col("first"), F.col("end") - 1)))
            .withColumn("band", band)
        )
        tile = F.col("group") * bands + F.col("band")

        def side(df: DataFrame, kind: int) -> DataFrame:
            chosen = df.where((F.col("band") == own) if first else (F.col("band") != own))
            return chosen.select(tile.alias("tile"), F.lit(kind).alias("kind"), *_ROW.names)

        n_tiles = max(1, self.n_groups * self.bands)
        n_tasks = min(n_tiles, _TILES_A_JOB)
        dealt = (
            side(of_group, 0).union(side(of_block, 1))
            .repartitionById(n_tasks, (F.col("tile") % n_tasks).cast("int"))
            .sortWithinPartitions("tile", "kind", "no")
        )

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            tile_now, state = None, None
            for batch in batches:
                for k in range(batch.num_rows):
                    row = {name: batch.column(c)[k] for c, name in enumerate(batch.schema.names)}
                    if row["tile"].as_py() != tile_now:
                        if state is not None:
                            yield record_batch(arrow, state.finish())
                        tile_now, state = row["tile"].as_py(), None
                    dims, n = row["dims"].as_py(), row["n"].as_py()
                    ids, labels = longs(row["ids"].as_py()), longs(row["labels"].as_py())
                    x = unpacked(row["x"].as_py(), dims, n)
                    if row["kind"].as_py() == 0:
                        state = work(Group(longs(row["numbers"].as_py()), ids, labels, x, row["given"].as_py()))
                    elif state is not None:
                        lists = row["lists"].as_py()
                        if lists is not None:
                            lists = np.frombuffer(lists, np.uint16 if n < 1 << 16 else np.uint32).reshape(dims, n)
                        state.read(Block(ids, labels, x, lists))
            if state is not None:
                yield record_batch(arrow, state.finish())

        return dealt.mapInArrow(run, schema)
