"""Near-duplicate vectors by an epsilon grid order join.

Vectors of length one with a cosine of at least ``c`` are at most ``sqrt(2 - 2c)`` apart
(epsilon). Projections on orthonormal directions do not increase distances, so two sets of
vectors whose boxes on the leading principal directions are further apart have no link.

1. Valid vectors are brought to length one; equal ones are one node with a weight.
2. The principal directions come from a bounded sample (``sample_rows``); they decide how
   much is skipped, not what is found.
3. Nodes are sorted by their grid cells on these directions, in lexicographic order, by
   one range shuffle, and cut into blocks of ``block_rows`` (by default 8 MiB of vectors),
   each with its box. Blocks go on across the ends of partitions, so their number follows
   from the rows alone.
4. The sequence is joined with itself recursively: pairs of intervals whose boxes are more
   than epsilon apart are dropped, the others are cut into ``FAN_OUT`` parts each, down to
   pairs of blocks. Boxes meet in equi-joins on the interval; each level is a small table.
5. A pair of blocks is one unit of work of bounded size, in which the recursion goes on by
   halves. Cosines are computed in double precision. Links are added up and folded into a
   spanning forest as they are found, so a unit's memory does not depend on their number;
   what leaves it is a number of links per node and the forest.

All links are found; none is below ``c``. Vectors of different lengths have no cosine and
are joined separately.

Rows: one for each row of ``embeddings``. A vector that is null, empty or zero, or has null
or non-finite components, is linked with nothing. Rows with equal or null ids count as
vectors of their own. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.components import connected_components
from tenantflow.llm.inputs import parallelism, record_batch
from tenantflow.session import staged

FAN_OUT = 8
_LEAF_ROWS = 256
_SAMPLE_BYTES = 32 << 20
BLOCK_BYTES = 8 << 20
#: More than the rounding errors of box distances.
_SLACK = 1e-9


def _normalise(embeddings: DataFrame) -> DataFrame:
    """vec_id, and of valid vectors: length of the vector, digest and values (doubles)."""
    schema = T.StructType(
        [
            T.StructField("vec_id", embeddings.schema["vec_id"].dataType),
            T.StructField("dims", T.IntegerType()),
            T.StructField("digest", T.BinaryType()),
            T.StructField("vector", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def unit(values: list | None) -> np.ndarray | None:
        if not values or None in values:
            return None
        vector = np.array(values, dtype=np.float64)
        if not np.isfinite(vector).all() or not vector.any():
            return None
        vector = vector / np.abs(vector).max()  # so that no square over- or underflows
        return vector / np.sqrt(vector @ vector)

    def normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = [unit(values) for values in batch.column(1).to_pylist()]
            raw = [None if v is None else (v + 0.0).tobytes() for v in vectors]
            yield record_batch(
                arrow,
                [
                    batch.column(0),
                    [None if v is None else len(v) for v in vectors],
                    [None if r is None else hashlib.blake2b(r, digest_size=16).digest() for r in raw],
                    raw,
                ],
            )

    return embeddings.select("vec_id", "embedding").mapInArrow(normalise, schema)


def _matrix(raw: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(raw), np.float64).reshape(len(raw), -1)


def _principal_directions(nodes: DataFrame, dims: int, n: int, wanted: int, sample_rows: int) -> np.ndarray:
    """``wanted`` orthonormal columns, from about ``sample_rows`` vectors (32 MiB at most)."""
    sample_rows = min(sample_rows, _SAMPLE_BYTES // (8 * dims))
    scale = 1 << 20
    bound = max(1, scale * sample_rows // max(n, 1))
    sample = nodes.where(F.pmod(F.xxhash64("node"), F.lit(scale)) < bound).select("vector").toArrow()
    values = _matrix(sample["vector"].to_pylist()) if sample.num_rows else np.zeros((0, dims))
    if len(values) < 2:
        return np.eye(dims)[:, :wanted]
    _, directions = np.linalg.eigh(np.cov(values.T).reshape(dims, dims))
    return np.ascontiguousarray(directions[:, ::-1][:, :wanted])


_BLOCK = T.StructType(
    [
        T.StructField("block", T.LongType()),
        T.StructField("low", T.ArrayType(T.DoubleType())),
        T.StructField("high", T.ArrayType(T.DoubleType())),
        T.StructField("nodes", T.BinaryType()),
        T.StructField("weights", T.BinaryType()),
        T.StructField("vectors", T.BinaryType()),
    ]
)


def _runs(nodes: DataFrame, n: int, directions: np.ndarray, cell: float, block_rows: int) -> DataFrame:
    """The nodes in epsilon grid order, as runs of ``block_rows``; the last of a task is shorter."""
    with_cells = T.StructType(nodes.schema.fields + [T.StructField("cells", T.ArrayType(T.IntegerType()))])
    cells_arrow = to_arrow_schema(with_cells)
    schema = T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("in_part", T.LongType()),
            T.StructField("rows", T.LongType()),
            *_BLOCK.fields[3:],
        ]
    )
    arrow = to_arrow_schema(schema)

    def add_cells(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cells = np.floor(_matrix(batch.column(2).to_pylist()) @ directions / cell).astype(np.int32)
                yield record_batch(cells_arrow, [*batch.columns, cells.tolist()])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, number = TaskContext.get().partitionId(), 0
        rows: list[tuple] = []

        def run(chosen: list[tuple]) -> pa.RecordBatch:
            ints = [np.array([r[k] for r in chosen], np.int64).tobytes() for k in (0, 1)]
            row = (part, number, len(chosen), *ints, b"".join(r[2] for r in chosen))
            return record_batch(arrow, [[value] for value in row])

        for batch in batches:
            rows += zip(*(batch.column(k).to_pylist() for k in range(3)))
            while len(rows) >= block_rows:
                yield run(rows[:block_rows])
                rows, number = rows[block_rows:], number + 1
        if rows:
            yield run(rows)

    n_parts = max(1, min(parallelism(nodes.sparkSession), -(-n // block_rows)))
    ordered = nodes.mapInArrow(add_cells, with_cells)
    ordered = ordered.repartitionByRange(n_parts, "cells", "node").sortWithinPartitions("cells", "node")
    return staged(ordered.mapInArrow(cut, schema), "vector-runs")


def _blocks(nodes: DataFrame, n: int, directions: np.ndarray, cell: float, block_rows: int) -> DataFrame:
    """Blocks of nodes in epsilon grid order, numbered in that order."""
    spark = nodes.sparkSession
    runs = _runs(nodes, n, directions, cell, block_rows)
    counts = runs.groupBy("part").agg(F.sum("rows").alias("rows")).orderBy("part").collect()  # a row for each task
    firsts, first = [], 0
    for row in counts:
        firsts.append((row.part, first))
        first += row["rows"]
    parts = spark.createDataFrame(firsts, "part long, first long")
    start = F.col("first") + F.col("in_part") * block_rows
    placed = runs.join(F.broadcast(parts), "part").withColumn("start", start)
    size = F.lit(block_rows)
    of_run = F.sequence(F.floor(F.col("start") / size), F.floor((F.col("start") + F.col("rows") - 1) / size))
    begin = F.greatest(F.lit(0), F.col("block") * size - F.col("start"))
    end = F.least("rows", (F.col("block") + 1) * size - F.col("start"))

    def part_of(column: str, width: int) -> Column:
        return F.substring(column, (begin * width + 1).cast("int"), ((end - begin) * width).cast("int")).alias(column)

    pieces = placed.withColumn("block", F.explode(of_run)).select(
        "block", "start", part_of("nodes", 8), part_of("weights", 8), part_of("vectors", 8 * len(directions))
    )
    arrow = to_arrow_schema(_BLOCK)

    def unite(table: pa.Table) -> pa.Table:
        table = table.sort_by("start")
        raw = [b"".join(table[c].to_pylist()) for c in ("nodes", "weights", "vectors")]
        places = np.frombuffer(raw[2], np.float64).reshape(-1, len(directions)) @ directions
        box = (places.min(axis=0).tolist(), places.max(axis=0).tolist())
        row = (table["block"][0].as_py(), *box, *raw)
        return pa.Table.from_batches([record_batch(arrow, [[value] for value in row])])

    return staged(pieces.groupBy("block").applyInArrow(unite, _BLOCK), "vector-blocks")


def _distance(a: str, b: str) -> Column:
    """The squared distance of two boxes."""
    gap = F.expr(f"zip_with({a}_low, {b}_high, (x, y) -> greatest(x - y, 0D))")
    other = F.expr(f"zip_with({b}_low, {a}_high, (x, y) -> greatest(x - y, 0D))")
    gaps = F.zip_with(gap, other, lambda x, y: x + y)  # one of the two is zero
    return F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x * x)


def _block_pairs(blocks: DataFrame, n_blocks: int, epsilon: float) -> DataFrame:
    """(a, b) of all pairs of blocks, a <= b, that are not provably distant."""
    spark = blocks.sparkSession
    dims = F.size("low")
    boxes = [staged(blocks.select(F.col("block").alias("part"), "low", "high"), "boxes")]
    while n_blocks > 1:
        n_blocks = -(-n_blocks // FAN_OUT)
        merged = (
            boxes[-1]
            .select(F.floor(F.col("part") / FAN_OUT).alias("part"), dims.alias("dims"), F.posexplode(F.arrays_zip("low", "high")))
            .groupBy("part", "pos")
            .agg(F.min("col.low").alias("low"), F.max("col.high").alias("high"))
            .groupBy("part")
            .agg(F.array_sort(F.collect_list(F.struct("pos", "low", "high"))).alias("sides"))
        )
        boxes.append(staged(merged.select("part", F.col("sides.low").alias("low"), F.col("sides.high").alias("high")), "boxes"))
    pairs = spark.range(1).select(F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
    for level in reversed(boxes[:-1]):
        parent = F.floor(F.col("part") / FAN_OUT)
        of_a = level.select(parent.alias("a"), F.col("part").alias("a_part"), F.col("low").alias("a_low"), F.col("high").alias("a_high"))
        of_b = level.select(parent.alias("b"), F.col("part").alias("b_part"), F.col("low").alias("b_low"), F.col("high").alias("b_high"))
        pairs = staged(
            pairs.join(of_a, "a")
            .join(of_b, "b")
            .where((F.col("a_part") <= F.col("b_part")) & (_distance("a", "b") <= epsilon**2 + _SLACK))
            .select(F.col("a_part").alias("a"), F.col("b_part").alias("b")),
            "interval-pairs",
        )
    return pairs


_FOUND = T.StructType(
    [
        T.StructField("node", T.LongType()),
        T.StructField("links", T.LongType()),
        T.StructField("root", T.LongType()),
    ]
)


class _Forest:
    """A spanning forest over places that are numbered from 0; roots are the smallest."""

    def __init__(self, n: int) -> None:
        self.parent = np.arange(n)

    def roots(self, places: np.ndarray) -> np.ndarray:
        while True:
            above = self.parent[places]
            if (above == places).all():
                return places
            places = above

    def link(self, i: np.ndarray, j: np.ndarray) -> None:
        while True:
            root_i, root_j = self.roots(i), self.roots(j)
            self.parent[i], self.parent[j] = root_i, root_j
            apart = root_i != root_j
            if not apart.any():
                return
            i, j = root_i[apart], root_j[apart]
            np.minimum.at(self.parent, np.maximum(i, j), np.minimum(i, j))


def _links_of_blocks(
    a: np.ndarray,
    b: np.ndarray,
    weights: tuple[np.ndarray, np.ndarray],
    same: bool,
    cosine: float,
    directions: np.ndarray,
    epsilon: float,
) -> tuple[np.ndarray, np.ndarray]:
    """For all places of ``a``, then of ``b`` if another: number of links, and root."""
    place_a, place_b = a @ directions, b @ directions
    shift = 0 if same else len(a)
    links = np.zeros(len(a) if same else len(a) + len(b), np.int64)
    forest = _Forest(len(links))

    def join(a0: int, a1: int, b0: int, b1: int) -> None:
        if same and b1 <= a0:
            return
        gap = np.maximum(
            place_a[a0:a1].min(axis=0) - place_b[b0:b1].max(axis=0),
            place_b[b0:b1].min(axis=0) - place_a[a0:a1].max(axis=0),
        )
        if (np.maximum(gap, 0) ** 2).sum() > epsilon**2 + _SLACK:
            return
        if max(a1 - a0, b1 - b0) <= _LEAF_ROWS:
            near = a[a0:a1] @ b[b0:b1].T >= cosine
            if same and a1 > b0:  # each link once
                near &= np.arange(a0, a1)[:, None] < np.arange(b0, b1)
            i, j = np.nonzero(near)
            if len(i):
                links[a0:a1] += near @ weights[1][b0:b1]
                links[b0 + shift : b1 + shift] += weights[0][a0:a1] @ near
                forest.link(i + a0, j + b0 + shift)
            return
        a_mid = (a0 + a1) // 2 if a1 - a0 > _LEAF_ROWS else a1
        b_mid = (b0 + b1) // 2 if b1 - b0 > _LEAF_ROWS else b1
        for x0, x1 in ((a0, a_mid), (a_mid, a1)):
            for y0, y1 in ((b0, b_mid), (b_mid, b1)):
                if x0 < x1 and y0 < y1:
                    join(x0, x1, y0, y1)

    join(0, len(a), 0, len(b))
    return links, forest.roots(np.arange(len(links)))


def _join_blocks(
    blocks: DataFrame, pairs: DataFrame, directions: np.ndarray, cosine: float, epsilon: float
) -> DataFrame:
    """Per pair of blocks and node with links: their number, and a node of its component."""
    arrow = to_arrow_schema(_FOUND)

    def join(table: pa.Table) -> pa.Table:
        table = table.sort_by("block")  # one row where a block meets itself
        columns = (("nodes", np.int64), ("weights", np.int64), ("vectors", np.float64))
        sides = [
            [np.frombuffer(table[c][k].as_buffer(), kind) for c, kind in columns] for k in (0, table.num_rows - 1)
        ]
        (nodes_a, weights_a, a), (nodes_b, weights_b, b) = sides
        same = table.num_rows == 1
        a, b = a.reshape(len(nodes_a), -1), b.reshape(len(nodes_b), -1)
        links, roots = _links_of_blocks(a, b, (weights_a, weights_b), same, cosine, directions, epsilon)
        nodes = nodes_a if same else np.concatenate([nodes_a, nodes_b])
        chosen = np.flatnonzero(links)
        return pa.Table.from_batches([record_batch(arrow, [nodes[chosen], links[chosen], nodes[roots[chosen]]])])

    n_tasks = max(1, min(parallelism(blocks.sparkSession), pairs.count()))
    number = F.expr("b * (b + 1) div 2 + a")  # no two pairs have the same
    task = F.pmod(number, F.lit(n_tasks)).cast("int").alias("task")
    ends = pairs.select("a", "b", task, F.explode(F.array_distinct(F.array("a", "b"))).alias("block"))
    dealt = ends.join(blocks.drop("low", "high"), "block").repartitionById(n_tasks, F.col("task"))
    return dealt.groupBy("task", "a", "b").applyInArrow(join, _FOUND)


def similar_vectors(
    embeddings: DataFrame,
    cosine: float = 0.95,
    grid_dims: int = 8,
    block_rows: int | None = None,
    sample_rows: int = 20_000,
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept."""
    epsilon = float(np.sqrt(2 - 2 * cosine))
    vectors = staged(_normalise(embeddings), "unit-vectors")
    nodes = vectors.where("digest is not null").groupBy("dims", "digest").agg(
        F.first("vector").alias("vector"), F.count("*").alias("weight"), F.min("vec_id").alias("first")
    )
    nodes = staged(nodes.withColumn("node", F.monotonically_increasing_id()), "vector-nodes")
    found = embeddings.sparkSession.createDataFrame([], _FOUND)
    for row in nodes.groupBy("dims").count().orderBy("dims").collect():  # one for each length in use
        own = nodes.where(F.col("dims") == row.dims).select("node", "weight", "vector")
        directions = _principal_directions(own, row.dims, row["count"], min(grid_dims, row.dims), sample_rows)
        size = block_rows or max(1, BLOCK_BYTES // (8 * row.dims))
        blocks = _blocks(own, row["count"], directions, epsilon, size)
        pairs = _block_pairs(blocks, -(-row["count"] // size), epsilon)
        found = found.union(_join_blocks(blocks, pairs, directions, cosine, epsilon))
    found = staged(found, "vector-links")

    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    labels = connected_components(found.select("node", "root"))
    members = labels.union(labels.select("root", "root").distinct().toDF("node", "root"))
    members = members.join(nodes.select("node", "first"), "node")
    roots = members.groupBy("root").agg(F.min("first").alias("component"))
    of_node = members.select("node", "root").join(roots, "root").select("node", "component")
    of_digest = (
        nodes.select("dims", "digest", "node", "first", "weight")
        .join(links, "node", "left")
        .join(of_node, "node", "left")
        .select(
            "dims",
            "digest",
            (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"),
            F.coalesce("component", "first").alias("component_id"),
        )
    )
    joined = vectors.drop("vector").join(of_digest, ["dims", "digest"], "left")
    component = F.when(F.col("digest").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    return joined.select(
        "vec_id",
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
