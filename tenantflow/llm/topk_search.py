"""Exact top-k search by inner product: threshold aggregation without random access.

Per block of rows and dimension there is a list of the rows, sorted by their component. A
component's weight is the query's, which may have either sign, so a list is read from both
ends; the queries of a group share the reading.

1. A page of every list is read, from both ends. Read components are known; the others of a
   list lie between the values that its two ends have come to.
2. Each row so has a lower and an upper bound of its score. The k-th lower bound, or the k-th
   score found before, is the query's threshold; a row whose upper bound is below it cannot
   qualify. Equal bounds go on, as ties are settled by identifier.
3. A query stops reading a block when the rows that can still qualify are few (``open_rows``);
   at the middle of the lists all is known. The final scores of these rows are then
   computed from their vectors. Nothing else is looked up by row.

Scores are exact whole numbers. Sums that could leave the exact whole numbers of doubles are
taken in whole numbers without bounds, cut to the range of long.

Rows: ``k`` for each query row, fewer where there are fewer candidates. Null vectors, vectors
with null or non-finite components and rows with a null id take no part. A row is no candidate
for a query of the same id. Vectors of different lengths are not compared; empty vectors score
0 with each other. Query rows that repeat an id are answered each. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.llm.vector_tiles import (
    EXACT,
    NO_SCORE,
    Block,
    Group,
    Tiles,
    best_of,
    blocks_of,
    groups_of,
    inner_products,
    kth_scores,
    numbered_queries,
    whole_vectors,
)
from tenantflow.session import staged

#: Ends of the pages, as parts of a list; half a list from each end is all of it.
_PAGES = (0.125, 0.25, 0.375, 0.5)
_QUERIES_AT_ONCE = 512

_FOUND = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("query_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


class ListReader:
    """Reads blocks for the queries of one group; keeps the best ``k`` of each."""

    def __init__(self, group: Group, k: int, open_rows: int) -> None:
        self.group, self.k, self.open_rows = group, k, open_rows
        self.threshold = np.array([NO_SCORE if not g else g[0][0] for g in group.given], np.int64)
        self.query, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))

    def read(self, block: Block) -> None:
        x, q = block.x.astype(np.float64), self.group.x.astype(np.float64)
        most = float(np.abs(x).max()) * float(np.abs(q).sum(axis=1).max()) if x.size else 0.0
        for start in range(0, len(q), _QUERIES_AT_ONCE):
            some = np.arange(start, min(start + _QUERIES_AT_ONCE, len(q)))
            if 4 * most >= EXACT or not x.size:
                at, row = self._all(some, block)
                scores = inner_products(self.group.x[some], block.x)[at - start, row].astype(np.int64)
            else:
                # In single precision where its whole numbers, and halves, are exact too.
                kind = np.float32 if 4 * most < 1 << 24 else np.float64
                at, row = self._qualified(some, q[some].astype(kind), x.astype(kind), block)
                scores = np.einsum("ij,ij->i", q[at], x[row]).astype(np.int64)
            self._keep(at, block.ids[row], scores)

    def _all(self, some: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
        at, row = np.nonzero(self.group.ids[some][:, None] != block.ids[None, :])
        return some[at], row

    def _qualified(self, some: np.ndarray, q: np.ndarray, x: np.ndarray, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """(query, row) of all that can be among the best; the pages are read on the way."""
        n, dims = x.shape
        middle, spread = np.empty_like(x), np.empty_like(x)
        every = np.arange(dims)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        open_ = np.arange(len(some))
        read = 0
        lists = block.lists
        least, most = x[lists[:, 0], every], x[lists[:, -1], every]
        middle[:], spread[:] = (most + least) / 2, (most - least) / 2
        for page in _PAGES:
            depth = min(-(-n // 2), max(read + 1, int(np.ceil(n * page))))
            unread = lists[:, depth : n - depth]
            for rows in (lists[:, read:depth], lists[:, n - depth : n - read]):
                middle[rows, every[:, None]] = x[rows, every[:, None]]
                spread[rows, every[:, None]] = 0
            if unread.size:
                least, most = x[lists[:, depth - 1], every], x[lists[:, n - depth], every]
                middle[unread, every[:, None]] = ((most + least) / 2)[:, None]
                spread[unread, every[:, None]] = ((most - least) / 2)[:, None]
            read = depth
            at_middle, around = q[open_] @ middle.T, np.abs(q[open_]) @ spread.T
            own = self.group.ids[some[open_]][:, None] == block.ids[None, :]
            lower = np.where(own, -np.inf, at_middle - around)
            threshold = self.threshold[some[open_]]
            if n >= self.k:
                kth = np.partition(lower, n - self.k, axis=1)[:, n - self.k]
                threshold = np.maximum(threshold, np.where(np.isfinite(kth), kth, NO_SCORE))
            can = (at_middle + around >= threshold[:, None]) & ~own
            closed = np.full(len(open_), True) if 2 * read >= n else can.sum(axis=1) <= self.open_rows
            at, row = np.nonzero(can[closed])
            found.append((some[open_[closed]][at], row))
            open_ = open_[~closed]
            if not len(open_):
                break
        return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])

    def _keep(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        enough = scores >= self.threshold[query]
        query, ids, scores = (
            np.concatenate([old, new[enough]])
            for old, new in ((self.query, query), (self.ids, ids), (self.scores, scores))
        )
        best = best_of(query, scores, ids, self.k)
        self.query, self.ids, self.scores = query[best], ids[best], scores[best]
        self.threshold = kth_scores(len(self.group.ids), self.query, self.scores, self.k, self.threshold)

    def finish(self) -> list[np.ndarray]:
        return [self.group.number[self.query], self.group.ids[self.query], self.ids, self.scores]


def top_k(embeddings: DataFrame, is_query: Column, k: int = 5, scale: int = 256, open_rows: int = 64) -> DataFrame:
    """query_id, rank, vec_id, score: for each row where ``is_query``, its ``k`` best others."""
    vec_id = F.col("vec_id").cast("long")
    rows = embeddings.where("vec_id is not null")
    candidates = whole_vectors(rows, vec_id.alias("id"), F.lit(0).alias("label"), scale=scale)
    queries = whole_vectors(rows.where(is_query), vec_id.alias("id"), F.lit(0).alias("label"), scale=scale)
    queries, ranges, n_groups = numbered_queries(queries, F.lit(0))
    tiles = Tiles.of(blocks_of(candidates, rows.count(), with_lists=True), ranges, n_groups)

    def reader(group: Group) -> ListReader:
        return ListReader(group, k, open_rows)

    unknown = F.lit(None).cast("array<array<bigint>>")
    begun = staged(tiles.search(groups_of(queries.withColumn("given", unknown)), reader, _FOUND, first=True), "top-begun")
    kth = begun.groupBy("number").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
    given = queries.join(kth, "number", "left").withColumn("given", F.when(F.col("kth").isNotNull(), F.array(F.array("kth"))))
    rest = tiles.search(groups_of(given), reader, _FOUND, first=False)
    order = Window.partitionBy("number").orderBy(F.desc("score"), "vec_id")
    ranked = begun.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")
