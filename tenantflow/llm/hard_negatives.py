"""Hard negatives from shared candidate lists of anchor clusters, in the manner of MAXIMUS.

1. Anchors are clustered by direction: spherical k-means, fitted on a bounded sample
   (``sample_rows``); it decides how much is skipped, not what is found. A cluster is cut
   into groups; each has the mean direction of its members and the widest angle to them.
2. For a group and a block of rows, a row at angle ``t`` from the direction has at most the
   score |member| * |row| * cos(max(0, t - widest)) with any member. The rows are sorted by
   this bound, once for all members.
3. Every member walks that list, a piece at a time, and stops when its next bound is
   certainly below what it needs: its k-th best row, or the least score that it accepts.

This is done twice: for the best rows of an anchor's own label (positives), then for each
positive's band of scores among the rows of other labels (negatives).

Scores are exact whole numbers, cut to the range of long.

Rows: up to ``n_negatives`` for each anchor and positive. Rows with a null id, label or vector
or with null or non-finite components take no part. Rows of the anchor's id are not its
positives. Vectors of different lengths are not compared. Anchor rows that repeat an id are
answered each, and repeated rows are positives and negatives of their own. Positives with a
score below 0 have no band; at 0 the band is 0. Other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tenantflow.llm.vector_tiles import (
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

_PIECE = 256
_MEMBERS = 1024
_MOST_CLUSTERS = 256
#: More than the rounding errors of angles, and of bounds in relation to them.
_ANGLE_SLACK, _BOUND_SLACK = 1e-6, 1e-9

_FOUND = T.StructType(
    [
        T.StructField("number", T.LongType()),
        T.StructField("band", T.IntegerType()),
        T.StructField("anchor_id", T.LongType()),
        T.StructField("vec_id", T.LongType()),
        T.StructField("score", T.LongType()),
    ]
)


def _lengths(x: np.ndarray) -> np.ndarray:
    return np.sqrt((x * x).sum(axis=1))


def _directions(x: np.ndarray) -> np.ndarray:
    length = _lengths(x)
    return x / np.where(length > 0, length, 1)[:, None]


def _angles(x: np.ndarray, direction: np.ndarray) -> np.ndarray:
    return np.arccos(np.clip(_directions(x) @ direction, -1, 1))


class Walker:
    """Walks blocks for the anchors of a group.

    A member has bands of accepted scores (least, most, threshold), with or without rows of
    its own label; it keeps the best ``k`` of each band.
    """

    def __init__(self, group: Group, k: int, same_label: bool) -> None:
        self.group, self.k, self.same_label = group, k, same_label
        self.n_bands = max([1, *(len(g) for g in group.given)])
        closed = [_NOTHING] * self.n_bands
        bands = np.array([[*g, *closed][: self.n_bands] for g in group.given], np.int64).reshape(-1, self.n_bands, 3)
        self.least, self.most, known = bands[..., 0], bands[..., 1], bands[..., 2]
        self.needed = np.maximum(self.least, known)
        self.band, self.ids, self.scores = (np.zeros(0, np.int64) for _ in range(3))
        self.x = group.x.astype(np.float64)
        self.lengths = _lengths(self.x)
        mean = _directions(self.x).sum(axis=0)
        self.direction = mean / max(float(np.sqrt(mean @ mean)), 1e-300)
        self.widest = float(_angles(self.x, self.direction).max()) + _ANGLE_SLACK

    def read(self, block: Block) -> None:
        rows = block.x.astype(np.float64)
        apart = _angles(rows, self.direction) - self.widest - _ANGLE_SLACK
        bound = _lengths(rows) * np.cos(np.maximum(apart, 0))
        bound += _BOUND_SLACK * np.abs(bound)
        order = np.argsort(-bound, kind="stable")
        open_ = np.arange(len(self.x))
        for start in range(0, len(order), _PIECE):
            highest = self.lengths[open_] * float(bound[order[start]])
            highest += _BOUND_SLACK * np.abs(highest)
            # Bounds equal to what is needed go on: ties are settled by identifier.
            open_ = open_[(highest[:, None] >= self.needed[open_]).any(axis=1)]
            if not len(open_):
                return
            self._take(open_, order[start : start + _PIECE], block)

    def _take(self, open_: np.ndarray, rows: np.ndarray, block: Block) -> None:
        scores = inner_products(self.group.x[open_], block.x[rows])
        equal = self.group.labels[open_][:, None] == block.labels[rows][None, :]
        fits = equal & (self.group.ids[open_][:, None] != block.ids[rows][None, :]) if self.same_label else ~equal
        found = []
        for band in range(self.n_bands):
            low, high = self.needed[open_, band][:, None], self.most[open_, band][:, None]
            at, row = np.nonzero(fits & (scores >= low) & (scores <= high))
            found.append((open_[at] * self.n_bands + band, block.ids[rows[row]], scores[at, row].astype(np.int64)))
        if not any(len(f[0]) for f in found):
            return
        band, ids, values = (
            np.concatenate([old, *new])
            for old, new in zip((self.band, self.ids, self.scores), zip(*found, strict=True), strict=True)
        )
        best = best_of(band, values, ids, self.k)
        self.band, self.ids, self.scores = band[best], ids[best], values[best]
        needed = kth_scores(self.needed.size, self.band, self.scores, self.k, self.needed.ravel())
        self.needed = needed.reshape(self.needed.shape)

    def finish(self) -> list[np.ndarray]:
        member, band = self.band // self.n_bands, (self.band % self.n_bands).astype(np.int32)
        return [self.group.number[member], band, self.group.ids[member], self.ids, self.scores]


_ALL = (NO_SCORE, -NO_SCORE, NO_SCORE)
#: A band without scores: more is needed than any row has.
_NOTHING = (-NO_SCORE, NO_SCORE, -NO_SCORE)


def _clusters(anchors: DataFrame, n: int, sample_rows: int) -> Column:
    """The cluster of an anchor, from spherical k-means on a sample of at most ``sample_rows``."""
    sample = anchors.where(F.col("dims") > 0).orderBy(F.xxhash64("id", "x")).limit(sample_rows).select("dims", "x").collect()
    centres: dict[int, list[list[float]]] = {}
    for dims in sorted({row.dims for row in sample}):
        x = _directions(np.array([row.x for row in sample if row.dims == dims], np.float64))
        wanted = min(_MOST_CLUSTERS, -(-n // _MEMBERS), len(x))
        centre = x[np.linspace(0, len(x) - 1, wanted).astype(int)]
        for _ in range(10):
            nearest = (x @ centre.T).argmax(axis=1)
            sums = np.zeros_like(centre)
            np.add.at(sums, nearest, x)
            centre = np.where(_lengths(sums)[:, None] > 0, _directions(sums), centre)
        centres[dims] = centre.tolist()

    @F.pandas_udf("int")
    def nearest_centre(x: pd.Series) -> pd.Series:
        nearest = np.zeros(len(x), np.int32)
        lengths = x.map(len).to_numpy(np.int64)
        for dims, centre in centres.items():
            chosen = np.flatnonzero(lengths == dims)
            if len(chosen):
                nearest[chosen] = (np.stack(x.iloc[chosen]).astype(np.float64) @ np.array(centre).T).argmax(axis=1)
        return pd.Series(nearest)

    return nearest_centre("x")


def hard_negatives(
    embeddings: DataFrame,
    is_anchor: Column,
    n_positives: int = 5,
    n_negatives: int = 3,
    least_percent: int = 50,
    most_percent: int = 95,
    scale: int = 256,
    sample_rows: int = 8192,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score."""
    vec_id, label = F.col("vec_id").cast("long").alias("id"), F.col("label").cast("long").alias("label")
    rows = embeddings.where("vec_id is not null and label is not null")
    anchors = whole_vectors(rows.where(is_anchor), vec_id, label, scale=scale)
    cluster = _clusters(anchors, anchors.count(), sample_rows)
    anchors, ranges, n_groups = numbered_queries(anchors, cluster, _MEMBERS)
    tiles = Tiles.of(blocks_of(whole_vectors(rows, vec_id, label, scale=scale), rows.count()), ranges, n_groups)

    def search(given: DataFrame, k: int, same_label: bool, label: str) -> DataFrame:
        """The best ``k`` of each band; ``given`` holds the bands without thresholds."""

        def walker(group: Group) -> Walker:
            return Walker(group, k, same_label)

        begun = staged(tiles.search(groups_of(given), walker, _FOUND, first=True), f"{label}-begun")
        kth = begun.groupBy("number", "band").agg(F.count("*").alias("n"), F.min("score").alias("kth")).where(F.col("n") >= k)
        by_band = kth.groupBy("number").agg(F.map_from_entries(F.collect_list(F.struct("band", "kth"))).alias("kths"))

        def raised(band: Column, at: Column) -> Column:
            return F.array(band[0], band[1], F.greatest(band[2], F.try_element_at("kths", at.cast("int"))))

        known = given.join(by_band, "number", "left")
        known = known.withColumn("given", F.when(F.col("kths").isNull(), F.col("given")).otherwise(F.transform("given", raised)))
        rest = tiles.search(groups_of(known), walker, _FOUND, first=False)
        order = Window.partitionBy("number", "band").orderBy(F.desc("score"), "vec_id")
        return begun.union(rest).withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    def band_of(low: Column, high: Column, needed: Column) -> Column:
        return F.array(low.cast("long"), high.cast("long"), needed.cast("long"))

    everything = F.array(band_of(*(F.lit(v) for v in _ALL)))
    positives = staged(search(anchors.withColumn("given", everything), n_positives, True, "positives"), "positives")

    # In decimals, as 95 times a score may leave the range of long.
    score = F.col("score").cast("decimal(38,0)")
    low = F.ceil(score * least_percent / 100)
    high = F.floor(score * most_percent / 100)
    nothing = band_of(*(F.lit(v) for v in _NOTHING))
    band = F.when(low <= high, band_of(low, high, low)).otherwise(nothing)
    bands = positives.groupBy("number").agg(F.sort_array(F.collect_list(F.struct("rank", band.alias("band")))).alias("bands"))
    given = anchors.join(bands, "number").withColumn("given", F.col("bands.band")).drop("bands")
    negatives = search(given, n_negatives, False, "negatives")
    of_positive = positives.select(
        "number",
        (F.col("rank") - 1).cast("int").alias("band"),
        F.col("vec_id").alias("positive_id"),
        F.col("score").alias("positive_score"),
    )
    return (
        negatives.withColumnsRenamed({"vec_id": "negative_id", "score": "negative_score"})
        .join(of_positive, ["number", "band"])
        .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")
    )
