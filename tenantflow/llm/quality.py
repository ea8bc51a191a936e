"""A quality classifier: gradient-boosted trees on histograms of document statistics.

``fit_quality`` learns from a bounded sample of labelled documents (``max_rows``): up to half
of it from each label, drawn by a hash of the doc_id and then of the statistics, so that a
rare label is learned and an often repeated id brings no more rows. Equal rows count as one
with a weight, and both labels weigh the same: a score of 0.5 means that a document is as
typical of one as of the other. Values are cut into at most 64 bins by the quantiles and ends
of each label; every tree is grown level by level, each split chosen from histograms of gradients. All trees are
complete, so a model is three arrays, and scoring walks all documents of a batch through
a tree at once. Statistics are computed from whole texts; language, source and ids take no
part.

Rows: scoring returns one row for each row of ``docs``. Null and empty texts have statistics
of zero and get a score like any other. Labels that are null, or whose document is missing,
are left out; a doc_id that occurs more than once counts as often. With no labels, or
labels of one class, the score is the same for all documents. Other columns are ignored,
and kept by ``good_documents``.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import record_batch, texts_of
from tenantflow.session import staged

_BYTE_CLASS = np.full(256, 7)
for _number, _bytes in enumerate(
    (b"abcdefghijklmnopqrstuvwxyz", b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"0123456789", b" \t\r\x0b\x0c",
     b"\n", b".,;:'\"-()", b"!?")
):
    _BYTE_CLASS[list(_bytes)] = _number
_BYTE_CLASS[128:] = 0  # letters outside ASCII, for the languages meant here
_N_CLASSES = 8

N_STATISTICS = 26


def document_statistics(text: str) -> list[float]:
    """The ``N_STATISTICS`` numbers of a text that the trees see."""
    raw = np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8)
    words, lines = text.split(), [line for line in text.split("\n") if line]
    if not words:
        return [0.0] * N_STATISTICS
    n, n_words, n_lines = len(raw), len(words), len(lines)
    counts = np.bincount(raw, minlength=256)
    classes = np.bincount(_BYTE_CLASS, weights=counts, minlength=_N_CLASSES) / n
    shares = counts[counts > 0] / n
    sizes = np.fromiter(map(len, words), np.int64, n_words)
    often: dict[str, int] = {}
    for word in words:
        often[word] = often.get(word, 0) + 1
    most = max(often.values())
    same_as_last = sum(map(str.__eq__, words[1:], words))
    pairs = len(set(zip(words, words[1:])))
    odd = sum(not word[-1].isalnum() for word in words)
    upper = sum(map(str.isupper, words))
    lone = sum(not any(map(str.isalnum, word)) for word in often) / len(often)
    line_words = n_words / n_lines
    marks = counts[list(b"#$%&*|=<>{}[]\\^~_@/+")].sum() / n
    return [
        *classes.tolist(),
        float(-(shares * np.log2(shares)).sum()),
        np.log1p(n_words),
        float(sizes.mean()),
        float(sizes.std()),
        float(sizes.max()),
        len(often) / n_words,
        len(often) / np.sqrt(n_words),
        most / n_words,
        same_as_last / n_words,
        pairs / max(1, n_words - 1),
        odd / n_words,
        upper / n_words,
        lone,
        len(set(lines)) / n_lines,
        np.log1p(n_lines),
        np.log1p(line_words),
        float(marks),
        len(zlib.compress(raw.tobytes(), 1)) / n,
    ]


def statistics_of(texts: list[str]) -> np.ndarray:
    return np.array([document_statistics(text) for text in texts], dtype=np.float64).reshape(-1, N_STATISTICS)


@dataclass(frozen=True)
class TreeEnsemble:
    """Complete trees: split column and limit of each inner node, value of each leaf.

    ``columns`` and ``limits`` have a row for each tree; the children of node k are 2k+1
    (value at most the limit) and 2k+2.
    """

    base: float
    columns: np.ndarray
    limits: np.ndarray
    leaves: np.ndarray

    def score(self, values: np.ndarray) -> np.ndarray:
        """The probability of label 1 for each row of ``values``."""
        total = np.full(len(values), self.base)
        rows, inner = np.arange(len(values)), self.columns.shape[1] if len(self.columns) else 0
        depth = int(np.log2(inner + 1)) if inner else 0
        for columns, limits, leaves in zip(self.columns, self.limits, self.leaves):
            node = np.zeros(len(values), dtype=np.int64)
            for _ in range(depth):
                node = 2 * node + 1 + (values[rows, columns[node]] > limits[node])
            total += leaves[node - inner]
        return 1 / (1 + np.exp(-total))


def _edges(values: np.ndarray, labels: np.ndarray, n_bins: int) -> np.ndarray:
    """Fewer than ``n_bins`` places to cut at: inner quantiles and ends of each label."""
    inner = np.linspace(0, 1, n_bins // 2 - 1)[1:-1]
    own = [values[labels == label] for label in (0, 1)]
    ends = [end for of in own for end in (np.nextafter(of.min(), -np.inf), of.max())]
    return np.unique(np.concatenate([*(np.quantile(of, inner) for of in own), ends]))


def fit_trees(
    values: np.ndarray,
    labels: np.ndarray,
    weights: np.ndarray | None = None,
    n_trees: int = 120,
    depth: int = 5,
    rate: float = 0.1,
    n_bins: int = 64,
    min_weight: float = 2.0,
    ridge: float = 1.0,
) -> TreeEnsemble:
    """Boosted trees for the logistic loss, grown on histograms."""
    inner = (1 << depth) - 1
    empty = np.zeros((0, inner), dtype=np.int64), np.zeros((0, inner)), np.zeros((0, inner + 1))
    weights = np.ones(len(labels)) if weights is None else weights
    share = float(np.average(labels, weights=weights)) if len(labels) else 0.5
    if share in (0.0, 1.0) or not len(labels):
        share = min(max(share, 0.01), 0.99)
        return TreeEnsemble(float(np.log(share / (1 - share))), *empty)
    n, width = values.shape
    edges = [_edges(values[:, k], labels, n_bins) for k in range(width)]
    binned = np.stack([np.searchsorted(e, values[:, k]) for k, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * n_bins
    base = float(np.log(share / (1 - share)))
    total = np.full(n, base)
    columns = np.zeros((n_trees, inner), dtype=np.int64)
    limits = np.full((n_trees, inner), np.inf)
    leaves = np.zeros((n_trees, inner + 1))
    for tree in range(n_trees):
        chance = 1 / (1 + np.exp(-total))
        slope, bend = weights * (chance - labels), weights * chance * (1 - chance)
        node = np.zeros(n, dtype=np.int64)
        for level in range(depth):
            first, n_nodes = (1 << level) - 1, 1 << level
            cells = ((node - first)[:, None] * (width * n_bins) + flat).ravel()
            shape = (n_nodes, width, n_bins)
            size = n_nodes * width * n_bins
            g = np.bincount(cells, np.repeat(slope, width), size).reshape(shape).cumsum(axis=2)
            h = np.bincount(cells, np.repeat(bend, width), size).reshape(shape).cumsum(axis=2)
            g_all, h_all = g[:, :, -1:], h[:, :, -1:]
            gain = g**2 / (h + ridge) + (g_all - g) ** 2 / (h_all - h + ridge) - g_all**2 / (h_all + ridge)
            gain[(h < min_weight) | (h_all - h < min_weight)] = 0
            best = gain.reshape(n_nodes, -1).argmax(axis=1)
            for k in range(n_nodes):
                column, cut = divmod(int(best[k]), n_bins)
                if gain[k, column, cut] > 1e-6 and cut < len(edges[column]):
                    columns[tree, first + k], limits[tree, first + k] = column, edges[column][cut]
            node = 2 * node + 1 + (values[np.arange(n), columns[tree, node]] > limits[tree, node])
        leaf = node - inner
        g, h = np.bincount(leaf, slope, inner + 1), np.bincount(leaf, bend, inner + 1)
        leaves[tree] = -rate * g / (h + ridge)
        total += leaves[tree][leaf]
    return TreeEnsemble(base, columns, limits, leaves)


def is_held_out(doc_id: str = "doc_id", folds: int = 5) -> Column:
    """Whether crc32 of the id as text leaves no remainder; null ids are not held out."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(crc % folds == 0, F.lit(False))


def _draw(rows: DataFrame, per_label: int, *key: str) -> DataFrame:
    """At most ``per_label`` rows of each label, those with the smallest hash of ``key``."""
    counts = {row.quality: row["count"] for row in rows.groupBy("quality").count().collect()}  # two rows

    def of_label(label: int) -> DataFrame:
        own, n = rows.where(F.col("quality") == label), counts.get(label, 0)
        if n <= per_label:
            return own
        place = F.pmod(F.xxhash64(*key), F.lit(1 << 40))
        few = own.where(place < (per_label << 41) // n)  # about twice as many as wanted
        return few.orderBy(place, *key).limit(per_label)

    return of_label(0).union(of_label(1))


def fit_quality(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000) -> TreeEnsemble:
    """Learn ``quality`` from rows that are not held out, ``max_rows`` different ones at most."""
    per_label = max(1, max_rows // 2)
    usable = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where(
        F.col("quality").isin(0, 1) & ~is_held_out()
    )
    usable = usable.groupBy("doc_id", "quality").agg(F.count("*").alias("times"))
    usable = staged(usable.join(docs.select("doc_id"), "doc_id", "left_semi"), "labelled-ids")
    chosen = _draw(usable, per_label, "doc_id")  # max_rows at most
    texts = docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "times", "text")
    schema = T.StructType(
        [
            T.StructField("quality", T.IntegerType()),
            T.StructField("times", T.LongType()),
            T.StructField("statistics", T.ArrayType(T.DoubleType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            statistics = statistics_of(texts_of(batch.column(2))).tolist()
            yield record_batch(arrow, [batch.column(0), batch.column(1), statistics])

    measured = texts.mapInArrow(measure, schema).groupBy("quality", "statistics").agg(F.sum("times").alias("times"))
    rows = _draw(staged(measured, "labelled-statistics"), per_label, "statistics").toArrow()  # max_rows at most
    values = np.array(rows["statistics"].to_pylist(), dtype=np.float64).reshape(-1, N_STATISTICS)
    labels_of = np.array(rows["quality"].to_pylist(), dtype=np.float64)
    times = np.array(rows["times"].to_pylist(), dtype=np.float64)
    for label in (0, 1):  # both weigh the same, together as much as all rows
        of_label = labels_of == label
        if of_label.any() and not of_label.all():
            times[of_label] *= len(times) / 2 / times[of_label].sum()
    order = np.lexsort((*values.T, labels_of))  # the same model whatever the order of rows
    return fit_trees(values[order], labels_of[order], times[order])


def score_documents(docs: DataFrame, model: TreeEnsemble, threshold: float = 0.3) -> DataFrame:
    """Per document: doc_id, held_out, score, predicted."""
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.select(F.col("doc_id")).schema.fields[0].dataType),
            T.StructField("score", T.DoubleType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(statistics_of(texts_of(batch.column(1))))
            yield record_batch(arrow, [batch.column(0), scores])

    scored = docs.select("doc_id", "text").mapInArrow(score, schema)
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def good_documents(docs: DataFrame, model: TreeEnsemble, threshold: float = 0.3) -> DataFrame:
    """The rows of ``docs`` that the model does not reject, with all their columns."""
    schema = docs.schema
    text_at = docs.columns.index("text")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            scores = model.score(statistics_of(texts_of(batch.column(text_at))))
            yield batch.filter(pa.array(scores >= threshold))

    return docs.mapInArrow(keep, schema)
