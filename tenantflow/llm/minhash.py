"""Near-duplicate documents by a join on the coordinates of MinHash signatures.

1. A document is the set of its distinct five-word shingles (64-bit hashes; A-Z in lower
   case; with fewer words the whole sequence is one shingle). Documents with equal sets
   are one class; from here on only classes are compared.
2. A class has a signature of ``coordinates`` minima. It is posted under each pair of
   coordinate and value. Two classes are compared if they collide in ``matches``
   coordinates at least. As pairs are ordered by how often they occur, such classes must
   collide within their ``coordinates - matches + 1`` rarest pairs (the prefix): only these
   are posted, and a class with too many values of its own is not posted at all.
3. Within a posting, collisions are counted on the signatures, so the long postings that
   the prefix skips are never walked through. A posting of more than ``POSTING_ROWS``
   classes is cut into blocks, and a task holds two blocks at most.
4. A parity sketch of the sets bounds their difference from below, without error; pairs
   that it excludes are dropped where they are found.
5. In a first round each block proposes one partner for each of its classes; proposals are
   confirmed on the full sets and give first components. As every posting is cut into other
   blocks, large groups of similar texts become one component here, at a cost that grows
   with their rows and not with their pairs. The second round proposes all pairs left between
   different components: postings of one component are skipped, and in the others the blocks
   of the largest component meet only those of the rest. No link between components is
   left out.

Classes are linked if 100 * intersection >= 75 * union, which is always confirmed on full
sets. A link of similarity 0.75 is missed if 33 or more of 64 coordinates differ; the
chance is about 1 in 300,000, and less for more similar texts.

Rows: one for each row of ``docs``. A document without words, null text included, is linked
with nothing. Of rows with equal ids all count as kept if one is; rows with null ids are
kept only if no row of their component has an id. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby
from operator import itemgetter

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.components import connected_components
from tenantflow.llm.inputs import fresh_name, parallelism, record_batch, text_hash
from tenantflow.session import staged

WORDS = 5
COORDINATES = 64
MATCHES = 32
PERCENT = 75

#: Ids of documents to fetch again are broadcast up to this number (16 bytes each).
BROADCAST_KEYS = 500_000
POSTING_ROWS = 2048

#: Bytes of text that are hashed at once; each takes some 60 bytes of a worker's memory.
_CHUNK_BYTES = 1 << 18
_U64 = np.uint64
_rng = np.random.default_rng(20)


def _odd_numbers(n: int) -> np.ndarray:
    return _rng.integers(0, 1 << 63, n, dtype=np.uint64) * _U64(2) + _U64(1)


_STEP = _odd_numbers(1)[0]
_STEP_INVERSE = _U64(pow(int(_STEP), -1, 1 << 64))
_IN_SHINGLE = _odd_numbers(WORDS)
_FACTORS, _SHIFTS = _odd_numbers(COORDINATES), _odd_numbers(COORDINATES)
_BYTE = _odd_numbers(256)
_BYTE[ord("A") : ord("Z") + 1] = _BYTE[ord("a") : ord("z") + 1]
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U64(33))) * _U64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> _U64(33))) * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


class ShingleHasher:
    """Shingle sets of the texts of an Arrow column, without making Python strings."""

    def __init__(self) -> None:
        self._powers, self._inverses = np.ones(1, np.uint64), np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self._powers) < n:
            self._powers = np.concatenate([[_U64(1)], np.multiply.accumulate(np.full(n, _STEP))])
            self._inverses = np.concatenate([[_U64(1)], np.multiply.accumulate(np.full(n, _STEP_INVERSE))])

    def sets(self, column: pa.Array) -> Iterator[np.ndarray]:
        """The sorted distinct shingles of each text; null counts as empty."""
        column = pc.fill_null(column, "")
        width = np.int64 if pa.types.is_large_string(column.type) else np.int32
        offsets = np.frombuffer(column.buffers()[1], width)[column.offset : column.offset + len(column) + 1]
        data = column.buffers()[2]
        raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
        first = 0
        while first < len(column):  # some texts at a time, one at least
            last = int(np.searchsorted(offsets, offsets[first] + _CHUNK_BYTES, "right")) - 1
            last = min(max(last, first + 1), len(column))
            bounds = (offsets[first : last + 1] - offsets[first]).astype(np.int64)
            yield from self._sets_of(raw[offsets[first] : offsets[last]], bounds)
            first = last

    def _sets_of(self, raw: np.ndarray, bounds: np.ndarray) -> Iterator[np.ndarray]:
        self._grow(len(raw) + 1)
        word = ~_SPACE[raw]
        cut = np.zeros(len(raw) + 1, dtype=bool)
        cut[bounds] = True
        begins = word & cut[:-1]
        begins[1:] |= word[1:] & ~word[:-1]
        ends = word & cut[1:]
        ends[:-1] |= word[:-1] & ~word[1:]
        begins, ends = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.multiply(_BYTE[raw], self._powers[: len(raw)], out=sums[1:])
        np.cumsum(sums[1:], out=sums[1:])
        words = _mixed((sums[ends] - sums[begins]) * self._inverses[begins])
        n = max(0, len(words) - WORDS + 1)
        shingles = np.zeros(n, np.uint64)
        for k, factor in enumerate(_IN_SHINGLE):
            shingles += words[k : k + n] * factor
        shingles = _mixed(shingles)
        of_text = np.searchsorted(begins, bounds).tolist()
        for a, b in zip(of_text, of_text[1:]):
            if b - a >= WORDS:
                yield np.unique(shingles[a : b - WORDS + 1])
            elif b > a:
                yield _mixed((words[a:b] * _IN_SHINGLE[: b - a]).sum(keepdims=True) + _U64(b - a))
            else:
                yield np.zeros(0, np.uint64)


def signature(shingles: np.ndarray) -> np.ndarray:
    """The minima of a set under all coordinates' hashes, as signed 32-bit integers."""
    least = np.full(COORDINATES, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(shingles), 4096):
        part = shingles[at : at + 4096]
        least = np.minimum(least, (_FACTORS[:, None] * part + _SHIFTS[:, None]).min(axis=1))
    return (least >> _U64(32)).astype(np.uint32).view(np.int32)


def parity_sketch(shingles: np.ndarray) -> bytes:
    """Parities of the counts of shingles per bit; the size is a power of two, about 2n bits.

    The ones of two sketches' difference are at most as many as the sets' differences.
    """
    bits = min(max(256, 1 << (2 * len(shingles) - 1).bit_length()), 1 << 16)
    counts = np.bincount((shingles & _U64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits(counts & 1, bitorder="little").tobytes()


def _folded(sketch: np.ndarray, size: int) -> np.ndarray:
    """Sketches (rows of words) brought to ``size`` words."""
    while sketch.shape[1] > size:
        half = sketch.shape[1] // 2
        sketch = sketch[:, :half] ^ sketch[:, half:]
    return sketch


def _sign(docs: DataFrame) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("doc_id", docs.schema["doc_id"].dataType),
            T.StructField("text_key", T.LongType()),
            T.StructField("n_shingles", T.LongType()),
            T.StructField("class", T.BinaryType()),
            T.StructField("signature", T.ArrayType(T.IntegerType())),
        ]
    )
    arrow = to_arrow_schema(schema)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            sizes, classes, signatures = [], [], []
            for found in hasher.sets(batch.column(2)):
                sizes.append(len(found))
                classes.append(hashlib.blake2b(found.tobytes(), digest_size=16).digest() if len(found) else None)
                signatures.append(signature(found) if len(found) else None)
            yield record_batch(arrow, [batch.column(0), batch.column(1), sizes, classes, signatures])

    return docs.select("doc_id", "text_key", "text").mapInArrow(sign, schema)


def _prefixes(classes: DataFrame) -> DataFrame:
    """Classes that can have a partner, with their tokens (coordinate and value) to post."""
    tokens = classes.select("node", F.posexplode("signature").alias("coordinate", "value")).select(
        "node",
        F.shiftleft(F.col("coordinate").cast("long"), 32)
        .bitwiseOR(F.col("value").cast("long").bitwiseAND(0xFFFFFFFF))
        .alias("token"),
    )
    often = tokens.groupBy("token").agg(F.count("*").alias("often")).where("often > 1")
    shared = F.array_sort(F.collect_list(F.struct("often", "token")))  # 64 at most
    # Values that no other class has come first in the order; they fill up the prefix.
    return (
        tokens.join(often, "token")
        .groupBy("node")
        .agg(shared.alias("shared"))
        .where(F.size("shared") >= MATCHES)
        .select("node", F.slice("shared", F.lit(1), F.size("shared") - (MATCHES - 1)).alias("prefix"))
    )


def _fetch_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(node, shingles, sketch) of the classes in ``wanted``, from one document of each."""
    schema = T.StructType(
        [
            T.StructField("node", T.LongType()),
            T.StructField("shingles", T.BinaryType()),
            T.StructField("sketch", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = ShingleHasher()
        for batch in batches:
            sets = list(hasher.sets(batch.column(1)))
            yield record_batch(
                arrow, [batch.column(0), [s.tobytes() for s in sets], [parity_sketch(s) for s in sets]]
            )

    keys = wanted.select(
        "node", F.col("first.text_key").alias("key"), F.col("first.doc_id").alias("first_id")
    )
    if keys.count() <= BROADCAST_KEYS:
        keys = F.broadcast(keys)
    same = (F.col("text_key") == F.col("key")) & F.col("doc_id").eqNullSafe(F.col("first_id"))
    found = docs.join(keys, same).select("node", "text").mapInArrow(measure, schema)
    return found.dropDuplicates(["node"])  # a row may be repeated


def _payload(wanted: DataFrame, sets: DataFrame) -> DataFrame:
    """What a posting holds of each class, and the coordinates of its prefix as a mask."""
    in_prefix = F.aggregate(
        "prefix",
        F.lit(0).cast("long"),
        lambda mask, x: mask.bitwiseOR(
            F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftright(x["token"], 32).cast("int"))
        ),
    )
    own = wanted.select("node", "n_shingles", "signature", "prefix", in_prefix.alias("mask"))
    return own.join(sets.select("node", "sketch"), "node")


_POSTED = ("token", "lo", "hi", "block", "node", "n_shingles", "mask", "signature", "sketch", "label")


def _postings_in_blocks(payload: DataFrame) -> DataFrame:
    """A row for each class and posted token; blocks of a posting do not meet."""
    blocks = F.ceil(F.col("posted.often") / POSTING_ROWS).cast("int")
    block = F.pmod(F.xxhash64("node", "posted.token"), blocks).cast("int")
    return (
        payload.withColumn("posted", F.explode("prefix"))
        .withColumns({"token": F.col("posted.token"), "block": block, "label": F.lit(None).cast("long")})
        .withColumns({"lo": F.col("block"), "hi": F.col("block")})
        .select(*_POSTED)
    )


def _mixed_postings(payload: DataFrame, labels: DataFrame) -> DataFrame:
    """The postings with more than one label, with a row for each class and pair of blocks.

    The classes of the most frequent label need not meet each other: their blocks meet
    those of the others only.
    """
    label = F.coalesce("root", "node").alias("label")
    posted = (
        payload.select("node", F.explode("prefix.token").alias("token"))
        .join(labels.toDF("node", "root"), "node", "left")
        .select("node", "token", label)
    )
    mixed = (
        posted.groupBy("token", "label")
        .agg(F.count("*").alias("n"))
        .groupBy("token")
        .agg(F.max(F.struct("n", "label")).alias("main"), F.sum("n").alias("n"))
        .where("main.n < n")
    )
    single = F.col("n") <= POSTING_ROWS
    n_main = F.when(single, 0).otherwise(F.ceil(F.col("main.n") / POSTING_ROWS)).cast("int")
    n_rest = F.when(single, 1).otherwise(F.ceil((F.col("n") - F.col("main.n")) / POSTING_ROWS)).cast("int")
    in_main = ~F.col("single") & (F.col("label") == F.col("main_label"))
    place = F.xxhash64("node", "token")
    block = F.when(in_main, F.pmod(place, F.col("n_main"))).otherwise(F.col("n_main") + F.pmod(place, F.col("n_rest")))
    others = F.sequence(
        F.when(in_main, F.col("n_main")).otherwise(0), F.col("n_main") + F.col("n_rest") - 1
    )
    sizes = mixed.select(
        "token", F.col("main.label").alias("main_label"), single.alias("single"), n_main.alias("n_main"), n_rest.alias("n_rest")
    )
    cells = posted.join(sizes, "token").select(
        "node", "token", "label", block.cast("int").alias("block"), others.alias("others")
    )
    return (
        payload.drop("prefix")
        .join(cells, "node")
        .withColumn("other", F.explode("others"))
        .withColumns({"lo": F.least("block", "other"), "hi": F.greatest("block", "other")})
        .select(*_POSTED)
    )


def _compare(rows: list[tuple], best_only: bool) -> Iterator[tuple[int, int]]:
    """Pairs of nodes of one posting (or of two of its blocks) that may be linked."""
    rows.sort(key=itemgetter(5))
    token, lo, hi = rows[0][:3]
    coordinate = _U64(1) << _U64(token >> 32)
    block = np.array([r[3] for r in rows])
    node = np.array([r[4] for r in rows])
    size = np.array([r[5] for r in rows])
    mask = np.array([r[6] for r in rows], dtype=np.int64).view(np.uint64)
    signatures = np.array([r[7] for r in rows], dtype=np.int32)
    sketches = [np.frombuffer(r[8], np.uint64) for r in rows]
    label = np.array([r[4] if r[9] is None else r[9] for r in rows])
    width = np.array([len(s) for s in sketches])
    levels = {
        int(w): {int(k): _folded(np.stack([sketches[j] for j in np.flatnonzero(width == k)]), int(w))
                 for k in set(width.tolist()) if w <= k <= 2 * w}
        for w in set(width.tolist())
    }
    place = np.zeros(len(rows), dtype=np.int64)
    for k in set(width.tolist()):
        place[width == k] = np.arange((width == k).sum())
    last = np.searchsorted(size, size * 100 // PERCENT, "right")
    best: dict[int, tuple] = {}
    for i in range(len(rows) - 1):
        near = np.arange(i + 1, last[i])
        keep = label[near] != label[i]
        if lo != hi:
            keep &= block[near] != block[i]
        near = near[keep]
        if not len(near):
            continue
        equal = signatures[near] == signatures[i]
        count = equal.sum(axis=1)
        chosen = np.flatnonzero(count >= MATCHES)
        if not len(chosen):
            continue
        near, equal, count = near[chosen], equal[chosen], count[chosen]
        if not best_only:
            shared = np.packbits(equal, axis=1, bitorder="little").view(np.uint64)[:, 0] & mask[i] & mask[near]
            keep = (shared & (~shared + _U64(1))) == coordinate  # no other posting proposes the pair
            near, count = near[keep], count[keep]
        apart = np.zeros(len(near), dtype=np.int64)
        mine = int(width[i])
        own = levels[mine][mine][place[i]]
        for k in set(width[near].tolist()):
            of = np.flatnonzero(width[near] == k)
            apart[of] = np.bitwise_count(levels[mine][k][place[near[of]]] ^ own).sum(axis=1)
        keep = 7 * apart <= size[near] + size[i]
        near, count = near[keep], count[keep]
        if best_only:
            for j, c in zip(near.tolist(), count.tolist()):
                best[i] = max(best.get(i, (0, 0, 0)), (c, -int(node[j]), j))
                best[j] = max(best.get(j, (0, 0, 0)), (c, -int(node[i]), i))
        else:
            yield from zip([int(node[i])] * len(near), node[near].tolist())
    for i, (_, _, j) in best.items():
        yield min(int(node[i]), int(node[j])), max(int(node[i]), int(node[j]))


_PAIR = T.StructType([T.StructField("a", T.LongType()), T.StructField("b", T.LongType())])


def _propose(postings: DataFrame, best_only: bool) -> DataFrame:
    """Distinct pairs of nodes with different labels that may be linked."""
    arrow = to_arrow_schema(_PAIR)

    def rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
        for batch in batches:
            columns = [c.to_pylist() for c in batch.columns[:7]]
            flat = batch.column(7).flatten().to_numpy().reshape(-1, COORDINATES)
            yield from zip(*columns, flat, batch.column(8).to_pylist(), batch.column(9).to_pylist())

    def propose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: set[tuple[int, int]] = set()
        for _, rows in groupby(rows_of(batches), itemgetter(0, 1, 2)):
            rows = list(rows)
            if len(rows) > 1:
                found.update(_compare(rows, best_only))
            if len(found) > 50_000:
                yield record_batch(arrow, zip(*found))
                found = set()
        if found:
            yield record_batch(arrow, zip(*found))

    cell = ["token", "lo", "hi"]
    pairs = postings.repartition(parallelism(postings.sparkSession), *cell).sortWithinPartitions(*cell)
    return pairs.mapInArrow(propose, _PAIR).distinct()


def _confirm(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs whose full sets are similar enough."""
    arrow = to_arrow_schema(_PAIR)
    of_a = sets.select(F.col("node").alias("a"), F.col("shingles").alias("set_a"))
    of_b = sets.select(F.col("node").alias("b"), F.col("shingles").alias("set_b"))

    def confirm(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            linked = []
            for x, y in zip(batch.column(2), batch.column(3)):
                x, y = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                linked.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield batch.select([0, 1]).filter(pa.array(linked, pa.bool_())).cast(arrow)

    return pairs.join(of_a, "a").join(of_b, "b").select("a", "b", "set_a", "set_b").mapInArrow(confirm, _PAIR)


def near_duplicates(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept, text_key, stays.

    ``stays`` is true for the rows of the first doc_id and text of a component; text_key
    is a hash of the text.
    """
    docs = docs.select("doc_id", "text", text_hash(F.col("text")).alias("text_key"))
    signed = staged(_sign(docs), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_key")
    classes = signed.where("n_shingles > 0").groupBy("class").agg(
        F.first("n_shingles").alias("n_shingles"),
        F.first("signature").alias("signature"),
        F.min(order).alias("first"),
    )
    classes = staged(classes.withColumn("node", F.monotonically_increasing_id()), "classes")

    prefixes = _prefixes(classes)
    wanted = staged(prefixes.join(classes.drop("class"), "node"), "prefixes")
    sets = staged(_fetch_sets(docs, wanted), "shingle-sets")
    payload = _payload(wanted, sets)
    links = staged(_confirm(_propose(_postings_in_blocks(payload), best_only=True), sets), "links")
    labels = connected_components(links)
    more = _propose(_mixed_postings(payload, labels), best_only=False)
    more = staged(_confirm(more, sets), "links")
    labels = connected_components(links.union(more))

    smallest = (
        labels.union(labels.select(F.col("root").alias("node"), "root").distinct())
        .join(classes.select("node", "first"), "node")
    )
    of_root = smallest.groupBy("root").agg(F.min("first").alias("component_first"))
    of_node = smallest.select("node", "root").join(of_root, "root").select("node", "component_first")
    of_class = classes.select("class", "node", "first").join(of_node, "node", "left").select(
        "class", F.coalesce("component_first", "first").alias("component")
    )
    found = signed.drop("signature").join(of_class, "class", "left")
    component_id = F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component.doc_id"))
    return found.select(
        "doc_id",
        "n_shingles",
        component_id.alias("component_id"),
        F.col("doc_id").eqNullSafe(component_id).alias("kept"),
        "text_key",
        (F.col("component").isNull() | (order == F.col("component"))).alias("stays"),
    )


def one_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    key = fresh_name(docs, "stays_key")
    stays = near_duplicates(docs).where("stays").select(F.col("doc_id").alias("stays_id"), F.col("text_key"))
    marked = docs.withColumn(key, text_hash(F.col("text")))
    same = (marked[key] == stays["text_key"]) & marked["doc_id"].eqNullSafe(stays["stays_id"])
    return marked.join(stays, same, "left_semi").select(*docs.columns)
