"""A token store of directly addressable codes, with random access to any token.

An id is split into chunks, by default of 8, 8 and 16 bits, the lowest first. Level 0
has the first chunk of every id, level 1 the second chunk of those ids that need one,
and so on. A continuation bitmap marks in each level the ids that go on in the next; a
directory of ranks (ones before each 512th bit) turns a position in one level into the
position in the next. So any token is found from its number with a few array reads.

A segment holds the codes of consecutive documents, about ``segment_tokens`` tokens. A
store is a folder: ``segments`` has a row for each segment in Parquet, uncompressed, as
the codes are read in place; ``parts`` says with which token each part begins. Parts
follow each other in ascending order of doc_id.

Null ids come first. Documents with one doc_id follow each other by a hash of their text.
A null or empty text has the end id as its only token. Other columns are ignored.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import parallelism, record_batch, text_hash, texts_of
from tenantflow.llm.wordcodes import ID_TYPE, shared_encoder

CHUNK_BITS = (8, 8, 16)

_MAGIC = b"DAC1"
_RANK_BITS = 512
_RANK_WORDS = _RANK_BITS // 64


def _chunk_type(bits: int) -> np.dtype:
    return np.dtype("<u1") if bits <= 8 else np.dtype("<u2") if bits <= 16 else np.dtype("<u4")


def encode_codes(ids: np.ndarray, chunk_bits: tuple[int, ...] = CHUNK_BITS) -> bytes:
    """The codes of ``ids`` as one string of bytes; the chunks have 32 bits in sum."""
    parts = [_MAGIC, struct.pack("<B", len(chunk_bits)), bytes(chunk_bits)]
    rest = ids
    for bits in chunk_bits:
        chunks = (rest & np.uint32((1 << bits) - 1)).astype(_chunk_type(bits))
        parts += [struct.pack("<Q", len(rest)), chunks.tobytes()]
        rest = rest >> np.uint32(bits)
        more = rest != 0
        words = np.zeros(-(-len(more) // _RANK_BITS) * _RANK_WORDS, dtype="<u8")
        packed = np.packbits(more, bitorder="little")
        words.view(np.uint8)[: len(packed)] = packed
        ones = np.bitwise_count(words).reshape(-1, _RANK_WORDS).sum(axis=1, dtype=np.uint32)
        ranks = np.concatenate([np.zeros(1, np.uint32), np.cumsum(ones, dtype=np.uint32)])
        parts += [words.tobytes(), ranks.astype("<u4").tobytes()]
        rest = rest[more]
    return b"".join(parts)


class Codes:
    """Reads ids out of ``encode_codes``' bytes without decoding what lies around them."""

    def __init__(self, raw: bytes) -> None:
        if raw[:4] != _MAGIC:
            raise ValueError("not a segment of directly addressable codes")
        self.chunk_bits = tuple(raw[5 : 5 + raw[4]])
        self.levels = []
        at = 5 + raw[4]

        def take(kind: str | np.dtype, count: int) -> np.ndarray:
            nonlocal at
            found = np.frombuffer(raw, kind, count, at)
            at += found.nbytes
            return found

        for bits in self.chunk_bits:
            n = int(take("<u8", 1)[0])
            blocks = -(-n // _RANK_BITS)
            chunks = take(_chunk_type(bits), n)
            self.levels.append((chunks, take("<u8", blocks * _RANK_WORDS), take("<u4", blocks + 1)))

    def __len__(self) -> int:
        return len(self.levels[0][0])

    @staticmethod
    def _ranks(words: np.ndarray, ranks: np.ndarray, positions: np.ndarray) -> np.ndarray:
        """The number of ones before each position."""
        block, word, bit = positions // _RANK_BITS, positions // 64, positions % 64
        found = ranks[block].astype(np.int64)
        for k in range(_RANK_WORDS):
            before = block * _RANK_WORDS + k
            within = before < word
            found[within] += np.bitwise_count(words[before[within]])
        inside = bit > 0
        below = (np.uint64(1) << bit[inside].astype(np.uint64)) - np.uint64(1)
        found[inside] += np.bitwise_count(words[word[inside]] & below)
        return found

    def at(self, positions: np.ndarray) -> np.ndarray:
        """The ids at any positions."""
        positions = np.asarray(positions, dtype=np.int64)
        found = np.zeros(len(positions), dtype=np.uint64)
        where, shift = np.arange(len(positions)), 0
        for bits, (chunks, words, ranks) in zip(self.chunk_bits, self.levels):
            found[where] |= chunks[positions].astype(np.uint64) << np.uint64(shift)
            more = (words[positions // 64] >> (positions % 64).astype(np.uint64)) & np.uint64(1) != 0
            where, positions = where[more], self._ranks(words, ranks, positions[more])
            shift += bits
            if not len(where):
                break
        return found.astype(ID_TYPE)

    @staticmethod
    def _rank(words: np.ndarray, ranks: np.ndarray, position: int) -> int:
        """The number of ones before one position."""
        block, word, bit = position // _RANK_BITS, position // 64, position % 64
        found = int(ranks[block]) + int(np.bitwise_count(words[block * _RANK_WORDS : word]).sum())
        return found + (int(words[word]) & ((1 << bit) - 1)).bit_count() if bit else found

    def between(self, start: int, end: int) -> np.ndarray:
        """The ids of the positions from ``start`` up to ``end``."""
        found = np.zeros(end - start, dtype=ID_TYPE)
        where, shift = slice(None), 0
        for bits, (chunks, words, ranks) in zip(self.chunk_bits, self.levels):
            if start == end:
                break
            found[where] |= chunks[start:end].astype(np.uint32) << np.uint32(shift)
            first = start // 64
            flags = np.unpackbits(words[first : -(-end // 64)].view(np.uint8), bitorder="little")
            more = np.flatnonzero(flags[start - first * 64 : end - first * 64])
            where, shift = more if shift == 0 else where[more], shift + bits
            start = self._rank(words, ranks, start)
            end = start + len(more)
        return found


def _segment_schema(id_type: T.DataType) -> T.StructType:
    return T.StructType(
        [
            T.StructField("part", T.LongType()),
            T.StructField("first_in_part", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("doc_ids", T.ArrayType(id_type)),
            T.StructField("doc_tokens", T.ArrayType(T.LongType())),
            T.StructField("codes", T.BinaryType()),
        ]
    )


def write_store(
    docs: DataFrame,
    path: str,
    tokenizer: str,
    end_id: int = 2,
    segment_tokens: int = 1 << 18,
    chunk_bits: tuple[int, ...] = CHUNK_BITS,
) -> None:
    """Encode ``docs`` (doc_id, text) and write them in ascending doc_id order."""
    if sum(chunk_bits) != 32:
        raise ValueError("the chunks must have 32 bits in sum")
    spark = docs.sparkSession
    schema = _segment_schema(docs.select(F.col("doc_id")).schema.fields[0].dataType)
    arrow = to_arrow_schema(schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = shared_encoder(tokenizer)
        end = np.array([end_id], dtype=ID_TYPE).tobytes()
        part, written = TaskContext.get().partitionId(), 0
        doc_ids, texts, held = [], [], 0

        def segment() -> pa.RecordBatch:
            ids = np.frombuffer(b"".join(texts), dtype=ID_TYPE)
            sizes = [len(raw) // ID_TYPE.itemsize for raw in texts]
            row = (part, written, len(ids), doc_ids, sizes, encode_codes(ids, chunk_bits))
            return record_batch(arrow, [[value] for value in row])

        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                raw = encoder.encode(text) + end
                doc_ids.append(doc_id)
                texts.append(raw)
                held += len(raw) // ID_TYPE.itemsize
                if held >= segment_tokens:
                    yield segment()
                    written += held
                    doc_ids, texts, held = [], [], 0
        if held:
            yield segment()

    # The row number splits a doc_id that very many rows share; it decides no value.
    order = [F.col("doc_id").asc_nulls_first(), text_hash(F.col("text")), F.monotonically_increasing_id()]
    (
        docs.select("doc_id", "text")
        .repartitionByRange(parallelism(spark), *order)
        .sortWithinPartitions(F.col("doc_id").asc_nulls_first(), text_hash(F.col("text")))
        .mapInArrow(encode, schema)
        .write.option("compression", "none")
        .option("parquet.enable.dictionary", "false")
        .parquet(f"{path}/segments")
    )
    sizes = (
        spark.read.parquet(f"{path}/segments")
        .groupBy("part")
        .agg(F.sum("n_tokens").alias("n_tokens"))
        .orderBy("part")
        .collect()  # a row for each part that was written, one part for each task
    )
    firsts = [0, *accumulate(row.n_tokens for row in sizes)]
    rows = [(row.part, first, row.n_tokens) for row, first in zip(sizes, firsts)]
    spark.createDataFrame(rows, "part long, first_token long, n_tokens long").coalesce(1).write.parquet(
        f"{path}/parts"
    )


def read_segments(spark: SparkSession, path: str) -> DataFrame:
    """The segments of a store, with the number of their first token in all documents."""
    parts = spark.read.parquet(f"{path}/parts").select("part", "first_token")
    return (
        spark.read.parquet(f"{path}/segments")
        .join(F.broadcast(parts), "part")  # a row for each writing task
        .withColumn("first_token", F.col("first_token") + F.col("first_in_part"))
    )


def read_documents(spark: SparkSession, path: str, with_ids: bool = False) -> DataFrame:
    """The documents of a store: doc_id, start, n_tokens, ids_crc32 and, if wanted, ids."""
    segments = read_segments(spark, path).select("doc_ids", "doc_tokens", "first_token", "codes")
    schema = T.StructType(
        [
            T.StructField("doc_id", segments.schema["doc_ids"].dataType.elementType),
            T.StructField("start", T.LongType()),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_crc32", T.LongType()),
        ]
        + ([T.StructField("ids", T.BinaryType())] if with_ids else [])
    )
    arrow = to_arrow_schema(schema)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for doc_ids, sizes, first, raw in zip(*(column.to_pylist() for column in batch.columns)):
                codes = Codes(raw)
                ends = list(accumulate(sizes))
                begins = [0, *ends[:-1]]
                ids = [codes.between(a, b).tobytes() for a, b in zip(begins, ends)]
                columns = [doc_ids, [first + a for a in begins], sizes, [zlib.crc32(x) for x in ids]]
                yield record_batch(arrow, [*columns, ids] if with_ids else columns)

    return segments.mapInArrow(decode, schema)


def read_tokens(spark: SparkSession, path: str, positions: DataFrame, stride: int = 1 << 18) -> DataFrame:
    """The token at each distinct ``position`` (long); positions outside the store are left out.

    Positions meet segments by blocks of ``stride`` tokens. Each segment is opened once
    for all positions in it, of which there are no more than it has tokens.
    """
    segments = read_segments(spark, path).withColumn("next_token", F.col("first_token") + F.col("n_tokens"))
    spans = segments.select(
        "first_token",
        "next_token",
        F.explode(
            F.sequence(F.floor(F.col("first_token") / stride), F.floor((F.col("next_token") - 1) / stride))
        ).alias("block"),
    )
    wanted = (
        positions.select(F.col("position").cast("long")).distinct()
        .withColumn("block", F.floor(F.col("position") / stride))
        .join(spans, "block")
        .where("position >= first_token and position < next_token")
        .groupBy("first_token")
        .agg(F.collect_list("position").alias("positions"))
        .join(segments.select("first_token", "codes"), "first_token")
        .select("first_token", "positions", "codes")
    )
    schema = T.StructType([T.StructField("position", T.LongType()), T.StructField("token", T.LongType())])
    arrow = to_arrow_schema(schema)

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, asked, raw in zip(*(column.to_pylist() for column in batch.columns)):
                yield record_batch(arrow, [asked, Codes(raw).at(np.array(asked) - first).astype(np.int64)])

    return wanted.mapInArrow(look_up, schema)
