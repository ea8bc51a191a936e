"""Encoding and decoding with a table of distinct words.

1. Texts are split into words. Documents are put into blocks of about ``block_chars``
   characters; a block has a list of its distinct words, and a document is the list of
   its words' numbers in that list.
2. The words of all blocks meet by a hash of the word, and each distinct word is encoded
   once. The ids go back to the blocks.
3. Each block joins the ids back by position. The pieces of the ids come from a join
   with the vocabulary, a table of fixed size that every task has; joined by the
   decoder's rule they are the decoded text.

The documents themselves are moved once, as compressed word numbers. The blocks are
written to the shared folder first, so that a repeated task finds the same blocks.

Rows: one for each row of ``docs``. A null or empty text has no ids and decodes to an
empty text. Repeated rows and null ids are kept as they are; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from tenantflow.llm.inputs import parallelism, record_batch, texts_of
from tenantflow.llm.wordcodes import ID_TYPE, WordTable, load_tokenizer, split_words
from tenantflow.session import staged

# Kinds of rows of a block, in the order in which a block is put together.
_BUCKETS, _WORDS, _DOCUMENTS = 0, 1, 2
_DOCS_OF_ROW = 16
_SMALL = 200
_BLOCK_SHIFT = 24
_MOST_KEPT = 1_000_000


def _packed(values: np.ndarray) -> bytes:
    """Numbers of 32 bits as compressed byte planes."""
    planes = np.ascontiguousarray(values.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return zstandard.ZstdCompressor(level=3).compress(planes.tobytes())


def _unpacked(raw: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<u4").reshape(-1)


def _packed_numbers(values: np.ndarray) -> bytes:
    """Word numbers: of small ones a byte, of others three; compressed."""
    if len(values) and int(values.max()) >= _SMALL + ((256 - _SMALL) << 16):
        return b"\0" + _packed(values)
    rest = values[values >= _SMALL] - _SMALL
    first = values.astype(np.uint8)
    first[values >= _SMALL] = _SMALL + (rest >> 16)
    others = np.ascontiguousarray(rest.astype("<u2").view(np.uint8).reshape(-1, 2).T)
    return b"\1" + zstandard.ZstdCompressor(level=1).compress(first.tobytes() + others.tobytes())


def _unpacked_numbers(raw: bytes, n: int) -> np.ndarray:
    if raw[:1] == b"\0":
        return _unpacked(raw[1:])
    found = np.frombuffer(zstandard.ZstdDecompressor().decompress(raw[1:]), np.uint8)
    values, others = found[:n].astype(np.uint32), found[n:].reshape(2, -1)
    large = values >= _SMALL
    rest = others[0] | (others[1].astype(np.uint32) << 8)
    values[large] = ((values[large] - _SMALL) << 16) + rest + _SMALL
    return values


class _Block:
    """The distinct words of a block and its documents as numbers of words.

    Words are numbered by how often they occur in the block.
    """

    def __init__(self, number: int, n_buckets: int) -> None:
        self.number, self.n_buckets = number, n_buckets
        self.codes: dict[str, int] = {}
        self.docs: list[tuple] = []
        self.chars = 0

    def add(self, doc_id: object, text: str) -> None:
        words = split_words(text)
        codes = self.codes
        try:
            numbers = np.fromiter(map(codes.__getitem__, words), "<u4", len(words))
        except KeyError:
            for word in words:
                codes.setdefault(word, len(codes))
            numbers = np.fromiter(map(codes.__getitem__, words), "<u4", len(words))
        self.docs.append((doc_id, numbers))
        self.chars += len(text)

    def rows(self) -> list[tuple]:
        seen = list(self.codes)
        often = np.bincount(np.concatenate([n for _, n in self.docs]), minlength=len(seen))
        by_rank = np.argsort(-often, kind="stable")
        rank = np.empty(len(seen), dtype="<u4")
        rank[by_rank] = np.arange(len(seen))
        words = [seen[k].encode("utf-8", "surrogatepass") for k in by_rank.tolist()]
        buckets = np.fromiter((zlib.crc32(w) % self.n_buckets for w in words), "<u4", len(words))
        rows = [(self.number, _BUCKETS, None, None, None, _packed(buckets))]
        for at in range(0, len(self.docs), _DOCS_OF_ROW):
            doc_ids, numbers = zip(*self.docs[at : at + _DOCS_OF_ROW])
            payload = _packed_numbers(rank[np.concatenate(numbers)])
            rows.append((self.number, _DOCUMENTS, None, doc_ids, [len(n) for n in numbers], payload))
        order = np.argsort(buckets, kind="stable")
        bounds = np.searchsorted(buckets[order], np.arange(self.n_buckets + 1))
        squeeze = zstandard.ZstdCompressor(level=3).compress
        for bucket in range(self.n_buckets):
            chosen = order[bounds[bucket] : bounds[bucket + 1]].tolist()
            if chosen:
                page = b"\n".join([words[k] for k in chosen])
                rows.append((self.number, _WORDS, bucket, None, None, squeeze(page)))
        return rows


def _split_into_blocks(docs: DataFrame, block_chars: int, n_buckets: int) -> DataFrame:
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("kind", T.IntegerType()),
            T.StructField("bucket", T.IntegerType()),
            T.StructField("doc_ids", T.ArrayType(docs.select(F.col("doc_id")).schema.fields[0].dataType)),
            T.StructField("sizes", T.ArrayType(T.IntegerType())),
            T.StructField("payload", T.BinaryType()),
        ]
    )
    arrow = to_arrow_schema(schema)

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << _BLOCK_SHIFT
        block = _Block(number, n_buckets)
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), texts_of(batch.column(1))):
                block.add(doc_id, text)
                if block.chars >= block_chars:
                    yield record_batch(arrow, zip(*block.rows()))
                    number += 1
                    block = _Block(number, n_buckets)
        if block.docs:
            yield record_batch(arrow, zip(*block.rows()))

    return docs.select("doc_id", "text").mapInArrow(split, schema)


def _encode_words(blocks: DataFrame, tokenizer: str, n_buckets: int) -> DataFrame:
    """The word pages of all blocks with the ids of their words instead of the words."""
    arrow = to_arrow_schema(blocks.schema)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table, unpack = WordTable(tokenizer), zstandard.ZstdDecompressor().decompress
        known: dict[bytes, bytes] = {}
        current = None
        for batch in batches:
            rows = []
            for block, bucket, payload in zip(*(batch.column(c).to_pylist() for c in (0, 2, 5))):
                if bucket != current or len(known) > _MOST_KEPT:
                    known, current = {}, bucket
                words = unpack(payload).split(b"\n")
                new = [word for word in words if word not in known]
                texts = [word.decode("utf-8", "surrogatepass") for word in new]
                known.update(zip(new, table.encode(texts), strict=True))
                ids = [known[word] for word in words]
                sizes = np.fromiter((len(x) // ID_TYPE.itemsize for x in ids), "<u4", len(ids))
                numbers = np.concatenate([[len(ids)], sizes, np.frombuffer(b"".join(ids), ID_TYPE)])
                rows.append((block, _WORDS, bucket, None, None, _packed(numbers)))
            if rows:
                yield record_batch(arrow, zip(*rows))

    return (
        blocks.where(F.col("kind") == _WORDS)
        .repartition(n_buckets, "bucket")
        .sortWithinPartitions("bucket")
        .mapInArrow(encode, blocks.schema)
    )


def encode_and_decode(
    docs: DataFrame, tokenizer: str, block_chars: int = 16_000_000, with_values: bool = False
) -> DataFrame:
    """The ids of every text, and the text decoded from them.

    Columns: doc_id, n_tokens, ids_sha256, decoded_sha256; ``with_values`` adds ids (raw
    little-endian 32-bit integers) and decoded.
    """
    spark = docs.sparkSession
    n_buckets = parallelism(spark)
    blocks = staged(_split_into_blocks(docs, block_chars, n_buckets), "word-blocks")
    pages = _encode_words(blocks, tokenizer, n_buckets)
    schema = T.StructType(
        [
            T.StructField("doc_id", blocks.schema["doc_ids"].dataType.elementType),
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids_sha256", T.StringType()),
            T.StructField("decoded_sha256", T.StringType()),
        ]
        + (
            [T.StructField("ids", T.BinaryType()), T.StructField("decoded", T.StringType())]
            if with_values
            else []
        )
    )
    arrow = to_arrow_schema(schema)

    def join_back(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = load_tokenizer(tokenizer)
        pieces = [vocabulary.id_to_token(k) or "" for k in range(vocabulary.get_vocab_size())]
        buckets, numbers, found = None, [], None
        for batch in batches:
            rows = []
            for kind, doc_ids, sizes, payload in zip(*(batch.column(k).to_pylist() for k in (1, 3, 4, 5))):
                if kind == _BUCKETS:
                    buckets, numbers, found = _unpacked(payload), [], None
                elif kind == _WORDS:
                    numbers.append(_unpacked(payload))
                else:
                    if found is None:
                        found = by_code(buckets, numbers, pieces)
                    codes, at = _unpacked_numbers(payload, sum(sizes)).tolist(), 0
                    for doc_id, size in zip(doc_ids, sizes):
                        rows.append(document(doc_id, codes[at : at + size], *found))
                        at += size
            if rows:
                yield record_batch(arrow, zip(*rows))

    def document(doc_id: object, codes: list[int], ids_of: list, pieces_of: list) -> tuple:
        ids = b"".join(map(ids_of.__getitem__, codes))
        decoded = " ".join(filter(None, map(pieces_of.__getitem__, codes)))  # a word may have no ids
        row = (
            doc_id,
            len(ids) // ID_TYPE.itemsize,
            hashlib.sha256(ids).hexdigest(),
            hashlib.sha256(decoded.encode()).hexdigest(),
        )
        return (*row, ids, decoded) if with_values else row

    def by_code(buckets: np.ndarray, pages: list[np.ndarray], pieces: list[str]) -> tuple[list, list]:
        """The ids and the pieces of each word of a block, by the word's number."""
        order = np.argsort(buckets, kind="stable").tolist()
        ids_of: list = [b""] * len(order)
        pieces_of: list = [""] * len(order)
        at = 0
        for page in pages:
            n = int(page[0])
            ids = page[1 + n :].astype(ID_TYPE)
            raw, names = ids.tobytes(), [pieces[k] for k in ids.tolist()]
            begin = 0
            for end in np.cumsum(page[1 : 1 + n]).tolist():
                code = order[at]
                ids_of[code] = raw[begin * ID_TYPE.itemsize : end * ID_TYPE.itemsize]
                pieces_of[code] = " ".join(names[begin:end])
                begin, at = end, at + 1
        return ids_of, pieces_of

    return (
        blocks.where(F.col("kind") != _WORDS)
        .unionByName(pages)
        .repartition(n_buckets, "block")
        .sortWithinPartitions("block", "kind", "bucket")
        .mapInArrow(join_back, schema)
    )
