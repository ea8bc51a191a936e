"""Packing, the token store and the word table, held against the tokenizers library."""

from __future__ import annotations

import hashlib
import random
import zlib
from collections import defaultdict

import brute
import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tenantflow.llm import bpe, packing, token_store
from tenantflow.llm.inputs import parallelism
from tenantflow.llm.wordcodes import TextEncoder, WordTable


def raw(ids: list[int]) -> bytes:
    return np.array(ids, dtype="<u4").tobytes()


def expected(docs, tokenizer) -> dict:
    found = defaultdict(list)
    for row in docs.select("doc_id", "text").collect():
        found[row.doc_id].append(brute.tokens(tokenizer, row.text))
    return found


@pytest.fixture(scope="module")
def encoders(tokenizer_path):
    return TextEncoder(tokenizer_path), TextEncoder(tokenizer_path, max_known=3)


@settings(max_examples=300, deadline=None)
@given(text=st.text(alphabet=st.one_of(st.characters(codec="utf-8"), st.sampled_from("ab'sS <|é\x1c\x85\n."))))
def test_encoder_equals_the_library(encoders, tokenizer, text):
    for encoder in encoders:
        assert encoder.encode(text) == raw(brute.tokens(tokenizer, text))
        assert encoder.encode(text) == raw(brute.tokens(tokenizer, text))


# One stretch without a word end, and one with two, beside each other.
STRETCHES = ["東京 foo. \u3000 x", "東京 \xa0 foo. x", "a <|endoftext|> b foo. c", "東京 \u3000 \xa0 it's, y Foo Bar"]


@pytest.mark.parametrize("text", STRETCHES)
def test_stretches_without_a_word_end(tokenizer_path, tokenizer, text):
    warm = TextEncoder(tokenizer_path)
    warm.encode("x y foo a b bar and \u3000 <|startoftext|>")
    for encoder in (TextEncoder(tokenizer_path), warm, TextEncoder(tokenizer_path, max_known=3)):
        for _ in range(2):
            assert encoder.encode(text) == raw(brute.tokens(tokenizer, text))
    words = [*text.split(" "), "<|endoftext|>", "foo."]
    assert WordTable(tokenizer_path).encode(words) == [raw(brute.tokens(tokenizer, w)) for w in words]


def test_word_table_of_stretches_without_a_word_end(spark, tokenizer_path, tokenizer):
    def bucket(word):
        return zlib.crc32(word.encode()) % parallelism(spark)

    # Both stretches in one bucket, so that they are encoded together.
    two = next(w for k in range(10_000) if bucket(w := f"foo{chr(97 + k % 26)}{'b' * (k // 26)}.") == bucket("\u3000"))
    for text in (*STRETCHES, f"東京 \u3000 x {two}"):
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string")
        check_bpe(docs, bpe.encode_and_decode(docs, tokenizer_path).collect(), tokenizer)


def check_packing(docs, rows, tokenizer, window):
    texts, sequences, pieces = expected(docs, tokenizer), defaultdict(list), defaultdict(list)
    for row in rows:
        sequences[row.sequence_id].append(row)
        pieces[row.doc_id].append(row)
    padding = total = 0
    for members in sequences.values():
        at = 0
        for row in sorted(members, key=lambda r: r.offset):
            assert row.offset == at and row.length > 0
            at += row.length
        assert at <= window
        total += at
        padding += 0 if at & (at - 1) == 0 else window - at
    assert set(pieces) == set(texts)
    for doc_id, versions in texts.items():
        if len(versions) > 1:  # rows with one id cannot be told apart
            assert sum(r.length for r in pieces[doc_id]) == sum(len(v) + 1 for v in versions)
            continue
        ids, at = [*versions[0], 2], 0
        for row in sorted(pieces[doc_id], key=lambda r: r.start):
            assert (row.start, row.doc_tokens) == (at, len(ids))
            assert row.ids_crc32 == zlib.crc32(raw(ids[at : at + row.length]))
            at += row.length
        assert at == len(ids)
    return padding, total


def test_packing_of_the_whole_table(documents, tokenizer_path, tokenizer):
    rows = packing.pack_documents(documents, tokenizer_path).collect()
    padding, _ = check_packing(documents, rows, tokenizer, 4096)
    assert padding == 0


@pytest.mark.parametrize("max_open", [1, 3, 1024])
def test_packing_of_awkward_rows(awkward, tokenizer_path, tokenizer, max_open):
    packed = packing.pack_documents(awkward, tokenizer_path, window=64, max_open=max_open, with_ids=True)
    rows = packed.collect()
    padding, _ = check_packing(awkward, rows, tokenizer, 64)
    assert padding == 0
    assert all(zlib.crc32(r.ids) == r.ids_crc32 and len(r.ids) == 4 * r.length for r in rows)


def test_packing_nothing(no_documents, tokenizer_path):
    assert packing.pack_documents(no_documents, tokenizer_path).collect() == []


def test_level_choice_is_the_least_sum_of_squares():
    rng = random.Random(3)
    packer = packing.Packer(32, 10_000)
    for _ in range(500):
        size = rng.randint(1, 31)
        outcomes = {}
        for level in range(33 - size):
            counts = packer.counts.copy()
            if level and not counts[level]:
                continue
            counts[level] -= 1
            counts[level + size] += 1
            outcomes[level] = int((counts[1:32] ** 2).sum())
        assert outcomes[packer._best_level(size)] == min(outcomes.values())
        packer._place(packing.Piece((0, size), 0, raw([1] * size)))


@settings(max_examples=200, deadline=None)
@given(
    ids=st.lists(st.one_of(st.integers(0, 300), st.integers(0, 70_000), st.integers(0, 2**32 - 1)), max_size=1500),
    bits=st.sampled_from([(8, 8, 16), (4, 4, 8, 16), (16, 16), (7, 9, 16)]),
    data=st.data(),
)
def test_codes_round_trip(ids, bits, data):
    codes = token_store.Codes(token_store.encode_codes(np.array(ids, dtype="<u4"), bits))
    assert len(codes) == len(ids)
    a = data.draw(st.integers(0, len(ids)))
    b = data.draw(st.integers(a, len(ids)))
    assert codes.between(a, b).tolist() == ids[a:b]
    if ids:
        asked = data.draw(st.lists(st.integers(0, len(ids) - 1), max_size=20))
        assert codes.at(np.array(asked, dtype=np.int64)).tolist() == [ids[k] for k in asked]


def test_store_of_the_whole_table(spark, documents, tokenizer_path, tokenizer, tmp_path):
    path = str(tmp_path / "store")
    token_store.write_store(documents, path, tokenizer_path, segment_tokens=20_000)
    texts, start = expected(documents, tokenizer), 0
    rows = {row.doc_id: row for row in token_store.read_documents(spark, path, with_ids=True).collect()}
    everything = []
    for doc_id in sorted(texts):
        ids, row = [*texts[doc_id][0], 2], rows[doc_id]
        assert (row.start, row.n_tokens, row.ids_crc32) == (start, len(ids), zlib.crc32(raw(ids)))
        assert bytes(row.ids) == raw(ids)
        start += len(ids)
        everything += ids
    positions = spark.range(0, start + 5000, 997).withColumnRenamed("id", "position")
    found = {r.position: r.token for r in token_store.read_tokens(spark, path, positions, 8192).collect()}
    assert found == {k: everything[k] for k in range(0, start, 997)}


def test_store_of_awkward_rows(spark, awkward, no_documents, tokenizer_path, tokenizer, tmp_path):
    token_store.write_store(awkward, str(tmp_path / "a"), tokenizer_path)
    rows = token_store.read_documents(spark, str(tmp_path / "a")).orderBy("start").collect()
    ids = [r.doc_id for r in rows]
    assert ids[:2] == [None, None] and ids[2:] == sorted(ids[2:]) and len(ids) == 16
    assert [r.start for r in rows] == [sum(r.n_tokens for r in rows[:k]) for k in range(16)]
    texts = expected(awkward, tokenizer)
    assert sorted(r.ids_crc32 for r in rows) == sorted(
        zlib.crc32(raw([*v, 2])) for versions in texts.values() for v in versions
    )
    token_store.write_store(no_documents, str(tmp_path / "b"), tokenizer_path)
    assert token_store.read_documents(spark, str(tmp_path / "b")).collect() == []


def check_bpe(docs, rows, tokenizer):
    def summary(ids):
        decoded = tokenizer.decode(ids, skip_special_tokens=False)
        return len(ids), hashlib.sha256(raw(ids)).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()

    wanted = sorted((str(i), *summary(v)) for i, versions in expected(docs, tokenizer).items() for v in versions)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in rows) == wanted


@pytest.mark.parametrize("block_chars", [16_000_000, 20_000])
def test_word_table_of_the_whole_table(documents, tokenizer_path, tokenizer, block_chars):
    check_bpe(documents, bpe.encode_and_decode(documents, tokenizer_path, block_chars).collect(), tokenizer)


def test_word_table_of_awkward_rows(awkward, no_documents, tokenizer_path, tokenizer):
    rows = bpe.encode_and_decode(awkward, tokenizer_path, with_values=True).collect()
    check_bpe(awkward, rows, tokenizer)
    assert all(hashlib.sha256(r.decoded.encode()).hexdigest() == r.decoded_sha256 for r in rows)
    assert bpe.encode_and_decode(no_documents, tokenizer_path).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.integers(0, 400), st.integers(0, 2**32 - 1)), max_size=300))
def test_word_numbers_round_trip(values):
    numbers = np.array(values, dtype="<u4")
    assert bpe._unpacked_numbers(bpe._packed_numbers(numbers), len(values)).tolist() == values
    assert bpe._unpacked(bpe._packed(numbers)).tolist() == values


def test_frequent_words_stay_in_a_full_memory(tokenizer_path, tokenizer):
    """What comes again and again is asked for once, however many rare words pass by."""
    encoder = TextEncoder(tokenizer_path, max_known=200)
    asked = []
    ask = encoder._table.encode_plain
    encoder._table.encode_plain = lambda words: (asked.extend(words), ask(words))[1]
    for k in range(60):
        rare = "".join(chr(97 + int(d)) for d in str(1000 + k))
        text = f"the frequent words, {rare}x {rare}y {rare}z"
        assert encoder.encode(text) == raw(brute.tokens(tokenizer, text))
    assert asked.count("frequent") == 1 and len(asked) == len(set(asked)) > 180
    assert len(encoder._known) + len(encoder._older) <= 200
