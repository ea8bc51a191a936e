"""Exact and near duplicates of texts, and similar vectors, against brute force."""

from __future__ import annotations

import random
from itertools import combinations

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tenantflow.llm import components, embeddings, exact_dedup, minhash
from tenantflow.llm.components import connected_components

FOLDER = "/root/testdata/sf0.01"


def with_ids(rows):
    return [r for r in rows if r.doc_id is not None]


def test_exact_groups_of_awkward_rows(awkward, no_documents):
    rows = exact_dedup.exact_groups(awkward).collect()
    assert len(rows) == 16
    found = {r.doc_id: (r.keep_id, r.group_size, r.kept) for r in with_ids(rows)}
    # Null, empty and white space are equal; the longest one stays.
    assert found[1] == (3, 4, False) and found[2] == (3, 4, False) and found[3] == (3, 4, True)
    # Two rows of id 13 are the same identifier; the text of 11 and 12 is another.
    assert found[13] == (13, 2, True)
    assert found[11] == (11, 2, True) and found[12] == (11, 2, False)
    assert found[8] == (8, 1, True)
    nulls = [(r.keep_id, r.group_size, r.kept) for r in rows if r.doc_id is None]
    assert sorted(nulls, key=str) == [(3, 4, False), (None, 1, True)]
    assert exact_dedup.exact_groups(no_documents).collect() == []


def test_first_of_each_keeps_columns(awkward, no_documents):
    stay = exact_dedup.first_of_each(awkward)
    assert stay.columns == awkward.columns
    assert sorted(str(r.doc_id) for r in stay.collect()) == sorted(
        ["3", "4", "5", "6", "7", "8", "9", "10", "11", "13", "None"]
    )
    assert exact_dedup.first_of_each(no_documents).collect() == []


@pytest.mark.parametrize("slots", [1, 8, 9, 500])
def test_merge_rounds_do_not_depend_on_slots(spark, slots):
    rng = random.Random(slots)
    rows = [(k, rng.choice("abcdefgh") * rng.randint(0, 3)) for k in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    merged = exact_dedup.merge_runs(exact_dedup.text_digests(docs), slots).collect()
    wanted = {(keep, size) for keep, size, _ in brute.exact_groups(rows).values()}
    assert {(r.best.doc_id, r.n) for r in merged} == wanted and len(merged) == len(wanted)


@pytest.mark.parametrize("slots, rounds", [(1, 1), (8, 1), (9, 2), (500, 3)])
def test_runs_lie_in_slots_and_move_to_partners_only(spark, slots, rounds):
    docs = spark.createDataFrame([(k, f"t{k % 50}") for k in range(400)], "doc_id long, text string").repartition(5)
    merged = exact_dedup.merge_runs(exact_dedup.text_digests(docs), slots)
    plan = merged._jdf.queryExecution().executedPlan().toString().lower()
    # One exchange by slot for the first runs and for each round, and none by digest.
    assert plan.count("exchange shufflepartitionidpassthrough") == rounds + 1
    assert "hashpartitioning" not in plan and plan.count("exchange ") == rounds + 2  # and the test's own
    assert merged.count() == 50
    # At the end a slot holds the digests whose bits are its number, and no other.
    placed = merged.select(F.spark_partition_id().alias("p"), (F.crc32("digest") % 8**rounds).alias("bits"))
    with_slots = placed.distinct().collect()
    assert all(r.p == r.bits for r in with_slots)


def check_near(rows, found):
    wanted = brute.near_groups(rows)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in found} == wanted
    assert all(r.kept == (r.doc_id == r.component_id) for r in found)


def edited(rng, words, vocabulary, edits):
    words = list(words)
    for _ in range(edits):
        words[rng.randrange(len(words))] = rng.choice(vocabulary)
    return " ".join(words)


@pytest.fixture(scope="module")
def copies():
    """A large group of near copies of all similarities, chains, and a shared passage."""
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(3000)]
    base = rng.choices(vocabulary, k=200)
    rows = [edited(rng, base, vocabulary, k % 12) for k in range(120)]
    chain = rng.choices(vocabulary, k=120)
    for _ in range(15):
        rows.append(" ".join(chain))
        chain = chain[4:] + rng.choices(vocabulary, k=4)
    passage = " ".join(rng.choices(vocabulary, k=60))
    rows += [" ".join(rng.choices(vocabulary, k=rng.randint(5, 150))) + " " + passage for _ in range(150)]
    rows += [rows[0]] * 30 + ["", "a", "a b c d", "A b c  d", "a b c d e", None]
    rng.shuffle(rows)
    return list(enumerate(rows))


@pytest.mark.parametrize("posting_rows", [2048, 16])
def test_near_duplicates_of_copies(spark, copies, monkeypatch, posting_rows):
    monkeypatch.setattr(minhash, "POSTING_ROWS", posting_rows)
    docs = spark.createDataFrame(copies, "doc_id long, text string").repartition(5)
    check_near(copies, minhash.near_duplicates(docs).collect())


def test_nodes_of_different_labels_meet_once(spark, monkeypatch):
    """Posting 1 has a large component and a few others, 2 one component, 3 is small."""
    monkeypatch.setattr(minhash, "POSTING_ROWS", 4)
    roots = {n: 0 for n in range(1, 30)} | {31: 30, 33: 32}
    tokens = {1: range(40), 2: range(30), 3: [5, 31, 35]}
    prefix = {n: [(9, t) for t in tokens if n in tokens[t]] for n in range(40)}
    payload = spark.createDataFrame(
        [(n, 1, prefix[n], 7, [0], b"") for n in prefix],
        "node long, n_shingles long, prefix array<struct<often long, token long>>, mask long, "
        "signature array<int>, sketch binary",
    )
    labels = spark.createDataFrame(sorted(roots.items()), "node long, root long")
    cells, sizes = {}, {}
    for r in minhash._mixed_postings(payload, labels).collect():
        assert r.label == roots.get(r.node, r.node)
        cells.setdefault((r.token, r.lo, r.hi), []).append((r.node, r.block))
    met = []
    for (token, lo, hi), members in cells.items():
        for (x, at_x), (y, at_y) in combinations(sorted(members), 2):
            if roots.get(x, x) != roots.get(y, y) and (lo == hi or at_x != at_y):
                met.append((token, x, y))
    wanted = [(t, x, y) for t in (1, 3) for x, y in combinations(sorted(tokens[t]), 2) if roots.get(x, x) != roots.get(y, y)]
    assert sorted(met) == sorted(wanted)
    main = {n for n in tokens[1] if roots.get(n, n) == 0}
    assert not any({n for n, _ in members} <= main for members in cells.values())


def test_near_duplicates_without_broadcast(spark, copies, monkeypatch):
    monkeypatch.setattr(minhash, "BROADCAST_KEYS", -1)
    docs = spark.createDataFrame(copies, "doc_id long, text string")
    check_near(copies, minhash.near_duplicates(docs).collect())


def test_near_duplicates_of_awkward_rows(awkward, no_documents):
    rows = minhash.near_duplicates(awkward).collect()
    assert len(rows) == 16
    found = {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in with_ids(rows)}
    assert found[1] == (0, 1, True) and found[3] == (0, 3, True)
    assert found[4] == (1, 4, True) and found[5] == (1, 4, False)
    assert found[7][1] == 6 and found[13][1] == 11 and found[12][1] == 11
    stay = minhash.one_of_each(awkward)
    assert stay.columns == awkward.columns
    left = [r.doc_id for r in stay.collect()]
    assert sorted(map(str, left)) == sorted(map(str, [1, 2, 3, 4, 6, 8, 9, 10, 11, None, None]))
    assert minhash.near_duplicates(no_documents).collect() == []
    assert minhash.one_of_each(no_documents).collect() == []


@settings(max_examples=100, deadline=None)
@given(st.lists(st.one_of(st.none(), st.text(alphabet="aAbé \t\n\x0b ", max_size=40)), max_size=8))
def test_shingle_hashes_follow_words(texts):
    hasher = minhash.ShingleHasher()
    for kind in (pa.string(), pa.large_string()):
        found = list(hasher.sets(pa.array(["pad", *texts], kind).slice(1)))
        wanted = [brute.shingles(t) for t in texts]
        assert [len(f) for f in found] == [len(w) for w in wanted]
        for a, x in zip(found, wanted):
            for b, y in zip(found, wanted):
                assert (a.tolist() == b.tolist()) == (x == y)


@settings(max_examples=100, deadline=None)
@given(st.integers(1, 3000), st.integers(0, 1000), st.integers(0, 1000))
def test_parity_sketch_is_a_lower_bound(common, more_a, more_b):
    rng = np.random.default_rng(common)
    both, a, b = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (common, more_a, more_b))
    x, y = (
        np.frombuffer(minhash.parity_sketch(np.concatenate([both, own])), np.uint64)[None, :] for own in (a, b)
    )
    size = min(x.shape[1], y.shape[1])
    ones = int(np.bitwise_count(minhash._folded(x, size) ^ minhash._folded(y, size)).sum())
    assert ones <= more_a + more_b


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(250)] + [(k, k + 1) for k in range(500, 700)]
    links += [(3, 3), (3, 3), (900, 901), (901, 900)]
    wanted = brute.roots({n for link in links for n in link}, links)
    found = connected_components(spark.createDataFrame([*links, (None, 5)], "a long, b long")).collect()
    assert {r.node: r.root for r in found} == {n: r for n, r in wanted.items() if n != r}
    assert connected_components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_links_of_a_hub_stay_where_they_are(spark):
    """The join of the hub's links is a broadcast of its one row, however large the rest is."""
    links = spark.range(1, 5000).select(F.col("id").alias("u"), (F.col("id") % 1).alias("v"))
    chain = spark.range(6000, 9000).select((F.col("id") + 1).alias("u"), F.col("id").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = connected_components(links.union(chain))
        assert found.groupBy("root").count().orderBy("root").collect() == [(0, 4999), (6000, 3000)]
        hub = links.select(F.col("v").alias("u"), F.col("u").alias("v"))
        plan = components._to_smallest(hub, 4999)._jdf.queryExecution().toString()
        assert "BroadcastHashJoin" in plan and components._to_smallest(hub, 4999).where("m <> 0").isEmpty()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def clusters(seed, dims=12):
    rng = np.random.default_rng(seed)
    rows = []
    for _ in range(6):
        centre = rng.normal(size=dims)
        for width in (0.0, 0.01, 0.08, 0.12, 0.3):
            rows += [(centre + width * rng.normal(size=dims)).tolist() for _ in range(12)]
    rows += [rng.normal(size=dims).tolist() for _ in range(100)]
    return rows


@pytest.mark.parametrize("block_rows", [None, 50, 7])
def test_vectors(spark, block_rows):
    rows = clusters(1)
    rows += [None, [], [0.0] * 12, [1.0] * 11 + [None], [float("nan")] + [1.0] * 11, [float("inf")] * 12]
    rows += [[1.0, 0.0], [2.0, 0.0], [2.0, 0.3], [1e-300] * 12, [1e300] * 12]
    rows = list(enumerate(rows))
    frame = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], "vec_id long, embedding array<double>, node string, label int")
    found = embeddings.similar_vectors(frame.repartition(5), block_rows=block_rows).collect()
    wanted = brute.similar_vectors([r for r in rows if r[0] < len(rows) - 2])
    assert {r.vec_id: (r.n_links, r.component_id) for r in found if r.vec_id < len(rows) - 2} == wanted
    tiny, huge = (next(r for r in found if r.vec_id == len(rows) - k) for k in (2, 1))
    assert tiny.n_links == huge.n_links >= 1 and tiny.component_id == huge.component_id


def test_vectors_repeated_and_empty(spark):
    frame = spark.createDataFrame(
        [(2, [1.0, 0.0]), (2, [1.0, 0.0]), (None, [3.0, 0.0]), (1, None)], "vec_id int, embedding array<float>"
    )
    found = sorted((str(r.vec_id), r.n_links, r.component_id, r.kept) for r in embeddings.similar_vectors(frame).collect())
    assert found == [("1", 0, 1, True), ("2", 2, 2, True), ("2", 2, 2, True), ("None", 2, 2, False)]
    assert embeddings.similar_vectors(frame.limit(0)).collect() == []


def test_many_partitions_do_not_make_more_blocks(spark):
    rng = np.random.default_rng(3)
    nodes = [(i, 1, v.tobytes()) for i, v in enumerate(rng.normal(size=(300, 3)))]
    frame = spark.createDataFrame(nodes, "node long, weight long, vector binary")
    spark.conf.set("spark.sql.shuffle.partitions", "37")
    try:
        blocks = embeddings._blocks(frame, len(nodes), np.eye(3)[:, :2], 0.3, 32).orderBy("block").collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert [(r.block, len(r.nodes) // 8) for r in blocks] == [*((k, 32) for k in range(9)), (9, 12)]
    ids = np.concatenate([np.frombuffer(r.nodes, np.int64) for r in blocks])
    vectors = np.concatenate([np.frombuffer(r.vectors, np.float64).reshape(-1, 3) for r in blocks])
    assert all((vectors[k] == np.frombuffer(nodes[i][2])).all() for k, i in enumerate(ids))
    cells = [tuple(np.floor(v[:2] / 0.3)) + (i,) for i, v in zip(ids, vectors)]
    assert sorted(ids) == list(range(300)) and cells == sorted(cells)


def test_links_of_a_dense_block_fold_into_a_forest():
    rng = np.random.default_rng(4)
    a = np.repeat(rng.normal(size=(3, 5)), 300, axis=0)[rng.permutation(900)]
    a /= np.linalg.norm(a, axis=1)[:, None]
    weights = rng.integers(1, 4, 900)
    near = a @ a.T >= 0.95
    np.fill_diagonal(near, False)
    links, roots = embeddings._links_of_blocks(a, a, (weights, weights), True, 0.95, np.eye(5)[:, :2], 0.4)
    assert (links == near @ weights).all()
    assert (roots == [min(np.flatnonzero(row).min(initial=k), k) for k, row in enumerate(near)]).all()
    b = a[:400]
    links, roots = embeddings._links_of_blocks(a, b, (weights, weights[:400]), False, 0.95, np.eye(5)[:, :2], 0.4)
    met = a @ b.T >= 0.95
    assert (links == np.concatenate([met @ weights[:400], weights @ met])).all()
    assert all(roots[i] == roots[900 + j] for i, j in zip(*np.nonzero(met)))


def test_hashing_takes_little_memory_beside_the_texts():
    import tracemalloc

    import pyarrow as pa

    from tenantflow.llm.minhash import ShingleHasher

    texts = pa.array([" ".join(f"w{n}" for n in range(k, k + 2000)) for k in range(400)])
    tracemalloc.start()
    assert sum(len(found) for found in ShingleHasher().sets(texts)) == 400 * 1996
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 30e6
