"""Searches and whitening of whole-number vectors, against brute force."""

from __future__ import annotations

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tenantflow.llm import hard_negatives, topk_search, vector_tiles, whitening

SCHEMA = "vec_id long, embedding array<float>, label int, ID string, x string, dims string, rank string, number string"


def is_query():
    return F.col("vec_id") % 50 == 0


def frame(spark, rows):
    return spark.createDataFrame([(*r, "i", "x", "d", "r", "n") for r in rows], SCHEMA)


def awkward_vectors() -> list[tuple]:
    """(vec_id, vector, label): clusters, ties, repeated rows and ids, bad values, lengths."""
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(4, 6))
    rows = [
        (i, (centres[i % 4] * rng.choice([0.2, 1.0]) + rng.normal(size=6) * 0.3).round(1).tolist(), int(rng.integers(3)))
        for i in range(260)
    ]
    rows += [(i, [1.0, 0.0, 0.0, 0.0, 0.0, 0.0], i % 2) for i in range(300, 330)]  # ties
    rows += [(400, [0.5] * 6, 1), (400, [0.5] * 6, 1), (401, [0.5] * 6, 1), (401, [0.5] * 6, 1)]  # repeated
    rows += [(450, [0.0] * 6, 1), (451, [0.0] * 6, 2), (452, [0.0] * 6, 1)]  # zero
    rows += [(500, None, 1), (501, [None] + [1.0] * 5, 1), (502, [float("nan")] * 6, 0), (503, [float("inf")] * 6, 0)]
    rows += [(None, [1.0] * 6, 1), (550, [1.0] * 6, None), (600, [], 1), (601, [], 1), (602, [], 2)]
    rows += [(650, [1.0, 2.0], 1), (651, [1.0, 1.9], 1), (652, [1.0, 1.2], 2)]
    rows += [(700, [1e6, -3e6, 2.0], 1), (701, [1e6, 3e6, 2.0], 1), (702, [2e6, 1e4, 1.0], 1), (703, [2e6, -1e4, 1.0], 2)]
    return rows


@pytest.fixture
def small_tiles(monkeypatch):
    """Blocks of 32 rows, bands of two blocks and groups of a few queries."""
    monkeypatch.setattr(vector_tiles, "BAND_BLOCKS", 2)
    monkeypatch.setattr(vector_tiles.blocks_of, "__defaults__", (False, 32))
    monkeypatch.setattr(vector_tiles.numbered_queries, "__defaults__", (3,))
    monkeypatch.setattr(hard_negatives, "_MEMBERS", 3)
    monkeypatch.setattr(hard_negatives, "_PIECE", 8)


def test_top_k_of_awkward_rows(spark, small_tiles):
    rows = awkward_vectors()
    found = topk_search.top_k(frame(spark, rows), is_query(), open_rows=4)
    assert found.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(map(tuple, found.collect())) == brute.top_k([r[:2] for r in rows])


def test_top_k_does_not_depend_on_tiles(spark):
    rows = awkward_vectors()
    found = topk_search.top_k(frame(spark, rows).repartition(7), is_query(), k=40, open_rows=300)
    assert sorted(map(tuple, found.collect())) == brute.top_k([r[:2] for r in rows], 40)


def test_hard_negatives_of_awkward_rows(spark, small_tiles):
    rows = awkward_vectors()
    found = hard_negatives.hard_negatives(frame(spark, rows), is_query())
    assert found.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    assert sorted(map(tuple, found.collect())) == brute.hard_negatives(rows)


def test_searches_of_nothing(spark):
    empty = frame(spark, [])
    assert topk_search.top_k(empty, is_query()).collect() == []
    assert hard_negatives.hard_negatives(empty, is_query()).collect() == []
    assert whitening.whiten(empty).collect() == []
    no_query = frame(spark, [(1, [1.0, 2.0], 1), (2, [1.0, 2.0], 1), (3, None, 1)])
    assert topk_search.top_k(no_query, is_query()).collect() == []
    assert hard_negatives.hard_negatives(no_query, is_query()).collect() == []
    alone = frame(spark, [(50, [1.0, 2.0], 1)])
    assert topk_search.top_k(alone, is_query()).collect() == []
    assert hard_negatives.hard_negatives(alone, is_query()).collect() == []


def test_scores_beyond_long_are_cut(spark):
    rows = [(0, [1e30, 1.0], 1), (1, [1e30, 0.0], 1), (2, [-1e30, 0.0], 1)]
    found = topk_search.top_k(frame(spark, rows), is_query()).collect()
    assert [(r.rank, r.vec_id, r.score) for r in found] == [(1, 1, 2**63 - 1), (2, 2, -(2**63) + 1)]


def test_lists_are_not_read_to_the_end():
    """Rows far from the query are never known in full, and the rest is found all the same."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=(400, 4)).round(2) * 100
    x[:, 0] += np.where(np.arange(400) < 6, 2000, 0)
    x = x.astype(np.int64)
    lists = np.argsort(x, axis=0, kind="stable").T.astype(np.uint16)
    block = vector_tiles.Block(np.arange(400), np.zeros(400, np.int64), x, lists)
    query = vector_tiles.Group(np.array([7]), np.array([-1]), np.array([0]), np.array([[90, 1, -2, 3]]), [None])
    reader = topk_search.ListReader(query, 5, open_rows=8)
    looked_up = []
    keep = reader._keep
    reader._keep = lambda query, ids, scores: (looked_up.extend(ids.tolist()), keep(query, ids, scores))
    reader.read(block)
    scores = x @ np.array([90, 1, -2, 3])
    assert set(reader.ids.tolist()) == set(np.argsort(-scores, kind="stable")[:5].tolist())
    assert set(looked_up) <= set(range(6))


def test_walk_ends_before_the_list():
    rng = np.random.default_rng(2)
    near, far = rng.normal(size=(300, 8)) * 3 + 100, rng.normal(size=(3000, 8)) * 3 - 100
    x = np.concatenate([near, far]).astype(np.int64)
    block = vector_tiles.Block(np.arange(len(x)), np.zeros(len(x), np.int64), x, None)
    members = vector_tiles.Group(
        np.arange(4), np.arange(-4, 0), np.zeros(4, np.int64), x[:4], [[list(hard_negatives._ALL)]] * 4
    )
    walker = hard_negatives.Walker(members, 5, same_label=True)
    met = []
    take = walker._take
    walker._take = lambda open_, rows, block: (met.extend(rows.tolist()), take(open_, rows, block))
    walker.read(block)
    assert max(met) < 600 and len(met) <= 2 * hard_negatives._PIECE
    number, _, _, ids, _ = walker.finish()
    for member in range(4):
        wanted = np.argsort(-(x @ x[member]), kind="stable")[:5]
        assert ids[number == member].tolist() == wanted.tolist()


def check_whitened(rows, found):
    """``rows`` are (vec_id, vector) of one length, with ids of their own."""
    x = {i: brute.whole(v) for i, v in rows if brute.whole(v)}
    fit = np.array(sorted(set(map(tuple, x.values()))), dtype=np.float64)
    n, sums = len(fit), fit.sum(axis=0)
    centred = fit - sums / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    by = {(r.vec_id, r.component): r for r in found}
    wanted = min(4, fit.shape[1])
    assert set(by) == {(i, k + 1) for i in x for k in range(wanted)}
    for k in range(wanted):
        value, vector = values[::-1][k], vectors[:, ::-1][:, k]
        mine = np.array([by[i, k + 1].whitened for i in x])
        theirs = (np.array(list(x.values())) - sums / n) @ vector / np.sqrt(value)
        assert np.abs(np.abs(mine) - np.abs(theirs)).max() < 1e-9 and abs(abs(mine @ theirs) / (mine @ mine) - 1) < 1e-9
    for (i, k), r in by.items():
        assert r.n == n
        assert r.deviation == sum((n * int(c) - int(s)) ** 2 for c, s in zip(x[i], sums, strict=True))
        assert abs(r.explained / (values[::-1][k - 1] / values.sum()) - 1) < 1e-9
        assert r.identity_error < 1e-9


def test_whitening(spark):
    rng = np.random.default_rng(5)
    mix = rng.normal(size=(7, 7))
    rows = [(i, (rng.normal(size=7) @ mix).tolist(), 0) for i in range(500)]
    rows += [(1000 + i, rows[0][1], 0) for i in range(300)] + [(2000, None, 0), (2001, [None] * 7, 0)]
    rows += [(2002, [float("nan")] * 7, 0)]
    found = whitening.whiten(frame(spark, rows).repartition(5)).collect()
    check_whitened([r[:2] for r in rows], found)


def test_whitening_by_length_and_without_variance(spark):
    rows = [(1, [1.0, 2.0], 0), (2, [1.0, 3.0], 0), (3, [2.0, 0.5], 0), (3, [2.0, 0.5], 0), (4, [], 0)]
    rows += [(5, [1.0, 2.0, 3.0], 0), (None, [1.0, 2.0, 3.0], 0), (6, [5.0], 0), (7, [6.0], 0)]
    found = whitening.whiten(frame(spark, rows)).collect()
    by = {}
    for r in found:
        by.setdefault(r.vec_id, []).append(r)
    assert {k: len(v) for k, v in by.items()} == {1: 2, 2: 2, 3: 4, 5: 3, None: 3, 6: 1, 7: 1}
    check_whitened([r[:2] for r in rows[:3]], by[1] + by[2] + by[3])
    # One distinct vector: nothing varies.
    assert all(r.n == 1 and r.whitened is None and r.explained is None and r.deviation == 0 for r in by[5] + by[None])
    assert sorted(r.whitened for r in by[6] + by[7]) == [-1.0, 1.0]


def test_whitening_of_constant_dimension_and_great_values(spark):
    rows = [(i, [float(i), 2.0 * i, 4.0], 0) for i in range(40)]
    found = whitening.whiten(frame(spark, rows)).collect()
    assert all((r.whitened is None) == (r.component > 1) for r in found)
    assert all(r.identity_error < 1e-9 for r in found)
    great = whitening.whiten(frame(spark, [(1, [1e30, 1.0], 0), (2, [-1e30, 5.0], 0)])).collect()
    assert all(r.deviation is None and r.n == 2 for r in great)


@pytest.mark.parametrize(
    "values",
    [[1, 1 + 1e-9, 1 + 2e-9, 5, 5, 7, 8, 9], [1] * 8, [0] * 6 + [3, 3 + 1e-12], list(np.linspace(1, 2, 64)), [2], [0, 0],
     [1 + 1e-7 * k for k in range(20)] + [1e-8, 3e-8]],
)
def test_refined_eigenvectors(values):
    values = np.array(values, dtype=np.float64)
    turn = np.linalg.qr(np.random.default_rng(len(values)).normal(size=(len(values),) * 2))[0]
    a = (turn * values) @ turn.T
    a = (a + a.T) / 2
    found, vectors = whitening.refined_eigenvectors(a)
    assert np.abs(found - np.sort(values)[::-1]).max() < 1e-14 * max(values.max(), 1)
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-14
    assert np.abs(a @ vectors - vectors * found).max() < 1e-14 * max(values.max(), 1)


def test_refinement_beats_single_precision():
    a = np.cov(np.random.default_rng(8).normal(size=(64, 900)))
    found, vectors = whitening.refined_eigenvectors(a)
    rough = np.linalg.eigh(a.astype(np.float32))[1].astype(np.float64)
    assert np.abs(a @ vectors - vectors * found).max() < 1e-14
    assert np.abs(rough.T @ a @ rough - np.diag(np.diag(rough.T @ a @ rough))).max() > 1e-9
