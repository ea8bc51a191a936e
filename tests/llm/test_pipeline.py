"""The pipeline's stages, each against a plain version on its own input."""

from __future__ import annotations

from collections import defaultdict

import brute

import __spark_entry__ as registered
import corpus_pipeline
from tenantflow.llm import quality

FOLDER = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path, tokenizer):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, FOLDER).write.parquet(str(tmp_path / name))
        before, docs = docs, spark.read.parquet(str(tmp_path / name))
        kept[name] = (before, docs)
    assert all(after.columns == columns for _, after in list(kept.values())[:-1])
    rows = {name: ([r.asDict() for r in a.collect()], [r.asDict() for r in b.collect()]) for name, (a, b) in kept.items()}

    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    before, after = rows["quality_classifier"]
    model = quality.fit_quality(kept["quality_classifier"][0], labels)
    scores = model.score(quality.statistics_of([r["text"] or "" for r in before]))
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r, s in zip(before, scores) if s >= 0.3)
    bad = {r.doc_id for r in labels.where("quality = 0").collect()}
    assert sum(r["doc_id"] in bad for r in after) < 0.2 * sum(r["doc_id"] in bad for r in before)

    before, after = rows["exact_duplicates"]
    keep = {k for k, _, _ in brute.exact_groups([(r["doc_id"], r["text"]) for r in before]).values()}
    assert sorted(r["doc_id"] for r in after) == sorted(keep)

    before, after = rows["near_duplicates"]
    keep = {c for _, c in brute.near_groups([(r["doc_id"], r["text"]) for r in before]).values()}
    assert sorted(r["doc_id"] for r in after) == sorted(keep)

    before, after = rows["personal_data"]
    assert sorted(r["doc_id"] for r in after) == sorted(r["doc_id"] for r in before)
    assert all(brute.base_spans(r["text"]) == "" for r in after)

    before, after = rows["pack"]
    pieces = defaultdict(list)
    for r in after:
        pieces[r["doc_id"]].append((r["start"], bytes(r["ids"])))
    for r in before:
        ids = b"".join(raw for _, raw in sorted(pieces[r["doc_id"]]))
        assert ids == b"".join(k.to_bytes(4, "little") for k in [*brute.tokens(tokenizer, r["text"]), 2])


def test_registered():
    queries = registered.queries()
    assert "pipeline" in queries
    assert all(any(name.startswith(f"op{n}_") for name in queries) for n in range(1, 11))
    assert corpus_pipeline.ORACLE_SQL is None
