"""The registered queries of this package: each operator on its whole table."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps
from io import BytesIO
from pathlib import Path
from zipfile import ZipFile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantflow.llm import (
    bpe,
    embeddings,
    exact_dedup,
    hard_negatives,
    minhash,
    packing,
    pii,
    quality,
    secret_scan,
    token_store,
    topk_search,
    url_templates,
    whitening,
)
from tenantflow.llm.inputs import default_tokenizer, read_table
from tenantflow.session import new_location, staged

#: The rules of the URL query.
URL_RULES = (
    url_templates.Rule("allow", "org", "/"),
    url_templates.Rule("block", "example.org", "/es/"),
    url_templates.Rule("block", "example.org", "/en/1"),
    url_templates.Rule("allow", "com", "/fr/"),
    url_templates.Rule("block", "com", "/de/"),
)

_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Give the workers of a session this package, once, wherever the driver was started.

    It goes through the shared folder as a zip file.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    content = BytesIO()
    with ZipFile(content, "w") as archive:
        for source in sorted(package.rglob("*.py")):
            archive.write(source, source.relative_to(package.parent).as_posix())
    path = f"{new_location(spark, 'package')}/{package.name}.zip"
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(target)
    stream.write(content.getvalue())
    stream.close()
    context.addPyFile(path)
    _shipped.add(context.applicationId)


def _shipping(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(query)
    def run(spark: SparkSession, folder: str) -> DataFrame:
        ship_package(spark)
        return query(spark, folder)

    return run


def op1_sum_of_squares_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack_documents(read_table(spark, folder, "documents"), default_tokenizer())


def op2_quality_trees(spark: SparkSession, folder: str) -> DataFrame:
    docs = read_table(spark, folder, "documents")
    model = quality.fit_quality(docs, read_table(spark, folder, "labels"))
    return quality.score_documents(docs, model)


def op3_addressable_codes(spark: SparkSession, folder: str) -> DataFrame:
    path = new_location(spark, "token-store")
    token_store.write_store(read_table(spark, folder, "documents"), path, default_tokenizer())
    return token_store.read_documents(spark, path)


def op4_secret_forest(spark: SparkSession, folder: str) -> DataFrame:
    candidates = staged(secret_scan.find_candidates(read_table(spark, folder, "documents")), "secret-candidates")
    model = secret_scan.fit_forest(secret_scan.label_findings(candidates))
    return secret_scan.score_candidates(candidates, model)


def op5_minhash_inverted_join(spark: SparkSession, folder: str) -> DataFrame:
    found = minhash.near_duplicates(read_table(spark, folder, "documents"))
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op6_distinct_word_bpe(spark: SparkSession, folder: str) -> DataFrame:
    return bpe.encode_and_decode(read_table(spark, folder, "documents"), default_tokenizer())


def op7_epsilon_grid_join(spark: SparkSession, folder: str) -> DataFrame:
    return embeddings.similar_vectors(read_table(spark, folder, "embeddings"))


def op8_tree_merge_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.exact_groups(read_table(spark, folder, "documents"))


def op9_anchor_pii(spark: SparkSession, folder: str) -> DataFrame:
    return pii.find_personal_data(read_table(spark, folder, "documents"))


def op10_path_template_tree(spark: SparkSession, folder: str) -> DataFrame:
    judged = url_templates.judge_urls(read_table(spark, folder, "pages"), URL_RULES)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op11_shared_list_negatives(spark: SparkSession, folder: str) -> DataFrame:
    rows = read_table(spark, folder, "embeddings")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.withColumn("label", moved), F.col("vec_id") % 50 == 0)


def op12_no_random_access(spark: SparkSession, folder: str) -> DataFrame:
    return topk_search.top_k(read_table(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


def op13_refined_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whitening.whiten(read_table(spark, folder, "embeddings"))


LLM_QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    query.__name__: _shipping(query)
    for query in (
        op1_sum_of_squares_packing,
        op2_quality_trees,
        op3_addressable_codes,
        op4_secret_forest,
        op5_minhash_inverted_join,
        op6_distinct_word_bpe,
        op7_epsilon_grid_join,
        op8_tree_merge_dedup,
        op9_anchor_pii,
        op10_path_template_tree,
        op11_shared_list_negatives,
        op12_no_random_access,
        op13_refined_whitening,
    )
}
