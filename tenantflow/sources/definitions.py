"""Job definitions from a folder tree.

``<org_code>/<mode>/<job>/`` holds ``meta.json`` and any number of
``query_sql.N.sql``, ``pre_sql.N.sql`` and ``session_sql.N.sql``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tenantflow.model import DEFAULT_FETCH_SIZE, JOB_META_SCHEMA, JOB_MODES

_PATH = (
    r"/([^/]+)/(" + "|".join(JOB_MODES) + r")/([^/]+)/"
    r"(meta\.json|(pre_sql|query_sql|session_sql)\.(\d+)\.sql)$"
)


def _statements(kind: str) -> Column:
    """Statements of one kind, by the number in the file name."""
    numbered = F.collect_list(F.when(F.col("kind") == kind, F.struct("number", "value")))
    return F.transform(F.array_sort(numbered), lambda s: s.getField("value")).alias(kind)


def scan_definitions(spark: SparkSession, root: str) -> DataFrame:
    """One row per job folder with a ``meta.json``."""
    files = spark.read.text(root, wholetext=True, recursiveFileLookup=True).select(
        "value", F.url_decode(F.replace("_metadata.file_path", F.lit("+"), F.lit("%2B"))).alias("p")
    )

    def part(n: int) -> Column:
        return F.regexp_extract("p", _PATH, n)

    parts = files.select(
        part(1).alias("org_code"),
        part(2).alias("mode"),
        part(3).alias("name"),
        F.when(part(4) == "meta.json", "meta").otherwise(part(5)).alias("kind"),
        part(6).try_cast("int").alias("number"),
        "value",
    ).filter(F.col("org_code") != "")
    meta = F.max(F.when(F.col("kind") == "meta", F.col("value")))
    jobs = (
        parts.groupBy("org_code", "mode", "name")
        .agg(
            F.from_json(meta, JOB_META_SCHEMA).alias("meta"),
            _statements("query_sql"),
            _statements("pre_sql"),
            _statements("session_sql"),
            meta.isNotNull().alias("has_meta"),
        )
        .filter("has_meta")
    )

    def setting(name: str, default: Column) -> Column:
        return F.coalesce(F.col("meta").getField(name), default).alias(name)

    no_text = F.array().cast("array<string>")
    increment = F.col("meta.increment_config")
    return jobs.select(
        "org_code",
        "mode",
        "name",
        "query_sql",
        "pre_sql",
        "session_sql",
        setting("target_tables", no_text),
        setting("target_columns", no_text),
        setting("fetch_size", F.lit(DEFAULT_FETCH_SIZE)),
        setting("task_priority", F.lit(0)),
        F.when(
            increment.remote_field.isNotNull() & increment.local_field.isNotNull(), increment
        ).alias("increment_config"),
        setting("preferred_db_config_name", F.lit("default")),
    )
