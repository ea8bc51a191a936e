"""Secrets in texts, with a random forest that removes false positives.

Candidates are the values after the names of credentials, of any length and alphabet, and
runs of at least 12 letters, digits, ``_ - + / . @`` with a digit, or of at least 16 without
digits but with two distinct letters, so addresses, numbers, file names and long words are
among them. A shorter run that no name stands before is no candidate. A value stands behind up to six
blanks, quotes, ``= : >`` on the name's line. In double quotes, single quotes or backticks it
reaches to the next such quote of the line; else to white space, a double quote or a backtick,
less closing marks at its end. Each candidate has features: its length, shares and transitions
of kinds of characters, entropy, how much of it dictionary words cover, words of its path, and
the words next to it. The forest learns from labelled findings and gives every candidate the
probability of being a secret.

Only DataFrame functions and the forest of ``pyspark.ml`` are used; no Python runs in
tasks. ``label_findings`` gives labels where no reviewed findings exist: what stands after
the name of a credential, or has the form of an access key, is one.

Rows: one for each candidate of each row. A null or empty text has none. Repeated rows and
ids give repeated findings. The path is the column ``path_column``, if there is one; null
counts as empty. With labels of one class only, or none, that class's share (or a half) is
every candidate's score. Other columns are ignored.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.llm.inputs import text_hash
from tenantflow.session import staged

#: Names of credentials, words of made-up values, words of identifiers.
CREDENTIAL_NAMES = ("password", "passwd", "pwd", "secret", "token", "api_key", "apikey", "access_key", "key", "auth")
PLACEHOLDERS = ("example", "sample", "test", "dummy", "fake", "xxxx", "your", "changeme", "placeholder", "1234")
DICTIONARY = (
    "user", "name", "admin", "file", "image", "page", "index", "data", "value", "config", "default", "service",
    "server", "client", "local", "public", "private", "account", "system", "module", "version", "build", "release",
    "the", "and", "tion", "ing", "der", "die", "und", "ung", "que", "les", "los", "ment", "heit", "keit", "ción",
)

_SEPARATOR = "[ \\t\"'`=:>]"


def _behind_names() -> str:
    """Looks back at a credential's name and one to six separators; each part has a fixed width."""
    lengths = sorted({len(name) for name in CREDENTIAL_NAMES})
    last = "".join(sorted({name[-1] + name[-1].upper() for name in CREDENTIAL_NAMES}))
    found = []
    for width in range(1, 7):
        gap = f"{_SEPARATOR}{{{width}}}"
        names = (
            "|".join(
                "".join(f"[{c}{c.upper()}]" if c.isalpha() else c for c in name)
                for name in CREDENTIAL_NAMES
                if len(name) == length
            )
            for length in lengths
        )
        found.append(f"(?<=[{last}]{gap})(?:" + "|".join(f"(?<=(?:{n}){gap})" for n in names) + ")")
    return f"(?<={_SEPARATOR})(?!{_SEPARATOR})(?:{'|'.join(found)})"


def _quoted(quote: str) -> str:
    return rf"(?<={quote})(?:[^{quote}\\\r\n]|\\[^\r\n])++(?={quote})"


#: Java and Python syntax; the end of a run is no full stop.
CANDIDATE = (
    _behind_names()
    + "(?:"
    + "|".join(_quoted(quote) for quote in "\"'`")
    + r"""|[^ \t\n\x0b\f\r"`]*[^ \t\n\x0b\f\r"'`.,;)\]}>])"""
    + r"|(?<![A-Za-z0-9_+/.@-])"
    + r"(?:(?=[A-Za-z_+/.@-]*[0-9])[A-Za-z0-9_+/.@-]{12,}"
    + r"|(?=[_+/.@-]*([A-Za-z])(?:[_+/.@-]|\1)*+[A-Za-z])[A-Za-z_+/.@-]{16,})(?<!\.)"
)

_CONTEXT = 60


class SecretModel(NamedTuple):
    """A forest, or a constant score where there was nothing to learn."""

    forest: RandomForestClassificationModel | None
    constant: float


def find_candidates(docs: DataFrame, path_column: str | None = "source") -> DataFrame:
    """doc_id, start and length (code points), value, before, after, path of each candidate."""
    path = F.col(path_column) if path_column in docs.columns else F.lit("")
    gaps, values = F.split("text", CANDIDATE, -1), F.regexp_extract_all("text", F.lit(CANDIDATE), F.lit(0))
    # Where a candidate starts: behind all gaps and candidates before it.
    ends = F.aggregate(
        F.arrays_zip(F.col("gaps").alias("gaps"), F.col("values").alias("values")),
        F.array(F.lit(0)),
        lambda all_ends, x: F.concat(
            all_ends,
            F.array(F.element_at(all_ends, -1) + F.length(x["gaps"]) + F.coalesce(F.length(x["values"]), F.lit(0))),
        ),
    )
    return (
        docs.select("doc_id", "text", F.coalesce(path.cast("string"), F.lit("")).alias("path"))
        .where(F.col("text").rlike(CANDIDATE))
        .select("doc_id", "path", gaps.alias("gaps"), values.alias("values"))
        .withColumn("ends", ends)
        .select("doc_id", "path", "gaps", "values", "ends", F.posexplode("values").alias("k", "value"))
        .select(
            "doc_id",
            (F.get("ends", F.col("k")) + F.length(F.get("gaps", F.col("k")))).cast("long").alias("start"),
            F.length("value").cast("long").alias("length"),
            "value",
            F.right(
                F.concat(F.coalesce(F.get("values", F.col("k") - 1), F.lit("")), F.get("gaps", F.col("k"))),
                F.lit(_CONTEXT),
            ).alias("before"),
            F.left(F.get("gaps", F.col("k") + 1), F.lit(_CONTEXT)).alias("after"),
            "path",
        )
    )


def _any_of(words: tuple[str, ...]) -> str:
    return "|".join(words)


def _features() -> dict[str, Column]:
    value, before, after = F.col("value"), F.lower("before"), F.lower("after")
    length = F.length(value)

    def share(pattern: str) -> Column:
        return F.regexp_count(value, F.lit(pattern)) / length

    characters = F.filter(F.split(value, ""), lambda c: c != "")
    entropy = F.aggregate(
        F.transform(
            F.array_distinct(characters),
            lambda c: (length - F.length(F.replace(value, c, F.lit("")))) / length,
        ),
        F.lit(0.0),
        lambda total, p: total - p * F.log2(p),
    )
    covered = length - F.length(F.regexp_replace(F.lower(value), _any_of(DICTIONARY + PLACEHOLDERS), ""))
    last_word = F.regexp_extract(before, r"([a-z_]+)[^a-z]*$", 1)
    return {
        "f_length": length.cast("double"),
        "f_digits": share("[0-9]"),
        "f_upper": share("[A-Z]"),
        "f_lower": share("[a-z]"),
        "f_marks": share("[_+/-]"),
        "f_dots": share("[.@]"),
        "f_other": share("[^A-Za-z0-9_+/.@-]"),
        "f_hex": share("[0-9a-f]"),
        "f_letter_to_digit": share("[A-Za-z](?=[0-9])"),
        "f_digit_to_letter": share("[0-9](?=[A-Za-z])"),
        "f_case_changes": share("[a-z](?=[A-Z])|[A-Z](?=[a-z])"),
        "f_vowel_pairs": share("[aeiouAEIOU](?=[^aeiouAEIOU0-9])"),
        "f_repeats": share(r"(.)(?=\1)"),
        "f_entropy": entropy,
        "f_dictionary": covered / length,
        "f_placeholder": F.lower(value).rlike(_any_of(PLACEHOLDERS)).cast("double"),
        "f_path_depth": F.regexp_count("path", F.lit("[/\\\\]")).cast("double"),
        "f_path_test": F.lower("path").rlike("test|example|sample|fixture|mock").cast("double"),
        "f_named": last_word.rlike(f"({_any_of(CREDENTIAL_NAMES)})$").cast("double"),
        "f_assigned": before.rlike(r"[=:]\s*[\"']?$").cast("double"),
        "f_quoted": (before.rlike("[\"'`]$") & after.rlike("^[\"'`]")).cast("double"),
        "f_in_url": before.rlike(r"://\S*$").cast("double"),
        "f_alone": (before.rlike(r"(^|\s)$") & after.rlike(r"^(\s|$)")).cast("double"),
        "f_word_before": F.length(last_word).cast("double"),
        "f_word_after": F.length(F.regexp_extract(after, r"^[^a-z]*([a-z]*)", 1)).cast("double"),
    }


def with_features(candidates: DataFrame) -> DataFrame:
    features = _features()
    measured = candidates.withColumns(features)
    return VectorAssembler(inputCols=list(features), outputCol="features").transform(measured)


def label_findings(candidates: DataFrame) -> DataFrame:
    """``candidates`` with ``label``: 1.0 for what is known to be a secret, else 0.0.

    Words after a name are known only behind ``=`` or a quote, or from 16 characters on after
    a colon; other short values only behind ``=``, a colon or a quote.
    """
    before, length = F.col("before"), F.length("value")
    words = F.col("value").rlike(r"^[(\[]?[\p{L}_+/.'’-]+$")
    strong = before.rlike("(=[\\s>]*|[\"'`])$")
    assigned = strong | before.rlike(r"[=:][\s>]*$")
    certain = F.when(words, strong | (assigned & (length >= 16))).otherwise(assigned | (length >= 8))
    named = F.lower("before").rlike(rf"({_any_of(CREDENTIAL_NAMES)})\W{{1,6}}$") & certain
    key = F.col("value").rlike("^(AKIA|ASIA)[0-9A-Z]{16}$")
    made_up = F.lower("value").rlike(_any_of(PLACEHOLDERS[:-1]))
    return candidates.withColumn("label", ((named | key) & ~made_up).cast("double"))


def fit_forest(
    labelled: DataFrame, max_rows: int = 20_000, trees: int = 40, depth: int = 8, seed: int = 7
) -> SecretModel:
    """Learn from labelled findings, ``max_rows`` distinct ones at most.

    Each label gives up to half of them, or more where the other has fewer; they are chosen
    by a hash. A finding weighs as often as it occurs, and for those of its label left out.
    """
    key = F.xxhash64("value", "before", "after", "path")
    labelled = labelled.where("label is not null").withColumn("key", key)
    counts = {
        row.label: row.findings
        for row in labelled.groupBy("label").agg(F.approx_count_distinct("key", 0.01).alias("findings")).collect()
    }
    if len(counts) < 2:
        return SecretModel(None, next(iter(counts), 0.5))
    fewer = min(counts.values())
    drawn = []
    for label, findings in sorted(counts.items()):
        quota = max(max_rows // 2, max_rows - fewer if findings > fewer else 0, 1)
        # A range of hashes that holds more than enough, whatever the number of findings.
        share = min(1.0, (2 * quota + 100) / findings)
        in_range = F.col("key") <= int(-(2**63) + share * (2**64 - 2**12)) if share < 1 else F.lit(True)
        some = (
            labelled.where((F.col("label") == label) & in_range)
            .groupBy("key", "value", "before", "after", "path", "label")
            .count()
            .orderBy("key", "value", "before", "after", "path")
            .limit(quota)
        )
        drawn.append(some.withColumn("weight", F.col("count") * max(1.0, findings / quota)))
    chosen = with_features(drawn[0].unionByName(drawn[1]))
    rows = staged(chosen.select("features", "label", "weight"), "secret-findings")
    forest = RandomForestClassifier(
        numTrees=trees, maxDepth=depth, seed=seed, maxBins=64, weightCol="weight"
    )
    return SecretModel(forest.fit(rows), 0.5)


def score_candidates(candidates: DataFrame, model: SecretModel, threshold: float = 0.5) -> DataFrame:
    """Per candidate: doc_id, start, length, value_hash, score, is_secret."""
    if model.forest is None:
        scored = candidates.withColumn("score", F.lit(float(model.constant)))
    else:
        scored = model.forest.transform(with_features(candidates))
        scored = scored.withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
    return scored.select(
        "doc_id",
        "start",
        "length",
        text_hash(F.col("value")).alias("value_hash"),
        "score",
        (F.col("score") >= threshold).alias("is_secret"),
    )
