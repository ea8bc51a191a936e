"""Exact deduplication by a tree merge of sorted digest runs.

Two texts are equal when they are identical without white space (see ``normalised``).
Runs lie in slots, ``2 ** ROUND_BITS`` to the power of the rounds; a slot is a partition, and
what lies there is sorted and has one entry for each digest. The first runs are those of the
partitions of the input. In each round the slots exchange entries with partners whose numbers differ in some bits: an entry moves to the partner
that has these bits as its digest does, and the runs that meet are merged. After the
last round a slot holds all entries of its share of the digests, so no task ever sees
more than its share, and a digest that very many documents have shrinks in every round.

An entry carries the smallest identifier so far: of the row with the most code points in
its original text, then with the smallest doc_id (null last). What is merged is verified
in every round by the digest together with the normalised length and a second hash.

Only DataFrame functions are used. Null and empty texts are equal to each other. Rows
with one doc_id, equal texts and one length are the same identifier and stay together;
``first_of_each`` leaves one of them. Columns other than doc_id and text are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tenantflow.llm.inputs import fresh_name, parallelism
from tenantflow.session import staged

#: Bits that a round settles: runs of two to this power meet in a merge.
ROUND_BITS = 3


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+", "")


def _identifier(doc_id: Column, n_chars: Column) -> Column:
    """Sorts the row that stays first."""
    return F.struct((-n_chars).alias("less"), doc_id.isNull().alias("no_id"), doc_id.alias("doc_id"))


def text_digests(docs: DataFrame, *keep: str) -> DataFrame:
    """For each row doc_id, digest (binary), second, n_norm, n_chars and the columns ``keep``."""
    plain = fresh_name(docs, "normalised_text")
    return docs.select("doc_id", "text", *keep, normalised(F.col("text")).alias(plain)).select(
        "doc_id",
        *keep,
        F.unhex(F.sha2(F.col(plain), 256)).alias("digest"),
        F.xxhash64(F.col(plain)).alias("second"),
        F.length(plain).alias("n_norm"),
        F.length(F.coalesce(F.col("text"), F.lit(""))).alias("n_chars"),
    )


def _exchanged(entries: DataFrame, slots: int) -> DataFrame:
    """Entries brought to the slots they name, and the sorted runs that meet there merged.

    A slot is a partition. Entries come sorted, so the merge is one pass over them.
    """
    key = ["slot", "digest", "n_norm", "second"]
    brought = entries.repartitionById(slots, F.col("slot")).sortWithinPartitions(*key)
    return brought.groupBy(*key).agg(F.min("best").alias("best"), F.sum("n").alias("n"))


def merge_runs(digests: DataFrame, slots: int) -> DataFrame:
    """One entry for each digest: the identifier that stays (``best``) and ``n`` rows.

    ``slots`` is rounded up to whole rounds.
    """
    rounds = max(1, -(-(slots - 1).bit_length() // ROUND_BITS))
    slots = 1 << (rounds * ROUND_BITS)
    entries = digests.select(
        F.pmod(F.spark_partition_id(), F.lit(slots)).alias("slot"),
        "digest",
        "n_norm",
        "second",
        _identifier(F.col("doc_id"), F.col("n_chars")).alias("best"),
        F.lit(1).cast("long").alias("n"),
    )
    entries = _exchanged(entries, slots)  # the first runs, one for each slot
    of_digest = F.crc32(F.col("digest"))
    for number in range(rounds):
        settled = ((1 << ROUND_BITS) - 1) << (number * ROUND_BITS)
        partner = F.col("slot").bitwiseAND(~settled).bitwiseOR(of_digest.bitwiseAND(settled))
        entries = _exchanged(entries.withColumn("slot", partner.cast("int")), slots)
    return entries.drop("slot")


def exact_groups(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    digests = staged(text_digests(docs), "digests")
    merged = merge_runs(digests, parallelism(docs.sparkSession))
    return digests.join(merged, ["digest", "n_norm", "second"]).select(
        "doc_id",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (_identifier(F.col("doc_id"), F.col("n_chars")) == F.col("best")).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
    )


def first_of_each(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stay, one for each text, with all their columns."""
    key = ["digest", "n_norm", "second"]
    digests = staged(text_digests(docs), "digests")
    winners = staged(
        merge_runs(digests, parallelism(docs.sparkSession)).select(*key, F.col("best").alias("winner")),
        "merged-runs",
    )
    names = {name: fresh_name(docs, f"dedup_{name}") for name in ("row", *key)}
    plain = normalised(F.col("text"))
    marked = docs.withColumns(
        {
            names["digest"]: F.unhex(F.sha2(plain, 256)),
            names["n_norm"]: F.length(plain),
            names["second"]: F.xxhash64(plain),
            names["row"]: _identifier(F.col("doc_id"), F.length(F.coalesce(F.col("text"), F.lit("")))),
        }
    )
    winners = winners.withColumnsRenamed({name: names[name] for name in key})
    winner = fresh_name(marked, "winner")
    winners = winners.withColumnRenamed("winner", winner)
    stay = marked.join(winners, [names[name] for name in key]).where(F.col(names["row"]) == F.col(winner))
    repeated = digests.groupBy("doc_id", *key, "n_chars").count().where("count > 1").limit(1)
    if not repeated.isEmpty():
        stay = stay.dropDuplicates([names["row"], names["digest"]])
    return stay.select(*docs.columns)
