"""A corpus pipeline: five stages over ``documents``, each written and read again.

quality rules -> quality classifier -> near-duplicates -> repeated strings ->
packing.  Every stage works on all rows its predecessor kept, and its decisions
take effect; all but the last return the columns of the documents given.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripledger.llm import frames
from tripledger.llm.op2_quality_rules import apply_policy, ledger
from tripledger.llm.op3_packing import pack_documents
from tripledger.llm.op5_quality_classifier import score, train
from tripledger.llm.op6_near_dedup import near_duplicates
from tripledger.llm.op8_bpe import vocabulary_path
from tripledger.llm.op10_suffix_dedup import cut_texts

SIMILARITY = 80  # percent


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the standard policy keeps."""
    judged = apply_policy(ledger(docs, carry=True))
    return judged.where("kept").select(*[frames.of_row("carried", c) for c in docs.columns])


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the rows at hand, predicts good."""
    field = train(docs, frames.table(spark, sf_dir, "labels"))
    return score(docs, field, carry=True).where("predicted = 1").select(
        *[frames.of_row("carried", c) for c in docs.columns])


def _row_hash() -> Column:
    """A row's number, as long as no other row has the same."""
    return frames.key_columns()[1]


def _numbered(docs: DataFrame) -> DataFrame:
    """did, one, two, n, rid of the distinct rows, no two of one rid; a stored stage.

    A row is known by doc_id and two independent 64-bit hashes of its text; rid
    is the first of them, and a new one for rows that share it by chance.
    """
    ids = frames.stage(docs.select(*_row_key()).groupBy("did", "one", "two").agg(
        F.count(F.lit(1)).alias("n")).withColumn("rid", F.col("one")), "row-ids")
    turn = 0
    while True:
        shared = ids.groupBy("rid").agg(F.count(F.lit(1)).alias("k")).where("k > 1").select(
            "rid", F.lit(True).alias("shared"))
        if shared.isEmpty():
            return ids
        turn += 1
        before, ids = ids, frames.stage(ids.join(shared, "rid", "left").select(
            "did", "one", "two", "n", F.when(F.col("shared"), F.xxhash64(
                F.lit(turn), "did", "one", "two")).otherwise(F.col("rid")).alias("rid")), "row-ids")
        frames.release(before)


def _row_key() -> list[Column]:
    did = frames.key_columns()[0]
    return [did, _row_hash().alias("one"),
            F.xxhash64(F.lit("two"), did, F.coalesce("text", F.lit(""))).alias("two")]


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each near-duplicate class: the one of smallest doc_id.

    Rows that differ in doc_id or text are documents of their own, NULL the
    smallest doc_id; rows equal in both are one document, of which one row
    stays, with or without words.
    """
    key = ["did", "one", "two"]
    ids = _numbered(docs)
    renamed = ids.where("rid != one").select(*key, "rid")
    texts = docs.select(*_row_key(), "text")
    if renamed.isEmpty():
        texts = texts.withColumn("rid", F.col("one"))
    else:
        texts = texts.join(renamed, key, "left").withColumn("rid", F.coalesce("rid", "one"))
    found = near_duplicates(texts.select(F.col("rid").alias("doc_id"), "text"), SIMILARITY).select(
        F.col("doc_id").alias("rid"), F.col("component_id").alias("class")).distinct()
    classes = frames.stage(ids.join(found, "rid"), "row-classes")
    frames.release(ids)
    kept = classes.groupBy("class").agg(F.min(F.struct(*key)).alias("first")).select("first.*")
    rows = docs.select(*_row_key(), frames.whole_row(docs.columns).alias("row"))
    left = rows.join(classes.join(kept, key, "left_anti").select(*key), key, "left_anti")
    repeated = classes.where("n > 1").select(*key)
    if not repeated.isEmpty():
        left = left.join(repeated, key, "left_anti").union(
            left.join(repeated, key, "left_semi").dropDuplicates(key))
    return left.select(*[frames.of_row("row", c) for c in docs.columns])


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the strings of 100 bytes that start earlier too."""
    return cut_texts(docs)


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all remaining documents, packed into sequences."""
    return pack_documents(docs, vocabulary_path())


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_classifier),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("packing", packing),
]

# The classifier, the tokeniser and the byte strings are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last one's rows."""
    docs = frames.table(spark, sf_dir, "documents")
    for name, step in STAGES[:-1]:
        docs = frames.stage(step(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
