"""The corpus pipeline: quality rules, near-dedup, decontamination, secret scans, packing.

Each stage takes (spark, docs, sf_dir) and works on every row that its predecessor
kept. All but the last return the columns of documents.

Defined cases are those of the operators; besides, a null doc_id can't be named by the
near-dedup and decontamination stages and passes them unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgeloom.llm import common, decontaminate, neardup, packing, quality, secrets

DOCUMENTS = ("doc_id", "text", "lang", "source", "n_chars")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base limits and the learned decision list keep."""
    rules = quality.fit(docs, common.read(spark, sf_dir, "labels"))
    return quality.judge(docs, rules).where("__kept").select(*DOCUMENTS)


#: Up to so many ids (16 MB), or spans of so many documents (10 MB or so), are broadcast; more are joined by a shuffle.
BROADCAST_IDS, BROADCAST_SPANS = 1_000_000, 50_000


def _counted(df: DataFrame, most: int) -> DataFrame:
    return F.broadcast(df) if df.count() <= most else df


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The smallest doc_id of each group of near copies (5-word shingles, similarity 0.8)."""
    judged = neardup.near_duplicates(docs, words=5, percent=80)
    gone = common.written(judged.where(~F.col("kept")).select("doc_id").distinct(), "gone")
    common.drop(judged)
    return docs.join(_counted(gone, BROADCAST_IDS), "doc_id", "left_anti").select(*DOCUMENTS)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark passage."""
    found = common.written(decontaminate.leaks(docs, common.read(spark, sf_dir, "benchmark")).select("doc_id").distinct(), "leaks")
    return docs.join(_counted(found, BROADCAST_IDS), "doc_id", "left_anti").select(*DOCUMENTS)


def secret_scans(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document; spans with a secret that is no copied example are masked in its text."""
    keyed = docs.withColumn("__key", F.xxhash64("text"))
    found = secrets.with_spans(keyed, repo=("source", "lang"), keep=("doc_id", "__key"))
    hit = F.filter(F.array_sort(F.concat("__base", "__added")), lambda x: ~F.array_contains("__examples", x))
    found = found.select(F.col("doc_id").alias("__id"), F.col("__key").alias("__k"), hit.alias("__hit")).where(F.size("__hit") > 0).distinct()
    found = common.written(found, "secrets")
    both = keyed.join(_counted(found, BROADCAST_SPANS), F.col("doc_id").eqNullSafe(F.col("__id")) & (F.col("__key") == F.col("__k")), "left")
    text = F.when(F.col("__hit").isNull(), F.col("text")).otherwise(secrets.masked(F.col("text"), F.col("__hit")))
    n_chars = F.when(F.col("__hit").isNull(), F.col("n_chars")).otherwise(F.length(text).cast("long"))
    return both.select("doc_id", text.alias("text"), "lang", "source", n_chars.alias("n_chars"))


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The packed pieces of every document left."""
    return packing.pack(docs, common.vocabulary())


STAGES = [
    ("quality_rules", quality_rules),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("secret_scans", secret_scans),
    ("best_fit_packing", best_fit_packing),
]
#: SQL can't express the learned list, signatures or token ids; tests compare with brute force.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = common.read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        docs = common.written(stage(spark, docs, sf_dir), name)
        if before is not None:
            common.drop(before)  # its last reader is done
        before = docs
    out = STAGES[-1][1](spark, docs, sf_dir)  # packing has read its documents by then
    common.drop(docs)
    return out
