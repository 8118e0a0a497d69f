"""A training corpus from raw documents: classify, deduplicate, cut repeats, mix, pack.

Each stage takes (spark, docs, sf_dir), works on all that its predecessor kept and returns a
DataFrame; all but the last return the columns of ``documents``. ``run`` writes the result of
every stage as Parquet to the shared folder and reads it again for the next one.

Rows without ``doc_id`` pass the first two stages and are taken once by the mix. Of rows that
repeat a ``doc_id`` one stays after near-dedup.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyguard.functions import quoted
from tallyguard.llm import minhash, mixing, packing, quality, suffixes
from tallyguard.llm.tokens import default_path
from tallyguard.llm.work import materialize, read, renamed_apart, without

# All passages of over 50 words, however short the words, and all of at least 250 bytes.
PASSAGE = suffixes.Passage(size=250, anchor=48, keep_first=True, words=51)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject."""
    judged = quality.classified(docs, read(spark, sf_dir, "labels"))
    return without(docs, judged.where("NOT kept"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    found = minhash.near_duplicates(docs)
    kept = without(docs, found.where("NOT kept"))
    repeated = docs.where("doc_id IS NOT NULL").groupBy("doc_id").count().where("count > 1").select("doc_id")
    if not repeated.limit(1).count():
        return kept
    one = kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    names = [quoted(c) for c in docs.columns]
    return kept.join(repeated, "doc_id", "left_anti").select(*names).unionByName(one.select(*names))


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages that an earlier document, or an earlier part, holds already."""
    cut = suffixes.without_repeats(docs, PASSAGE)
    if "n_chars" not in docs.columns:
        return cut
    return cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType)).select(*map(quoted, docs.columns))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as the mix takes it."""
    taken = mixing.mixture(docs).where("doc_id IS NOT NULL").groupBy("doc_id")
    copies = taken.agg(F.expr("sum(copies) div count(*)").alias("_copies"))
    taken_as = renamed_apart(docs, [])
    joined = docs.join(copies.withColumnRenamed("_copies", taken_as), "doc_id", "left")
    times = F.coalesce(F.col(taken_as), F.lit(1)).cast("int")
    return joined.select(*[F.col(quoted(c)) for c in docs.columns], F.explode(F.array_repeat(F.lit(0), times)).alias(taken_as)).drop(taken_as)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token ids with their sequences and places."""
    return packing.packed_documents(docs, default_path())


STAGES = [
    ("quality_classifier", quality_classifier),
    ("minhash_near_dedup", near_dedup),
    ("suffix_array_dedup", suffix_dedup),
    ("entropy_mixing", mix_sources),
    ("best_fit_packing", pack),
]

# The classifier, the token ids and the packing have no form in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), name.replace("_", "-"))
    return docs
