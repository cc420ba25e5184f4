"""A training corpus from raw documents: four stages, each an operator of ``gridtide.llm``.

Every stage takes (spark, docs, sf_dir) and works on all documents its
predecessor kept.  Nulls, empty texts, repeated rows and other columns are
treated as the operators say.  The stages run on workers that earlier ones have
filled, so batches to them are small (``small_batches``).
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import decision_list, jaccard_join, packing, quality_classifier
from gridtide.llm.common import small_batches, stored, table
from gridtide.llm.doc_stats import with_counts

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")
# Near duplicates of the corpus; op5_jaccard_join has a contract of its own.
SHINGLE_WORDS = 5
NEAR_PERCENT = 80


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that neither the base rules nor the learned decision list reject.

    The list is learned from the labelled documents among ``docs``.
    """
    small_batches(spark)
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    judged = decision_list.judge(with_counts(docs, list(COLUMNS)), rules)
    return judged.where("kept").select(*COLUMNS)


def quality_select(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose chance of the highest grade reaches the classifier's limit.

    The model is fitted to labelled documents of the raw table: those of low
    grade have mostly left ``docs`` by now.
    """
    small_batches(spark)
    ratings = quality_classifier.graded(table(spark, sf_dir, "labels"))
    model = quality_classifier.fit(table(spark, sf_dir, "documents"), ratings)
    return quality_classifier.score(docs, model, list(COLUMNS)).where("kept").select(*COLUMNS)


def distinct_texts(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: that of the smallest id.

    Of a group's texts under that id the one of the smallest key stays, rows
    that repeat it are one document.  Rows that share an id but belong to other
    groups are other documents.  Rows without an id stay, as no id names the one
    to be kept.
    """
    small_batches(spark)
    found = jaccard_join.groups(docs, percent=NEAR_PERCENT, size=SHINGLE_WORDS)
    first = found.where("doc_id = component_id")
    texts = first.groupBy("component", "doc_id", "text_key").agg(F.count(F.lit(1)).alias("rows"))
    # An empty set is no group: every text of that kind stands for itself.
    alone = F.when(F.col("component").isNull(), F.struct("doc_id", "text_key"))
    chosen = texts.groupBy("component", alone.alias("alone")).agg(
        F.min(F.struct("doc_id", "text_key", "rows")).alias("kept")
    )
    keyed = docs.withColumn("text_key", F.xxhash64(F.col("text").cast("string")))
    kept = keyed.join(stored(chosen.select("kept.*"), "pipeline-first"), ["doc_id", "text_key"])
    once = kept.where("rows = 1").select(*COLUMNS)
    repeated = kept.where("rows > 1").dropDuplicates(["doc_id", "text_key"]).select(*COLUMNS)
    return once.union(repeated).union(docs.where("doc_id IS NULL").select(*COLUMNS))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents as pieces of context windows."""
    small_batches(spark)
    path = public_tokenizers.path("word_bpe_49k.json")
    return packing.pack_documents(docs, path, caches=packing.SMALL_CACHES)


STAGES = [
    ("quality_rules", quality_rules),
    ("quality_classifier", quality_select),
    ("near_duplicates", distinct_texts),
    ("packing", pack),
]

# Learned rules, a fitted classifier and a tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
