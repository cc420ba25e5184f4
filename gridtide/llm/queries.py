"""The registered queries of the training-data operators."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gridtide.llm import (
    ann_graph,
    bpe,
    decision_list,
    jaccard_join,
    kd_shards,
    license_scan,
    packing,
    periodic_runs,
    quality_classifier,
    topk_search,
    url_filter,
    warc,
    whitening,
)
from gridtide.llm.common import table
from gridtide.llm.doc_stats import with_counts
from gridtide.sources.tables import shared_folder

URL_RULES = [
    ("net", "/", "block"),
    ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"),
    ("org", "/fr/", "allow"),
]


TOP_K = 10
QUERY_STEP = 50  # every row whose id it divides is a query
GRAPH_QUERY_STEP = 100


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    embeddings = table(spark, sf_dir, "embeddings")
    bits = topk_search.dimensions(embeddings, "embedding")
    code = topk_search.sign_words(F.col("embedding"), -(-bits // topk_search.BITS))
    rows = embeddings.select(F.col("vec_id").alias("id"), code.alias("code"))
    return topk_search.search(rows, rows.where(F.col("id") % QUERY_STEP == 0), TOP_K, bits)


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select(
        F.col("page_id").alias("id"), "url", F.col("html").alias("payload")
    )
    path = shared_folder(spark, "warc")
    warc.write_archives(pages, path)
    return warc.read_archives(spark, path).select(
        F.col("record_id").alias("page_id"),
        "payload_bytes",
        "payload_digest",
        "record_type",
        "refers_to",
        "target_uri",
        "problem",
    )


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ratings = quality_classifier.graded(table(spark, sf_dir, "labels"))
    model = quality_classifier.fit(docs, ratings)
    return quality_classifier.score(docs, model, ["doc_id"])


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan_licences(table(spark, sf_dir, "documents"), ["doc_id"])


def op5_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return packing.pack_documents(docs, public_tokenizers.path("word_bpe_49k.json"))


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return bpe.encode_documents(docs, ranks, public_tokenizers.PATTERN)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    rules = decision_list.fit(docs, table(spark, sf_dir, "labels"))
    return decision_list.judge(with_counts(docs, ["doc_id"]), rules)


def op9_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    rules = spark.createDataFrame(URL_RULES, url_filter.RULE_SCHEMA)
    judged = url_filter.filter_urls(pages, rules)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op10_kd_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = kd_shards.shard_documents(table(spark, sf_dir, "documents"), shards=8)
    return placed.withColumns(
        {"law": F.lit("bytes"), "grown_shard": F.lit(None).cast("int")}
    )


def _with_planted_periods(docs: DataFrame) -> DataFrame:
    """doc_id and text; by a hash of its id, a tenth of the texts repeats a passage of its own."""
    hashed = F.crc32(F.col("doc_id").cast("string").cast("binary"))
    g = (hashed / 10).cast("long")
    words = F.filter(F.split(F.coalesce("text", F.lit("")), "[ \\t-\\r]+"), lambda word: word != "")

    def repeated(w: Column) -> Column:
        n = F.size(w)
        a = (g % F.greatest(n, F.lit(1))).cast("int")
        p = (1 + F.floor((n - a) / (3 + g % 8))).cast("int")
        times = F.ceil((n - a) / p).cast("int")
        made = F.concat(F.slice(w, 1, a), F.flatten(F.array_repeat(F.slice(w, a + 1, p), times)))
        return F.array_join(F.slice(made, 1, n), " ")

    # The list of words is bound once; each use of it would split the text anew.
    text = F.when(hashed % 10 == 0, F.transform(F.array(words), repeated)[0]).otherwise(F.col("text"))
    return docs.select("doc_id", text.alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _with_planted_periods(table(spark, sf_dir, "documents"))
    found = periodic_runs.find_runs(docs, ["doc_id"])
    numbers = ("start", "length", "period")
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r[n].cast("string") for n in numbers]), F.lit("\n")))
    order = F.transform("runs", lambda r: F.struct(r["length"].alias("l"), (-r["start"]).alias("s"), (-r["period"]).alias("p")))
    return found.select("*", F.array_max(order).alias("best")).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        (-F.col("best.s")).alias("start"),
        F.col("best.l").alias("length"),
        (-F.col("best.p")).alias("period"),
        F.floor(1000 * F.col("best.l") / -F.col("best.p")).alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"), "embedding", "vec_id")


def op13_graph_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("id"), F.col("embedding").alias("vector")
    )
    return ann_graph.nearest(rows, rows.where(F.col("id") % GRAPH_QUERY_STEP == 0), TOP_K)


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_warc": op2_warc,
    "op3_quality_classifier": op3_quality_classifier,
    "op4_license_scan": op4_license_scan,
    "op5_jaccard_join": op5_jaccard_join,
    "op6_packing": op6_packing,
    "op7_byte_bpe": op7_byte_bpe,
    "op8_quality_rules": op8_quality_rules,
    "op9_url_filter": op9_url_filter,
    "op10_kd_shards": op10_kd_shards,
    "op11_periodic_runs": op11_periodic_runs,
    "op12_whitening": op12_whitening,
    "op13_graph_neighbours": op13_graph_neighbours,
}
