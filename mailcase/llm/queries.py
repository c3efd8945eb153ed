"""Registered queries of the training-data operators (their SQL: ``oracles``)."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailcase.llm.alignment import alignment_scores
from mailcase.llm.decontamination import decontaminate
from mailcase.llm.exact_dedup import exact_dedup
from mailcase.llm.lexical import ranked_search
from mailcase.llm.line_dedup import line_dedup
from mailcase.llm.mixing import mix
from mailcase.llm.near_dedup import near_dedup
from mailcase.llm.oracles import ORACLE
from mailcase.llm.quality import quality_scores
from mailcase.llm.secrets import secret_scan
from mailcase.llm.simhash import simhash_dedup
from mailcase.llm.substring_dedup import substring_dedup
from mailcase.llm.tables import read_table
from mailcase.llm.token_counts import token_counts
from mailcase.llm.toxicity import toxicity_scores

__all__ = ["ORACLE", "QUERIES"]

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_substring_dedup(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return substring_dedup(d).select("doc_id", "n_words", "n_removed",
                                     F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op2_decontamination(spark, sf_dir):
    r = decontaminate(read_table(spark, sf_dir, "documents"),
                      read_table(spark, sf_dir, "benchmark"))
    return r.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                    F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated")


@query
def op3_mixing(spark, sf_dir):
    return mix(read_table(spark, sf_dir, "documents")).select(
        "doc_id", "size", "source_size", "target", "taken")


@query
def op5_exact_dedup(spark, sf_dir):
    return exact_dedup(read_table(spark, sf_dir, "documents"))


@query
def op6_token_counts(spark, sf_dir):
    return token_counts(read_table(spark, sf_dir, "documents"))


@query
def op8_secret_scan(spark, sf_dir):
    r = secret_scan(read_table(spark, sf_dir, "documents"))

    def names(spans):
        return F.concat_ws(",", F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def n(kind):
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["kind"].isin("assign", "access", "hex"))
    return r.select("doc_id", n("assign"), n("access"), n("hex"),
                    F.sha2(names(base), 256).alias("base_sha256"),
                    names(F.col("spans")).alias("spans"))


@query
def op10_line_dedup(spark, sf_dir):
    r = line_dedup(read_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return r.select("row.doc_id", "n_lines", "n_dropped",
                    F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op4_quality(spark, sf_dir):
    return quality_scores(read_table(spark, sf_dir, "documents"),
                          read_table(spark, sf_dir, "labels")).drop("text_hash", "text_id")


@query
def op7_toxicity(spark, sf_dir):
    return toxicity_scores(read_table(spark, sf_dir, "documents"),
                           read_table(spark, sf_dir, "labels"))


@query
def op9_near_dedup(spark, sf_dir):
    return near_dedup(read_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


@query
def op11_simhash_dedup(spark, sf_dir):
    return simhash_dedup(read_table(spark, sf_dir, "documents"))


@query
def op12_lexical_search(spark, sf_dir):
    return ranked_search(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op13_tokenizer_alignment(spark, sf_dir):
    return alignment_scores(read_table(spark, sf_dir, "documents"), whole=False).withColumnRenamed(
        "groups", "groups_sha256")
