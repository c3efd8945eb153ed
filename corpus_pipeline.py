"""Corpus pipeline: quality filter, line dedup, near-dedup, decontamination, mixing.

Each stage takes (spark, docs, sf_dir), works on all rows the stage before it
kept, and returns rows with the columns of ``documents``; it is written as
Parquet and read again before the next. Rows are told apart by key and 128
bits of their text; rows equal in both count as one document.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailcase.llm.bloom import row_filter
from mailcase.llm.decontamination import decontaminate
from mailcase.llm.line_dedup import line_dedup
from mailcase.llm.mixing import mixture
from mailcase.llm.near_dedup import near_dedup
from mailcase.llm.quality import quality_scores
from mailcase.llm.tables import read_table, same, stored, text_id


def _without(docs: DataFrame, rejected: DataFrame) -> DataFrame:
    """The rows of ``docs`` that (doc_id, text_id) of ``rejected`` do not name.

    Rows that a filter of the rejected ones does not know stay where they are;
    the others are compared exactly.
    """
    bad = stored(rejected.select(F.col("doc_id").alias("_doc"), F.col("text_id").alias("_text")), "rejected")
    listed = row_filter(bad)("doc_id", text_id("text"))
    bad, hit = bad.hint("merge"), docs.where(listed)
    checked = hit.join(bad, hit["doc_id"].eqNullSafe(bad["_doc"])
                       & text_id(hit["text"]).eqNullSafe(bad["_text"]), "left_anti")
    return docs.where(~listed).unionByName(checked)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents that the quality classifier rejects."""
    scores = quality_scores(docs, read_table(spark, sf_dir, "labels"))
    return _without(docs, scores.where("predicted = 0"))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops repeated lines from the texts; no document goes. ``n_chars`` follows the text.

    A null text stays null.
    """
    kept = line_dedup(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    columns = {c: F.col("row")[c] for c in docs.columns}
    columns["text"] = text
    if "n_chars" in columns:
        columns["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length(text).cast(
            docs.schema["n_chars"].dataType)).otherwise(columns["n_chars"])
    return kept.select(*[v.alias(c) for c, v in columns.items()])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of copies and near copies stays, that of the smallest key."""
    classes = stored(near_dedup(docs), "classes")
    rest = _without(docs, classes.where("NOT kept"))
    # Equal rows (same key and text) are one document.
    twice = classes.groupBy("doc_id", "text_id").count().where("count > 1")
    if twice.isEmpty():
        return rest
    return rest.dropDuplicates(["doc_id", "text"])


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents contaminated by benchmark items."""
    found = decontaminate(docs, read_table(spark, sf_dir, "benchmark"))
    return _without(docs, found.where("contaminated"))


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix: each document as often as its source's repetition rate says."""
    return mixture(docs)


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dedup", near_duplicates),
          ("decontamination", decontamination), ("mixing", mixing)]

#: A trained classifier and near-duplicate classes cannot be put in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table of documents."""
    docs = read_table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs, name)
    return docs
