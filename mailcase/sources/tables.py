"""Driver tables and the shared fixture views built from them.

Every fixture is a lazy DataFrame derived from the parquet tables, so its
size grows with the tables. The DuckDB text of the same views lives in
``mailcase.plans.oracle_views`` and must stay semantically identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table; Catalyst prunes columns and pushes filters into the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _mod(col: str, n: int) -> Column:
    return F.col(col) % F.lit(n)


def email_cases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case-export shaped view over ``documents`` + ``labels``.

    Schema: case_id BIGINT, Subject, TextBody, Priority, Type_of_Complaint,
    lang, ParentId (all strings nullable except lang, ParentId).
    """
    return cases_from(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def cases_from(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The ``email_cases`` columns from a documents frame (batch or streaming)
    left-joined to the labels table."""
    d = documents.select("doc_id", "text", "lang", "source")
    lab = labels.select("doc_id", "quality", "toxic", F.lit(True).alias("_labelled"))
    j = d.join(lab, "doc_id", "left")
    k = F.col("doc_id")
    ks = k.cast("string")
    nl = F.lit("\n")
    subject = (
        F.when(_mod("doc_id", 23) == 0, F.lit(None).cast("string"))
        .when(_mod("doc_id", 11) == 0, F.concat(F.lit("Automatic reply: "), F.col("source")))
        .when(_mod("doc_id", 11) == 1, F.concat(F.lit("re: order "), ks))
        .when(_mod("doc_id", 11) == 2, F.concat(F.lit("Software: "), F.col("source")))
        .otherwise(F.concat(F.lit("Order "), ks, F.lit(" "), F.col("source")))
    )
    m8 = _mod("doc_id", 8)
    t = F.col("text")
    body = (
        F.when(m8 == 0, F.lit(None).cast("string"))
        .when(m8 == 1, F.concat(F.lit("ATTENTION: external sender, check it is safe."), nl, t))
        .when(m8 == 2, F.concat(t, nl, F.lit("Kind regards,"), nl, F.lit("A. Person")))
        .when(m8 == 3, F.concat(t, nl, F.lit("Van: x"), nl, F.lit("Aan: y")))
        .when(m8 == 4, F.concat(t, nl, F.lit("a.person@example.com"), nl,
                                F.lit("Tel 0123456789 desk")))
        .when(m8 == 5, F.concat(F.lit("### Form 7"), nl, t, nl, nl, nl,
                                F.lit("The information contained in this communication is "
                                      "private, no obligation. End")))
        .otherwise(t)
    )
    m9 = _mod("doc_id", 9)
    priority = (
        F.when(m9 == 0, "Low").when(m9 == 1, "Normal").when(m9 == 2, "Urgent")
        .when(m9 == 3, "Immediate").when(m9 == 4, " Normal ").when(m9 == 5, "Medium")
        .when(m9 == 6, "Critical").when(m9 == 7, "").otherwise(F.lit(None).cast("string"))
    )
    m4 = _mod("doc_id", 4)
    ctype = (
        F.when(F.col("_labelled").isNull(), F.lit(None).cast("string"))
        .when(F.col("toxic") == 1, "Quality")
        .when(F.col("quality") == 0, "")
        .when(m4 == 0, "Packaging").when(m4 == 1, "Logistics")
        .when(m4 == 2, "Pricing errors").otherwise("Not applicable")
    )
    return j.select(
        k.alias("case_id"),
        subject.alias("Subject"),
        body.alias("TextBody"),
        priority.alias("Priority"),
        ctype.alias("Type_of_Complaint"),
        F.col("lang"),
        F.concat(F.lit("P"), _mod("doc_id", 300).cast("string")).alias("ParentId"),
    )


def metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Case metadata keyed by ``Id``: every customer, keys shifted by 50 so the
    e-mails of parents P0-P49 find no metadata (left-join nulls)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.concat(F.lit("P"), (F.col("c_custkey") + F.lit(50)).cast("string")).alias("Id"),
        F.col("c_mktsegment").alias("Segment"),
    )


def _every(values: Column, k: int, n: int) -> Column:
    """Sum of the elements k, k + n, k + 2n, ... of an array."""
    return F.aggregate(F.filter(values, lambda x, i: i % n == k), F.lit(0.0), lambda a, x: a + x)


def class_logits(spark: SparkSession, sf_dir: str, n_classes: int = 5) -> DataFrame:
    """(id, label, logits array<double>) from ``embeddings``; logit k adds up every
    ``n_classes``-th element of the whole vector, from element k."""
    e = table(spark, sf_dir, "embeddings")
    return e.select(
        F.col("vec_id").alias("id"),
        (F.col("label") % F.lit(n_classes)).cast("int").alias("label"),
        F.array(*[_every(F.col("embedding").cast("array<double>"), k, n_classes)
                  for k in range(n_classes)]).alias("logits"),
    )


def binary_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(id, label 0/1, score) — truth ``label = 1``, score = softmax element 2."""
    from mailcase.functions.scores import softmax

    cl = class_logits(spark, sf_dir)
    return cl.select(
        "id",
        (F.col("label") == 1).cast("int").alias("label"),
        F.element_at(softmax(F.col("logits")), 2).alias("score"),
    )


def tied_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``binary_scores`` rounded to 2 digits, so many scores tie."""
    return binary_scores(spark, sf_dir).withColumn("score", F.round("score", 2))


def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Long training log from ``events``: run, step, loss / eval_accuracy.

    Purchases log an accuracy, every other event a loss."""
    ev = table(spark, sf_dir, "events")
    paid = F.col("event_type") == "purchase"
    return ev.select(
        (F.col("user_id") % 4).cast("bigint").alias("run"),
        F.col("event_id").alias("step"),
        F.when(~paid, F.col("value")).alias("loss"),
        F.when(paid, F.col("value") / 1000.0).alias("eval_accuracy"),
    )
