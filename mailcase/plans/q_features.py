"""Registered queries for TF-IDF features."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.operators.features import (doc_terms, fit_featurizer, fit_vocabulary, tfidf,
                                         tfidf_rows, vector_entries, vector_struct)
from mailcase.plans.registry import query
from mailcase.sources.tables import table

TERMS_SQL = """
WITH tok AS (
  SELECT doc_id, regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}') AS t FROM documents),
terms AS (
  SELECT doc_id, unnest(t) AS term FROM tok
  UNION ALL
  SELECT doc_id, unnest(list_transform(range(1, len(t)), lambda i: t[i] || ' ' || t[i + 1]))
  FROM tok),
dt AS (SELECT doc_id, term, count(*) AS tf FROM terms GROUP BY doc_id, term),
nd AS (SELECT count(*) AS n FROM documents),
st AS (SELECT term, count(*) AS df, sum(tf) AS cf FROM dt GROUP BY term),
vocab AS (
  SELECT term, df, cf, ln((1.0 + n) / (1.0 + df)) + 1 AS idf FROM st, nd
  WHERE df >= 2 AND df <= 0.95 * n ORDER BY cf DESC, term LIMIT 3000),
w AS (SELECT dt.doc_id, dt.term, dt.tf * v.idf AS w FROM dt JOIN vocab v USING (term))
"""


@query("vocabulary", TERMS_SQL + """
SELECT term, df, CAST(cf AS BIGINT) AS cf, round(idf, 6) AS idf FROM vocab""")
def q_vocabulary(spark, sf_dir):
    """M1: min_df 2, max_df 0.95, top 3000 terms by corpus count over whole documents."""
    d = table(spark, sf_dir, "documents")
    v = fit_vocabulary(d, "doc_id", "text")
    return v.select("term", "df", F.col("cf").cast("bigint").alias("cf"),
                    F.round("idf", 6).alias("idf"))


@query("tfidf", TERMS_SQL + """
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w""")
def q_tfidf(spark, sf_dir):
    """M2: long-form L2-normalised TF-IDF of every document on the fitted vocabulary."""
    d = table(spark, sf_dir, "documents")
    v = fit_vocabulary(d, "doc_id", "text")
    return tfidf_rows(d, v).select("doc_id", "term", F.round("tfidf", 6).alias("tfidf"))


@query("tfidf_full_vocabulary", TERMS_SQL.replace(" ORDER BY cf DESC, term LIMIT 3000", "") + """
SELECT doc_id, count(*) AS n_terms, round(sum(w) / sqrt(sum(w * w)), 6) AS weight_sum, min(term) AS first_term
FROM w GROUP BY doc_id""")
def q_tfidf_full(spark, sf_dir):
    """M1/M2/J6 without a cap: every term of 2+ documents is joined; per document the
    number of terms, the sum of its normalised weights and its first term."""
    d = table(spark, sf_dir, "documents")
    terms = doc_terms(d, "doc_id", "text", pack=True)
    v = fit_vocabulary(terms, "doc_id", "text", max_features=None)
    return tfidf(terms, v, "doc_id").groupBy("doc_id").agg(
        F.count(F.lit(1)).alias("n_terms"), F.round(F.sum("tfidf"), 6).alias("weight_sum"),
        F.min("term").alias("first_term"))


@query("featurizer_tfidf", TERMS_SQL + """
SELECT doc_id, term, round(w / sqrt(sum(w * w) OVER (PARTITION BY doc_id)), 6) AS tfidf FROM w""")
def q_featurizer_tfidf(spark, sf_dir):
    """M3: the saveable MLlib featurizer (fit once, transform many) gives the
    same weights as the long form; its vectors are listed as (doc, term, tfidf)."""
    d = table(spark, sf_dir, "documents").select("doc_id", "text")
    feat, _ = fit_featurizer(d, "doc_id", "text")
    v = feat.transform(d).select("doc_id", vector_struct("features").alias("s"))
    cells = v.select("doc_id", F.explode(vector_entries("s", parsed=True)).alias("c"))
    # Index -> term: one row per vocabulary term (bounded by max_features).
    terms = spark.createDataFrame(list(enumerate(feat.stages[2].vocabulary)),
                                  "i int, term string")
    return cells.join(F.broadcast(terms), F.col("c.i") == F.col("i")).select(
        "doc_id", "term", F.round("c.x", 6).alias("tfidf"))
