"""Registered queries for profiles, joins, heads and caps (A, J, X, U, P9, P10)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.functions.labels import PRIORITY5, priority5_label
from mailcase.operators import profile as A
from mailcase.operators.filters import partition_by_null, prefix_columns, remove_rows
from mailcase.operators.joins import join_metadata, join_metadata_salted
from mailcase.operators.sampling import balanced_sample, head, union_all
from mailcase.plans.oracle_views import with_views
from mailcase.plans.prepare import prepare_cases
from mailcase.plans.registry import query
from mailcase.sources.tables import email_cases, metadata

R = 6


@query("value_counts_priority", with_views(["email_cases"], """
SELECT Priority AS value, count(*) AS count FROM email_cases GROUP BY 1"""))
def q_value_counts_priority(spark, sf_dir):
    """A1 with nulls kept (dropna=False)."""
    return A.value_counts(email_cases(spark, sf_dir), "Priority")


@query("value_counts_type_dropna", with_views(["email_cases"], """
SELECT Type_of_Complaint AS value, count(*) AS count FROM email_cases
WHERE Type_of_Complaint IS NOT NULL GROUP BY 1"""))
def q_value_counts_type(spark, sf_dir):
    """A1 with dropna=True."""
    return A.value_counts(email_cases(spark, sf_dir), "Type_of_Complaint", dropna=True)


@query("complaint_amount", with_views(["prepared_cases"], """
SELECT count(*) FILTER (WHERE Complaint) AS count FROM prepared_cases"""))
def q_complaint_amount(spark, sf_dir):
    """A2: ``value_counts().get(True, 0)``."""
    return A.count_value(prepare_cases(email_cases(spark, sf_dir)), "Complaint", True)


@query("language_share", with_views(["email_cases"], """
SELECT l.Language, CAST(count(c.lang) AS BIGINT) AS Count,
       round(count(c.lang) * 100.0 / (SELECT count(*) FROM email_cases), 6) AS Percentage
FROM (VALUES ('nl'), ('en'), ('fr'), ('es'), ('it')) l(Language)
LEFT JOIN email_cases c ON c.lang = l.Language GROUP BY l.Language"""))
def q_language_share(spark, sf_dir):
    """A3: counts and percent of all rows for nl/en/fr/es/it."""
    s = A.language_share(email_cases(spark, sf_dir))
    return s.select("Language", "Count", F.round("Percentage", R).alias("Percentage"))


@query("distinct_priorities", with_views(["prepared_cases"], """
SELECT DISTINCT Priority FROM prepared_cases"""))
def q_distinct_priorities(spark, sf_dir):
    """A4: distinct values, null included."""
    return A.distinct_values(prepare_cases(email_cases(spark, sf_dir)), "Priority")


NON_EMPTY_COLS = ("Subject", "TextBody", "Priority", "Type_of_Complaint", "Complaint",
                  "Complaint_type")


@query("non_empty_counts", with_views(["prepared_cases"], " UNION ALL ".join(
    f"SELECT '{c}' AS \"column\", count(*) FILTER (WHERE {c} IS NOT NULL AND "
    f"CAST({c} AS VARCHAR) <> '') AS n_non_empty FROM prepared_cases" for c in NON_EMPTY_COLS)))
def q_non_empty_counts(spark, sf_dir):
    """Non-null, non-empty values per column, one pass."""
    return A.non_empty_counts(prepare_cases(email_cases(spark, sf_dir)), NON_EMPTY_COLS)


@query("profile_report", with_views(["prepared_cases"], """
SELECT 'Priority' AS "column", Priority AS value, count(*) AS count FROM prepared_cases GROUP BY 2
UNION ALL
SELECT 'Complaint_type', Complaint_type, count(*) FROM prepared_cases GROUP BY 2
UNION ALL
SELECT 'Complaint', CAST(Complaint AS VARCHAR), count(*) FROM prepared_cases GROUP BY 2"""))
def q_profile_report(spark, sf_dir):
    """A10: value counts of three columns in one scan."""
    return A.profile_report(prepare_cases(email_cases(spark, sf_dir)))


PRIO5_SQL = """CASE trim(coalesce(Priority, 'nan'))
  WHEN 'Low' THEN 0 WHEN 'Normal' THEN 1 WHEN 'Urgent' THEN 2 WHEN 'Immediate' THEN 3
  ELSE 4 END"""


@query("label_histogram", with_views(["prepared_cases"], f"""
SELECT c.class_id, c.class_name, CAST(coalesce(h.n, 0) AS BIGINT) AS n
FROM (VALUES (0, 'Low'), (1, 'Normal'), (2, 'Urgent'), (3, 'Immediate'), (4, 'nan'))
     c(class_id, class_name)
LEFT JOIN (SELECT {PRIO5_SQL} AS label, count(*) AS n FROM prepared_cases GROUP BY 1) h
  ON h.label = c.class_id"""))
def q_label_histogram(spark, sf_dir):
    """Zero-filled label histogram in label-set order."""
    p = prepare_cases(email_cases(spark, sf_dir)).withColumn("label", priority5_label("Priority"))
    return A.label_histogram(p, "label", PRIORITY5)


@query("match_count", with_views(["class_logits"], """
SELECT count(*) FILTER (WHERE pred = CAST(label = 1 AS VARCHAR)) AS n_match, count(*) AS n_rows,
       round(count(*) FILTER (WHERE pred = CAST(label = 1 AS VARCHAR)) * 100.0
             / nullif(count(*), 0), 6) AS accuracy_pct
FROM (SELECT label, CASE WHEN logits[2] > logits[1] THEN 'true' ELSE 'false' END AS pred
      FROM class_logits)"""))
def q_match_count(spark, sf_dir):
    """A9 + P19: string predictions against ``lower(str(Complaint))``."""
    from mailcase.sources.tables import class_logits

    cl = class_logits(spark, sf_dir).select(
        F.when(F.element_at("logits", 2) > F.element_at("logits", 1), "true")
        .otherwise("false").alias("predicted_label"),
        (F.col("label") == 1).alias("Complaint"))
    a = A.match_accuracy(cl, "predicted_label", "Complaint")
    return a.select("n_match", "n_rows", F.round("accuracy_pct", R).alias("accuracy_pct"))


@query("join_metadata", with_views(["email_cases", "metadata"], """
SELECT e.case_id, e.ParentId, m.Id AS Meta_Id, m.Segment AS Meta_Segment
FROM email_cases e LEFT JOIN metadata m ON e.ParentId = m.Id"""))
def q_join_metadata(spark, sf_dir):
    """J1 (+ P4): e-mails left-joined to prefixed case metadata."""
    e = email_cases(spark, sf_dir).select("case_id", "ParentId")
    m = prefix_columns(metadata(spark, sf_dir), "Meta_")
    return join_metadata(e, m, "ParentId", "Meta_Id").select("case_id", "ParentId", "Meta_Id", "Meta_Segment")


@query("join_metadata_hot", with_views(["email_cases", "metadata"], """
SELECT e.case_id, e.ParentId, m.Id AS Meta_Id, m.Segment AS Meta_Segment
FROM (SELECT case_id, CASE WHEN case_id % 3 = 0 THEN 'P77' WHEN case_id % 7 = 0 THEN NULL ELSE ParentId END AS ParentId
      FROM email_cases) e LEFT JOIN metadata m ON e.ParentId = m.Id"""))
def q_join_metadata_hot(spark, sf_dir):
    """J1 with a third of the e-mails under one parent and many under none: salted join."""
    parent = F.when(F.col("case_id") % 3 == 0, "P77").when(F.col("case_id") % 7 == 0, None).otherwise(F.col("ParentId"))
    e = email_cases(spark, sf_dir).select("case_id", parent.alias("ParentId"))
    m = prefix_columns(metadata(spark, sf_dir), "Meta_")
    return join_metadata_salted(e, m, "ParentId", "Meta_Id").select("case_id", "ParentId", "Meta_Id", "Meta_Segment")


@query("count_matching", with_views(["email_cases", "metadata"], """
SELECT count(*) FILTER (WHERE Id IN (SELECT ParentId FROM email_cases)) AS matched,
       count(*) AS total,
       count(*) FILTER (WHERE Id IN (SELECT ParentId FROM email_cases)) / count(*) AS ratio
FROM metadata"""))
def q_count_matching(spark, sf_dir):
    """Metadata rows that have a matching e-mail."""
    return A.count_matching(metadata(spark, sf_dir), email_cases(spark, sf_dir), "Id", "ParentId")


@query("head_cases", with_views(["prepared_cases"], """
SELECT case_id, Subject FROM prepared_cases ORDER BY case_id LIMIT 100"""))
def q_head_cases(spark, sf_dir):
    """The first 100 prepared rows by case id (a top-k report)."""
    return head(prepare_cases(email_cases(spark, sf_dir)), 100, "case_id").select(
        "case_id", "Subject")


@query("balanced_sample", with_views(["prepared_cases"], """
SELECT case_id, Complaint_type FROM (
  SELECT case_id, Complaint_type, row_number() OVER (
    PARTITION BY Type_of_Complaint IS NOT NULL ORDER BY case_id) AS rn
  FROM prepared_cases) WHERE rn <= 100"""))
def q_balanced_sample(spark, sf_dir):
    """X2 + U1: first 100 complaints-typed rows plus first 100 without a type."""
    p = prepare_cases(email_cases(spark, sf_dir))
    return balanced_sample(p, "Type_of_Complaint", 100, "case_id").select(
        "case_id", "Complaint_type")


@query("partition_by_null", with_views(["prepared_cases"], """
SELECT case_id, 'notna' AS half FROM prepared_cases WHERE Type_of_Complaint IS NOT NULL
UNION ALL
SELECT case_id, 'isna' FROM prepared_cases WHERE Type_of_Complaint IS NULL"""))
def q_partition_by_null(spark, sf_dir):
    """P9 + U1: the two halves, ``''`` in the not-null half."""
    p = prepare_cases(email_cases(spark, sf_dir))
    has, hasnt = partition_by_null(p, "Type_of_Complaint")
    return union_all([has.select("case_id", F.lit("notna").alias("half")),
                      hasnt.select("case_id", F.lit("isna").alias("half"))])


@query("remove_rows", with_views(["prepared_cases"], """
SELECT case_id, Complaint_type FROM prepared_cases
WHERE Complaint_type IS DISTINCT FROM 'Not applicable'"""))
def q_remove_rows(spark, sf_dir):
    """P10: drop ``Not applicable`` rows, keep nulls."""
    p = prepare_cases(email_cases(spark, sf_dir))
    return remove_rows(p, "Complaint_type", "Not applicable").select("case_id", "Complaint_type")
