"""Registered queries for labels and text composition."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.functions import labels as L
from mailcase.functions.text import lower_strip
from mailcase.functions.tokens import ngrams, truncate, word_tokens
from mailcase.operators.instructions import instruction_pairs
from mailcase.plans.oracle_views import with_views
from mailcase.plans.prepare import prepare_cases
from mailcase.plans.registry import query
from mailcase.sources.tables import email_cases, table

PRIO5_SQL = """CASE trim(coalesce(Priority, 'nan'))
  WHEN 'Low' THEN 0 WHEN 'Normal' THEN 1 WHEN 'Urgent' THEN 2 WHEN 'Immediate' THEN 3
  ELSE 4 END"""
PRIO7_SQL = """CASE coalesce(Priority, 'nan')
  WHEN 'Medium' THEN 0 WHEN 'Low' THEN 1 WHEN 'Normal' THEN 2 WHEN 'Urgent' THEN 3
  WHEN 'nan' THEN 4 WHEN 'Immediate' THEN 5 WHEN 'Critical' THEN 6 ELSE 4 END"""
TYPE4_SQL = """CASE lower(coalesce(Complaint_type, 'nan'))
  WHEN 'packaging' THEN 0 WHEN 'logistics' THEN 1 WHEN 'quality' THEN 2
  WHEN 'pricing errors' THEN 3 ELSE 0 END"""
TYPE6_SQL = """CASE lower(coalesce(Complaint_type, 'nan'))
  WHEN '' THEN 0 WHEN 'packaging' THEN 1 WHEN 'logistics' THEN 2 WHEN 'quality' THEN 3
  WHEN 'not applicable' THEN 4 WHEN 'pricing errors' THEN 5 ELSE 0 END"""
TEXT_SQL = ("concat('Subject: ', coalesce(Subject, 'nan'), chr(10), 'Body: ', "
            "coalesce(TextBody, 'nan'))")


@query("label_priority5", with_views(["email_cases"], f"""
SELECT case_id, Priority, CAST({PRIO5_SQL} AS INTEGER) AS label FROM email_cases"""))
def q_label_priority5(spark, sf_dir):
    """5-class priority (strip, case-sensitive, missing -> nan id)."""
    c = email_cases(spark, sf_dir)
    return c.select("case_id", "Priority", L.priority5_label("Priority").alias("label"))


@query("label_priority7", with_views(["email_cases"], f"""
SELECT case_id, Priority, CAST({PRIO7_SQL} AS INTEGER) AS label FROM email_cases"""))
def q_label_priority7(spark, sf_dir):
    """7-class priority (exact match, unmapped -> nan id)."""
    c = email_cases(spark, sf_dir)
    return c.select("case_id", "Priority", L.priority7_label("Priority").alias("label"))


@query("label_type4", with_views(["prepared_cases"], f"""
SELECT case_id, Complaint_type, CAST({TYPE4_SQL} AS INTEGER) AS label FROM prepared_cases"""))
def q_label_type4(spark, sf_dir):
    """4-class complaint type, lower-cased, default 0."""
    p = prepare_cases(email_cases(spark, sf_dir))
    return p.select("case_id", "Complaint_type", L.type4_label("Complaint_type").alias("label"))


@query("label_type6", with_views(["prepared_cases"], f"""
SELECT case_id, CAST({TYPE6_SQL} AS INTEGER) AS label,
  (['', 'packaging', 'logistics', 'quality', 'not applicable', 'pricing errors'])[{TYPE6_SQL} + 1]
    AS label_name
FROM prepared_cases"""))
def q_label_type6(spark, sf_dir):
    """P14 + P20: 6-class type id and its decoded name."""
    p = prepare_cases(email_cases(spark, sf_dir)).withColumn("label",
                                                             L.type6_label("Complaint_type"))
    return p.select("case_id", "label", L.decode("label", L.TYPE6).alias("label_name"))


@query("joint_labels", with_views(["prepared_cases"], f"""
SELECT case_id, {TEXT_SQL} AS text,
  CAST(lower(CAST(Complaint AS VARCHAR)) = 'true' AS INTEGER) AS labels_binary,
  CAST({TYPE4_SQL} AS INTEGER) AS labels_multiclass
FROM prepared_cases"""))
def q_joint_labels(spark, sf_dir):
    """P11 + P12 + P13 (P17): text and both labels in one pass."""
    p = prepare_cases(email_cases(spark, sf_dir))
    return p.select("case_id", L.compose_text("Subject", "TextBody").alias("text"),
                    L.binary_label("Complaint").alias("labels_binary"),
                    L.type4_label("Complaint_type").alias("labels_multiclass"))


@query("normalized_priority", with_views(["email_cases"], """
SELECT case_id, lower(trim(Priority)) AS priority_norm FROM email_cases"""))
def q_normalized_priority(spark, sf_dir):
    """cast, strip, lower."""
    c = email_cases(spark, sf_dir)
    return c.select("case_id", lower_strip("Priority").alias("priority_norm"))


CLEAN_TEXT_SQL = ("coalesce(lower(trim(regexp_replace(regexp_replace({x}, "
                  "'[^\\pL\\pN_\\s]', '', 'g'), '\\s+', ' ', 'g'))), '')")


@query("instruction_pairs", with_views(["email_cases"], f"""
SELECT case_id,
  'Analyze the following complaint text and identify:' || chr(10) ||
  '1. The root cause of the complaint' || chr(10) ||
  '2. Additional contextual information' || chr(10) || chr(10) ||
  'Input Text: ' || {CLEAN_TEXT_SQL.format(x="concat(coalesce(Subject, 'nan'), ' ', coalesce(TextBody, 'nan'))")}
  || chr(10) || chr(10) ||
  'Provide your analysis focusing on:' || chr(10) ||
  '- Precise root cause classification' || chr(10) ||
  '- Relevant extra information' AS instruction,
  'Root Cause: ' || {CLEAN_TEXT_SQL.format(x="coalesce(Type_of_Complaint, 'nan')")} || chr(10) ||
  'Additional Information: ' || {CLEAN_TEXT_SQL.format(x="coalesce(Priority, 'nan')")} AS output
FROM email_cases"""))
def q_instruction_pairs(spark, sf_dir):
    """Root cause = complaint type, extra information = priority (fixture mapping)."""
    c = email_cases(spark, sf_dir)
    return instruction_pairs(c, root_cause="Type_of_Complaint", extra="Priority",
                             keep=("case_id",))


@query("word_tokens", """
SELECT doc_id,
  CAST(len(regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')) AS INTEGER) AS n_tokens,
  CAST(least(len(regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')), 512) AS INTEGER)
    AS n_truncated,
  CAST(greatest(len(regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')) - 1, 0) AS INTEGER)
    AS n_bigrams,
  regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}')[1] AS first_token,
  md5(array_to_string(regexp_extract_all(lower(text), '[\\pL\\pN_]{2,}'), ' ')) AS tokens_md5
FROM documents""")
def q_word_tokens(spark, sf_dir):
    """F26 + F27 + F28 over whole documents."""
    d = table(spark, sf_dir, "documents")
    t = word_tokens("text")
    return d.select("doc_id", F.size(t).alias("n_tokens"), F.size(truncate(t, 512)).alias(
        "n_truncated"), F.size(ngrams(t, 2)).alias("n_bigrams"),
        F.try_element_at(t, F.lit(1)).alias("first_token"),
        F.md5(F.array_join(t, " ")).alias("tokens_md5"))
