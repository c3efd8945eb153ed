"""Registered queries for lifecycle (a): filters, cleaning, split (P, F, X)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.functions import text as T
from mailcase.operators.filters import drop_auto_replies, with_complaint
from mailcase.operators.sampling import exact_sample_flag, in_sample
from mailcase.plans.oracle_views import clean_body_sql, with_views
from mailcase.plans.prepare import prepare_cases, split_stats, with_split
from mailcase.plans.registry import query
from mailcase.sources.tables import email_cases


@query("clean_body", with_views(["email_cases"], f"""
SELECT case_id, {clean_body_sql('TextBody')} AS clean_body FROM email_cases"""))
def q_clean_body(spark, sf_dir):
    """F9 + F10 over every case body."""
    c = email_cases(spark, sf_dir)
    return c.select("case_id", T.clean_whitespace(T.clean_body("TextBody")).alias("clean_body"))


@query("drop_auto_replies", with_views(["email_cases"], """
SELECT case_id, Subject FROM email_cases
WHERE NOT coalesce(regexp_matches(Subject, 'Automatic reply|Automatisch antwoord|Fw:|RE:', 'i'),
                   false)"""))
def q_drop_auto_replies(spark, sf_dir):
    """P7."""
    return drop_auto_replies(email_cases(spark, sf_dir)).select("case_id", "Subject")


@query("complaint_flag", with_views(["email_cases"], """
SELECT case_id, coalesce(Type_of_Complaint IS NOT NULL AND Type_of_Complaint <> '', false)
         AS Complaint,
       Type_of_Complaint AS Complaint_type
FROM email_cases"""))
def q_complaint_flag(spark, sf_dir):
    """P5 + P6."""
    return with_complaint(email_cases(spark, sf_dir)).select("case_id", "Complaint",
                                                             "Complaint_type")


@query("prepared_cases", with_views(["prepared_cases"], "SELECT * FROM prepared_cases"))
def q_prepared_cases(spark, sf_dir):
    """Lifecycle (a) output table: P7 -> P5/P6 -> F9/F10 -> P2."""
    return prepare_cases(email_cases(spark, sf_dir))


SPLIT_SQL = "substr(md5(concat(CAST(case_id AS VARCHAR), ':42')), 1, 8) < 'cccccccc'"


@query("prepare_split_stats", with_views(["prepared_cases"], f"""
SELECT CASE WHEN {SPLIT_SQL} THEN 'train' ELSE 'test' END AS split,
       count(*) AS n_rows, CAST(sum(CAST(Complaint AS INTEGER)) AS BIGINT) AS n_true,
       round(avg(CAST(Complaint AS INTEGER)), 6) AS share_true
FROM prepared_cases GROUP BY 1"""))
def q_prepare_split_stats(spark, sf_dir):
    """The minimum slice: prepare -> 80/20 hash split -> A5 per split."""
    s = split_stats(prepare_cases(email_cases(spark, sf_dir)))
    return s.select("split", "n_rows", F.col("n_true").cast("bigint").alias("n_true"),
                    F.round("share_true", 6).alias("share_true"))


@query("split_assignment", with_views(["prepared_cases"], f"""
SELECT case_id, CASE WHEN {SPLIT_SQL} THEN 'train' ELSE 'test' END AS split
FROM prepared_cases"""))
def q_split_assignment(spark, sf_dir):
    """Every prepared row lands in exactly one split."""
    return with_split(prepare_cases(email_cases(spark, sf_dir))).select("case_id", "split")


@query("split_exact", with_views(["prepared_cases"], """
SELECT case_id, CASE WHEN rn <= CAST(round(0.8 * n) AS BIGINT) THEN 'train' ELSE 'test' END AS split
FROM (SELECT case_id,
        row_number() OVER (ORDER BY md5(concat(CAST(case_id AS VARCHAR), ':42')),
                                    CAST(case_id AS VARCHAR)) AS rn,
        count(*) OVER () AS n
      FROM prepared_cases)"""))
def q_split_exact(spark, sf_dir):
    """X3 ``exact=True``: exactly round(0.8 n) training rows, no global sort."""
    p = prepare_cases(email_cases(spark, sf_dir)).select("case_id")
    flag = exact_sample_flag(p, "case_id", 0.8, 42)
    return p.select("case_id", F.when(flag, "train").otherwise("test").alias("split"))


@query("holdout_assignment", with_views(["prepared_cases"], """
SELECT case_id,
  CASE WHEN substr(md5(concat(CAST(case_id AS VARCHAR), ':42:holdout')), 1, 8) < '19999999'
       THEN 'eval' ELSE 'train' END AS split
FROM prepared_cases"""))
def q_holdout(spark, sf_dir):
    """Seeded 10 % evaluation hold-out."""
    p = prepare_cases(email_cases(spark, sf_dir))
    flag = in_sample("case_id", 0.1, 42, salt="holdout")
    return p.select("case_id", F.when(flag, "eval").otherwise("train").alias("split"))


@query("complaints_only_clean", with_views(["email_cases"], f"""
SELECT case_id, Subject,
  translate({clean_body_sql('TextBody')}, '!"#$%&''()*+,-./:;<=>?@[\\]^_`{{|}}~', '') AS TextBody,
  Priority, Type_of_Complaint, true AS Complaint, Type_of_Complaint AS Complaint_type
FROM email_cases
WHERE coalesce(Type_of_Complaint IS NOT NULL AND Type_of_Complaint <> '', false)
  AND NOT coalesce(regexp_matches(Subject, 'Automatic reply|Automatisch antwoord|Fw:|RE:', 'i'),
                   false)"""))
def q_complaints_only_clean(spark, sf_dir):
    """Complaints-only variant: P7 -> P8 -> F9 -> F10 -> F11 (case kept)."""
    return prepare_cases(email_cases(spark, sf_dir), complaints_only_=True,
                         strip_punctuation=True)


@query("clean_text", with_views(["email_cases"], """
SELECT case_id, coalesce(lower(trim(regexp_replace(regexp_replace(
    concat(coalesce(Subject, 'nan'), ' ', coalesce(TextBody, 'nan')),
    '[^\\pL\\pN_\\s]', '', 'g'), '\\s+', ' ', 'g'))), '') AS input_text
FROM email_cases"""))
def q_clean_text(spark, sf_dir):
    """F12 over ``Subject + ' ' + TextBody`` (null prints as nan)."""
    from mailcase.functions.labels import as_text

    c = email_cases(spark, sf_dir)
    x = F.concat(as_text("Subject"), F.lit(" "), as_text("TextBody"))
    return c.select("case_id", T.clean_text(x).alias("input_text"))


@query("sentences", """
SELECT doc_id, CAST(len(string_split(text, '. ')) AS INTEGER) AS n_sentences,
       string_split(text, '. ')[1] AS first_sentence,
       md5(array_to_string(string_split(text, '. '), chr(31))) AS sentences_md5
FROM documents""")
def q_sentences(spark, sf_dir):
    """F15 over whole documents."""
    from mailcase.sources.tables import table

    d = table(spark, sf_dir, "documents")
    s = T.split_sentences("text")
    return d.select("doc_id", F.size(s).alias("n_sentences"), s[0].alias("first_sentence"),
                    F.md5(F.array_join(s, "\x1f")).alias("sentences_md5"))


@query("prepared_short", with_views(["prepared_cases"], """
SELECT Subject, TextBody, Complaint, Complaint_type FROM prepared_cases"""))
def q_prepared_short(spark, sf_dir):
    """The four-column form, without a key."""
    return prepare_cases(email_cases(spark, sf_dir), key=None, short=True)
