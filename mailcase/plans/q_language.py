"""Registered queries for language detection and filtering (F16-F19, A3 on detections)."""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.functions.text import remove_disclaimers, unwrap_url
from mailcase.operators.language import (fit_language_model, keep_language,
                                         sentence_languages)
from mailcase.operators.sampling import in_sample
from mailcase.plans.oracle_views import with_views
from mailcase.plans.registry import query
from mailcase.sources.tables import email_cases, table

TRAIN_SQL = "substr(md5(concat(CAST(doc_id AS VARCHAR), ':42')), 1, 8) < 'cccccccc'"


def _model_sql() -> dict[str, str]:
    """CTEs fitting the trigram profiles on the training split of documents."""
    return {
        "tr": f"SELECT doc_id, text, lang FROM documents WHERE {TRAIN_SQL}",
        "trn": """SELECT doc_id, CASE WHEN length(c) > 0 THEN ' ' || c || ' ' END AS s
  FROM (SELECT doc_id, trim(regexp_replace(lower(text), '[^\\pL]+', ' ', 'g')) AS c FROM tr)""",
        "trg": """SELECT doc_id, unnest(list_transform(range(1, length(s) - 1),
  lambda i: substr(s, i, 3))) AS trigram FROM trn WHERE s IS NOT NULL""",
        "cnt": """SELECT tr.lang, trg.trigram, count(*) AS c FROM trg JOIN tr USING (doc_id)
  GROUP BY tr.lang, trg.trigram""",
        "langs": """SELECT lang, ln(N + (SELECT count(DISTINCT trigram) FROM cnt)) AS ln_norm
  FROM (SELECT lang, sum(c) AS N FROM cnt GROUP BY lang)""",
    }


def _detect_sql(src: str, keys: str) -> dict[str, str]:
    """CTEs scoring the texts of CTE ``src`` (columns ``keys``, ``text``) -> ``det``."""
    on = " AND ".join(f"a.{k} = b.{k}" for k in keys.split(", "))
    return {
        "dn": f"""SELECT {keys}, CASE WHEN length(c) > 0 THEN ' ' || c || ' ' END AS s
  FROM (SELECT {keys}, trim(regexp_replace(lower(text), '[^\\pL]+', ' ', 'g')) AS c FROM {src})""",
        "dg": f"""SELECT {keys}, unnest(list_transform(range(1, length(s) - 1),
  lambda i: substr(s, i, 3))) AS trigram FROM dn WHERE s IS NOT NULL""",
        "dtc": f"SELECT {keys}, trigram, count(*) AS n FROM dg GROUP BY {keys}, trigram",
        "dT": f"SELECT {keys}, sum(n) AS T FROM dtc GROUP BY {keys}",
        "dp": f"""SELECT {keys}, cnt.lang, sum(n * ln(cnt.c + 1)) AS s FROM dtc
  JOIN cnt USING (trigram) GROUP BY {keys}, cnt.lang""",
        "dscore": f"""SELECT {', '.join('a.' + k for k in keys.split(', '))}, l.lang,
  coalesce(b.s, 0) - a.T * l.ln_norm AS score
  FROM dT a CROSS JOIN langs l LEFT JOIN dp b ON {on} AND b.lang = l.lang""",
        "det": f"""SELECT {keys}, lang AS detected FROM (
  SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY score DESC, lang) AS rn
  FROM dscore) WHERE rn = 1""",
    }


def _model(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return fit_language_model(d.where(in_sample("doc_id", 0.8, 42)), "doc_id", "text", "lang")


@query("detect_language", with_views([], """
SELECT d.doc_id, coalesce(det.detected, 'unknown') AS detected
FROM documents d LEFT JOIN det USING (doc_id)""",
    dict(_model_sql(), src="SELECT doc_id, text FROM documents", **_detect_sql("src", "doc_id"))))
def q_detect_language(spark, sf_dir):
    """F16 on every document, profiles learned on the 80 % training split."""
    m = _model(spark, sf_dir)
    return m.detect(table(spark, sf_dir, "documents"), ["doc_id"], "text")


@query("language_accuracy", with_views([], f"""
SELECT d.lang, count(*) AS n, count(*) FILTER (WHERE det.detected = d.lang) AS n_correct
FROM documents d JOIN det USING (doc_id) WHERE NOT ({TRAIN_SQL}) GROUP BY d.lang""",
    dict(_model_sql(), src="SELECT doc_id, text FROM documents", **_detect_sql("src", "doc_id"))))
def q_language_accuracy(spark, sf_dir):
    """F16 hold-out check: per true language, rows and correct detections on the test split."""
    m = _model(spark, sf_dir)
    d = table(spark, sf_dir, "documents").where(~in_sample("doc_id", 0.8, 42))
    det = m.detect(d, ["doc_id"], "text")
    return d.select("doc_id", "lang").join(det, "doc_id").groupBy("lang").agg(
        F.count(F.lit(1)).alias("n"), F.count_if(F.col("detected") == F.col("lang")).alias(
            "n_correct"))


SENT_SQL = """SELECT doc_id, unnest(string_split(text, '. ')) AS text,
  generate_subscripts(string_split(text, '. '), 1) - 1 AS pos FROM documents"""


@query("keep_language", with_views([], """
SELECT d.doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.kept, '') END AS kept
FROM documents d LEFT JOIN (
  SELECT doc_id, string_agg(s.text, '. ' ORDER BY s.pos) AS kept
  FROM sents s JOIN det USING (doc_id, pos) WHERE det.detected = 'en' GROUP BY doc_id) k
USING (doc_id)""", dict(_model_sql(), sents=SENT_SQL, **_detect_sql("sents", "doc_id, pos"))))
def q_keep_language(spark, sf_dir):
    """F17 + F18: keep the English sentences of every document, in order."""
    m = _model(spark, sf_dir)
    return keep_language(table(spark, sf_dir, "documents"), "doc_id", "text", m, "en")


@query("sentence_languages", with_views([], """
SELECT s.doc_id, s.text AS sentence, CAST(min(s.pos) AS INTEGER) AS pos,
       any_value(coalesce(det.detected, 'unknown')) AS lang
FROM sents s LEFT JOIN det USING (doc_id, pos) GROUP BY s.doc_id, s.text""",
    dict(_model_sql(), sents=SENT_SQL, **_detect_sql("sents", "doc_id, pos"))))
def q_sentence_languages(spark, sf_dir):
    """the language of every distinct sentence of every document."""
    m = _model(spark, sf_dir)
    return sentence_languages(table(spark, sf_dir, "documents"), "doc_id", "text", m, distinct=True)


@query("preprocess_body", with_views(["email_cases"], """
SELECT e.case_id, CASE WHEN e.TextBody IS NOT NULL THEN coalesce(k.kept, '') END AS kept
FROM email_cases e LEFT JOIN (
  SELECT doc_id AS case_id, string_agg(s.text, '. ' ORDER BY s.pos) AS kept
  FROM sents s JOIN det USING (doc_id, pos) WHERE det.detected = 'en' GROUP BY doc_id) k
USING (case_id)""", dict(_model_sql(), dis="""
SELECT case_id AS doc_id, TextBody,
  trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(TextBody,
    '(?is)ATTENTION: This is an external email.*?safe\\.', '', 'g'),
    '(?is)Please consider the environment before printing this email\\.', '', 'g'),
    '(?is)This message and any attachments are intended only for the addressee.*?', '', 'g'),
    '(?is)https?://checkpoint\\.url-protection\\.com/[^ ]+', '', 'g'), '\\s+', ' ', 'g')) AS text
FROM email_cases""", sents="""
SELECT doc_id, unnest(string_split(text, '. ')) AS text,
  generate_subscripts(string_split(text, '. '), 1) - 1 AS pos FROM dis WHERE TextBody IS NOT NULL""",
    **_detect_sql("sents", "doc_id, pos"))))
def q_preprocess_body(spark, sf_dir):
    """F19 = F13 -> F14 -> F18 on case bodies, keeping English sentences."""
    m = _model(spark, sf_dir)
    c = email_cases(spark, sf_dir)
    body = F.when(F.col("TextBody").isNotNull(), unwrap_url(remove_disclaimers("TextBody")))
    kept = keep_language(c.select("case_id", body.alias("body")), "case_id", "body", m, "en")
    return kept
