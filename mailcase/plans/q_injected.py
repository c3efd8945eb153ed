"""Registered queries whose inputs carry what the driver tables lack: long rows,
disclaimers, protected links, null keys, names, and operators that no other query
shows (S3, S8, P1, P10, J2, J3, A10, E11, E12, X5, F13, F14, F25). Each reads whole tables and adds the missing part by key.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from mailcase.functions.labels import PRIORITY5
from mailcase.functions.scores import probability_map
from mailcase.functions.text import remove_disclaimers, unwrap_url
from mailcase.operators import metrics as M
from mailcase.operators import profile as A
from mailcase.operators.filters import anonymize, removal_counts
from mailcase.operators.sampling import complement, top_k
from mailcase.plans.oracle_views import with_views
from mailcase.plans.prepare import prepare_cases
from mailcase.plans.q_metrics import CLASSES5, OVR_SRC, _cum_sql, _r, predictions
from mailcase.plans.q_sources import _na, scratch
from mailcase.plans.registry import query
from mailcase.sources import cases as S
from mailcase.sources.tables import class_logits, email_cases, metadata, table


def _one_vs_rest(spark, sf_dir):
    return M.label_binarize(predictions(spark, sf_dir), "label", "probs", keep=["id"])


@query("roc_curve_ovr", with_views(["class_probs"], """
SELECT class_id, round(CAST(score AS DOUBLE), 6) AS threshold, round(fp / N, 6) AS fpr,
       round(tp / P, 6) AS tpr FROM cumt
UNION ALL SELECT class_id, CAST('inf' AS DOUBLE), 0.0, 0.0 FROM tot""",
                                   dict(OVR_SRC, **_cum_sql("bs", "class_id"))))
def q_roc_curve_ovr(spark, sf_dir):
    """The ROC curve of every class against the rest."""
    c = M.roc_curve(_one_vs_rest(spark, sf_dir), "is_pos", "score", by=["class_id"])
    return c.select("class_id", _r("threshold"), _r("fpr"), _r("tpr"))


@query("pr_curve_ovr", with_views(["class_probs"], """
SELECT class_id, round(CAST(score AS DOUBLE), 6) AS threshold,
       round(tp / (tp + fp), 6) AS precision, round(tp / P, 6) AS recall FROM cumt
UNION ALL SELECT class_id, NULL, 1.0, 0.0 FROM tot""",
                                  dict(OVR_SRC, **_cum_sql("bs", "class_id"))))
def q_pr_curve_ovr(spark, sf_dir):
    """The precision-recall curve of every class against the rest."""
    c = M.pr_curve(_one_vs_rest(spark, sf_dir), "is_pos", "score", by=["class_id"])
    return c.select("class_id", _r("threshold"), _r("precision"), _r("recall"))


@query("long_rows_skipped", f"""
SELECT doc_id AS case_id, {_na("coalesce(lang, '')")} AS lang,
       CASE WHEN doc_id % 7 = 1 THEN NULL ELSE {_na("coalesce(source, '')")} END AS source
FROM documents WHERE doc_id % 7 <> 0""")
def q_long_rows_skipped(spark, sf_dir):
    """S3: rows with a field too many are skipped, short ones are padded with null.

    A seventh of the rows gets a fourth field and a seventh only two.
    """
    k, lang, src = F.col("doc_id"), F.coalesce("lang", F.lit("")), F.coalesce("source", F.lit(""))
    row = (F.when(k % 7 == 0, F.concat_ws(";", k, lang, src, F.lit("surplus")))
           .when(k % 7 == 1, F.concat_ws(";", k, lang)).otherwise(F.concat_ws(";", k, lang, src)))
    path = scratch(spark, "longrows")
    (table(spark, sf_dir, "documents").select(row.alias("case_id;lang;source"))
     .write.option("sep", "\u0001").option("header", True).csv(path))
    back = S.read_cases(spark, path)
    return back.select(F.col("case_id").cast("bigint").alias("case_id"), "lang", "source")


@query("results_roundtrip", with_views(["class_logits"], """
SELECT form, id, label, logits[2] > logits[1] AS predicted
FROM class_logits, (VALUES ('csv'), ('parquet')) f(form)"""))
def q_results_roundtrip(spark, sf_dir):
    """A table of predictions written as CSV and as Parquet, and read back."""
    p = class_logits(spark, sf_dir).select(
        "id", "label", (F.element_at("logits", 2) > F.element_at("logits", 1)).alias("predicted"))
    csv, parquet = scratch(spark, "results"), scratch(spark, "results")
    S.write_results(p, csv, "csv")
    S.write_results(p, parquet)
    a = S.read_labelled(spark, csv, sep=",", bool_cols=["predicted"]).select(
        F.lit("csv").alias("form"), F.col("id").cast("bigint").alias("id"),
        F.col("label").cast("int").alias("label"), "predicted")
    b = spark.read.schema(p.schema).parquet(parquet)
    return a.unionByName(b.select(F.lit("parquet").alias("form"), "id", "label", "predicted"))


@query("anonymized_cases", with_views(["email_cases"], """
SELECT case_id, '1' AS Name, Subject FROM email_cases"""))
def q_anonymized_cases(spark, sf_dir):
    """A name column, null for some rows, becomes a constant."""
    named = email_cases(spark, sf_dir).withColumn(
        "Name", F.when(F.col("case_id") % 5 > 0, F.concat(F.lit("Person "), "lang")))
    return anonymize(named).select("case_id", "Name", "Subject")


@query("removal_counts", with_views(["prepared_cases"], """
SELECT count(*) AS n_before,
       count(*) FILTER (WHERE Complaint_type IS DISTINCT FROM 'Not applicable') AS n_after
FROM prepared_cases"""))
def q_removal_counts(spark, sf_dir):
    """P10: rows before and after a removal."""
    return removal_counts(prepare_cases(email_cases(spark, sf_dir)), "Complaint_type", "Not applicable")


REPORT_COLS = ("Priority", "Complaint_type", "Complaint")
FILLED_COLS = ("Subject", "TextBody", "Priority", "Complaint_type")


@query("data_amount_report", with_views(["prepared_cases"], " UNION ALL ".join(
    [f"SELECT 'values' AS section, '{c}' AS \"column\", CAST({c} AS VARCHAR) AS value, "
     f"count(*) AS count FROM prepared_cases GROUP BY 3" for c in REPORT_COLS]
    + [f"SELECT 'non_empty', '{c}', NULL, count(*) FILTER (WHERE {c} <> '') FROM prepared_cases"
       for c in FILLED_COLS]
    + ["SELECT 'total', 'Complaint', NULL, count(*) FILTER (WHERE Complaint) FROM prepared_cases"])))
def q_data_amount_report(spark, sf_dir):
    """A10 with A6: value counts, non-empty counts and the complaint total in one scan."""
    return A.data_amount_report(prepare_cases(email_cases(spark, sf_dir)), REPORT_COLS,
                                FILLED_COLS, "Complaint")


@query("count_matching_null_safe", with_views(["email_cases", "metadata"], """
SELECT count(*) FILTER (WHERE hit) AS matched, count(*) AS total,
       count(*) FILTER (WHERE hit) / count(*) AS ratio
FROM (SELECT k.key IS NOT NULL OR k.here AS hit
      FROM (SELECT CASE WHEN Segment <> 'BUILDING' THEN Id END AS key FROM metadata) m
      LEFT JOIN (SELECT DISTINCT CASE WHEN lang <> 'en' THEN ParentId END AS key, true AS here
                 FROM email_cases) k ON m.key IS NOT DISTINCT FROM k.key)"""))
def q_count_matching_null_safe(spark, sf_dir):
    """J2 where a null key matches a null key; both sides have some."""
    m = metadata(spark, sf_dir).select(F.when(F.col("Segment") != "BUILDING", F.col("Id")).alias("Id"))
    e = email_cases(spark, sf_dir).select(F.when(F.col("lang") != "en", F.col("ParentId")).alias("ParentId"))
    return A.count_matching(m, e, "Id", "ParentId", null_safe=True)


@query("top_sources", """
SELECT source AS value, count(*) AS count FROM documents GROUP BY 1 ORDER BY 2 DESC, 1 LIMIT 3""")
def q_top_sources(spark, sf_dir):
    """The three most frequent sources (a top-k report)."""
    return top_k(A.value_counts(table(spark, sf_dir, "documents"), "source"), 3, "count", "value")


@query("protected_links", r"""
SELECT doc_id, regexp_replace(concat(
  'See https://checkpoint.url-protection.com/v1/url?o=http://shop.example/', CAST(doc_id AS VARCHAR),
  '&g=abc&h=1 now. ', text, ' http://checkpoint.url-protection.com/v1/url?o=x', lang, '&q'),
  'https?://checkpoint\.url-protection\.com/v1/url\?o=([^&]+)&', '\1', 'g') AS text
FROM documents""")
def q_protected_links(spark, sf_dir):
    """two protected links in every text give way to their targets."""
    t = F.concat(F.lit("See https://checkpoint.url-protection.com/v1/url?o=http://shop.example/"),
                 F.col("doc_id").cast("string"), F.lit("&g=abc&h=1 now. "), F.col("text"),
                 F.lit(" http://checkpoint.url-protection.com/v1/url?o=x"), F.col("lang"), F.lit("&q"))
    return table(spark, sf_dir, "documents").select("doc_id", unwrap_url(t).alias("text"))


# The four disclaimer rules in DuckDB's spelling.
DISCLAIMER_SQL = (r"ATTENTION: This is an external email.*?safe\.",
                  r"Please consider the environment before printing this email\.",
                  r"This message and any attachments are intended only for the addressee.*?",
                  r"https?://checkpoint\.url-protection\.com/[^ ]+")
_NOTED = ("concat('ATTENTION: this is an external EMAIL', chr(10), 'be sure it is safe. ', text, ' please consider "
          "the environment before printing this email. This message and any attachments are intended only for "
          "the addressee and https://checkpoint.url-protection.com/v2/', lang, ' end')")
for _p in DISCLAIMER_SQL:
    _NOTED = f"regexp_replace({_NOTED}, '(?is){_p}', '', 'g')"


@query("disclaimers", rf"""
SELECT doc_id, coalesce(trim(regexp_replace({_NOTED}, '\s+', ' ', 'g')), '') AS text FROM documents""")
def q_disclaimers(spark, sf_dir):
    """all four disclaimers stand in every text and go."""
    t = F.concat(F.lit("ATTENTION: this is an external EMAIL\nbe sure it is safe. "), F.col("text"),
                 F.lit(" please consider the environment before printing this email. This message and any "
                       "attachments are intended only for the addressee and "
                       "https://checkpoint.url-protection.com/v2/"), F.col("lang"), F.lit(" end"))
    return table(spark, sf_dir, "documents").select("doc_id", remove_disclaimers(t).alias("text"))


@query("complement_rows", with_views(["prepared_cases"], """
SELECT case_id, Subject FROM prepared_cases
WHERE case_id NOT IN (SELECT case_id FROM prepared_cases WHERE Complaint)"""))
def q_complement_rows(spark, sf_dir):
    """The rows of a frame that are not in a part of it, by key."""
    p = prepare_cases(email_cases(spark, sf_dir))
    return complement(p, p.where("Complaint"), "case_id").select("case_id", "Subject")


@query("probability_map", with_views(["class_probs"], f"""
SELECT id, class_name, round(probs[class_id + 1], 6) AS prob
FROM class_probs, (VALUES {CLASSES5}) c(class_name, class_id)"""))
def q_probability_map(spark, sf_dir):
    """the probability of every class by its name."""
    p = predictions(spark, sf_dir)
    return p.select("id", F.explode(probability_map("probs", PRIORITY5)).alias("class_name", "prob")
                    ).select("id", "class_name", _r("prob"))
