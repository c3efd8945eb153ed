"""DuckDB text of the fixture views (the oracle side of ``sources.tables``).

Each entry is the body of a CTE; ``with_views`` prepends the ones a query
needs. DuckDB regexes are RE2: ASCII classes, no lookbehind, and a
replacement string cannot contain ``\\n`` (use ``chr(10)``).
"""

from __future__ import annotations

VIEWS: dict[str, str] = {}

VIEWS["email_cases"] = """
SELECT d.doc_id AS case_id,
  CASE WHEN d.doc_id % 23 = 0 THEN NULL
       WHEN d.doc_id % 11 = 0 THEN concat('Automatic reply: ', d.source)
       WHEN d.doc_id % 11 = 1 THEN concat('re: order ', CAST(d.doc_id AS VARCHAR))
       WHEN d.doc_id % 11 = 2 THEN concat('Software: ', d.source)
       ELSE concat('Order ', CAST(d.doc_id AS VARCHAR), ' ', d.source) END AS Subject,
  CASE d.doc_id % 8
       WHEN 0 THEN NULL
       WHEN 1 THEN concat('ATTENTION: external sender, check it is safe.', chr(10), d.text)
       WHEN 2 THEN concat(d.text, chr(10), 'Kind regards,', chr(10), 'A. Person')
       WHEN 3 THEN concat(d.text, chr(10), 'Van: x', chr(10), 'Aan: y')
       WHEN 4 THEN concat(d.text, chr(10), 'a.person@example.com', chr(10), 'Tel 0123456789 desk')
       WHEN 5 THEN concat('### Form 7', chr(10), d.text, chr(10), chr(10), chr(10),
            'The information contained in this communication is private, no obligation. End')
       ELSE d.text END AS TextBody,
  CASE d.doc_id % 9 WHEN 0 THEN 'Low' WHEN 1 THEN 'Normal' WHEN 2 THEN 'Urgent'
       WHEN 3 THEN 'Immediate' WHEN 4 THEN ' Normal ' WHEN 5 THEN 'Medium'
       WHEN 6 THEN 'Critical' WHEN 7 THEN '' ELSE NULL END AS Priority,
  CASE WHEN l.doc_id IS NULL THEN NULL WHEN l.toxic = 1 THEN 'Quality'
       WHEN l.quality = 0 THEN ''
       WHEN d.doc_id % 4 = 0 THEN 'Packaging' WHEN d.doc_id % 4 = 1 THEN 'Logistics'
       WHEN d.doc_id % 4 = 2 THEN 'Pricing errors' ELSE 'Not applicable' END AS Type_of_Complaint,
  d.lang AS lang, concat('P', CAST(d.doc_id % 300 AS VARCHAR)) AS ParentId
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
"""

# The body cleaner's rules F1-F8 (then F10) in RE2 syntax: (pattern, replacement SQL).
CLEAN_BODY_STEPS = (
    (r"(?is)ATTENTION:.*?safe\.", "''"),
    (r"(?is)(Best regards.*|Kind regards.*|Regards,.*)", "''"),
    (r"(?is)The information contained in this communication.*?obligation\.", "''"),
    (r"(?is)(Van:.*|Verzonden:.*|Aan:.*|Onderwerp:.*)", "''"),
    (r"(?s)[^\n\r]+@[^\n\r]+\n.*?\d{9,}.*", "''"),
    (r"###\s*.*\n", "''"),
    (r"\n{3,}", "chr(10) || chr(10)"),
)


def collapse_sql(x: str) -> str:
    return f"trim(regexp_replace({x}, '\\s+', ' ', 'g'))"


def clean_body_sql(x: str) -> str:
    for pattern, repl in CLEAN_BODY_STEPS:
        x = f"regexp_replace({x}, '{pattern}', {repl}, 'g')"
    x = collapse_sql(x)
    return collapse_sql(f"regexp_replace({x}, '[\\n\\r]+', ' ', 'g')")


AUTO_REPLY_SQL = ("coalesce(regexp_matches({x}, "
                  "'Automatic reply|Automatisch antwoord|Fw:|RE:', 'i'), false)")
IS_COMPLAINT_SQL = "coalesce({x} IS NOT NULL AND {x} <> '', false)"


VIEWS["prepared_cases"] = f"""
SELECT case_id, Subject, {clean_body_sql('TextBody')} AS TextBody, Priority, Type_of_Complaint,
  {IS_COMPLAINT_SQL.format(x='Type_of_Complaint')} AS Complaint,
  Type_of_Complaint AS Complaint_type
FROM email_cases
WHERE NOT {AUTO_REPLY_SQL.format(x='Subject')}
"""

VIEWS["metadata"] = """
SELECT concat('P', CAST(c_custkey + 50 AS VARCHAR)) AS Id, c_mktsegment AS Segment
FROM customer
"""

VIEWS["class_logits"] = """
SELECT vec_id AS id, CAST(label % 5 AS INTEGER) AS label,
  [list_sum(CAST(embedding[1:64:5] AS DOUBLE[])), list_sum(CAST(embedding[2:64:5] AS DOUBLE[])),
   list_sum(CAST(embedding[3:64:5] AS DOUBLE[])), list_sum(CAST(embedding[4:64:5] AS DOUBLE[])),
   list_sum(CAST(embedding[5:64:5] AS DOUBLE[]))] AS logits
FROM embeddings
"""

# Softmax element k of a logits list, numerically stable.
VIEWS["class_probs"] = """
SELECT id, label, logits,
  list_transform(logits, lambda x: exp(x - list_max(logits)) /
    list_sum(list_transform(logits, lambda y: exp(y - list_max(logits))))) AS probs
FROM class_logits
"""

VIEWS["binary_scores"] = """
SELECT id, CAST(label = 1 AS INTEGER) AS label, probs[2] AS score FROM class_probs
"""

VIEWS["tied_scores"] = """
SELECT id, label, round(score, 2) AS score FROM binary_scores
"""

VIEWS["training_log"] = """
SELECT CAST(user_id % 4 AS BIGINT) AS run, event_id AS step,
  CASE WHEN event_type <> 'purchase' THEN value END AS loss,
  CASE WHEN event_type = 'purchase' THEN value / 1000.0 END AS eval_accuracy
FROM events
"""

# Dependencies between views, so ``with_views`` can order the CTEs.
DEPENDS = {
    "prepared_cases": ["email_cases"],
    "class_probs": ["class_logits"],
    "binary_scores": ["class_probs"],
    "tied_scores": ["binary_scores"],
}


def _closure(names):
    out: list[str] = []

    def visit(n):
        for d in DEPENDS.get(n, []):
            visit(d)
        if n not in out:
            out.append(n)
    for n in names:
        visit(n)
    return out


def with_views(names, body: str, extra: dict[str, str] | None = None) -> str:
    """``WITH v1 AS (...), v2 AS (...) <body>`` for the named views (+ extra CTEs)."""
    ctes = [f"{n} AS ({VIEWS[n]})" for n in _closure(names)]
    ctes += [f"{n} AS ({sql})" for n, sql in (extra or {}).items()]
    return "WITH " + ",\n".join(ctes) + "\n" + body
