from pyspark.sql import functions as F

from conftest import SF_SMALL
from mailcase.plans.prepare import prepare_cases, with_split
from mailcase.sources.tables import email_cases, table
from mailcase.streaming.cases import (prepare_stream, read_table_stream, run_prepare_stream,
                                      write_parquet_stream)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_stream_equals_batch(spark, tmp_out):
    out = run_prepare_stream(spark, SF_SMALL, f"{tmp_out}/out", f"{tmp_out}/ck")
    got = spark.read.parquet(out).select("case_id", "TextBody", "Complaint", "split")
    want = with_split(prepare_cases(email_cases(spark, SF_SMALL))).select(
        "case_id", "TextBody", "Complaint", "split")
    assert _rows(got) == _rows(want)


def test_stream_resumes_from_checkpoint(spark, tmp_out):
    """Files arriving after a run are processed once by the next run; earlier
    files are not repeated (the checkpoint records them)."""
    docs = table(spark, SF_SMALL, "documents")
    labels = table(spark, SF_SMALL, "labels")
    inbox = f"{tmp_out}/inbox"
    docs.where(F.col("doc_id") % 2 == 0).write.parquet(f"{inbox}/part=a")
    out, ck = f"{tmp_out}/out", f"{tmp_out}/ck"

    def run():
        stream = read_table_stream(spark, inbox, max_files_per_trigger=1)
        q = write_parquet_stream(prepare_stream(stream.drop("part"), labels), out, ck,
                                 partition_by=("split",))
        q.awaitTermination(300)
        assert q.exception() is None

    run()
    first = spark.read.parquet(out).count()
    docs.where(F.col("doc_id") % 2 == 1).write.parquet(f"{inbox}/part=b")
    run()
    got = spark.read.parquet(out)
    want = with_split(prepare_cases(email_cases(spark, SF_SMALL)))
    assert 0 < first < got.count()
    assert got.count() == got.select("case_id").distinct().count()
    assert _rows(got.select("case_id", "split")) == _rows(want.select("case_id", "split"))


def test_score_stream_equals_batch(spark, tmp_out):
    """M9 on a stream: the fitted pipeline (SQL, count, idf, norm, logistic
    stages) scores each micro-batch exactly as in batch."""
    import math

    from mailcase.functions.labels import BINARY, compose_text
    from mailcase.operators import models as ML
    from mailcase.plans.q_models import model_cases
    from mailcase.streaming.cases import score_stream

    cases = model_cases(spark, SF_SMALL)
    model = ML.train_logistic(cases.where("is_train"), "case_id", "text", "label_b", BINARY,
                              max_features=300, max_iter=10)
    docs = read_table_stream(spark, f"{SF_SMALL}/documents.parquet")
    stream = prepare_stream(docs, table(spark, SF_SMALL, "labels")).select(
        "case_id", compose_text("Subject", "TextBody").alias("text"))
    q = write_parquet_stream(score_stream(model, stream, BINARY), f"{tmp_out}/scores",
                             f"{tmp_out}/ck")
    q.awaitTermination(300)
    assert q.exception() is None
    got = {r["case_id"]: (r["pred_name"], r["probs"])
           for r in spark.read.parquet(f"{tmp_out}/scores").collect()}
    want = {r["case_id"]: (r["pred_name"], r["probs"])
            for r in ML.score(model, cases, BINARY, keep=["case_id"]).collect()}
    assert got.keys() == want.keys()
    for k, (name, probs) in want.items():
        assert got[k][0] == name
        assert all(math.isclose(a, b, rel_tol=1e-9) for a, b in zip(got[k][1], probs))
