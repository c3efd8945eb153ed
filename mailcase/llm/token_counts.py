"""Token counts as an exact length histogram.

Documents are encoded once, counted by encoded length, and suffix sums over
the histogram answer, for every context limit at once: how many documents
and tokens there are, how many documents are longer, and how many tokens are
left when every document is truncated to the limit.
"""

from __future__ import annotations

import base64

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from mailcase.llm.tables import stored

#: GPT-2's published split pattern, which belongs to the default vocabulary (fixed value).
PATTERN = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: Lengths of one bucket of the two-level suffix sums.
BUCKET = 1024


def token_lengths(docs: DataFrame, key: str = "doc_id", text: str = "text", *,
                  vocabulary: str = VOCABULARY, pattern: str = PATTERN) -> DataFrame:
    """(key, n_tokens) of every row; null and empty texts have 0 tokens.

    ``vocabulary`` is a file of base64 token and rank pairs. The driver reads
    it (about 1 MB, a fixed size) and sends it to the tasks, so executors need
    no such file.
    """
    with open(vocabulary, "rb") as f:
        sent = docs.sparkSession.sparkContext.broadcast(f.read())

    def run(batches):
        import tiktoken

        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, sent.value.splitlines())}
        enc = tiktoken.Encoding("vocabulary", pat_str=pattern, mergeable_ranks=ranks,
                                special_tokens={})
        for b in batches:
            yield pd.DataFrame({"k": b["k"], "n_tokens": [
                len(enc.encode_ordinary(t)) if t else 0 for t in b["t"]]})

    src = docs.select(F.col(key).alias("k"), F.col(text).alias("t"))
    kind = src.schema["k"].dataType.simpleString()
    return src.mapInPandas(run, f"k {kind}, n_tokens long").withColumnRenamed("k", key)


def length_histogram(lengths: DataFrame, length: str = "n_tokens") -> DataFrame:
    """Exact histogram with suffix sums, one row per occurring length L.

    (n_tokens = L, n_docs, total_tokens of these, docs_at_least, tokens_at_least
    over lengths >= L, truncated_total = sum of min(length, L) over all
    documents, share_at_most = part of all documents with length <= L). The
    quantile q is the smallest L with share_at_most >= q; the truncated total
    of a limit between two lengths follows from the next one above:
    truncated_total(L') - docs_at_least(L') * (L' - limit).

    The sums have two levels, inside buckets of ``BUCKET`` lengths and over
    the buckets' totals, so no task needs the whole histogram; the number of
    buckets is the longest length divided by ``BUCKET``.
    """
    h = stored(lengths.groupBy(F.col(length).alias("n_tokens")).agg(F.count(F.lit(1)).alias("n_docs"))
               .withColumn("total_tokens", F.col("n_tokens") * F.col("n_docs"))
               .withColumn("_b", F.floor(F.col("n_tokens") / BUCKET)), "lengths")
    per = h.groupBy("_b").agg(F.sum("n_docs").alias("d"), F.sum("total_tokens").alias("t"))
    over = Window.orderBy(F.col("_b").desc()).rowsBetween(Window.unboundedPreceding, -1)
    everything = Window.partitionBy()
    after = per.select("_b", F.coalesce(F.sum("d").over(over), F.lit(0)).alias("_d"),
                       F.coalesce(F.sum("t").over(over), F.lit(0)).alias("_t"),
                       F.sum("d").over(everything).alias("_docs"),
                       F.sum("t").over(everything).alias("_tokens"))
    inner = Window.partitionBy("_b").orderBy(F.col("n_tokens").desc())
    j = h.join(after, "_b")
    docs, tokens = F.sum("n_docs").over(inner), F.sum("total_tokens").over(inner)
    r = j.select("n_tokens", "n_docs", "total_tokens", (docs + F.col("_d")).alias("docs_at_least"),
                 (tokens + F.col("_t")).alias("tokens_at_least"), "_docs", "_tokens")
    below = F.col("_tokens") - F.col("tokens_at_least")
    shorter = F.col("_docs") - F.col("docs_at_least") + F.col("n_docs")
    return r.select("n_tokens", "n_docs", "total_tokens", "docs_at_least", "tokens_at_least",
                    (below + F.col("docs_at_least") * F.col("n_tokens")).alias("truncated_total"),
                    (shorter / F.col("_docs")).alias("share_at_most"))


def token_counts(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """The length histogram of a table of documents (see ``length_histogram``).

    Every row counts, repeated ones and null texts (length 0) too; keys don't
    matter. An empty table gives an empty histogram.
    """
    return length_histogram(token_lengths(docs, key, text, **options))
