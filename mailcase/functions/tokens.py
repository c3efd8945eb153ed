"""Word tokens and n-grams as array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: a token is a run of 2+ word characters of the lower-cased text ---
TOKEN_CHAR = r"[\p{L}\p{N}_]"
TOKEN_PATTERN = TOKEN_CHAR + "{2,}"
# --- end of fixed values ---


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def word_tokens(text) -> Column:
    """lower-case, then every run of 2+ word characters; null -> empty array."""
    t = F.coalesce(_col(text), F.lit(""))
    return F.regexp_extract_all(F.lower(t), F.lit(TOKEN_PATTERN), 0)


def truncate(tokens, n: int) -> Column:
    """keep the first ``n`` tokens (a token budget)."""
    return F.slice(_col(tokens), 1, max(int(n), 0)) if n > 0 else F.array().cast("array<string>")


def ngrams(tokens, n: int) -> Column:
    """contiguous ``n``-grams joined by a space; empty when fewer than ``n`` tokens.

    The ``n`` shifted slices are zipped, so the lambda only sees struct
    fields and never re-evaluates the token expression.
    """
    t = _col(tokens)
    if n == 1:
        return t
    k = F.size(t) - F.lit(n - 1)
    shifted = [F.slice(t, i + 1, F.greatest(k, F.lit(0))) for i in range(n)]
    zipped = F.arrays_zip(*shifted)
    joined = F.transform(zipped, lambda s: F.concat_ws(" ", *[s[str(i)] for i in range(n)]))
    return F.when(k > 0, joined).otherwise(F.array().cast("array<string>"))


def uni_bi_grams(tokens) -> Column:
    """``ngram_range=(1, 2)``: unigrams followed by bigrams."""
    t = _col(tokens)
    return F.concat(t, ngrams(t, 2))
