"""Instruction / output pairs from a case export."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from mailcase.functions.labels import as_text
from mailcase.functions.text import clean_text

# --- fixed values: prompt and answer templates ---
INSTRUCTION_TEMPLATE = """Analyze the following complaint text and identify:
1. The root cause of the complaint
2. Additional contextual information

Input Text: %s

Provide your analysis focusing on:
- Precise root cause classification
- Relevant extra information"""
OUTPUT_TEMPLATE = """Root Cause: %s
Additional Information: %s"""
# --- end of fixed values ---


def instruction_pairs(df: DataFrame, subject: str = "Subject", body: str = "TextBody",
                      root_cause: str = "Root_Cause", extra: str = "Extra_Information",
                      keep: tuple[str, ...] = ()) -> DataFrame:
    """``instruction`` (cleaned ``Subject Body`` in the prompt) and
    ``output`` (cleaned root cause and extra information). Missing values
    print as ``nan`` before cleaning."""
    text = clean_text(F.concat(as_text(subject), F.lit(" "), as_text(body)))
    return df.select(
        *keep,
        F.format_string(INSTRUCTION_TEMPLATE, text).alias("instruction"),
        F.format_string(OUTPUT_TEMPLATE, clean_text(as_text(root_cause)),
                        clean_text(as_text(extra))).alias("output"))
