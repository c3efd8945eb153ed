"""Text cleaning as Spark column expressions (no UDFs).

Every function maps ``Column -> Column`` and stays inside whole-stage
codegen. Null input gives null output unless the docstring says otherwise.

Regex dialect: Java patterns are ASCII by default while the cleaning rules
are defined over Unicode text, so whitespace is spelled ``[\\s\\x1c-\\x1f]``
under ``(?U)``, a word character ``[\\p{L}\\p{N}_]``, ``.`` without DOTALL
is written ``(?d:.)`` (only ``\\n`` ends a line) and case-insensitive
matching uses ``(?iu)``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values: cleaning rules that must match the reference results ---
# Body cleaner steps, applied in this order (pattern, replacement).
BANNER = r"(?isu)ATTENTION:.*?safe\."                                          # F1
SIGNATURE = r"(?isu)(Best regards.*|Kind regards.*|Regards,.*)"                # F2
CONFIDENTIALITY = r"(?isu)The information contained in this communication.*?obligation\."  # F3
QUOTED_HEADER = r"(?isu)(Van:.*|Verzonden:.*|Aan:.*|Onderwerp:.*)"             # F4
# a line holding an e-mail address, then a 9+ digit run later on: cut to
# the end. The lookbehind only lets a match start at a line start, which
# keeps the scan linear and gives the same leftmost match.
CONTACT_BLOCK = r"(?Us)(?<![^\n\r])[^\n\r]+@[^\n\r]+\n.*?\d{9,}.*"
FORM_HEADER = r"(?U)###[\s\x1c-\x1f]*(?d:.*)\n"                               # F6
MANY_NEWLINES = r"\n{3,}"                                                      # F7
WHITESPACE_RUN = r"(?U)[\s\x1c-\x1f]+"                                         # F8
NEWLINE_RUN = r"[\n\r]+"                                                       # F10
NOT_WORD_OR_SPACE = r"(?U)[^\p{L}\p{N}_\s\x1c-\x1f]"                           # F12
EDGE_WHITESPACE = r"(?U)^[\s\x1c-\x1f]+|[\s\x1c-\x1f]+$"                       # strip()
# The 32 ASCII punctuation marks.
ASCII_PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
# Disclaimer patterns (F13), case-insensitive and dot-all, in this order.
DISCLAIMERS = (
    r"ATTENTION: This is an external email.*?safe\.",
    r"Please consider the environment before printing this email\.",
    r"This message and any attachments are intended only for the addressee.*?",
    r"https?://checkpoint\.url-protection\.com/[^ ]+",
)
# Protected link -> original target (F14); the trailing lazy group matches nothing.
PROTECTED_LINK = r"https?://checkpoint\.url-protection\.com/v1/url\?o=([^&]+)&.*?"
SENTENCE_SEPARATOR = ". "                                                      # F15
# --- end of fixed values ---

# The same matches found sooner: a signature or header is only tried at its first
# letters (U+212A is a k to a case-insensitive match).
SIGNATURE_AT = r"(?s)(?=[BbKkRr\x{212A}])(?iu:Best regards.*|Kind regards.*|Regards,.*)"
QUOTED_HEADER_AT = r"(?s)(?=[VvAaOo])(?iu:Van:.*|Verzonden:.*|Aan:.*|Onderwerp:.*)"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """Python ``str.strip()``: trims Unicode whitespace, not only spaces."""
    return F.regexp_replace(_col(c), EDGE_WHITESPACE, "")


def collapse_whitespace(c) -> Column:
    """F8: every whitespace run becomes one space, then strip.

    After the collapse the only whitespace left is ``' '``, so the strip is
    a plain space trim.
    """
    return F.trim(F.regexp_replace(_col(c), WHITESPACE_RUN, " "))


def _guarded(c, needed: str, pattern: str) -> Column:
    """Remove ``pattern`` where ``needed``, which every match contains, occurs at all.

    Without it each opener of a text would be searched for to its end in vain.
    """
    x = _col(c)
    return F.when(x.rlike(needed), F.regexp_replace(x, pattern, "")).otherwise(x)


def remove_banner(c) -> Column:
    return _guarded(c, r"(?iu)safe\.", BANNER)


def remove_signature(c) -> Column:
    return F.regexp_replace(_col(c), SIGNATURE_AT, "")


def remove_confidentiality(c) -> Column:
    return _guarded(c, r"(?iu)obligation\.", CONFIDENTIALITY)


def remove_quoted_header(c) -> Column:
    return F.regexp_replace(_col(c), QUOTED_HEADER_AT, "")


def remove_contact_block(c) -> Column:
    return _guarded(c, r"(?U)\d{9,}", CONTACT_BLOCK)


def remove_form_header(c) -> Column:
    return F.regexp_replace(_col(c), FORM_HEADER, "")


def squeeze_newlines(c) -> Column:
    return F.regexp_replace(_col(c), MANY_NEWLINES, "\n\n")


def clean_body(c) -> Column:
    """F1 -> F8 in order; null stays null."""
    x = _col(c)
    for step in (remove_banner, remove_signature, remove_confidentiality,
                 remove_quoted_header, remove_contact_block, remove_form_header,
                 squeeze_newlines, collapse_whitespace):
        x = step(x)
    return x


def clean_whitespace(c) -> Column:
    """newline runs -> space, collapse whitespace, strip."""
    return collapse_whitespace(F.regexp_replace(_col(c), NEWLINE_RUN, " "))


def remove_punctuation(c) -> Column:
    """delete the 32 ASCII punctuation marks; case is kept."""
    return F.translate(_col(c), ASCII_PUNCTUATION, "")


def clean_text(c) -> Column:
    """drop non-word non-space characters, collapse, strip, lower.

    Null gives ``''``.
    """
    x = F.regexp_replace(_col(c), NOT_WORD_OR_SPACE, "")
    return F.coalesce(F.lower(collapse_whitespace(x)), F.lit(""))


def remove_disclaimers(c) -> Column:
    """the four disclaimer patterns, then collapse; null gives ``''``."""
    x = _col(c)
    for p in DISCLAIMERS:
        x = F.regexp_replace(x, "(?isu)" + p, "")
    return F.coalesce(collapse_whitespace(x), F.lit(""))


def unwrap_url(c) -> Column:
    """replace a protected link by its original target."""
    return F.regexp_replace(_col(c), PROTECTED_LINK, "$1")


def split_sentences(c) -> Column:
    """split on ``'. '``, keeping empty pieces like ``str.split``."""
    return F.split(_col(c), r"\. ", -1)


def lower_strip(c) -> Column:
    """cast to string, strip, lower."""
    return F.lower(strip(_col(c).cast("string")))
