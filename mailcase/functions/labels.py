"""Label sets and label expressions.

A label set is an ordered list of class names; the position is the class
id. Lookups compile to a literal map (``create_map``), so they stay JVM-side
and need no join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F

from mailcase.functions.text import strip


@dataclass(frozen=True)
class LabelSet:
    name: str
    classes: tuple[str, ...]

    def __len__(self) -> int:
        return len(self.classes)

    def index_of(self, cls: str) -> int:
        return self.classes.index(cls)

    def lookup_map(self) -> Column:
        pairs = []
        for i, c in enumerate(self.classes):
            pairs += [F.lit(c), F.lit(i)]
        return F.create_map(*pairs)

    def names(self) -> Column:
        return F.array(*[F.lit(c) for c in self.classes])


# --- fixed values: label sets of the reference (id = position) ---
BINARY = LabelSet("binary", ("false", "true"))
TYPE4 = LabelSet("type4", ("packaging", "logistics", "quality", "pricing errors"))
TYPE6 = LabelSet("type6", ("", "packaging", "logistics", "quality", "not applicable",
                           "pricing errors"))
PRIORITY5 = LabelSet("priority5", ("Low", "Normal", "Urgent", "Immediate", "nan"))
PRIORITY7 = LabelSet("priority7", ("Medium", "Low", "Normal", "Urgent", "nan", "Immediate",
                                   "Critical"))
NULL_TOKEN = "nan"  # text a missing value prints as
# --- end of fixed values ---

LABEL_SETS = {s.name: s for s in (BINARY, TYPE4, TYPE6, PRIORITY5, PRIORITY7)}


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c, null_token: str = NULL_TOKEN) -> Column:
    """``str(x)`` of a nullable value: null prints as ``null_token``."""
    return F.coalesce(_col(c).cast("string"), F.lit(null_token))


def is_complaint(c) -> Column:
    """P5: complaint type present and not empty; never null."""
    x = _col(c)
    return F.coalesce(x.isNotNull() & (x != F.lit("")), F.lit(False))


def compose_text(subject, body, null_token: str = NULL_TOKEN) -> Column:
    """``"Subject: " + S + "\\nBody: " + B``."""
    return F.concat(F.lit("Subject: "), as_text(subject, null_token),
                    F.lit("\nBody: "), as_text(body, null_token))


def binary_label(c) -> Column:
    """1 when ``lower(str(x)) == 'true'`` else 0."""
    return F.coalesce((F.lower(_col(c).cast("string")) == F.lit("true")).cast("int"), F.lit(0))


def encode(c, label_set: LabelSet, *, lower: bool = False, trim: bool = False,
           default: int | None = None, null_token: str = NULL_TOKEN) -> Column:
    """Generic label lookup: ``str(x)`` -> optional strip/lower -> id, else ``default``."""
    x = as_text(c, null_token)
    if trim:
        x = strip(x)
    if lower:
        x = F.lower(x)
    hit = label_set.lookup_map()[x]
    return F.coalesce(hit, F.lit(default)).cast("int") if default is not None else hit.cast("int")


def type4_label(c) -> Column:
    """Lower-cased lookup in the 4-class type set, default 0."""
    return encode(c, TYPE4, lower=True, default=0)


def type6_label(c) -> Column:
    """Lower-cased lookup in the 6-class type set (incl. ``''``), default 0."""
    return encode(c, TYPE6, lower=True, default=0)


def priority5_label(c) -> Column:
    """Strip; ``''``/``nan`` -> 4; case-sensitive lookup, default 4."""
    return encode(c, PRIORITY5, trim=True, default=PRIORITY5.index_of("nan"))


def priority7_label(c) -> Column:
    """Null -> ``nan``; exact lookup (no strip); unmapped -> ``nan`` id."""
    return encode(c, PRIORITY7, default=PRIORITY7.index_of("nan"))


def decode(idx, label_set: LabelSet) -> Column:
    """P20: class id -> name (null when out of range)."""
    return F.try_element_at(label_set.names(), _col(idx).cast("int") + F.lit(1))


def matches_text(pred, truth) -> Column:
    """``predicted == lower(str(truth))``."""
    return F.coalesce(_col(pred) == F.lower(as_text(truth)), F.lit(False))
