"""Scalar column helpers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Quality bands of an average rating, highest first
# (> 8 star, > 7 good, > 6 average, otherwise bad; NULL average -> bad).
QUALITY_BANDS = ((8, "star"), (7, "good"), (6, "average"))
QUALITY_DEFAULT = "bad"


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def band(col, bands=QUALITY_BANDS, default=QUALITY_DEFAULT) -> Column:
    """Searched CASE over descending thresholds: first ``col > t`` wins;
    NULL input falls through to ``default``."""
    col = _c(col)
    expr = None
    for threshold, label in bands:
        cond = col > F.lit(threshold)
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(default)) if expr is not None else F.lit(default)


def exact_int(col) -> Column:
    """double -> int rounding half away from zero (Spark's cast truncates)."""
    return F.round(_c(col)).cast("int")


def to_type(col, type_name: str, strict: bool = False) -> Column:
    """CAST that gives NULL where the value does not fit the type (text that is
    no number, a number out of range, a date that does not exist).  ``strict``
    raises there instead, whatever the session's ANSI setting: a NULL that
    comes out of a value is an error."""
    col = _c(col)
    made = col.try_cast(type_name)
    if not strict:
        return made
    bad = F.raise_error(F.concat(F.lit(f"not a value of type {type_name}: "), col.cast("string"))).cast(type_name)
    return F.when(col.isNotNull() & made.isNull(), bad).otherwise(made)


def clock_to_seconds(col) -> Column:
    """'MM:SS' text to seconds; text without ':' is taken as it stands.

    More than one ':'-separated part -> mm*60 + ss (rounded to int); else
    the text cast to int; NULL stays NULL.
    """
    col = _c(col)
    parts = F.split(col, ":")
    mmss = F.element_at(parts, 1).cast("double") * 60 + F.element_at(parts, 2).cast("double")
    return F.when(F.size(parts) > 1, exact_int(mmss)).otherwise(col.cast("int"))


def day_of(ts) -> Column:
    """Calendar day of a timestamp.  ``to_date`` (unlike ``date_trunc``)
    turns an equality on the day into a range pushed to the Parquet scan."""
    return F.to_date(_c(ts))
