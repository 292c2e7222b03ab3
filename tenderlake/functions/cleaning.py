"""Column expressions for cleaning raw notice fields.

All of these are built-in Catalyst expressions (no Python UDFs), so they stay
inside whole-stage codegen and can be pushed below joins by the optimizer.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .lookups import (AWARDED_CODE, BIDDER_BRACKETS, CPV_DIVISIONS, PROC_TYPE_MAP, RESULT_STATUSES,
                      SIZE_TIER_EDGES, SIZE_TIER_LABELS_EURO, SME_VALUES)


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def clean_date(c: str | Column) -> Column:
    """Strip a trailing ``±hh:mm`` or ``Z`` zone suffix and keep ``YYYY-MM-DD``."""
    s = F.regexp_replace(F.regexp_replace(col(c).cast("string"), r"[+\-]\d{2}:\d{2}$", ""), "Z$", "")
    return F.substring(s, 1, 10)


def to_date_lenient(c: str | Column) -> Column:
    """Typed twin of :func:`clean_date`: invalid text becomes NULL."""
    return F.try_to_date(clean_date(c))


def to_double(c: str | Column) -> Column:
    """Lenient number: anything that does not parse (or is NaN) becomes NULL."""
    v = col(c).try_cast("double")
    return F.when(~F.isnan(v), v)


def to_int(c: str | Column) -> Column:
    """Nullable integer, parsed through double like a lenient numeric cast."""
    return to_double(c).cast("int")


def non_negative(c: str | Column) -> Column:
    """Negative or non-numeric values become NULL."""
    v = to_double(c)
    return F.when(v >= 0, v)


def cpv_division(c: str | Column) -> Column:
    """CPV division = first two characters of the code."""
    return F.substring(col(c).cast("string"), 1, 2)


def _literal_map(d: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for kv in d.items() for x in kv])


def cpv_division_name(division: str | Column) -> Column:
    """Label of a CPV division; unknown divisions give NULL.

    The lookup is a literal map expression evaluated per row, so no join or
    broadcast is needed for it.
    """
    return F.try_element_at(_literal_map(CPV_DIVISIONS), col(division))


def normalise_proc_type(c: str | Column) -> Column:
    """Case-insensitive mapping of procurement type spellings; unknown kept."""
    return F.coalesce(F.try_element_at(_literal_map(PROC_TYPE_MAP), F.lower(col(c))), col(c))


def sme_flag(c: str | Column, values: tuple[str, ...] = SME_VALUES) -> Column:
    """True when the lower-cased size word is in ``values``; NULL -> False."""
    return F.coalesce(F.lower(col(c)).isin(*values), F.lit(False))


def awarded_flag(c: str | Column) -> Column:
    return F.coalesce(F.lower(col(c)) == F.lit(AWARDED_CODE), F.lit(False))


def result_status(c: str | Column) -> Column:
    return F.try_element_at(_literal_map(RESULT_STATUSES), F.lower(col(c)))


def fill_null_from(df, target: str, source: str):
    """Fill ``target`` from ``source`` where null; create the column if absent."""
    if target not in df.columns:
        return df.withColumn(target, col(source))
    return df.withColumn(target, F.coalesce(col(target), col(source)))


def date_prefix_filter(df, date_col: str, prefix: str | None):
    """Keep rows whose date string starts with ``prefix`` (NULL excluded)."""
    if not prefix:
        return df
    return df.where(col(date_col).startswith(prefix))


def blank_to_null(c: str | Column) -> Column:
    """Empty / literal null spellings become SQL NULL."""
    s = F.substring(col(c).cast("string"), 1, 10)
    return F.when(~s.isin("", "None", "nan", "NaT", "<NA>"), s)


def size_tier(c: str | Column, closed: str = "right", labels: tuple[str, ...] = SIZE_TIER_LABELS_EURO) -> Column:
    """Contract size tier on edges 50k / 500k / 5M.

    ``closed="right"``: (0,50k], (50k,500k], (500k,5M], (5M,inf); 0, negatives
    and NULL get no tier.  ``closed="left"``: (-inf,50k), [50k,500k), [500k,5M),
    [5M,inf); NULL gets no tier.
    """
    v = col(c)
    e1, e2, e3 = SIZE_TIER_EDGES
    l1, l2, l3, l4 = labels
    if closed == "right":
        return (F.when(v.isNull() | (v <= 0), None).when(v <= e1, l1).when(v <= e2, l2).when(v <= e3, l3)
                .otherwise(l4))
    return F.when(v.isNull(), None).when(v < e1, l1).when(v < e2, l2).when(v < e3, l3).otherwise(l4)


def interval_label(c: str | Column, bins: tuple[tuple[str, float, float], ...], closed: str = "right") -> Column:
    """Label of the (lo, hi] (or [lo, hi)) interval holding the value; NULL if none."""
    v = col(c)
    out = F.lit(None).cast("string")
    for label, lo, hi in reversed(bins):
        if closed == "right":
            cond = (v > lo) & (v <= hi) if hi != float("inf") else (v > lo)
        else:
            cond = (v >= lo) & (v < hi) if hi != float("inf") else (v >= lo)
        out = F.when(cond, label).otherwise(out)
    return out


def bidder_bracket(c: str | Column) -> Column:
    """Bidder bracket of a notice-average bidder count, left-closed [lo, hi);
    values below 1 (and NULL) get none."""
    v = col(c)
    out = F.lit(None).cast("string")
    for label, lo, hi in reversed(BIDDER_BRACKETS):
        out = F.when((v >= lo) & (v < hi), label).otherwise(out)
    return out
