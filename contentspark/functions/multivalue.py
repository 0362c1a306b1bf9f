"""Multi-value predicate helpers.

Every document field may hold several values. A positive predicate holds when
*any* value satisfies it; a negative predicate holds when *no* value does,
including when the field is missing. SQL three-valued logic would make the
negation NULL on a missing field, so every helper coalesces before negating.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def any_match(arr: Column, pred: Callable[[Column], Column]) -> Column:
    """True when some element satisfies ``pred``; False on a missing array."""
    return F.coalesce(F.exists(arr, pred), F.lit(False))


def none_match(arr: Column, pred: Callable[[Column], Column]) -> Column:
    """True when no element satisfies ``pred`` (also when the array is missing)."""
    return ~any_match(arr, pred)


def all_present(arr: Column, values: Iterable) -> Column:
    """Every listed value occurs in ``arr`` (AND semantics)."""
    vals = list(values)
    if not vals:
        return F.lit(True)
    return F.coalesce(F.size(F.array_except(F.array(*[F.lit(v) for v in vals]), arr)) == 0,
                      F.lit(False))


def overlaps(arr: Column, values: Iterable) -> Column:
    """Some listed value occurs in ``arr`` (IN semantics); False when missing."""
    vals = list(values)
    if not vals:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(arr, F.array(*[F.lit(v) for v in vals])), F.lit(False))


def and_all(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out & c)
    return F.lit(True) if out is None else out


def or_all(cols: Iterable[Column]) -> Column:
    out = None
    for c in cols:
        out = c if out is None else (out | c)
    return F.lit(False) if out is None else out


def clean_list(values) -> list:
    """Drop falsy entries (0, '', None) from an ``__in``-style argument list.

    An empty list after cleaning means "no filter" for the caller.
    """
    if values is None:
        return []
    if isinstance(values, (str, int, float)):
        values = [values]
    return [v for v in values if v not in (0, "", None, "0")]
