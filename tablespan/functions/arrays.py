"""Collection columns: membership, multiset equality and the two update modes."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# mode names of a collection update (fixed values of the query interface)
APPEND_MODE = "_DOPISZ_"
OVERWRITE_MODE = "_NADPISZ_"


def has_element(a: Column, value: Column | str) -> Column:
    """Membership; false, not an error, for an empty or missing collection."""
    return F.coalesce(F.array_contains(a, value), F.lit(False))


def same_elements(a: Column, b: Column) -> Column:
    """Multiset equality: order is ignored, repeats and size count."""
    return F.array_sort(a) == F.array_sort(b)


def append_missing(stored: Column, extra: Column) -> Column:
    """Add the elements of `extra` that `stored` lacks. Only the stored array is consulted, so
    repeats inside `extra` all arrive (`array_union` would drop them)."""
    return F.concat(stored, F.filter(extra, lambda x: ~F.array_contains(stored, x)))


def updated(stored: Column, extra: Column, mode: Column) -> Column:
    """Apply a change by its mode; any other mode, NULL included, leaves the array as it is."""
    return (F.when(mode == APPEND_MODE, append_missing(stored, extra))
            .when(mode == OVERWRITE_MODE, extra)
            .otherwise(stored))


def bounded(a: Column, limit: int) -> Column:
    """The array, which may hold at most `limit` elements; one that holds more is an error. For children
    without such a bound use `nested.nest`."""
    return F.when(F.size(a) > limit, F.raise_error(F.lit(f"more than {limit} elements"))).otherwise(a)
