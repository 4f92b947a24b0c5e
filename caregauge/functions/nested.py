"""Array helpers."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def concat_present(*arrays: Column | str) -> Column:
    """Concatenate arrays, skipping the null ones."""
    return F.flatten(F.array_compact(F.array(*arrays)))


def any_of(array: Column | str, values: Iterable[str]) -> Column:
    """True when the array holds one of the values; false, never null, otherwise."""
    wanted = [F.lit(value) for value in values]
    if not wanted:
        return F.lit(False)
    return F.coalesce(F.arrays_overlap(array, F.array(*wanted)), F.lit(False))
