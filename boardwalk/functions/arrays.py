"""Safe element access on stop arrays. Null or empty arrays give null (or 0
for the count) instead of the errors ANSI mode raises for ``a[0]``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def stop_count(arr: Column | str) -> Column:
    """Length of the array, counting null elements; 0 for a null array in
    either ANSI mode (``array_size(null)`` is null in both, unlike ``size``)."""
    return F.coalesce(F.array_size(_col(arr)), F.lit(0))


def first_item(arr: Column | str) -> Column:
    return F.get(_col(arr), 0)


def last_item(arr: Column | str) -> Column:
    return F.try_element_at(_col(arr), F.lit(-1))
