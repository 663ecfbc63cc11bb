"""Safe numeric typing as column expressions (bad text becomes null, never an error)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from vidgraph.functions.text import py_strip

_INF = float("inf")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def finite_double(c) -> Column:
    """``try_cast(x as double)`` with NaN and +-Infinity mapped to null.

    ``try_cast`` accepts ``NaN``/``Infinity``; those would sort first in a
    descending Spark sort, so the typed projection drops them to null.
    """
    d = _col(c).try_cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != F.lit(_INF)), d)


def to_integer(c) -> Column:
    """Graph-store ``toInteger(trim(x))``: integers exactly, decimals truncated
    toward zero, anything else null."""
    s = py_strip(_col(c))
    via_double = s.try_cast("double")
    via_double = F.when(~F.isnan(via_double) & (F.abs(via_double) != F.lit(_INF)), via_double)
    return F.coalesce(s.try_cast("bigint"), via_double.try_cast("bigint"))


def to_float(c) -> Column:
    """Graph-store ``toFloat(trim(x))``."""
    return finite_double(py_strip(_col(c)))
