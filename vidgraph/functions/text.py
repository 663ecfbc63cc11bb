"""Text cleaning of crawl lines as Spark column expressions.

The rules follow Python string semantics so that a crawl parsed here equals
the reference's row-by-row parser:

* ``py_strip`` removes what ``str.strip()`` removes.  Spark's one-argument
  ``trim`` only removes the space character, so the two-argument form with the
  full character set is used (it compares whole code points, so multi-byte
  blanks such as U+3000 are handled).
* Plain ``trim``/``startswith``/``substring`` keep the per-field work free of
  regular expressions on the ingest hot path.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters for which Python's str.isspace() is true, i.e.
# what str.strip() removes (Unicode White_Space plus the separators U+001C..U+001F).
PY_WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)
BOM = "\ufeff"


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def py_strip(c) -> Column:
    """``str.strip()``: drop leading and trailing Unicode blanks."""
    return F.trim(_col(c), F.lit(PY_WHITESPACE))


def _drop_lead_bom(c: Column) -> Column:
    return F.when(c.startswith(BOM), F.substring(c, 2, 1 << 30)).otherwise(c)


def _wrapped_in_quotes(c: Column) -> Column:
    return (F.length(c) >= 2) & c.startswith('"') & c.endswith('"')


def _inner(c: Column) -> Column:
    return F.substring(c, F.lit(2), F.length(c) - 2)


def strip_outer_quotes(c) -> Column:
    """Drop trailing CR/LF, then exactly one pair of quotes around the whole line."""
    s = F.rtrim(_col(c), F.lit("\r\n"))
    return F.when(_wrapped_in_quotes(s), _inner(s)).otherwise(s)


def split_fields(c) -> Column:
    """Split on literal tabs, keeping trailing empty fields."""
    return F.split(_col(c), "\t", -1)


def clean_id(c) -> Column:
    """ID cleaning: null -> ''; strip; drop one leading BOM; drop all leading and
    all trailing double quotes (no second strip)."""
    s = _drop_lead_bom(py_strip(F.coalesce(_col(c), F.lit(""))))
    return F.trim(s, F.lit('"'))


def clean_cell(c) -> Column:
    """Attribute cleaning: null -> ''; strip; drop one leading BOM; if wrapped in
    quotes, drop one pair and turn doubled inner quotes into single ones."""
    s = _drop_lead_bom(py_strip(F.coalesce(_col(c), F.lit(""))))
    return F.when(_wrapped_in_quotes(s), F.replace(_inner(s), F.lit('""'), F.lit('"'))).otherwise(s)
