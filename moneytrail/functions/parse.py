"""Lenient typing of raw text: a bad number or date becomes NULL, never an error.

The typed layer must agree with the reference's embedded engine on the same
text, so two engine differences are smoothed here:

* integer casts accept a decimal text and round it (``'2026.0'`` -> 2026,
  ``'2.5'`` -> 3), as the reference's try-cast does;
* two-digit years below 69 are 20xx and from 69 up 19xx (``'05-JAN-69'`` is
  1969), where Spark's ``yy`` would read 2069.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.sources.schemas import MONEY


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def try_int(c) -> Column:
    """Text -> INT, NULL when not a number; decimal text is rounded half up."""
    return F.round(_col(c).try_cast(T.DecimalType(38, 10)), 0).try_cast(T.IntegerType())


def try_bigint(c) -> Column:
    """Text -> BIGINT, NULL when not a number."""
    return F.round(_col(c).try_cast(T.DecimalType(38, 10)), 0).try_cast(T.LongType())


def try_money(c) -> Column:
    """Text -> DECIMAL(14,2), NULL for ``$5``, ``1,000``, overflow or blanks."""
    return _col(c).try_cast(MONEY)


def try_date_mdy(c) -> Column:
    """``MMDDYYYY`` text -> DATE (NULL on bad month, day, length or blank)."""
    return F.try_to_date(_col(c), "MMddyyyy")


def try_date_dmy(c) -> Column:
    """``DD-MON-YY`` text (any case, one- or two-digit day) -> DATE."""
    c = _col(c)
    d = F.try_to_date(c, "d-MMM-yy")
    yy = F.substring_index(c, "-", -1).try_cast(T.IntegerType())
    return F.when(yy >= 69, F.add_months(d, -1200)).otherwise(d)
