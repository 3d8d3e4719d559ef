"""Joins of a large frame with a dimension.

No side is forced into a broadcast: Spark broadcasts one when its *measured*
size is within ``spark.sql.autoBroadcastJoinThreshold`` (file sizes when the
plan is made, shuffle sizes when adaptive execution replans), and joins by a
shuffle beyond it, where adaptive execution splits skewed partitions. A
dimension that has grown since is measured anew by every query. Callers
project a dimension to the few short columns that the join needs.

File sizes say little of a hash table's: ids compress well, and Spark gives a
column the share of its type's default width. A dimension of many rows, whose
count is known, is therefore marked by ``sized`` and never built by the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

#: What a broadcast hash table holds of a row with a short key and a column or two, about (rows of two
#: longs took 119 bytes).
ENTRY_BYTES = 100


def join_small(big: DataFrame, dim: DataFrame, on, how: str = "inner") -> DataFrame:
    """Join a large frame to a (usually small) dimension."""
    return big.join(dim, on, how)


def sized(dim: DataFrame, rows: int | None) -> DataFrame:
    """``dim``, known to have about ``rows`` rows, as a side of joins: where a hash table of so many
    would be beyond the broadcast threshold, joins with it (and with what is projected, filtered or
    grouped from it) are merge joins, whatever the size of its files. Without a count it stays as it is."""
    if rows is None:
        return dim
    limit = dim.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()  # noqa: SLF001
    return dim.hint("merge") if rows * ENTRY_BYTES > limit else dim
