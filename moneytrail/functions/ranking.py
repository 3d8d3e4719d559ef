"""Exact ranks and percentiles without funnelling a group into one task.

``Window.partitionBy(signal).orderBy(value)`` would put a whole cohort (which
grows with the candidate table) into a single task, and an unpartitioned
``row_number()`` moves every row into one partition. ``running_before`` computes
the same numbers by levels: the order is refined from coarse to fine keys, rows
are counted per key (pre-aggregated before the shuffle), and at each level a
window runs only over the keys that share the coarser one. The sum of what lies
before at every level is the number of rows before. It is one plan for every
size: nothing is sampled, counted or checkpointed while it is built.

Hot values never form a large window group: percentiles collapse equal values
first, and their join back is an inner join that adaptive execution may split.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Values are shares, mostly between 0 and 1: the coarse key has so many steps there.
STEPS = 1024
#: Leading characters of an id that make a key of their own.
ID_PREFIX = 6


def _coarse(value: Column) -> Column:
    """A key that grows with the value: STEPS steps from 0 to 1, the rest at its ends."""
    return F.greatest(F.lit(-1), F.least(F.lit(STEPS), F.floor(value * STEPS))).cast("int")


Key = tuple[str, Column, bool]  # name, value, descending


def running_before(df: DataFrame, part_cols: list[str], levels: list[list[Key]],
                   weight: str, out: str, total: str | None = None) -> DataFrame:
    """Add ``out`` = sum of ``weight`` over the rows of the same group that come
    strictly before in the order of ``levels``, and, as ``total``, the sum over the
    group. Each level is a list of keys that refines the levels before it; the last
    must be unique within the others."""
    rows = df.select("*", *[k.alias(n) for level in levels for n, k, _ in level])
    before: DataFrame | None = None
    keys = list(part_cols)
    for i, level in enumerate(levels):
        names = [n for n, _, _ in level]
        order = [F.col(n).desc() if desc else F.col(n).asc() for n, _, desc in level]
        w = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
        here = F.coalesce(F.sum("_w").over(w), F.lit(0))
        if i == len(levels) - 1:
            found = rows.withColumn("_w", F.col(weight))
        else:
            found = rows.groupBy(*keys, *names).agg(F.sum(weight).alias("_w"))
        if i == 0 and total is not None:
            found = found.withColumn(total, F.sum("_w").over(Window.partitionBy(*keys)))
        found = found.withColumn("_here", here).drop("_w")
        if before is None:
            before = found.withColumnRenamed("_here", "_before")
        else:
            before = (found.join(before, keys)
                      .withColumn("_before", F.col("_before") + F.col("_here")).drop("_here"))
        keys += names
    return before.withColumnRenamed("_before", out).drop(*[n for level in levels for n, _, _ in level])


def value_counts(df: DataFrame, part_cols: list[str], value: str, out: str = "_m") -> DataFrame:
    """One row per group and distinct ``value`` with its number of rows: what hot values
    collapse to. Plans that read it several times share its shuffle."""
    return df.groupBy(*part_cols, value).agg(F.count(F.lit(1)).alias(out))


def below_per_value(counts: DataFrame, part_cols: list[str], value: str,
                    out: str = "below", present: str | None = None) -> DataFrame:
    """From ``value_counts``: per group and value the number of rows with a strictly smaller
    value, and, as ``present``, the number of rows of the group."""
    levels = [[("_l1", _coarse(F.col(value)), False)], [("_l2", F.col(value), False)]]
    return running_before(counts, part_cols, levels, "_m", out, present).drop("_m")


def count_strictly_below(df: DataFrame, part_cols: list[str], value: str,
                         out: str = "below", present: str | None = None) -> DataFrame:
    """Add ``out`` = number of rows of the same group with a strictly smaller
    ``value`` (equal values share the count, like ``rank() - 1``), and, as
    ``present``, the number of rows of the group."""
    ranked = below_per_value(value_counts(df, part_cols, value), part_cols, value, out, present)
    return df.join(ranked, [*part_cols, value])


def global_row_number(df: DataFrame, value: str, key: str, out: str = "rank") -> DataFrame:
    """Add ``out`` = 1-based position by ``value`` descending, then by the
    unique ``key`` ascending."""
    levels = [[("_l1", _coarse(F.col(value)), True)],
              [("_l2", F.col(value), True), ("_l3", F.substring(key, 1, ID_PREFIX), False)],
              [("_l4", F.col(key), False)]]
    r = running_before(df.withColumn("_one", F.lit(1)), [], levels, "_one", "_before")
    return r.withColumn(out, (F.col("_before") + 1).cast("long")).drop("_one", "_before")
