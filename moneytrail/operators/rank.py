"""Cohort ranking (R1-R7): the funding-headline signal of every cohort member.

The reference builds Python dicts, sorts lists and bisects. Here:

* signals are columns (R1) and a long table (cand_id, signal, value);
* interest-tag shares stay sparse (R2): only (member, tag) pairs with money
  are rows; members without the tag have share 0, which the percentile step
  counts arithmetically instead of materialising a member x tag product;
* the percentile of v is (#cohort values strictly below v) / cohort size
  (R3), computed by a prefix count in levels (no single-task window);
* floors (R4), the headline pick (R5, one minimum per member over at most
  4 + #tags rows) and the final numbering (R6, a distributed global rank).

The ranking computes the cohort three times: for the counts per value, for the picks and for
the names. Nothing is cached: the levels of both counts read the same shuffles, which Spark
reuses, because what they aggregate is one column that no level can prune differently.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.functions.constants import (FLOOR_BLOC, NO_STANDOUT, SIGNALS,
                                            TAG_SIGNAL_ORDER)
from moneytrail.functions.ranking import below_per_value, global_row_number, value_counts

DBL = T.DoubleType()


def _d(c: str) -> Column:
    return F.col(c).cast(DBL)


def rank_signals(base: DataFrame) -> DataFrame:
    """From rank_base, members with positive individual money; raised and
    backing in double; the four signals (0 when the denominator is 0)."""
    b = base.filter(F.col("indiv_total") > 0)
    indiv, pac, ie_s = _d("indiv_total"), _d("pac_total"), _d("ie_support")
    raised = indiv + pac
    backing = raised + ie_s
    return b.select(
        F.col("CAND_ID").alias("cand_id"),
        F.col("CAND_NAME").alias("name"),
        F.concat(F.col("CAND_OFFICE"), F.lit("-"),
                 F.coalesce(F.when(F.col("CAND_OFFICE_DISTRICT") != "",
                                   F.col("CAND_OFFICE_DISTRICT")), F.lit("00")),
                 F.lit(" "), F.col("CAND_OFFICE_ST")).alias("seat"),
        F.col("CAND_PTY_AFFILIATION").alias("party"),
        indiv.alias("indiv"),
        raised.alias("raised"),
        backing.alias("backing"),
        ((indiv - _d("in_state")) / indiv).alias("out_of_state"),
        (F.lit(1.0) - _d("small") / indiv).alias("concentration"),
        F.when(raised != 0, pac / raised).otherwise(F.lit(0.0)).alias("pac"),
        F.when(backing != 0, ie_s / backing).otherwise(F.lit(0.0)).alias("outside"),
    )


def members(signals: DataFrame, categories: DataFrame) -> DataFrame:
    """The signals with ``tags``: an array of (tag, share) for every tag the member
    has money in. Members absent for a tag have share 0 for it (implicit)."""
    own = categories.groupBy(F.col("cand_id").alias("_cid")).agg(
        F.collect_list(F.struct(F.col("interest_category").alias("tag"), "amount")).alias("_tags"))
    amount = lambda t: F.coalesce(t["amount"], F.lit(0)).cast(DBL)  # noqa: E731  float(amt or 0)
    share = lambda t: F.when(F.col("backing") != 0, amount(t) / F.col("backing")).otherwise(0.0)
    tags = F.transform("_tags", lambda t: F.struct(t["tag"].alias("tag"), share(t).alias("share")))
    j = signals.join(own, F.col("cand_id") == F.col("_cid"), "left")
    return j.select(*signals.columns, F.coalesce(tags, F.array()).alias("tags"))


def rank_category_shares(members: DataFrame) -> DataFrame:
    """R2 (sparse): share of backing per (member, tag) for every tag the member
    has money in."""
    return members.select("cand_id", F.explode("tags").alias("t")).select("cand_id", "t.tag", "t.share")


def _signals_long(members: DataFrame) -> DataFrame:
    """(cand_id, signal, label, signal_order, floor, value): the cohort's four
    signals and its tag shares, by one explode."""
    def row(signal, label, order, floor, value):
        return F.struct(signal.alias("signal"), label.alias("label"), F.lit(order).alias("signal_order"),
                        F.lit(floor).alias("floor"), value.alias("value"))

    base = F.array(*[row(F.lit(sid), F.lit(label), order, floor, F.col(sid))
                     for sid, label, floor, order in SIGNALS])
    tags = F.transform("tags", lambda t: row(F.concat(F.lit("tag:"), t["tag"]), t["tag"],
                                             TAG_SIGNAL_ORDER, FLOOR_BLOC, t["share"]))
    return members.select("cand_id", F.explode(F.concat(base, tags)).alias("s")).select("cand_id", "s.*")


def rank_percentiles(members: DataFrame) -> DataFrame:
    """Percentile of each (member, signal) value within the cohort:
    (#members whose value is strictly below) / cohort size. For tag signals the
    absent members count as zeros."""
    long = _signals_long(members)
    counts = value_counts(long, ["signal"], "value")
    # every member has the first signal, so its rows are the cohort's size: one row, which
    # meets the values by a constant key
    cohort = counts.agg(F.sum(F.when(F.col("signal") == SIGNALS[0][0], F.col("_m"))).alias("_n"))
    below = below_per_value(counts, ["signal"], "value", "_below", "_present")
    zeros_below = F.when(F.col("value") > 0, F.col("_n") - F.col("_present")).otherwise(F.lit(0))
    pct = (F.col("_below") + zeros_below).cast(DBL) / F.col("_n").cast(DBL)
    per_value = (below.withColumn("_k", F.lit(1))
                 .join(F.broadcast(cohort.withColumn("_k", F.lit(1))), "_k")
                 .select("signal", "value", pct.alias("pctile")))
    return long.join(per_value, ["signal", "value"]).select(
        "cand_id", "signal", "label", "signal_order", "floor", "value", "pctile")


def rank_floors(pctiles: DataFrame) -> DataFrame:
    """The signals that clear their floor (compared unrounded)."""
    return pctiles.filter(F.col("value") >= F.col("floor"))


def rank_picks(pctiles: DataFrame) -> DataFrame:
    """Per member the eligible signal with the highest percentile; ties go to out-of-state,
    PAC, outside, concentration, then tags by name. Members with none get
    ``(balanced / no standout)``, 0, 0. One minimum of one struct, pre-aggregated."""
    ok = F.col("value") >= F.col("floor")
    first = F.min(F.struct((~ok).alias("none"), (-F.col("pctile")).alias("down"), "signal_order",
                           "label", "value", "pctile"))
    none = F.col("_p.none")
    return pctiles.groupBy("cand_id").agg(first.alias("_p")).select(
        "cand_id",
        F.when(none, F.lit(NO_STANDOUT)).otherwise(F.col("_p.label")).alias("headline"),
        F.when(none, F.lit(0.0)).otherwise(F.col("_p.value")).alias("headline_value"),
        F.when(none, F.lit(0.0)).otherwise(F.col("_p.pctile")).alias("headline_pctile"))


def rank_headline(picks: DataFrame, signals: DataFrame) -> DataFrame:
    """Every member with its pick (and what else ``picks`` holds)."""
    return signals.select("cand_id", "name", "seat", "party", "indiv", "raised", "backing").join(
        picks, "cand_id")


def funding_headline_ranking(picks: DataFrame, signals: DataFrame, limit: int = 0) -> DataFrame:
    """Members by headline percentile (desc; ties by cand_id), numbered
    from 1; ``limit`` > 0 keeps the top N (a top-k report)."""
    ranked = global_row_number(picks, "headline_pctile", "cand_id")
    if limit:
        ranked = ranked.filter(F.col("rank") <= limit)
    return rank_headline(ranked, signals)


def rank_display_fields(ranking: DataFrame) -> DataFrame:
    """Printed fields: seat, whole-percent value ('—' for 0) and
    percentile (Python rounds half to even, as ``bround`` does)."""
    v = F.col("headline_value")
    return ranking.select(
        "rank", "cand_id", "name", "seat", "party", "backing", "headline",
        F.when(v != 0, F.concat(F.bround(v * 100, 0).cast("long").cast("string"), F.lit("%")))
         .otherwise(F.lit("—")).alias("value_display"),
        F.bround(F.col("headline_pctile") * 100, 0).cast("long").alias("pctile_display"))


class CohortRanking:
    """R1-R6 over one cohort. Frames are lazy: nothing runs while they are built, and
    nothing stays in the executors after they ran."""

    def __init__(self, base: DataFrame, categories: DataFrame, limit: int = 0):
        self.limit = limit
        self.signals = rank_signals(base)
        self.members = members(self.signals, categories)

    @property
    def category_shares(self) -> DataFrame:
        return rank_category_shares(self.members)

    @property
    def percentiles(self) -> DataFrame:
        return rank_percentiles(self.members)

    @property
    def eligible(self) -> DataFrame:
        return rank_floors(self.percentiles)

    @property
    def picks(self) -> DataFrame:
        return rank_picks(self.percentiles)

    @property
    def headline(self) -> DataFrame:
        return rank_headline(self.picks, self.signals)

    @property
    def ranking(self) -> DataFrame:
        return funding_headline_ranking(self.picks, self.signals, self.limit)
