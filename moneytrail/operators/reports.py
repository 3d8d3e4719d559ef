"""Report queries (Q1-Q9), computed for every candidate in one pass.

The reference binds one ``cand_id`` per query; here every report is grouped by
``cand_id`` and a single candidate is a filter on the result (pushed down into
the scans by Catalyst). Aggregations run partial-then-final, so a candidate that
holds a large share of all rows is pre-aggregated on every map task before the
shuffle. Per-candidate top-N uses ``row_number() <= N``, which Spark plans as a
``WindowGroupLimit`` (also applied before the window's shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moneytrail.functions.constants import (BUCKET_CODES, TOP_DIRECT_PAC, TOP_IE_SPENDERS,
                                            TOP_STATES)
from moneytrail.operators.views import (NON_DIRECT_TYPES, POSITIVE_BUCKETS, REPORT_BUCKETS,
                                        as_rollup)
from moneytrail.plans.joins import join_small


def _sum_if(cond: Column, value: str = "amount") -> Column:
    return F.sum(F.when(cond, F.col(value)))


def _count_if(cond: Column) -> Column:
    """Rows meeting ``cond`` (the rollup carries a row weight ``n_rows``)."""
    return F.coalesce(F.sum(F.when(cond, F.col("n_rows"))), F.lit(0).cast("long"))


def _rows() -> Column:
    return F.coalesce(F.sum("n_rows"), F.lit(0).cast("long"))


def _bucket(codes) -> Column:
    return F.col("size_bucket").isin(codes)


def _zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0))


def CH_() -> Column:
    return F.col("channel")


def candidate_totals(money: DataFrame, candidates: DataFrame) -> DataFrame:
    """Q1: per candidate, channel sums (0 when none), gift and PAC counts,
    ``raised`` = individual + direct_pac, ``total_backing`` = all but ie_oppose.
    Every candidate gets a row, like the one-candidate query always does."""
    agg = as_rollup(money).groupBy("cand_id").agg(
        _sum_if(CH_() == "individual").alias("individual_amount"),
        _count_if(CH_() == "individual").alias("individual_count"),
        _sum_if(CH_() == "direct_pac").alias("direct_pac_amount"),
        _count_if(CH_() == "direct_pac").alias("direct_pac_count"),
        _sum_if(CH_() == "ie_support").alias("ie_support_amount"),
        _sum_if(CH_() == "ie_oppose").alias("ie_oppose_amount"),
        _sum_if(CH_().isin("individual", "direct_pac")).alias("raised"),
        _sum_if(CH_() != "ie_oppose").alias("total_backing"),
    )
    cands = candidates.select(F.col("CAND_ID").alias("cand_id")).distinct()
    j = cands.join(agg, "cand_id", "left")
    return j.select(
        "cand_id",
        _zero(F.col("individual_amount")).alias("individual_amount"),
        _zero(F.col("individual_count")).alias("individual_count"),
        _zero(F.col("direct_pac_amount")).alias("direct_pac_amount"),
        _zero(F.col("direct_pac_count")).alias("direct_pac_count"),
        _zero(F.col("ie_support_amount")).alias("ie_support_amount"),
        _zero(F.col("ie_oppose_amount")).alias("ie_oppose_amount"),
        _zero(F.col("raised")).alias("raised"),
        _zero(F.col("total_backing")).alias("total_backing"),
    )


def candidate_buckets(money: DataFrame, small_max=None, near_max=None) -> DataFrame:
    """Q2: count and sum of individual gifts per size bucket; zero and NULL
    amounts excluded."""
    ind = as_rollup(money, small_max, near_max).filter(
        (CH_() == "individual") & _bucket(REPORT_BUCKETS))
    label = F.element_at(F.create_map(*[F.lit(x) for kv in BUCKET_CODES.items() for x in kv]),
                         F.col("size_bucket"))
    return (ind.groupBy("cand_id", label.alias("bucket"))
            .agg(_rows().alias("n"), F.sum("amount").alias("amount")))


def _top_n(df: DataFrame, part: str, order: list[Column], n: int) -> DataFrame:
    w = Window.partitionBy(part).orderBy(*order)
    return (df.withColumn("rank", F.row_number().over(w).cast("long"))
            .filter(F.col("rank") <= n))


def candidate_top_states(money: DataFrame, limit: int = TOP_STATES) -> DataFrame:
    """Q3: individual money by donor state (NULL state and net-negative sums
    included), top ``limit`` per candidate by amount desc, then state."""
    agg = (as_rollup(money).filter(CH_() == "individual")
           .groupBy("cand_id", "donor_state")
           .agg(F.sum("amount").alias("amount"), _rows().alias("n")))
    return _top_n(agg, "cand_id", [F.col("amount").desc_nulls_last(),
                                   F.col("donor_state").asc_nulls_last()], limit)


def _home(candidates: DataFrame) -> DataFrame:
    return candidates.select(F.col("CAND_ID").alias("_cid"),
                             F.col("CAND_OFFICE_ST").alias("home_state"))


def candidate_oos_states(money: DataFrame, candidates: DataFrame) -> DataFrame:
    """Q4: positive individual money per donor state other than the home state
    (a NULL state is dropped by ``<>``)."""
    ind = as_rollup(money).filter((CH_() == "individual") & _bucket(POSITIVE_BUCKETS))
    j = join_small(ind, _home(candidates), F.col("cand_id") == F.col("_cid"))
    return (j.filter(F.col("donor_state") != F.col("home_state"))
            .groupBy("cand_id", "donor_state").agg(F.sum("amount").alias("amount")))


def candidate_interest_blocs(money: DataFrame) -> DataFrame:
    """Q5: per interest tag, direct PAC and IE-support sums (0 when none);
    only tags whose combined total is not zero."""
    m = as_rollup(money).filter(CH_().isin("direct_pac", "ie_support")
                                & F.col("interest_category").isNotNull())
    agg = m.groupBy("cand_id", "interest_category").agg(
        _zero(_sum_if(CH_() == "direct_pac")).alias("direct_pac_amount"),
        _zero(_sum_if(CH_() == "ie_support")).alias("ie_support_amount"),
        _zero(F.sum("amount")).alias("_total"))
    return agg.filter(F.col("_total") != 0).drop("_total")


def candidate_top_direct_pac(contributions: DataFrame, committees: DataFrame,
                             limit: int = TOP_DIRECT_PAC) -> DataFrame:
    """Q6: top direct givers by committee (name, type); unknown committees are
    dropped by the inner join. Grouping is by name, as in the reference."""
    f = contributions.filter(~F.col("TRANSACTION_TP").isin(NON_DIRECT_TYPES)).select(
        "TARGET_CAND_ID", "SOURCE_CMTE_ID", "AMOUNT")
    cm = committees.select("CMTE_ID", "CMTE_NM", "CMTE_TP")
    j = join_small(f, cm, F.col("SOURCE_CMTE_ID") == F.col("CMTE_ID"))
    agg = (j.groupBy(F.col("TARGET_CAND_ID").alias("cand_id"), "CMTE_NM", "CMTE_TP")
           .agg(F.sum("AMOUNT").alias("amount"), F.count(F.lit(1)).alias("n")))
    return _top_n(agg, "cand_id", [F.col("amount").desc_nulls_last(),
                                   F.col("CMTE_NM").asc_nulls_last(),
                                   F.col("CMTE_TP").asc_nulls_last()], limit)


def candidate_top_ie_spenders(clean_ie: DataFrame, limit: int = TOP_IE_SPENDERS) -> DataFrame:
    """Q7: top outside spenders (name, support/oppose) by amount."""
    agg = (clean_ie.groupBy(F.col("TARGET_CAND_ID").alias("cand_id"), "SPENDER_NAME",
                            "SUPPORT_OPPOSE")
           .agg(F.sum("AMOUNT").alias("amount")))
    return _top_n(agg, "cand_id", [F.col("amount").desc_nulls_last(),
                                   F.col("SPENDER_NAME").asc_nulls_last(),
                                   F.col("SUPPORT_OPPOSE").asc_nulls_last()], limit)


def cohort(candidates: DataFrame, office: str | None = None, state: str | None = None,
           incumbents: bool = False) -> DataFrame:
    """The ranking cohort: candidates filtered by optional office / state /
    incumbency (an unset parameter is no filter)."""
    c = candidates
    if office is not None:
        c = c.filter(F.col("CAND_OFFICE") == office)
    if state is not None:
        c = c.filter(F.col("CAND_OFFICE_ST") == state.upper())
    if incumbents:
        c = c.filter(F.col("CAND_ICI") == "I")
    return c.select("CAND_ID", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST",
                    "CAND_OFFICE_DISTRICT", "CAND_PTY_AFFILIATION")


def rank_base(money: DataFrame, candidates: DataFrame, office: str | None = None,
              state: str | None = None, incumbents: bool = False,
              min_individual: float = 50000) -> DataFrame:
    """Q8: per cohort member, individual total, in-state part, small gifts
    (0 < amount <= 200), direct PAC and IE support; members below
    ``min_individual`` individual money are dropped."""
    c = cohort(candidates, office, state, incumbents)
    j = join_small(as_rollup(money), c.select(F.col("CAND_ID").alias("_cid"),
                                   F.col("CAND_OFFICE_ST").alias("_home")),
                   F.col("cand_id") == F.col("_cid"))
    ind = CH_() == "individual"
    agg = j.groupBy("cand_id").agg(
        _sum_if(ind).alias("indiv_total"),
        _sum_if(ind & (F.col("donor_state") == F.col("_home"))).alias("in_state"),
        _sum_if(ind & _bucket(["1"])).alias("small"),
        _sum_if(CH_() == "direct_pac").alias("pac_total"),
        _sum_if(CH_() == "ie_support").alias("ie_support"))
    agg = agg.withColumnRenamed("cand_id", "_agg_cid")
    out = join_small(agg, c, F.col("_agg_cid") == F.col("CAND_ID")).select(
        "CAND_ID", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST", "CAND_OFFICE_DISTRICT",
        "CAND_PTY_AFFILIATION",
        *[_zero(F.col(x)).alias(x) for x in
          ("indiv_total", "in_state", "small", "pac_total", "ie_support")])
    return out.filter(F.col("indiv_total") >= F.lit(min_individual))


def rank_interest_categories(money: DataFrame) -> DataFrame:
    """Q9: per (candidate, tag) direct PAC + IE support; not cohort-filtered."""
    return (as_rollup(money).filter(CH_().isin("direct_pac", "ie_support")
                                    & F.col("interest_category").isNotNull())
            .groupBy("cand_id", "interest_category").agg(F.sum("amount").alias("amount")))
