"""Semantic-model measures (L1-L8) as named Column expressions.

The reference keeps a semantic model (dimensions, measures, two views) next
to its SQL. Here a measure is a Column aggregate and a dimension a Column; any
``groupBy(dims).agg(measures)`` over the star join evaluates them. Joins to
dimensions are left outer (a fact row without a dimension row stays, with
NULL attributes); sums are 0 over no rows, ratios are NULL on a zero
denominator.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.functions.constants import SMALL_MAX
from moneytrail.operators.views import POSITIVE_BUCKETS, as_rollup
from moneytrail.plans.joins import join_small

DBL = T.DoubleType()


def _sum(c: Column, cond: Column | None = None) -> Column:
    v = F.when(cond, c) if cond is not None else c
    return F.coalesce(F.sum(v), F.lit(0))


def _ratio(a: Column, b: Column) -> Column:
    return F.when(b.cast(DBL) != 0, a.cast(DBL) / b.cast(DBL))


# ------------------------------------------------------------------ L1
def candidate_dimensions(candidates: DataFrame) -> DataFrame:
    return candidates.select(
        "*", F.col("CAND_OFFICE").alias("office"), F.col("CAND_OFFICE_ST").alias("home_state"),
        F.col("CAND_PTY_AFFILIATION").alias("party"),
        (F.col("CAND_ICI") == "I").alias("is_incumbent"))


def sem_candidate_count(candidates: DataFrame,
                        dims=("office", "party", "home_state", "is_incumbent")) -> DataFrame:
    """L1: candidate_count by any candidate dimensions."""
    return (candidate_dimensions(candidates).groupBy(*dims)
            .agg(F.count(F.lit(1)).alias("candidate_count")))


# ------------------------------------------------------------------ L2
def sem_committee_interest(committees: DataFrame, tags: DataFrame) -> DataFrame:
    """L2: committees with their type and (left-joined) interest category."""
    g = tags.select(F.col("CMTE_ID").alias("_gid"), F.col("custom_category"))
    j = join_small(committees, g, F.col("CMTE_ID") == F.col("_gid"), "left")
    return j.select("CMTE_ID", "CMTE_NM", F.col("CMTE_TP").alias("committee_type"),
                    F.col("custom_category").alias("interest_category"))


# ------------------------------------------------------------------ L3
def sem_contributions(contributions: DataFrame, committees: DataFrame,
                      candidates: DataFrame) -> DataFrame:
    """L3: committee -> candidate money by target office and source committee
    type: the true direct amount (IE/coordinated types excluded), the total
    including IE rows ("usually wrong"), and the IE for/against parts."""
    cm = committees.select(F.col("CMTE_ID").alias("_sc"), F.col("CMTE_TP").alias("committee_type"))
    cd = candidates.select(F.col("CAND_ID").alias("_tc"), F.col("CAND_OFFICE").alias("office"))
    j = join_small(contributions, cm, F.col("SOURCE_CMTE_ID") == F.col("_sc"), "left")
    j = join_small(j, cd, F.col("TARGET_CAND_ID") == F.col("_tc"), "left")
    tp = F.col("TRANSACTION_TP")
    is_direct = ~((tp == "24E") | (tp == "24A") | (tp == "24C") | (tp == "24N"))
    amt = F.col("AMOUNT")
    return j.groupBy("office", "committee_type").agg(
        _sum(amt, is_direct).alias("direct_amount"),
        _sum(amt).alias("total_amount"),
        _sum(amt, tp == "24E").alias("ie_for_amount"),
        _sum(amt, tp == "24A").alias("ie_against_amount"),
        F.count(F.lit(1)).alias("n"))


# ------------------------------------------------------------------ L4
def sem_individual(individual: DataFrame, committees: DataFrame) -> DataFrame:
    """L4: individual -> committee money by committee type, donor state and
    the small-dollar flag (0 < amount <= 200)."""
    cm = committees.select(F.col("CMTE_ID").alias("_cc"), F.col("CMTE_TP").alias("committee_type"))
    j = join_small(individual.select("TARGET_CMTE_ID", "STATE", "AMOUNT"), cm,
                   F.col("TARGET_CMTE_ID") == F.col("_cc"), "left")
    small = (F.col("AMOUNT") <= SMALL_MAX) & (F.col("AMOUNT") > 0)
    return (j.groupBy("committee_type", F.col("STATE").alias("donor_state"),
                      small.alias("is_small_dollar"))
            .agg(_sum(F.col("AMOUNT")).alias("total_amount"), F.count(F.lit(1)).alias("n")))


# ------------------------------------------------------------------ L5
def sem_ie(ie: DataFrame, committees: DataFrame, candidates: DataFrame) -> DataFrame:
    """Independent expenditures by target office and party: support and
    oppose among original filings by a real spender, and the raw total."""
    cm = committees.select(F.col("CMTE_ID").alias("_spender")).distinct()
    cd = candidates.select(F.col("CAND_ID").alias("_tc"), F.col("CAND_OFFICE").alias("office"),
                           F.col("CAND_PTY_AFFILIATION").alias("party"))
    j = join_small(ie, cm, F.col("SPENDER_CMTE_ID") == F.col("_spender"), "left")
    j = join_small(j, cd, F.col("TARGET_CAND_ID") == F.col("_tc"), "left")
    clean = (F.col("AMNDT_IND") == "N") & F.col("_spender").isNotNull()
    amt = F.col("AMOUNT")
    return j.groupBy("office", "party").agg(
        _sum(amt, clean & (F.col("SUPPORT_OPPOSE") == "S")).alias("support_amount"),
        _sum(amt, clean & (F.col("SUPPORT_OPPOSE") == "O")).alias("oppose_amount"),
        _sum(amt).alias("raw_amount"))


# ------------------------------------------------------------------ L6
def money_measures(home_state: Column) -> list[Column]:
    """The twelve money measures of L6 over candidate_money joined to the
    candidate (``home_state`` is the joined candidate's office state)."""
    ch, amt = F.col("channel"), F.col("amount")
    ind = ch == "individual"
    individual = _sum(amt, ind)
    direct = _sum(amt, ch == "direct_pac")
    sup = _sum(amt, ch == "ie_support")
    opp = _sum(amt, ch == "ie_oppose")
    in_state = _sum(amt, ind & (F.col("donor_state") == home_state))
    small = _sum(amt, ind & (F.col("size_bucket") == "1"))
    raised = _sum(amt, ind | (ch == "direct_pac"))
    backing = _sum(amt, ~(ch == "ie_oppose"))
    return [
        individual.alias("individual_amount"), direct.alias("direct_pac_amount"),
        sup.alias("ie_support_amount"), opp.alias("ie_oppose_amount"),
        in_state.alias("in_state_amount"), small.alias("small_dollar_amount"),
        raised.alias("raised"), backing.alias("total_backing"),
        _ratio(direct, raised).alias("pac_share"),
        (F.lit(1.0) - _ratio(in_state, individual)).alias("out_of_state_share"),
        _ratio(small, individual).alias("small_dollar_share"),
        _ratio(sup, backing).alias("outside_share"),
    ]


def _money_with_candidate(money: DataFrame, candidates: DataFrame) -> DataFrame:
    cd = candidates.select(F.col("CAND_ID").alias("_cid"), "CAND_NAME", "CAND_OFFICE",
                           "CAND_OFFICE_ST", "CAND_OFFICE_DISTRICT", "CAND_PTY_AFFILIATION")
    return join_small(as_rollup(money), cd, F.col("cand_id") == F.col("_cid"), "left")


def sem_money_measures(money: DataFrame, candidates: DataFrame,
                       dims=("CAND_OFFICE", "CAND_PTY_AFFILIATION")) -> DataFrame:
    """The twelve measures grouped by any candidate dimensions."""
    j = _money_with_candidate(money, candidates)
    return j.groupBy(*dims).agg(*money_measures(F.col("CAND_OFFICE_ST")))


# ------------------------------------------------------------------ L7, L8
def interest_backing(money: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per candidate and interest tag, the backing (all channels but
    ie_oppose) with the candidate's name, office, state and district."""
    m = money.filter((F.col("channel") != "ie_oppose") & F.col("interest_category").isNotNull())
    j = _money_with_candidate(m, candidates)
    return (j.groupBy("cand_id", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST",
                      "CAND_OFFICE_DISTRICT", "interest_category")
            .agg(F.sum("amount").alias("backing_in_category")))


def individual_by_state(money: DataFrame, candidates: DataFrame) -> DataFrame:
    """Per candidate and donor state other than home, positive individual
    money (feeds the out-of-state concentration)."""
    m = as_rollup(money).filter((F.col("channel") == "individual")
                                & F.col("size_bucket").isin(POSITIVE_BUCKETS))
    j = _money_with_candidate(m, candidates).filter(F.col("donor_state") != F.col("CAND_OFFICE_ST"))
    return (j.groupBy("cand_id", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST",
                      "CAND_OFFICE_DISTRICT", "donor_state")
            .agg(F.sum("amount").alias("state_amount")))
