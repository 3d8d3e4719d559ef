"""Canonical views (V1-V4): the unified money fact ``candidate_money``.

Only the individual arm is large. It meets the candidate-committee link table through
a broadcast hash join while that table is small, so the big side is not shuffled before
the first aggregation; committees and tags are broadcast the same way. Beyond that they
meet by a shuffle (``plans/joins.py``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.functions.parse import try_bigint, try_date_mdy, try_money
from moneytrail.plans.joins import join_small

STR = T.StringType()

# Committee designations / types that attribute money to a
# candidate, and the committee->candidate transaction types that are really
# independent or coordinated expenditures (excluded from direct PAC money).
LINK_DESIGNATIONS = ["P", "A"]
LINK_COMMITTEE_TYPES = ["H", "S", "P"]
NON_DIRECT_TYPES = ["24E", "24A", "24C", "24N"]

CHANNELS = ["individual", "direct_pac", "ie_support", "ie_oppose"]
MONEY_COLUMNS = ["cand_id", "channel", "amount", "donor_state", "contributor_name",
                 "employer", "interest_category"]


def candidate_committees(bridge: DataFrame) -> DataFrame:
    """V1: DISTINCT (CAND_ID, CMTE_ID, CMTE_TP, CMTE_DSGN) over P/A links of H/S/P
    committees. A pair linked under two designations stays twice."""
    return (bridge
            .filter(F.col("CMTE_DSGN").isin(LINK_DESIGNATIONS)
                    & F.col("CMTE_TP").isin(LINK_COMMITTEE_TYPES))
            .select("CAND_ID", "CMTE_ID", "CMTE_TP", "CMTE_DSGN")
            .distinct())


def clean_individual(raw_indiv: DataFrame) -> DataFrame:
    """V2: typed individual gifts straight from the raw landing; only people
    (ENTITY_TP = 'IND') and without the memo duplicate of an earmark
    (MEMO_CD = 'X'); a NULL memo code stays."""
    return (raw_indiv
            .filter((F.col("ENTITY_TP") == "IND")
                    & (F.col("MEMO_CD").isNull() | (F.col("MEMO_CD") != "X")))
            .select(
                try_bigint("SUB_ID").alias("SUB_ID"),
                F.col("CMTE_ID").alias("TARGET_CMTE_ID"),
                F.col("NAME").alias("CONTRIBUTOR_NAME"),
                "CITY", "STATE", "ZIP_CODE", "EMPLOYER", "OCCUPATION",
                try_money("TRANSACTION_AMT").alias("AMOUNT"),
                try_date_mdy("TRANSACTION_DT").alias("TRANSACTION_DT"),
                "TRANSACTION_TP", "ENTITY_TP", "OTHER_ID", "IMAGE_NUM", "FILE_NUM",
                "TRAN_ID", "MEMO_CD", "MEMO_TEXT"))


def clean_ie(fact_ie: DataFrame, committees: DataFrame) -> DataFrame:
    """V3: original filings (AMNDT_IND = 'N') by a spender that exists in the
    committee master (inner join, like the reference)."""
    cm = committees.select(F.col("CMTE_ID").alias("_spender"))
    return join_small(fact_ie.filter(F.col("AMNDT_IND") == "N"), cm,
                      F.col("SPENDER_CMTE_ID") == F.col("_spender")).drop("_spender")


def _null() -> Column:
    return F.lit(None).cast(STR)


def money_individual(clean_ind: DataFrame, links: DataFrame) -> DataFrame:
    """Individual gifts attributed through every link of their committee."""
    lk = links.select(F.col("CAND_ID"), F.col("CMTE_ID").alias("_cmte"))
    j = join_small(clean_ind.select("TARGET_CMTE_ID", "AMOUNT", "STATE",
                                    "CONTRIBUTOR_NAME", "EMPLOYER"),
                   lk, F.col("TARGET_CMTE_ID") == F.col("_cmte"))
    return j.select(
        F.col("CAND_ID").alias("cand_id"), F.lit("individual").alias("channel"),
        F.col("AMOUNT").alias("amount"), F.col("STATE").alias("donor_state"),
        F.col("CONTRIBUTOR_NAME").alias("contributor_name"),
        F.col("EMPLOYER").alias("employer"), _null().alias("interest_category"))


def _tagged(df: DataFrame, id_col: str, tags: DataFrame) -> DataFrame:
    g = tags.select(F.col("CMTE_ID").alias("_tag_id"), F.col("custom_category"))
    return join_small(df, g, F.col(id_col) == F.col("_tag_id"), "left")


def money_direct_pac(fact_contrib: DataFrame, tags: DataFrame) -> DataFrame:
    """Committee -> candidate money except IE/coordinated types (a NULL
    type is dropped by NOT IN, as in SQL); tags left-joined (duplicates fan out)."""
    f = fact_contrib.filter(~F.col("TRANSACTION_TP").isin(NON_DIRECT_TYPES))
    j = _tagged(f.select("TARGET_CAND_ID", "AMOUNT", "SOURCE_CMTE_ID"), "SOURCE_CMTE_ID", tags)
    return j.select(
        F.col("TARGET_CAND_ID").alias("cand_id"), F.lit("direct_pac").alias("channel"),
        F.col("AMOUNT").alias("amount"), _null().alias("donor_state"),
        _null().alias("contributor_name"), _null().alias("employer"),
        F.col("custom_category").alias("interest_category"))


def _money_ie(clean: DataFrame, tags: DataFrame, code: str, channel: str) -> DataFrame:
    f = clean.filter(F.col("SUPPORT_OPPOSE") == code)
    j = _tagged(f.select("TARGET_CAND_ID", "AMOUNT", "SPENDER_CMTE_ID"), "SPENDER_CMTE_ID", tags)
    return j.select(
        F.col("TARGET_CAND_ID").alias("cand_id"), F.lit(channel).alias("channel"),
        F.col("AMOUNT").alias("amount"), _null().alias("donor_state"),
        _null().alias("contributor_name"), _null().alias("employer"),
        F.col("custom_category").alias("interest_category"))


def money_ie_support(clean: DataFrame, tags: DataFrame) -> DataFrame:
    """IE supporting the candidate."""
    return _money_ie(clean, tags, "S", "ie_support")


def money_ie_oppose(clean: DataFrame, tags: DataFrame) -> DataFrame:
    """V4d: IE opposing the candidate (other codes fall in neither arm)."""
    return _money_ie(clean, tags, "O", "ie_oppose")


# --------------------------------------------------------- money without its tags
# The stored fact names the paying committee instead of its tag, so that new tags
# rewrite nothing: they join it when it is read.
FACT_COLUMNS = ["cand_id", "channel", "amount", "donor_state", "contributor_name", "employer", "cmte_id"]
PAID_BY_COMMITTEES = ["direct_pac", "ie_support", "ie_oppose"]


def fact_individual(clean_ind: DataFrame, links: DataFrame) -> DataFrame:
    """V4a as the stored fact has it."""
    return money_individual(clean_ind, links).withColumn("cmte_id", _null()).select(*FACT_COLUMNS)


def _paid(rows: DataFrame, channel: str, payer: str) -> DataFrame:
    return rows.select(
        F.col("TARGET_CAND_ID").alias("cand_id"), F.lit(channel).alias("channel"),
        F.col("AMOUNT").alias("amount"), _null().alias("donor_state"),
        _null().alias("contributor_name"), _null().alias("employer"), F.col(payer).alias("cmte_id"))


def fact_direct_pac(fact_contrib: DataFrame) -> DataFrame:
    """V4b before its tags."""
    return _paid(fact_contrib.filter(~F.col("TRANSACTION_TP").isin(NON_DIRECT_TYPES)), "direct_pac", "SOURCE_CMTE_ID")


def fact_ie(clean: DataFrame, channel: str) -> DataFrame:
    """V4c or V4d before its tags."""
    code = {"ie_support": "S", "ie_oppose": "O"}[channel]
    return _paid(clean.filter(F.col("SUPPORT_OPPOSE") == code), channel, "SPENDER_CMTE_ID")


def with_tags(fact: DataFrame, tags: DataFrame) -> DataFrame:
    """Fact rows (or groups of them) with the tags of their committees; a committee of two tags
    fans out, one without keeps its rows."""
    return (_tagged(fact, "cmte_id", tags).drop("_tag_id", "cmte_id")
            .withColumnRenamed("custom_category", "interest_category"))


def committee_rollup(fact: DataFrame) -> DataFrame:
    """One channel of the fact pre-aggregated by candidate, state, size bucket and paying committee."""
    return (fact.groupBy("cand_id", "channel", "donor_state", "cmte_id",
                         size_bucket(F.col("amount")).alias("size_bucket"))
            .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_rows")))


def tagged_rollup(rollup: DataFrame, tags: DataFrame) -> DataFrame:
    """The report rollup from the rollup by committee: exact sums add up."""
    return (with_tags(rollup, tags).groupBy(*ROLLUP_KEYS)
            .agg(F.sum("amount").cast(rollup.schema["amount"].dataType).alias("amount"),
                 F.sum("n_rows").alias("n_rows")))


def candidate_money(ind: DataFrame, pac: DataFrame, sup: DataFrame, opp: DataFrame) -> DataFrame:
    """V4: UNION ALL of the four arms (no dedup)."""
    return (ind.select(*MONEY_COLUMNS).unionByName(pac.select(*MONEY_COLUMNS))
            .unionByName(sup.select(*MONEY_COLUMNS)).unionByName(opp.select(*MONEY_COLUMNS)))


# ------------------------------------------------------------------ money rollup
# Size-bucket codes of the rollup: 1-5 are the report buckets (1 small .. 4
# max+, 5 negative); 0 = a zero amount, N = a NULL amount.
ROLLUP_KEYS = ["cand_id", "channel", "donor_state", "interest_category", "size_bucket"]
POSITIVE_BUCKETS = ["1", "2", "3", "4"]
REPORT_BUCKETS = ["1", "2", "3", "4", "5"]


def size_bucket(amount: Column, small_max=None, near_max=None) -> Column:
    from moneytrail.functions.constants import NEAR_MAX, SMALL_MAX
    small_max = SMALL_MAX if small_max is None else small_max
    near_max = NEAR_MAX if near_max is None else near_max
    return (F.when(amount.isNull(), "N").when(amount == 0, "0").when(amount < 0, "5")
             .when(amount <= small_max, "1").when(amount <= 999, "2")
             .when(amount < near_max, "3").otherwise("4"))


def money_rollup(money: DataFrame) -> DataFrame:
    """candidate_money pre-aggregated to (candidate, channel, donor state,
    interest tag, size bucket) with the exact sum and the row count. Every
    report except those that need donor names reads this instead of the
    row-level fact; the aggregation is partial on every map task, so hot
    candidates collapse before the shuffle."""
    return (money.groupBy("cand_id", "channel", "donor_state", "interest_category",
                          size_bucket(F.col("amount")).alias("size_bucket"))
            .agg(F.sum("amount").alias("amount"), F.count(F.lit(1)).alias("n_rows")))


def as_rollup(money: DataFrame, small_max=None, near_max=None) -> DataFrame:
    """The rollup shape of a money frame: a rollup passes through (only with
    the default bucket bounds), a row-level frame gets its bucket and a row
    weight of 1 (a projection, no aggregation)."""
    if "n_rows" in money.columns:
        if small_max is not None or near_max is not None:
            from moneytrail.functions.constants import NEAR_MAX, SMALL_MAX
            if (SMALL_MAX if small_max is None else small_max) != SMALL_MAX or (NEAR_MAX if near_max is None else near_max) != NEAR_MAX:
                raise ValueError("non-default bucket bounds need the row-level money fact")
        return money
    return money.select("cand_id", "channel", "donor_state", "interest_category",
                        size_bucket(F.col("amount"), small_max, near_max).alias("size_bucket"),
                        "amount", F.lit(1).cast("long").alias("n_rows"))
