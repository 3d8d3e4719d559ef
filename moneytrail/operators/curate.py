"""Curated star schema (P1-P7): map-only projections of the raw text datasets.

Each function is ``raw DataFrame -> typed DataFrame``; no shuffle, no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.functions.parse import (try_bigint, try_date_dmy, try_date_mdy, try_int,
                                        try_money)
from moneytrail.sources.schemas import TAG_SCHEMA


def dim_candidates(raw_cn: DataFrame) -> DataFrame:
    """10 of the 15 candidate columns; election year typed."""
    return raw_cn.select(
        "CAND_ID", "CAND_NAME", "CAND_PTY_AFFILIATION",
        try_int("CAND_ELECTION_YR").alias("CAND_ELECTION_YR"),
        "CAND_OFFICE_ST", "CAND_OFFICE", "CAND_OFFICE_DISTRICT", "CAND_ICI",
        "CAND_STATUS", "CAND_PCC")


def dim_committees(raw_cm: DataFrame) -> DataFrame:
    """8 of the 15 committee columns; CAND_ID renamed AFFILIATED_CAND_ID."""
    return raw_cm.select(
        "CMTE_ID", "CMTE_NM", "CMTE_TP", "CMTE_DSGN", "CMTE_PTY_AFFILIATION",
        "ORG_TP", "CONNECTED_ORG_NM", F.col("CAND_ID").alias("AFFILIATED_CAND_ID"))


def bridge_candidate_committee(raw_ccl: DataFrame) -> DataFrame:
    """Candidate-committee links (drops CAND_ELECTION_YR)."""
    return raw_ccl.select(
        "CAND_ID", "CMTE_ID", try_int("FEC_ELECTION_YR").alias("FEC_ELECTION_YR"),
        "CMTE_TP", "CMTE_DSGN", "LINKAGE_ID")


def fact_contributions(raw_pas2: DataFrame) -> DataFrame:
    """Committee -> candidate edges, typed."""
    return raw_pas2.select(
        try_bigint("SUB_ID").alias("SUB_ID"),
        F.col("CMTE_ID").alias("SOURCE_CMTE_ID"),
        F.col("CAND_ID").alias("TARGET_CAND_ID"),
        try_money("TRANSACTION_AMT").alias("AMOUNT"),
        try_date_mdy("TRANSACTION_DT").alias("TRANSACTION_DT"),
        "TRANSACTION_TP", "ENTITY_TP", "OTHER_ID", "IMAGE_NUM", "FILE_NUM", "TRAN_ID")


def fact_individual_contributions(raw_indiv: DataFrame) -> DataFrame:
    """P5: individual -> committee gifts, typed (keeps MEMO_CD)."""
    return raw_indiv.select(
        try_bigint("SUB_ID").alias("SUB_ID"),
        F.col("CMTE_ID").alias("TARGET_CMTE_ID"),
        F.col("NAME").alias("CONTRIBUTOR_NAME"),
        "CITY", "STATE", "ZIP_CODE", "EMPLOYER", "OCCUPATION",
        try_money("TRANSACTION_AMT").alias("AMOUNT"),
        try_date_mdy("TRANSACTION_DT").alias("TRANSACTION_DT"),
        "TRANSACTION_TP", "ENTITY_TP", "OTHER_ID", "IMAGE_NUM", "FILE_NUM", "TRAN_ID",
        "MEMO_CD")


def fact_independent_expenditures(raw_ie: DataFrame) -> DataFrame:
    """Independent expenditures, typed; IE_ID is NULL when a part is NULL."""
    return raw_ie.select(
        F.concat(F.col("file_num"), F.lit("-"), F.col("tran_id")).alias("IE_ID"),
        F.col("spe_id").alias("SPENDER_CMTE_ID"),
        F.col("cand_id").alias("TARGET_CAND_ID"),
        F.upper("sup_opp").alias("SUPPORT_OPPOSE"),
        try_money("exp_amo").alias("AMOUNT"),
        try_date_dmy("exp_date").alias("EXPENDITURE_DT"),
        try_money("agg_amo").alias("AGGREGATE_AMOUNT"),
        F.col("pur").alias("PURPOSE"),
        F.col("pay").alias("PAYEE"),
        F.col("spe_nam").alias("SPENDER_NAME"),
        F.col("cand_name").alias("TARGET_CAND_NAME"),
        F.col("ele_type").alias("ELECTION_TYPE"),
        try_date_dmy("dissem_dt").alias("DISSEMINATION_DT"),
        F.col("image_num").alias("IMAGE_NUM"),
        F.col("file_num").alias("FILE_NUM"),
        F.col("tran_id").alias("TRAN_ID"),
        F.col("amndt_ind").alias("AMNDT_IND"),
        F.col("prev_file_num").alias("PREV_FILE_NUM"))


def empty_group_mappings(spark: SparkSession) -> DataFrame:
    """The tag table exists (empty) before any dictionary load."""
    return spark.createDataFrame([], TAG_SCHEMA)


CURATE = {
    "cn": dim_candidates,
    "cm": dim_committees,
    "ccl": bridge_candidate_committee,
    "pas2": fact_contributions,
    "indiv": fact_individual_contributions,
    "ie": fact_independent_expenditures,
}
