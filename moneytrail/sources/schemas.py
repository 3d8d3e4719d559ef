"""Raw filing layouts (S3) and the curated table layouts.

Fixed values: the column lists and their order must equal the published bulk
file layouts, so they are written out plainly here.
"""

from __future__ import annotations

from pyspark.sql import types as T

# --- fixed values: raw bulk-file column orders --------------------------------
RAW_COLUMNS: dict[str, list[str]] = {
    "cn": [
        "CAND_ID", "CAND_NAME", "CAND_PTY_AFFILIATION", "CAND_ELECTION_YR",
        "CAND_OFFICE_ST", "CAND_OFFICE", "CAND_OFFICE_DISTRICT", "CAND_ICI",
        "CAND_STATUS", "CAND_PCC", "CAND_ST1", "CAND_ST2", "CAND_CITY",
        "CAND_ST", "CAND_ZIP",
    ],
    "cm": [
        "CMTE_ID", "CMTE_NM", "TRES_NM", "CMTE_ST1", "CMTE_ST2", "CMTE_CITY",
        "CMTE_ST", "CMTE_ZIP", "CMTE_DSGN", "CMTE_TP", "CMTE_PTY_AFFILIATION",
        "CMTE_FILING_FREQ", "ORG_TP", "CONNECTED_ORG_NM", "CAND_ID",
    ],
    "ccl": [
        "CAND_ID", "CAND_ELECTION_YR", "FEC_ELECTION_YR", "CMTE_ID",
        "CMTE_TP", "CMTE_DSGN", "LINKAGE_ID",
    ],
    "pas2": [
        "CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM",
        "TRANSACTION_TP", "ENTITY_TP", "NAME", "CITY", "STATE", "ZIP_CODE",
        "EMPLOYER", "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT",
        "OTHER_ID", "CAND_ID", "TRAN_ID", "FILE_NUM", "MEMO_CD",
        "MEMO_TEXT", "SUB_ID",
    ],
    "indiv": [
        "CMTE_ID", "AMNDT_IND", "RPT_TP", "TRANSACTION_PGI", "IMAGE_NUM",
        "TRANSACTION_TP", "ENTITY_TP", "NAME", "CITY", "STATE", "ZIP_CODE",
        "EMPLOYER", "OCCUPATION", "TRANSACTION_DT", "TRANSACTION_AMT",
        "OTHER_ID", "TRAN_ID", "FILE_NUM", "MEMO_CD", "MEMO_TEXT", "SUB_ID",
    ],
    "ie": [
        "cand_id", "cand_name", "spe_id", "spe_nam", "ele_type",
        "can_office_state", "can_office_dis", "can_office", "cand_pty_aff",
        "exp_amo", "exp_date", "agg_amo", "sup_opp", "pur", "pay",
        "file_num", "amndt_ind", "tran_id", "image_num", "receipt_dat",
        "fec_election_yr", "prev_file_num", "dissem_dt",
    ],
}
DATASETS = list(RAW_COLUMNS)

# Curated table produced from each dataset.
TABLE_OF_DATASET = {
    "cn": "dim_candidates",
    "cm": "dim_committees",
    "ccl": "bridge_candidate_committee",
    "pas2": "fact_contributions",
    "indiv": "fact_individual_contributions",
    "ie": "fact_independent_expenditures",
}

# Pipe files vs the one real CSV.
CSV_DATASETS = {"ie"}

MONEY = T.DecimalType(14, 2)


def raw_schema(dataset: str) -> T.StructType:
    """All-text schema of a raw dataset, in file order."""
    return T.StructType([T.StructField(c, T.StringType(), True)
                         for c in RAW_COLUMNS[dataset]])


TAG_SCHEMA = T.StructType([
    T.StructField("CMTE_ID", T.StringType(), True),
    T.StructField("custom_category", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])

INTEREST_DICTIONARY_SCHEMA = T.StructType([
    T.StructField("cmte_id", T.StringType(), True),
    T.StructField("category", T.StringType(), True),
    T.StructField("notes", T.StringType(), True),
])
