"""Data dictionary, quality and audit jobs.

Every check is an aggregate over the tables (counts, conditional counts,
anti/semi joins against the small dimensions), returning a DataFrame of
findings; nothing is collected to the driver except table schemas.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.functions.parse import (try_bigint, try_date_dmy, try_date_mdy, try_int,
                                        try_money)
from moneytrail.operators.views import (LINK_COMMITTEE_TYPES, LINK_DESIGNATIONS,
                                        NON_DIRECT_TYPES, as_rollup)
from moneytrail.plans.joins import join_small

DBL = T.DoubleType()

# Table documentation of this project (grain and column descriptions) that the
# dictionary jobs join against.
TABLE_DOCS: dict[str, dict] = {
    "dim_candidates": {
        "grain": "one row per candidate of the cycle",
        "columns": {
            "CAND_ID": "candidate id; first letter is the office",
            "CAND_NAME": "name as filed, LAST, FIRST",
            "CAND_PTY_AFFILIATION": "party code",
            "CAND_ELECTION_YR": "election year (NULL when not a number)",
            "CAND_OFFICE_ST": "state of the office sought (home state)",
            "CAND_OFFICE": "H House, S Senate, P President",
            "CAND_OFFICE_DISTRICT": "district, 00 for statewide offices",
            "CAND_ICI": "I incumbent, C challenger, O open seat",
            "CAND_STATUS": "candidate status code",
            "CAND_PCC": "principal campaign committee id",
        },
    },
    "dim_committees": {
        "grain": "one row per committee",
        "columns": {
            "CMTE_ID": "committee id",
            "CMTE_NM": "committee name",
            "CMTE_TP": "committee type",
            "CMTE_DSGN": "designation (P principal, A authorized, J joint, U unauthorized)",
            "AFFILIATED_CAND_ID": "candidate the committee is tied to, if any",
        },
    },
    "bridge_candidate_committee": {
        "grain": "one row per filed candidate-committee link",
        "columns": {
            "CAND_ID": "candidate id",
            "CMTE_ID": "committee id",
            "FEC_ELECTION_YR": "cycle of the link",
            "CMTE_TP": "committee type on the link",
            "CMTE_DSGN": "designation on the link",
            "LINKAGE_ID": "link id",
        },
    },
    "fact_contributions": {
        "grain": "one row per committee-to-candidate transaction",
        "columns": {
            "SUB_ID": "transaction id",
            "SOURCE_CMTE_ID": "giving committee",
            "TARGET_CAND_ID": "receiving candidate",
            "AMOUNT": "amount in dollars (negative = refund)",
            "TRANSACTION_DT": "transaction date",
            "TRANSACTION_TP": "transaction type; 24E/24A are independent expenditures",
        },
    },
    "fact_individual_contributions": {
        "grain": "one row per itemized gift from a person or entity to a committee",
        "columns": {
            "SUB_ID": "transaction id",
            "TARGET_CMTE_ID": "receiving committee",
            "CONTRIBUTOR_NAME": "donor name",
            "STATE": "donor state",
            "EMPLOYER": "donor employer",
            "AMOUNT": "amount in dollars (negative = refund)",
            "TRANSACTION_DT": "transaction date",
            "ENTITY_TP": "IND for people",
            "MEMO_CD": "X marks the memo copy of an earmarked gift",
        },
    },
    "fact_independent_expenditures": {
        "grain": "one row per independent expenditure filing line",
        "columns": {
            "IE_ID": "file number and transaction id",
            "SPENDER_CMTE_ID": "spending committee",
            "TARGET_CAND_ID": "candidate supported or opposed",
            "SUPPORT_OPPOSE": "S support, O oppose",
            "AMOUNT": "amount in dollars",
            "EXPENDITURE_DT": "expenditure date",
            "AMNDT_IND": "N original filing, otherwise an amendment",
        },
    },
    "dim_group_mappings": {
        "grain": "one row per curated committee interest tag",
        "columns": {
            "CMTE_ID": "tagged committee",
            "custom_category": "interest category (encodes stance)",
            "notes": "free text",
        },
    },
}


def _docs_frame(spark: SparkSession) -> DataFrame:
    rows = [(t, c, d) for t, m in TABLE_DOCS.items() for c, d in m["columns"].items()]
    return spark.createDataFrame(rows, "table string, column string, description string")


def _count(df: DataFrame, name: str, extra: dict | None = None) -> DataFrame:
    cols = [F.lit(name).alias("table"), F.count(F.lit(1)).alias("rows"),
            F.lit(len(df.columns)).cast("long").alias("cols")]
    for k, v in (extra or {}).items():
        cols.append(F.lit(v).alias(k))
    return df.agg(*cols[1:2]).select(cols[0], "rows", *cols[2:])


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


# ------------------------------------------------------------------ D1-D6
def table_profile(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows, columns and documented grain per curated table."""
    return _union([_count(df, name, {"grain": TABLE_DOCS.get(name, {}).get("grain", "")})
                   for name, df in tables.items()])


def _columns_present(tables: dict[str, DataFrame]) -> DataFrame:
    """table, ordinal, column, rows and present (values that are not NULL) of every
    column: one pass over each table."""
    frames = []
    for t, df in tables.items():
        counts = df.agg(F.count(F.lit(1)).alias("rows"),
                        *[F.count(F.col(c)).alias(f"_{i}") for i, c in enumerate(df.columns, 1)])
        each = F.explode(F.array(*[
            F.struct(F.lit(i).alias("ordinal"), F.lit(c).alias("column"),
                     F.col(f"_{i}").alias("present")) for i, c in enumerate(df.columns, 1)])).alias("c")
        frames.append(counts.select(F.lit(t).alias("table"), "rows", each)
                      .select("table", "c.ordinal", "c.column", "rows", "c.present"))
    return _union(frames)


def column_dictionary(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """Table, ordinal, column, rows, present and description
    ('(undocumented)' when the project documents nothing for the column)."""
    j = _columns_present(tables).join(_docs_frame(spark), ["table", "column"], "left")
    return j.select("table", "ordinal", "column", "rows", "present",
                    F.coalesce("description", F.lit("(undocumented)")).alias("description"))


def dictionary_drift(spark: SparkSession, tables: dict[str, DataFrame]) -> DataFrame:
    """D3: undocumented (live, not described), empty (described, but no row has a
    value) and stale (described, not live) columns, with their values present."""
    live, docs = _columns_present(tables), _docs_frame(spark)
    j = live.join(docs, ["table", "column"], "left")
    kind = F.when(F.col("description").isNull(), "undocumented").when(F.col("present") == 0, "empty")
    found = j.select("table", "column", kind.alias("kind"), "present").filter("kind IS NOT NULL")
    stale = docs.join(live, ["table", "column"], "left_anti").select(
        "table", "column", F.lit("stale").alias("kind"), F.lit(0).cast("long").alias("present"))
    return found.unionByName(stale)


def raw_profile(raws: dict[str, DataFrame]) -> DataFrame:
    """Rows and columns per raw landed dataset."""
    return _union([_count(df, f"raw_{ds}.parquet") for ds, df in raws.items()]
                  ).withColumnRenamed("table", "file")


def profile_staleness(stored: DataFrame, fresh: DataFrame) -> DataFrame:
    """Rows of the stored profile that differ from a fresh one (both
    directions; empty = up to date)."""
    cols = fresh.columns
    a = stored.select(*cols).exceptAll(fresh.select(*cols)).withColumn("side", F.lit("stored"))
    b = fresh.select(*cols).exceptAll(stored.select(*cols)).withColumn("side", F.lit("fresh"))
    return a.unionByName(b)


def raw_vs_curated_counts(raws: dict[str, DataFrame], tables: dict[str, DataFrame],
                          table_of: dict[str, str]) -> DataFrame:
    """Each raw dataset's row count against its curated table's."""
    frames = []
    for ds, raw in raws.items():
        t = table_of[ds]
        r = raw.agg(F.count(F.lit(1)).alias("raw_rows"))
        c = tables[t].agg(F.count(F.lit(1)).alias("table_rows"))
        both = r.unionByName(c, allowMissingColumns=True).agg(
            F.max("raw_rows").alias("raw_rows"), F.max("table_rows").alias("table_rows"))
        frames.append(both.select(F.lit(ds).alias("dataset"), F.lit(t).alias("table"),
                                  "raw_rows", "table_rows",
                                  (F.col("raw_rows") == F.col("table_rows")).alias("equal")))
    return _union(frames)


# ------------------------------------------------------------------ D7, D8
def dictionary_tag_report(entries: DataFrame, committees: DataFrame) -> DataFrame:
    """Per category, dictionary entries, of them valid (committee known)
    and unknown."""
    ids = committees.select(F.col("CMTE_ID").alias("_id")).distinct()
    j = join_small(entries, ids.withColumn("_known", F.lit(True)),
                   F.col("cmte_id") == F.col("_id"), "left")
    known = F.col("_known").isNotNull()
    return j.groupBy("category").agg(
        F.count(F.lit(1)).alias("entries"),
        F.count(F.when(known, 1)).alias("valid"),
        F.count(F.when(~known, 1)).alias("unknown"))


def unknown_dictionary_ids(entries: DataFrame, committees: DataFrame) -> DataFrame:
    """The dictionary rows (cmte_id, category, notes) whose committee is not known:
    what the load leaves out."""
    ids = committees.select(F.col("CMTE_ID").alias("_id"))
    return entries.join(ids, F.col("cmte_id") == F.col("_id"), "left_anti")


def tag_conflicts(entries: DataFrame) -> DataFrame:
    """Committees listed under more than one category."""
    return (entries.groupBy("cmte_id")
            .agg(F.countDistinct("category").alias("n_categories"),
                 F.array_join(F.array_sort(F.collect_set("category")), "|").alias("categories"))
            .filter(F.col("n_categories") > 1))


# ------------------------------------------------------------------ D9-D12
def channel_counts(money: DataFrame) -> DataFrame:
    """Rows and money per channel."""
    return as_rollup(money).groupBy("channel").agg(F.sum("n_rows").alias("n"),
                                                   F.sum("amount").alias("amount"))


def null_checks(money: DataFrame) -> DataFrame:
    """Individual rows with a NULL amount / NULL contributor name."""
    ind = money.filter(F.col("channel") == "individual")
    return ind.agg(F.count(F.when(F.col("amount").isNull(), 1)).alias("null_amount"),
                   F.count(F.when(F.col("contributor_name").isNull(), 1)).alias("null_name"))


def link_checks(links: DataFrame) -> DataFrame:
    """Attributed links outside the allowed designations / types."""
    return links.agg(
        F.count(F.when(~F.col("CMTE_DSGN").isin(LINK_DESIGNATIONS), 1)).alias("bad_designation"),
        F.count(F.when(~F.col("CMTE_TP").isin(LINK_COMMITTEE_TYPES), 1)).alias("bad_type"))


def derived_total_identity(totals: DataFrame) -> DataFrame:
    """raised = individual + direct PAC and backing = raised + IE support,
    compared in whole dollars per candidate."""
    def whole(c: Column) -> Column:
        return F.round(c, 0)
    return totals.select(
        "cand_id", "raised",
        (F.col("individual_amount") + F.col("direct_pac_amount")).alias("individual_plus_pac"),
        "total_backing",
        (F.col("raised") + F.col("ie_support_amount")).alias("raised_plus_ie_support"),
        (whole(F.col("raised")) == whole(F.col("individual_amount") + F.col("direct_pac_amount")))
        .alias("raised_ok"),
        (whole(F.col("total_backing")) == whole(F.col("raised") + F.col("ie_support_amount")))
        .alias("backing_ok"))


# ------------------------------------------------------------------ D13-D15
def pac_types_by_category(contributions: DataFrame, tags: DataFrame) -> DataFrame:
    """Per tag category and transaction type, rows and money, with the
    flag whether the type is excluded from direct PAC money."""
    g = tags.select(F.col("CMTE_ID").alias("_gid"), F.col("custom_category").alias("category"))
    j = join_small(contributions, g, F.col("SOURCE_CMTE_ID") == F.col("_gid"))
    return j.groupBy("category", "TRANSACTION_TP").agg(
        F.count(F.lit(1)).alias("n"), F.sum("AMOUNT").alias("amount")).withColumn(
        "excluded", F.coalesce(F.col("TRANSACTION_TP").isin(NON_DIRECT_TYPES), F.lit(True)))


def ie_raw_vs_clean(ie: DataFrame, clean: DataFrame) -> DataFrame:
    """The raw IE total, the clean total and their ratio (one row)."""
    u = (ie.select(F.col("AMOUNT").alias("a"), F.lit(True).alias("raw"))
         .unionByName(clean.select(F.col("AMOUNT").alias("a"), F.lit(False).alias("raw"))))
    agg = u.agg(F.sum(F.when(F.col("raw"), F.col("a"))).alias("raw_amount"),
                F.sum(F.when(~F.col("raw"), F.col("a"))).alias("clean_amount"))
    return agg.select("raw_amount", "clean_amount",
                      F.when(F.col("clean_amount") != 0,
                             F.col("raw_amount").cast(DBL) / F.col("clean_amount").cast(DBL))
                      .alias("raw_to_clean"))


def category_ie_support(clean: DataFrame, tags: DataFrame) -> DataFrame:
    """Per candidate and tag category, IE support from the category's
    committees."""
    g = tags.select(F.col("CMTE_ID").alias("_gid"), F.col("custom_category").alias("category"))
    s = clean.filter(F.col("SUPPORT_OPPOSE") == "S")
    j = join_small(s, g, F.col("SPENDER_CMTE_ID") == F.col("_gid"))
    return (j.groupBy(F.col("TARGET_CAND_ID").alias("cand_id"), "category")
            .agg(F.sum("AMOUNT").alias("amount")))


# ------------------------------------------------------------------ D16-D18
def key_uniqueness(keyed: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """Per (table, key): rows, distinct keys, duplicated keys and the
    rows they cover, NULL keys. Counting per key is map-side combined, so a
    hot key costs one row per task before the shuffle."""
    frames = []
    for table, (df, key) in keyed.items():
        per = df.groupBy(F.col(key).alias("k")).agg(F.count(F.lit(1)).alias("c"))
        frames.append(per.agg(
            F.sum("c").alias("rows"),
            F.count(F.when(F.col("k").isNotNull(), 1)).alias("distinct_keys"),
            F.count(F.when(F.col("k").isNotNull() & (F.col("c") > 1), 1)).alias("dup_keys"),
            F.coalesce(F.sum(F.when(F.col("k").isNotNull() & (F.col("c") > 1), F.col("c"))),
                       F.lit(0)).alias("dup_rows"),
            F.coalesce(F.sum(F.when(F.col("k").isNull(), F.col("c"))), F.lit(0)).alias("null_keys"),
        ).select(F.lit(table).alias("table"), F.lit(key).alias("key"), "*"))
    return _union(frames)


def orphan_references(refs: list[tuple[str, DataFrame, str, str, DataFrame, str]]) -> DataFrame:
    """Per (fact, key -> dimension): rows, rows whose key is found in the
    dimension, and that share. ``refs`` = (fact name, fact, key, dim name,
    dim, dim key)."""
    frames = []
    for fname, fact, key, dname, dim, dkey in refs:
        ids = dim.select(F.col(dkey).alias("_k")).distinct().withColumn("_hit", F.lit(True))
        j = join_small(fact.select(key), ids, F.col(key) == F.col("_k"), "left")
        frames.append(j.agg(F.count(F.lit(1)).alias("rows"),
                            F.count(F.when(F.col("_hit"), 1)).alias("matched"))
                      .select(F.lit(fname).alias("fact"), F.lit(key).alias("key"),
                              F.lit(dname).alias("dimension"), "rows", "matched",
                              F.when(F.col("rows") > 0, F.col("matched").cast(DBL)
                                     / F.col("rows").cast(DBL)).alias("matched_share")))
    return _union(frames)


# (dataset, raw column, typing function) of every typed raw column
TYPED_COLUMNS = [
    ("cn", "CAND_ELECTION_YR", try_int),
    ("ccl", "FEC_ELECTION_YR", try_int),
    ("pas2", "SUB_ID", try_bigint), ("pas2", "TRANSACTION_AMT", try_money),
    ("pas2", "TRANSACTION_DT", try_date_mdy),
    ("indiv", "SUB_ID", try_bigint), ("indiv", "TRANSACTION_AMT", try_money),
    ("indiv", "TRANSACTION_DT", try_date_mdy),
    ("ie", "exp_amo", try_money), ("ie", "exp_date", try_date_dmy),
    ("ie", "agg_amo", try_money), ("ie", "dissem_dt", try_date_dmy),
]


def unparsed_values(raws: dict[str, DataFrame]) -> DataFrame:
    """Per typed column, blank texts and non-blank texts that typed to
    NULL (lenient typing hides them otherwise). One aggregation pass per
    dataset; its one-row result is unpivoted with ``explode``."""
    frames = []
    for ds in dict.fromkeys(d for d, _, _ in TYPED_COLUMNS):
        cols = [(c, fn) for d, c, fn in TYPED_COLUMNS if d == ds]
        aggs = []
        for c, fn in cols:
            blank = F.col(c).isNull() | (F.trim(F.col(c)) == "")
            aggs += [F.count(F.when(blank, 1)).alias(f"{c}__blank"),
                     F.count(F.when(~blank & fn(F.col(c)).isNull(), 1)).alias(f"{c}__bad")]
        rows = F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"{c}__blank").alias("blank"),
                                  F.col(f"{c}__bad").alias("unparsed")) for c, _ in cols])
        frames.append(raws[ds].agg(*aggs).select(F.lit(ds).alias("dataset"),
                                                 F.explode(rows).alias("r"))
                      .select("dataset", "r.column", "r.blank", "r.unparsed"))
    return _union(frames)
