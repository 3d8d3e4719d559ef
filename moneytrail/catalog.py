"""Registry of every operator as a query over a scale-factor folder.

Each entry is ``(spark, sf_dir) -> DataFrame``. Entries open (or reuse) the
landed store for ``sf_dir`` and call the library operator on its tables, for
all candidates at once.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.operators import angles, profile, quality, rank, reports, semantic
from moneytrail.plans.session import fs_exists
from moneytrail.plans.store import Store
from moneytrail.sources import files, interests
from moneytrail.sources.fixture import CYCLE
from moneytrail.sources.schemas import CSV_DATASETS, TABLE_OF_DATASET
from moneytrail.sources.schemas import DATASETS as DATASETS_ORDER
from moneytrail.streaming import refresh

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def register(name: str):
    def deco(fn):
        REGISTRY[name] = fn
        return fn
    return deco


def comparable(df: DataFrame) -> DataFrame:
    """Exact decimals leave the engine as DOUBLE (the reference hands Python
    floats to its presentation layer; DuckDB and Spark agree on the conversion
    of a DECIMAL(18,2) value to the nearest double)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            out.append(F.col(f.name).cast(T.DoubleType()).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def S(spark: SparkSession, sf_dir: str) -> Store:
    return Store.open(spark, sf_dir)


# ------------------------------------------------------------------ curated (P)
@register("dim_candidates")
def _p1(spark, sf):
    return S(spark, sf).candidates


@register("dim_committees")
def _p2(spark, sf):
    return S(spark, sf).committees


@register("bridge_candidate_committee")
def _p3(spark, sf):
    return S(spark, sf).bridge


@register("fact_contributions")
def _p4(spark, sf):
    return S(spark, sf).contributions


@register("fact_individual_contributions")
def _p5(spark, sf):
    return S(spark, sf).individual


@register("fact_independent_expenditures")
def _p6(spark, sf):
    return S(spark, sf).ie


# ------------------------------------------------------------------ views (V)
@register("candidate_committees")
def _v1(spark, sf):
    return S(spark, sf).links


@register("clean_individual")
def _v2(spark, sf):
    return S(spark, sf).clean_individual


@register("clean_ie")
def _v3(spark, sf):
    return S(spark, sf).clean_ie


@register("candidate_money")
def _v4(spark, sf):
    return S(spark, sf).money_view


@register("money_individual")
def _v4a(spark, sf):
    return S(spark, sf).money_individual


@register("money_direct_pac")
def _v4b(spark, sf):
    return S(spark, sf).money_direct_pac


@register("money_ie_support")
def _v4c(spark, sf):
    return S(spark, sf).money_ie_support


@register("money_ie_oppose")
def _v4d(spark, sf):
    return S(spark, sf).money_ie_oppose


# ------------------------------------------------------------------ reports (Q)
@register("candidate_totals")
def _q1(spark, sf):
    s = S(spark, sf)
    return reports.candidate_totals(s.rollup, s.candidates)


@register("candidate_buckets")
def _q2(spark, sf):
    return reports.candidate_buckets(S(spark, sf).rollup)


@register("candidate_top_states")
def _q3(spark, sf):
    return reports.candidate_top_states(S(spark, sf).rollup)


@register("candidate_oos_states")
def _q4(spark, sf):
    s = S(spark, sf)
    return reports.candidate_oos_states(s.rollup, s.candidates)


@register("candidate_interest_blocs")
def _q5(spark, sf):
    return reports.candidate_interest_blocs(S(spark, sf).rollup)


@register("candidate_top_direct_pac")
def _q6(spark, sf):
    s = S(spark, sf)
    return reports.candidate_top_direct_pac(s.contributions, s.committees)


@register("candidate_top_ie_spenders")
def _q7(spark, sf):
    return reports.candidate_top_ie_spenders(S(spark, sf).clean_ie)


@register("rank_base")
def _q8(spark, sf):
    s = S(spark, sf)
    return reports.rank_base(s.rollup, s.candidates)


@register("rank_interest_categories")
def _q9(spark, sf):
    return reports.rank_interest_categories(S(spark, sf).rollup)


def queries() -> dict[str, Query]:
    return {k: (lambda fn: (lambda spark, sf: comparable(fn(spark, sf))))(v)
            for k, v in REGISTRY.items()}


# ------------------------------------------------------------------ profile (M)


def _facts(s: Store) -> DataFrame:
    return profile.candidate_facts(s.rollup, s.candidates)


def search_terms(candidates: DataFrame) -> DataFrame:
    """Search terms derived from the candidate table: every CAND_ID (the id
    form), the lower-cased last four and last two characters of every name, and
    a term with a wildcard from the last characters of id and name."""
    name, cid = F.col("CAND_NAME"), F.col("CAND_ID")
    forms = [cid, F.lower(F.right(name, F.lit(4))), F.lower(F.right(name, F.lit(2))),
             F.concat(F.right(cid, F.lit(1)), F.lit("_"), F.right(name, F.lit(1)))]
    terms = candidates.select(F.explode(F.array(*forms)).alias("term"))
    return terms.filter(F.col("term").isNotNull()).distinct()


@register("resolve_candidates")
def _m1(spark, sf):
    s = S(spark, sf)
    return profile.resolve_candidates(s.candidates, search_terms(s.candidates))


@register("committee_count")
def _m2(spark, sf):
    s = S(spark, sf)
    return profile.committee_count(s.links, s.candidates)


@register("in_state_amount")
def _m3(spark, sf):
    return profile.in_state_amount(_facts(S(spark, sf)))


def _share(col):
    def q(spark, sf):
        return profile.profile_shares(_facts(S(spark, sf))).select("cand_id", col)
    return q


for _k in ["out_of_state_share", "small_dollar_share", "low_small_share", "maxplus_share",
           "pac_share", "outside_share"]:
    register(_k)(_share(_k))


@register("interest_share")
def _m10(spark, sf):
    s = S(spark, sf)
    return profile.interest_share(reports.candidate_interest_blocs(s.rollup), _facts(s))


def _oos(s: Store) -> DataFrame:
    return profile.oos_pool(reports.candidate_oos_states(s.rollup, s.candidates))


@register("oos_pool")
def _m11(spark, sf):
    return _oos(S(spark, sf)).select("cand_id", "oos_total", "n_states", "top_state",
                                     "top_amount", "top_share")


@register("oos_hhi")
def _m12(spark, sf):
    return _oos(S(spark, sf)).select("cand_id", "hhi", "hhi_label")


@register("channel_composition")
def _m13(spark, sf):
    return profile.channel_composition(_facts(S(spark, sf)))


@register("bucket_shares")
def _m14(spark, sf):
    s = S(spark, sf)
    return profile.bucket_shares(reports.candidate_buckets(s.rollup), _facts(s))


@register("state_shares")
def _m15(spark, sf):
    s = S(spark, sf)
    return profile.state_shares(reports.candidate_top_states(s.rollup), _facts(s))


@register("candidate_profile")
def _m16(spark, sf):
    s = S(spark, sf)
    return profile.candidate_profile(profile.facts_with_pool(s.rollup, s.candidates), s.links)


# ------------------------------------------------------------------ ranking (R)
def _ranking(s: Store) -> rank.CohortRanking:
    return rank.CohortRanking(reports.rank_base(s.rollup, s.candidates),
                               reports.rank_interest_categories(s.rollup))


@register("rank_signals")
def _r1(spark, sf):
    return _ranking(S(spark, sf)).signals


@register("rank_category_shares")
def _r2(spark, sf):
    return _ranking(S(spark, sf)).category_shares


@register("rank_percentiles")
def _r3(spark, sf):
    return _ranking(S(spark, sf)).percentiles


@register("rank_floors")
def _r4(spark, sf):
    return _ranking(S(spark, sf)).eligible


@register("rank_headline")
def _r5(spark, sf):
    return _ranking(S(spark, sf)).headline


@register("funding_headline_ranking")
def _r6(spark, sf):
    return _ranking(S(spark, sf)).ranking


@register("rank_display_fields")
def _r7(spark, sf):
    return rank.rank_display_fields(_ranking(S(spark, sf)).ranking)


# ------------------------------------------------------------------ angles (X)


def _angle_inputs(s: Store):
    return (reports.candidate_buckets(s.rollup), _facts(s),
            reports.candidate_top_states(s.rollup), angles.candidate_card(s.candidates))


def _with_committees(df: DataFrame, s: Store) -> DataFrame:
    """Exports exist only for candidates with an attributable committee."""
    n = s.links.select(F.col("CAND_ID").alias("_lc")).distinct()
    return df.join(n, F.col("cand_id") == F.col("_lc"), "left_semi")


@register("angle_donor_size")
def _x1(spark, sf):
    s = S(spark, sf)
    return _with_committees(angles.angle_donor_size(reports.candidate_buckets(s.rollup)), s)


@register("angle_geography")
def _x2(spark, sf):
    s = S(spark, sf)
    return _with_committees(angles.angle_geography(_facts(s), reports.candidate_top_states(s.rollup)), s)


@register("angles_skipped")
def _x3(spark, sf):
    s = S(spark, sf)
    return _with_committees(angles.angles_skipped(reports.candidate_buckets(s.rollup), _facts(s)), s)


@register("angle_documents")
def _x4(spark, sf):
    s = S(spark, sf)
    return _with_committees(angles.angle_documents(*_angle_inputs(s)), s)


@register("candidate_card")
def _x5(spark, sf):
    return angles.candidate_card(S(spark, sf).candidates)


@register("canonical_dirname")
def _x6(spark, sf):
    return angles.canonical_dirname(S(spark, sf).candidates)


@register("chart_reconciliation")
def _x7(spark, sf):
    s = S(spark, sf)
    return _with_committees(angles.chart_reconciliation(
        angles.angle_donor_size(reports.candidate_buckets(s.rollup)),
        angles.angle_geography(_facts(s), reports.candidate_top_states(s.rollup))), s)


@register("donor_inversion")
def _x8(spark, sf):
    s = S(spark, sf)
    return _with_committees(angles.donor_inversion(
        angles.angle_donor_size(reports.candidate_buckets(s.rollup))), s)


@register("write_angles")
def _s12(spark, sf):
    """Write every document as JSON under <dirname>/<angle_id>, then read
    the written files back (key fields)."""
    s = S(spark, sf)
    docs = _with_committees(angles.angle_documents_nested(*_angle_inputs(s)), s)
    dirs = angles.canonical_dirname(s.candidates).withColumnRenamed("cand_id", "_dc")
    docs = docs.join(dirs, F.col("cand_id") == F.col("_dc")).drop("_dc")
    out = s.path("export", "angles", str(s.state["number"]))  # the same files for the same state
    files.write_angles(docs, out)
    # the document schema is known: no inference pass over the written files
    back = files.read_angles(spark, out, docs.drop("dirname", "angle_id").schema)
    return back.select("dirname", "angle_id", F.col("candidate.cand_id").alias("cand_id"),
                       F.col("angle.metric_value").alias("metric_value"),
                       F.col("angle.featured").alias("featured"),
                       F.size("chart.rows").cast("long").alias("n_rows"),
                       F.size("footnotes").cast("long").alias("n_footnotes"))


# ------------------------------------------------------------------ semantic (L)


@register("sem_candidate_count")
def _l1(spark, sf):
    return semantic.sem_candidate_count(S(spark, sf).candidates)


@register("sem_committee_interest")
def _l2(spark, sf):
    s = S(spark, sf)
    return semantic.sem_committee_interest(s.committees, s.tags)


@register("sem_contributions")
def _l3(spark, sf):
    s = S(spark, sf)
    return semantic.sem_contributions(s.contributions, s.committees, s.candidates)


@register("sem_individual")
def _l4(spark, sf):
    s = S(spark, sf)
    return semantic.sem_individual(s.individual, s.committees)


@register("sem_ie")
def _l5(spark, sf):
    s = S(spark, sf)
    return semantic.sem_ie(s.ie, s.committees, s.candidates)


@register("sem_money_measures")
def _l6(spark, sf):
    s = S(spark, sf)
    return semantic.sem_money_measures(s.rollup, s.candidates)


@register("interest_backing")
def _l7(spark, sf):
    s = S(spark, sf)
    return semantic.interest_backing(s.rollup, s.candidates)


@register("individual_by_state")
def _l8(spark, sf):
    s = S(spark, sf)
    return semantic.individual_by_state(s.rollup, s.candidates)


# ------------------------------------------------------------------ quality (D)


@register("table_profile")
def _d1(spark, sf):
    return quality.table_profile(S(spark, sf).curated_tables())


@register("column_dictionary")
def _d2(spark, sf):
    return quality.column_dictionary(spark, S(spark, sf).curated_tables())


@register("dictionary_drift")
def _d3(spark, sf):
    return quality.dictionary_drift(spark, S(spark, sf).curated_tables())


@register("raw_profile")
def _d4(spark, sf):
    return quality.raw_profile(S(spark, sf).raws())


@register("profile_staleness")
def _d5(spark, sf):
    """The profile of an older snapshot (transactions filed later are not in it)
    against a fresh one."""
    now = S(spark, sf).curated_tables()
    older = {t: df.filter(F.col("SUB_ID") % 10 != 3) if "SUB_ID" in df.columns else df
             for t, df in now.items()}
    return quality.profile_staleness(quality.table_profile(older), quality.table_profile(now))


@register("raw_vs_curated_counts")
def _d6(spark, sf):
    s = S(spark, sf)
    return quality.raw_vs_curated_counts(s.raws(), s.curated_tables(), TABLE_OF_DATASET)


@register("dictionary_tag_report")
def _d7(spark, sf):
    s = S(spark, sf)
    return quality.dictionary_tag_report(s.interest_entries(), s.committees)


@register("tag_conflicts")
def _d8(spark, sf):
    return quality.tag_conflicts(S(spark, sf).interest_entries())


@register("channel_counts")
def _d9(spark, sf):
    return quality.channel_counts(S(spark, sf).rollup)


@register("null_checks")
def _d10(spark, sf):
    return quality.null_checks(S(spark, sf).money)


@register("link_checks")
def _d11(spark, sf):
    return quality.link_checks(S(spark, sf).links)


@register("derived_total_identity")
def _d12(spark, sf):
    s = S(spark, sf)
    return quality.derived_total_identity(reports.candidate_totals(s.rollup, s.candidates))


@register("pac_types_by_category")
def _d13(spark, sf):
    s = S(spark, sf)
    return quality.pac_types_by_category(s.contributions, s.tags)


@register("ie_raw_vs_clean")
def _d14(spark, sf):
    s = S(spark, sf)
    return quality.ie_raw_vs_clean(s.ie, s.clean_ie)


@register("category_ie_support")
def _d15(spark, sf):
    s = S(spark, sf)
    return quality.category_ie_support(s.clean_ie, s.tags)


@register("key_uniqueness")
def _d16(spark, sf):
    s = S(spark, sf)
    return quality.key_uniqueness({
        "fact_individual_contributions": (s.individual, "SUB_ID"),
        "fact_contributions": (s.contributions, "SUB_ID"),
        "fact_independent_expenditures": (s.ie, "IE_ID"),
        "dim_candidates": (s.candidates, "CAND_ID"),
        "dim_committees": (s.committees, "CMTE_ID"),
    })


@register("orphan_references")
def _d17(spark, sf):
    s = S(spark, sf)
    return quality.orphan_references([
        ("fact_independent_expenditures", s.ie, "TARGET_CAND_ID", "dim_candidates",
         s.candidates, "CAND_ID"),
        ("fact_independent_expenditures", s.ie, "SPENDER_CMTE_ID", "dim_committees",
         s.committees, "CMTE_ID"),
        ("fact_contributions", s.contributions, "TARGET_CAND_ID", "dim_candidates",
         s.candidates, "CAND_ID"),
        ("fact_contributions", s.contributions, "SOURCE_CMTE_ID", "dim_committees",
         s.committees, "CMTE_ID"),
        ("fact_individual_contributions", s.individual, "TARGET_CMTE_ID", "dim_committees",
         s.committees, "CMTE_ID"),
    ])


@register("unparsed_values")
def _d18(spark, sf):
    return quality.unparsed_values(S(spark, sf).raws())


# ------------------------------------------------------------------ sources (S)


def _union(frames):
    out = None
    for f in frames:
        out = f if out is None else out.unionByName(f)
    return out


def _bulk(s: Store, ds: str) -> str:
    """A landed dataset in its bulk-file form, written once beside the version it shows."""
    path = s.raw_path(ds) + ".bulk"
    if not fs_exists(s.spark, path + "/_SUCCESS"):
        (files.write_ie_csv if ds in CSV_DATASETS else files.write_pipe_text)(s.raw(ds), path)
    return path


@register("scan_pipe_raw")
def _s1(spark, sf):
    """The five pipe datasets in bulk-file form, read back."""
    s = S(spark, sf)
    return _union(files.raw_lines(files.scan_pipe_raw(spark, _bulk(s, ds), ds), ds)
                  for ds in DATASETS_ORDER if ds not in CSV_DATASETS)


@register("scan_ie_csv")
def _s2(spark, sf):
    """The IE dataset as quoted CSV with a header, read back."""
    return files.scan_ie_csv(spark, _bulk(S(spark, sf), "ie"))


@register("land_raw_parquet")
def _s4(spark, sf):
    s = S(spark, sf)
    return files.landed_counts(spark, s.raw_paths())


@register("scan_raw_parquet")
def _s5(spark, sf):
    at = S(spark, sf).raw_paths()
    return _union(files.raw_lines(files.scan_raw_parquet(spark, at[ds], ds), ds)
                  for ds in DATASETS_ORDER)


@register("replace_curated")
def _s6(spark, sf):
    """Every curated table replaced twice in one place: the second write leaves the
    same table (rows per key)."""
    s = S(spark, sf)
    keys = {"dim_candidates": "CAND_ID", "dim_committees": "CMTE_ID",
            "bridge_candidate_committee": "CAND_ID", "fact_contributions": "TARGET_CAND_ID",
            "fact_individual_contributions": "TARGET_CMTE_ID",
            "fact_independent_expenditures": "SPENDER_CMTE_ID", "dim_group_mappings": "CMTE_ID"}

    def twice(table, key):
        path = s.path("export", "replaced", table)
        files.replace_curated(s.table(table), path)
        return (files.replace_curated(s.table(table), path).groupBy(F.col(key).alias("key"))
                .agg(F.count(F.lit(1)).alias("rows"))
                .select(F.lit(table).alias("table"), "key", "rows"))

    return _union(twice(t, k) for t, k in keys.items())


@register("scan_interest_dictionary")
def _s7(spark, sf):
    return S(spark, sf).interest_entries()


@register("load_group_mappings")
def _s8(spark, sf):
    s = S(spark, sf)
    return interests.load_group_mappings(s.interest_entries(), s.committees)


def _changes(s: Store) -> DataFrame:
    """The landed datasets against the manifest of an older store: cm was filed without
    its C1 committees (changed), ccl is not there (new), cn has gone since (missing)."""
    raws = s.raws()
    older = {ds: df for ds, df in raws.items() if ds != "ccl"}
    older["cm"] = older["cm"].filter(~F.col("CMTE_ID").startswith("C1"))
    now = {ds: df for ds, df in raws.items() if ds != "cn"}
    return refresh.snapshot_changes(refresh.manifest(now, CYCLE), refresh.manifest(older, CYCLE))


@register("snapshot_changes")
def _s9(spark, sf):
    return _changes(S(spark, sf))


@register("rebuild_set")
def _s10(spark, sf):
    """The tables to build after those changes, the one of pas2 having been lost."""
    existing = spark.createDataFrame([(t,) for ds, t in TABLE_OF_DATASET.items() if ds != "pas2"],
                                     "table string")
    return refresh.rebuild_set(_changes(S(spark, sf)), existing, TABLE_OF_DATASET)


@register("single_cycle_guard")
def _s11(spark, sf):
    return refresh.single_cycle_guard(refresh.cycles_in_data(S(spark, sf).raws()), CYCLE)
