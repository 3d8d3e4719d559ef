"""Audit invariants on the landed test store (sf0.001)."""
from pyspark.sql import functions as F

import __spark_entry__ as E

SF = "/root/testdata/sf0.001"


def test_no_null_amounts_or_names(spark):
    r = E.queries()["null_checks"](spark, SF).first()
    assert (r.null_amount, r.null_name) == (0, 0)


def test_links_inside_allowed_codes(spark):
    r = E.queries()["link_checks"](spark, SF).first()
    assert (r.bad_designation, r.bad_type) == (0, 0)


def test_derived_totals_identity(spark):
    df = E.queries()["derived_total_identity"](spark, SF)
    assert df.filter(~F.col("raised_ok") | ~F.col("backing_ok")).count() == 0


def test_donor_size_charts_reconcile(spark):
    df = E.queries()["chart_reconciliation"](spark, SF)
    assert df.filter((F.col("angle_id") == "donor-size") & ~F.col("ok")).count() == 0


def test_raw_and_curated_counts_agree(spark):
    df = E.queries()["raw_vs_curated_counts"](spark, SF)
    assert df.filter(~F.col("equal")).count() == 0


def test_nothing_new_nothing_to_do(spark):
    from moneytrail.operators import quality
    from moneytrail.plans.store import Store
    from moneytrail.sources.schemas import TABLE_OF_DATASET
    from moneytrail.streaming import refresh
    s = Store.open(spark, SF)
    changes = refresh.snapshot_changes(refresh.manifest(s.raws(), "2026"), s.manifest())
    assert {r.status for r in changes.collect()} == {"unchanged"}
    have = spark.createDataFrame([(t,) for t in TABLE_OF_DATASET.values()], "table string")
    assert refresh.rebuild_set(changes, have, TABLE_OF_DATASET).count() == 0
    now = quality.table_profile(s.curated_tables())
    assert quality.profile_staleness(now, now).count() == 0


def test_nested_profile_arrays_are_bounded(spark):
    from moneytrail.operators import profile, reports
    from moneytrail.plans.store import Store
    s = Store.open(spark, SF)
    nested = profile.candidate_profile_nested(
        profile.facts_with_pool(s.rollup, s.candidates), reports.candidate_top_states(s.rollup), reports.candidate_buckets(s.rollup),
        reports.candidate_interest_blocs(s.rollup),
        reports.candidate_top_direct_pac(s.contributions, s.committees),
        reports.candidate_top_ie_spenders(s.clean_ie), s.links)
    flat = E.queries()["candidate_profile"](spark, SF)
    assert nested.count() == flat.count() > 0
    worst = nested.select(F.max(F.size("states")).alias("st"), F.max(F.size("buckets")).alias("b"),
                          F.max(F.size("top_pacs")).alias("p"), F.max(F.size("top_ie")).alias("i")
                          ).first()
    assert worst.st <= 8 and worst.b <= 5 and worst.p <= 12 and worst.i <= 8


def test_cohort_filters_restrict_rank_base(spark):
    from moneytrail.operators import reports
    from moneytrail.plans.store import Store
    s = Store.open(spark, SF)
    everyone = reports.rank_base(s.rollup, s.candidates, min_individual=0)
    for kw, cond in [({"office": "H"}, F.col("CAND_OFFICE") == "H"),
                     ({"incumbents": True}, F.col("CAND_ID").isin(
                         [r.CAND_ID for r in s.candidates.filter("CAND_ICI = 'I'").collect()]))]:
        part = reports.rank_base(s.rollup, s.candidates, min_individual=0, **kw)
        assert sorted(map(tuple, part.collect())) == sorted(map(tuple, everyone.filter(cond).collect()))
    state = s.candidates.first().CAND_OFFICE_ST
    st = reports.rank_base(s.rollup, s.candidates, state=state.lower(), min_individual=0)
    assert {r.CAND_OFFICE_ST for r in st.collect()} <= {state}


def test_unknown_dictionary_ids_are_listed(spark):
    from moneytrail.operators import quality
    from moneytrail.plans.store import Store
    s = Store.open(spark, SF)
    rows = quality.unknown_dictionary_ids(s.interest_entries(), s.committees).collect()
    report = E.queries()["dictionary_tag_report"](spark, SF).collect()
    assert len(rows) == sum(r.unknown for r in report) > 0
    assert {r.cmte_id[:2] for r in rows} == {"C8"}


def test_a_bound_of_zero_is_a_bound(spark):
    from moneytrail.operators import reports
    from moneytrail.plans.store import Store
    s = Store.open(spark, SF)
    codes = {r.bucket[:1] for r in reports.candidate_buckets(s.money, small_max=0).collect()}
    assert "1" not in codes and codes
