"""Views and reports on hand-made frames: NULL logic, fan-out, bucket edges."""
from decimal import Decimal

from pyspark.sql import functions as F

from moneytrail.operators import reports, views
from moneytrail.sources.schemas import RAW_COLUMNS, TAG_SCHEMA


def raw(spark, ds, rows):
    cols = RAW_COLUMNS[ds]
    full = [tuple(r.get(c) for c in cols) for r in rows]
    return spark.createDataFrame(full, ", ".join(f"{c} string" for c in cols))


def test_clean_individual_memo_and_entity(spark):
    rows = [dict(CMTE_ID="C1", ENTITY_TP="IND", MEMO_CD=None, TRANSACTION_AMT="10"),
            dict(CMTE_ID="C1", ENTITY_TP="IND", MEMO_CD="X", TRANSACTION_AMT="20"),
            dict(CMTE_ID="C1", ENTITY_TP="IND", MEMO_CD="Y", TRANSACTION_AMT="30"),
            dict(CMTE_ID="C1", ENTITY_TP=None, MEMO_CD=None, TRANSACTION_AMT="40"),
            dict(CMTE_ID="C1", ENTITY_TP="ORG", MEMO_CD=None, TRANSACTION_AMT="50")]
    out = views.clean_individual(raw(spark, "indiv", rows))
    assert sorted(float(r.AMOUNT) for r in out.collect()) == [10.0, 30.0]


def test_links_distinct_keeps_double_designation(spark):
    b = spark.createDataFrame(
        [("H1", "C1", 2026, "H", "P", "1"), ("H1", "C1", 2026, "H", "P", "1"),
         ("H1", "C1", 2026, "H", "A", "2"), ("H1", "C5", 2026, "N", "J", "3")],
        "CAND_ID string, CMTE_ID string, FEC_ELECTION_YR int, CMTE_TP string, "
        "CMTE_DSGN string, LINKAGE_ID string")
    links = views.candidate_committees(b)
    assert links.count() == 2  # exact duplicate collapsed; P and A both stay
    gifts = spark.createDataFrame([("C1", Decimal("5.00"), "NM", "A", "E")],
                                  "TARGET_CMTE_ID string, AMOUNT decimal(14,2), STATE string, "
                                  "CONTRIBUTOR_NAME string, EMPLOYER string")
    assert views.money_individual(gifts, links).count() == 2  # fan-out like the SQL


def test_direct_pac_null_type_and_duplicate_tags(spark):
    f = spark.createDataFrame(
        [("P1", "H1", Decimal("100"), "24K"), ("P1", "H1", Decimal("7"), None),
         ("P1", "H1", Decimal("9"), "24E"), ("P2", "H1", Decimal("11"), "24Z")],
        "SOURCE_CMTE_ID string, TARGET_CAND_ID string, AMOUNT decimal(14,2), "
        "TRANSACTION_TP string")
    tags = spark.createDataFrame([("P1", "A", ""), ("P1", "B", "")], TAG_SCHEMA)
    m = views.money_direct_pac(f, tags).collect()
    # NULL type dropped by NOT IN, 24E excluded, P1 tagged twice -> two rows
    assert sorted((r.interest_category or "", float(r.amount)) for r in m) == [
        ("", 11.0), ("A", 100.0), ("B", 100.0)]


def money_frame(spark, rows):
    return spark.createDataFrame(
        [(c, ch, None if a is None else Decimal(a), st, None, None, cat)
         for c, ch, a, st, cat in rows],
        "cand_id string, channel string, amount decimal(14,2), donor_state string, "
        "contributor_name string, employer string, interest_category string")


def test_bucket_boundaries(spark):
    amts = ["-5", "0", None, "200", "200.50", "999", "999.50", "1000", "3499.99", "3500"]
    m = money_frame(spark, [("H1", "individual", a, "NM", None) for a in amts])
    got = {r.bucket: (r.n, float(r.amount)) for r in reports.candidate_buckets(m).collect()}
    assert got == {
        "5 refund/negative": (1, -5.0),
        "1 small  (<=$200)": (1, 200.0),
        "2 mid    ($201-999)": (2, 1199.5),
        "3 large  ($1k-max)": (3, 5499.49),
        "4 max+   (>=$3500)": (1, 3500.0),
    }


def test_top_states_null_state_and_order(spark):
    rows = [("H1", "individual", "10", None, None), ("H1", "individual", "10", "AA", None),
            ("H1", "individual", "30", "BB", None)]
    rows += [("H1", "individual", str(i), f"S{i:02d}", None) for i in range(1, 9)]
    top = reports.candidate_top_states(money_frame(spark, rows)).orderBy("rank").collect()
    assert [r.donor_state for r in top] == ["BB", "AA", None, "S08", "S07", "S06", "S05", "S04"]


def test_totals_zero_fill_and_blocs(spark):
    m = money_frame(spark, [
        ("H1", "individual", "100", "NM", None), ("H1", "direct_pac", "50", None, "T1"),
        ("H1", "ie_support", "25", None, "T1"), ("H1", "ie_oppose", "1000", None, "T2"),
        ("H1", "direct_pac", "5", None, "T3"), ("H1", "ie_support", "-5", None, "T3")])
    cands = spark.createDataFrame([("H1", "NM"), ("H2", "TX")], "CAND_ID string, CAND_OFFICE_ST string")
    t = {r.cand_id: r for r in reports.candidate_totals(m, cands).collect()}
    assert float(t["H1"].raised) == 155.0 and float(t["H1"].total_backing) == 175.0
    assert t["H2"].individual_count == 0 and float(t["H2"].raised) == 0.0
    blocs = {r.interest_category for r in reports.candidate_interest_blocs(m).collect()}
    assert blocs == {"T1"}  # T2 is oppose only; T3 nets to zero


def test_oos_states_drop_null_and_nonpositive(spark):
    m = money_frame(spark, [("H1", "individual", "10", None, None),
                            ("H1", "individual", "-10", "TX", None),
                            ("H1", "individual", "20", "TX", None),
                            ("H1", "individual", "40", "NM", None)])
    cands = spark.createDataFrame([("H1", "NM")], "CAND_ID string, CAND_OFFICE_ST string")
    got = [(r.donor_state, float(r.amount)) for r in reports.candidate_oos_states(m, cands).collect()]
    assert got == [("TX", 20.0)]


def test_resolve_candidates_paths(spark):
    from moneytrail.operators import profile
    c = spark.createDataFrame(
        [("H0000001", "LUJAN, BEN RAY"), ("S0000002", "SMITH, JOHN Q."),
         ("P0000003", "SMITHERS, WAYLON"), ("H0000004", "O_NEIL, ANN")],
        "CAND_ID string, CAND_NAME string")
    terms = spark.createDataFrame([("h0000001",), ("smith",), ("jo",), ("o_n",), ("zzz",),
                                   ("S0000002",)], "term string")
    got = {(r.term, r.cand_id): r.n_matches
           for r in profile.resolve_candidates(c, terms).collect()}
    assert got == {
        # 'h0000001' is not id-like (the office letter test is case-sensitive)
        # and no name contains it
        ("S0000002", "S0000002"): 1,          # id form
        ("smith", "S0000002"): 2, ("smith", "P0000003"): 2,   # 3-gram index path
        ("jo", "S0000002"): 1,                                 # short term: scan path
        ("o_n", "H0000004"): 2, ("o_n", "S0000002"): 2,        # '_' is a wildcard (JOHN)
    }
