"""Chart angles: the reference's own test figures, restated on DataFrames."""
from decimal import Decimal

from pyspark.sql import functions as F

from moneytrail.operators import angles


def buckets(spark, rows, cand="H1"):
    labels = {"1": "1 small  (<=$200)", "2": "2 mid    ($201-999)", "3": "3 large  ($1k-max)",
              "4": "4 max+   (>=$3500)", "5": "5 refund/negative"}
    return spark.createDataFrame([(cand, labels[b], n, Decimal(a)) for b, n, a in rows],
                                 "cand_id string, bucket string, n long, amount decimal(24,2)")


def test_refunds_excluded_and_shares_reconcile(spark):
    b = buckets(spark, [("1", 1000, 50000), ("2", 100, 40000), ("3", 50, 80000),
                        ("4", 10, 40000), ("5", 8, -30000)])
    rows = angles.angle_donor_size(b).collect()
    assert len(rows) == 4
    assert rows[0].denominator_amount == 210000.0 and rows[0].denominator_count == 1160
    assert abs(sum(r.share_of_individual for r in rows) - 1.0) < 1e-3
    assert rows[0].refund_amount == -30000.0 and rows[0].refund_count == 8


def test_below_floor_gives_reason(spark):
    b = buckets(spark, [("1", 5, 500)])
    assert angles.angle_donor_size(b).count() == 0
    facts = spark.createDataFrame([("H1", Decimal(500))], "cand_id string, ind decimal(24,2)")
    sk = {r.angle_id: r.reason for r in angles.angles_skipped(b, facts).collect()}
    assert sk["donor-size"] == "itemized gifts $500 / 5 below viability floor ($25,000 / 50)"
    assert sk["geography"] == "individual $500 below $25,000 floor"


def test_zero_dollar_is_silent(spark):
    b = buckets(spark, [("5", 3, -100)])
    facts = spark.createDataFrame([("H1", Decimal(0))], "cand_id string, ind decimal(24,2)")
    assert angles.angles_skipped(b, facts).count() == 0


def test_folder_names_and_display_name(spark):
    c = spark.createDataFrame(
        [("S1", "LUJAN, BEN RAY", "S", "NM", "00", "I", 2026, "DEM"),
         ("H1", "LEGER FERNANDEZ, TERESA", "H", "NM", "3", "I", None, "DEM"),
         ("P1", "SMITH, JOHN Q.", "P", "US", "00", "O", 2028, "REP")],
        "CAND_ID string, CAND_NAME string, CAND_OFFICE string, CAND_OFFICE_ST string, "
        "CAND_OFFICE_DISTRICT string, CAND_ICI string, CAND_ELECTION_YR int, "
        "CAND_PTY_AFFILIATION string")
    d = {r.cand_id: r.dirname for r in angles.canonical_dirname(c).collect()}
    assert d == {"S1": "nm-senate-lujan-ben-ray", "H1": "nm-house-03-leger-fernandez-teresa",
                 "P1": "us-president-smith-john-q"}
    cards = {r.cand_id: r for r in angles.candidate_card(c).collect()}
    assert cards["H1"].name == "Teresa Leger Fernandez"
    assert cards["H1"].region_note == "U.S. House NM-3" and cards["H1"].election_year == 0
    assert cards["S1"].region_note == "U.S. Senate, NM" and cards["S1"].incumbency == "Incumbent"


def test_donor_inversion_figures(spark):
    b = buckets(spark, [("1", 1268, 46604), ("2", 306, 114375), ("3", 183, 225336),
                        ("4", 75, 262500)])
    rows = {r.tier_order: r for r in angles.donor_inversion(angles.angle_donor_size(b)).collect()}
    assert sum(r["count"] for r in rows.values()) == 1832
    assert round(100 * rows[1].money_share, 1) == 7.2
    assert round(100 * rows[4].money_share, 1) == 40.5
    assert round(rows[1].maxout_to_small_ratio, 1) == round(262500 / 46604, 1)


def test_geography_shares(spark):
    facts = spark.createDataFrame(
        [("H1", "X", "NM", Decimal(860692), 100, Decimal(358792))],
        "cand_id string, CAND_NAME string, CAND_OFFICE_ST string, ind decimal(24,2), "
        "ind_count long, instate decimal(24,2)")
    top = spark.createDataFrame(
        [("H1", "NM", Decimal(358792), 40, 1), ("H1", "CA", Decimal(233460), 30, 2),
         ("H1", "DC", Decimal(153555), 20, 3), ("H1", "NY", Decimal(114885), 10, 4)],
        "cand_id string, donor_state string, amount decimal(24,2), n long, rank int")
    g = angles.angle_geography(facts, top).orderBy("row_order").collect()
    assert [r.label for r in g] == ["New Mexico (home)", "California", "Washington, D.C.",
                                    "New York"]
    assert g[0].in_state_share == 0.4169 and g[0].out_of_state_share == 0.5831
    assert g[0].featured is True
