"""Regression figures of the test-table mapping at sf0.01."""
from decimal import Decimal

import __spark_entry__ as E

SF = "/root/testdata/sf0.01"


def test_channel_rows_and_sums(spark):
    got = {r.channel: (r.n, round(Decimal(r.amount), 2))
           for r in E.queries()["channel_counts"](spark, SF).collect()}
    assert got == {
        "individual": (43140, Decimal("60250286.28")),
        "direct_pac": (5696, Decimal("84402293.97")),
        "ie_support": (4913, Decimal("805006425.10")),
        "ie_oppose": (3310, Decimal("462938417.10")),
    }


def test_ie_raw_and_clean(spark):
    r = E.queries()["ie_raw_vs_clean"](spark, SF).first()
    assert round(Decimal(r.raw_amount), 2) == Decimal("3770284750.70")
    assert round(Decimal(r.clean_amount), 2) == Decimal("1222394279.70")


def test_cohort_headlines(spark):
    df = E.queries()["funding_headline_ranking"](spark, SF)
    counts = {r.headline: r["count"] for r in df.groupBy("headline").count().collect()}
    assert counts == {
        "few small-$ donors": 32, "out-of-state donors": 28, "PAC-funded": 9,
        "(balanced / no standout)": 8, "outside-funded (IE)": 7, "PROMO": 4, "SMALL": 4,
        "ECONOMY": 1, "LARGE": 1, "MEDIUM": 1, "SECOND TAG": 1,
    }
