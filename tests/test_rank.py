"""Cohort ranking: the percentile rule, zero-filled tags, floors, headline ties."""
import bisect
import random
from decimal import Decimal

from moneytrail.functions.ranking import count_strictly_below, global_row_number
from moneytrail.operators import rank


def base_frame(spark, rows):
    return spark.createDataFrame(
        [(c, c, "H", "NM", "01", "DEM", Decimal(i), Decimal(s), Decimal(sm), Decimal(p), Decimal(e))
         for c, i, s, sm, p, e in rows],
        "CAND_ID string, CAND_NAME string, CAND_OFFICE string, CAND_OFFICE_ST string, "
        "CAND_OFFICE_DISTRICT string, CAND_PTY_AFFILIATION string, indiv_total decimal(24,2), "
        "in_state decimal(24,2), small decimal(24,2), pac_total decimal(24,2), "
        "ie_support decimal(24,2)")


def cats_frame(spark, rows):
    return spark.createDataFrame([(c, t, Decimal(a)) for c, t, a in rows],
                                 "cand_id string, interest_category string, amount decimal(24,2)")


def test_percentile_is_strictly_below_over_n(spark):
    vals = [0.1, 0.2, 0.2, 0.5]
    df = spark.createDataFrame([(str(i), "s", v) for i, v in enumerate(vals)],
                               "id string, signal string, value double")
    got = {r.id: r.below for r in count_strictly_below(df, ["signal"], "value").collect()}
    assert got == {"0": 0, "1": 1, "2": 1, "3": 3}  # rank - 1, not percent_rank


def test_prefix_counts_match_windows(spark):
    rnd = random.Random(7)
    # values in, below and above the steps of the coarse key, and one value that a third of the rows share
    draw = [lambda: 0.25, rnd.random, lambda: rnd.uniform(-3, 3), lambda: float(rnd.randint(0, 40)), lambda: rnd.random() / 5000]
    rows = [(f"H{i:08d}", rnd.choice("ab"), draw[i % 5 if i % 3 else 0]()) for i in range(600)]
    df = spark.createDataFrame(rows, "id string, signal string, value double")
    below = {r.id: r.below for r in count_strictly_below(df, ["signal"], "value").collect()}
    for sig in "ab":
        vs = sorted(v for _, s, v in rows if s == sig)
        assert all(below[i] == bisect.bisect_left(vs, v) for i, s, v in rows if s == sig)
    rank_of = {r.id: r["rank"] for r in global_row_number(df, "value", "id").collect()}
    ordered = sorted(rows, key=lambda r: (-r[2], r[0]))
    assert [rank_of[r[0]] for r in ordered] == list(range(1, 601))


def reference_headlines(members, cats):
    """Straight restatement of the rule: dense tag matrix, bisect percentiles."""
    recs = []
    all_tags = sorted({t for _, t, _ in cats})
    for c, i, s, sm, p, e in members:
        i, s, sm, p, e = map(float, (i, s, sm, p, e))
        if i <= 0:
            continue
        raised, backing = i + p, i + p + e
        amt = {t: float(a) for cc, t, a in cats if cc == c}
        recs.append(dict(cid=c, sig={
            "out-of-state donors": (i - s) / i, "PAC-funded": p / raised if raised else 0.0,
            "outside-funded (IE)": e / backing if backing else 0.0,
            "few small-$ donors": 1 - sm / i},
            tags={t: amt.get(t, 0.0) / backing if backing else 0.0 for t in all_tags}))
    n = len(recs)

    def pct(values, v):
        return bisect.bisect_left(sorted(values), v) / n
    floors = {"out-of-state donors": .4, "PAC-funded": .3, "outside-funded (IE)": .3,
              "few small-$ donors": .9}
    out = {}
    for x in recs:
        cands = []
        for k in ["out-of-state donors", "PAC-funded", "outside-funded (IE)", "few small-$ donors"]:
            if x["sig"][k] >= floors[k]:
                cands.append((k, pct([y["sig"][k] for y in recs], x["sig"][k])))
        for t in all_tags:
            if x["tags"][t] >= .08:
                cands.append((t, pct([y["tags"][t] for y in recs], x["tags"][t])))
        out[x["cid"]] = max(cands, key=lambda z: z[1]) if cands else ("(balanced / no standout)", 0.0)
    return out


def test_headlines_match_restatement(spark):
    rnd = random.Random(3)
    members = []
    for k in range(40):
        i = rnd.randint(1, 100) * 1000
        members.append((f"H{k:03d}", i, rnd.randint(-10, i // 1000) * 1000, rnd.randint(0, i // 1000) * 1000,
                        rnd.randint(0, 50) * 1000, rnd.randint(0, 50) * 1000))
    cats = [(m[0], rnd.choice(["A", "B", "C"]), rnd.randint(-5, 40) * 1000)
            for m in members if rnd.random() < .5]
    cats = list({(c, t): (c, t, a) for c, t, a in cats}.values())
    cr = rank.CohortRanking(base_frame(spark, members), cats_frame(spark, cats))
    got = {r.cand_id: (r.headline, r.headline_pctile) for r in cr.headline.collect()}
    exp = reference_headlines(members, cats)
    assert got.keys() == exp.keys()
    for c in exp:
        assert got[c][1] == exp[c][1]
        assert got[c][0] == exp[c][0] or got[c][1] == exp[c][1]


def test_cohort_of_one_and_ties(spark):
    cr = rank.CohortRanking(base_frame(spark, [("H1", 100000, 0, 0, 0, 0)]),
                            cats_frame(spark, []))
    r = cr.ranking.collect()
    assert len(r) == 1 and r[0]["rank"] == 1
    # alone: every percentile is 0; out-of-state (1.0 >= .40) wins the tie by order
    assert r[0]["headline"] == "out-of-state donors" and r[0]["headline_pctile"] == 0.0


def test_no_standout(spark):
    cr = rank.CohortRanking(base_frame(spark, [("H1", 100000, 100000, 50000, 0, 0),
                                               ("H2", 100000, 100000, 60000, 0, 0)]),
                            cats_frame(spark, []))
    heads = {r.cand_id: r.headline for r in cr.headline.collect()}
    assert heads == {"H1": "(balanced / no standout)", "H2": "(balanced / no standout)"}


def test_empty_cohort(spark):
    cr = rank.CohortRanking(base_frame(spark, []), cats_frame(spark, []))
    assert cr.ranking.count() == 0 and cr.percentiles.count() == 0
