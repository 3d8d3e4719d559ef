"""Chart-ready angles (X1-X8) for every candidate at once.

Inputs are the per-candidate reports (buckets, top states) and totals; every
candidate contributes at most 5 bucket rows and 9 state rows, so the nested
documents are built with ``collect_list`` only after those limits. Text fields
are ``format_string`` renderings of the fixed templates in
:mod:`moneytrail.functions.constants` with values formatted like the reference.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.functions import constants as K
from moneytrail.functions.text import (display_name, lookup, money, pct1, r4, slug,
                                       zfill2)

DBL = T.DoubleType()
DEC = T.DecimalType(24, 2)


def _d(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast(DBL)


def _fmt(template: str, *args) -> Column:
    return F.format_string(template, *args)


# ------------------------------------------------------------------ X5, X6
def candidate_card(candidates: DataFrame, region_note: str | None = None) -> DataFrame:
    """The candidate block of a document."""
    office = F.col("CAND_OFFICE")
    label = F.coalesce(lookup(K.OFFICE_LABEL, office), office)
    default_note = F.when(office == "H", F.concat(label, F.lit(" "), F.col("CAND_OFFICE_ST"),
                                                  F.lit("-"), F.col("CAND_OFFICE_DISTRICT"))
                          ).otherwise(F.concat(label, F.lit(", "), F.col("CAND_OFFICE_ST")))
    return candidates.select(
        F.col("CAND_ID").alias("cand_id"),
        display_name(F.col("CAND_NAME")).alias("name"),
        F.col("CAND_NAME").alias("name_fec"),
        F.col("CAND_PTY_AFFILIATION").alias("party"),
        label.alias("office"),
        F.col("CAND_OFFICE_ST").alias("state"),
        F.col("CAND_OFFICE_DISTRICT").alias("district"),
        F.coalesce(lookup(K.ICI_LABEL, F.col("CAND_ICI")), F.col("CAND_ICI")).alias("incumbency"),
        F.coalesce(F.col("CAND_ELECTION_YR"), F.lit(0)).alias("election_year"),
        (F.lit(region_note) if region_note is not None else default_note).alias("region_note"))


def canonical_dirname(candidates: DataFrame) -> DataFrame:
    """``<st>-<chamber>[-<dd> for House]-<name slug>``."""
    office = F.col("CAND_OFFICE")
    chamber = F.coalesce(lookup(K.OFFICE_SLUG, office), F.lower(office))
    d = F.when(office == "H", zfill2(F.col("CAND_OFFICE_DISTRICT")))
    return candidates.select(
        F.col("CAND_ID").alias("cand_id"),
        F.concat_ws("-", F.lower(F.col("CAND_OFFICE_ST")), chamber, d,
                    slug(F.col("CAND_NAME"))).alias("dirname"))


# ------------------------------------------------------------------ X1
def _bucket_code(c="bucket") -> Column:
    return F.substring(F.col(c), 1, 1)


def donor_size_summary(buckets: DataFrame) -> DataFrame:
    """Per candidate: the positive-gift universe (buckets 1-4 with a positive
    sum), bucket 1/4 amounts, refunds, the small-gift share and the verdict."""
    code = _bucket_code()
    pos = (code != "5") & (F.col("amount") > 0)
    w = buckets.groupBy("cand_id").agg(
        F.sum(F.when(pos, F.col("amount"))).alias("pos_amt"),
        F.sum(F.when(pos, F.col("n"))).alias("pos_n"),
        F.sum(F.when(code == "1", F.col("amount"))).alias("small_amt"),
        F.sum(F.when(code == "4", F.col("amount"))).alias("mp_amt"),
        F.sum(F.when(code == "5", F.col("amount"))).alias("refund_amt"),
        F.sum(F.when(code == "5", F.col("n"))).alias("refund_n"),
        F.count(F.when(pos, 1)).alias("n_rows"))
    w = w.select("cand_id", "n_rows",
                 F.coalesce("pos_amt", F.lit(0).cast(DEC)).alias("pos_amt"),
                 F.coalesce("pos_n", F.lit(0).cast("long")).alias("pos_n"),
                 F.coalesce("small_amt", F.lit(0).cast(DEC)).alias("small_amt"),
                 F.coalesce("mp_amt", F.lit(0).cast(DEC)).alias("mp_amt"),
                 F.coalesce("refund_amt", F.lit(0).cast(DEC)).alias("refund_amt"),
                 F.coalesce("refund_n", F.lit(0).cast("long")).alias("refund_n"))
    emitted = (F.col("pos_amt") >= K.MIN_INDIVIDUAL) & (F.col("pos_n") >= K.MIN_DONORS)
    ss = F.when(emitted, _d("small_amt") / _d("pos_amt"))
    mp = F.when(emitted, _d("mp_amt") / _d("pos_amt"))
    return w.select("*", emitted.alias("emitted"), ss.alias("ss"), mp.alias("mp_share"),
                    F.when(emitted, (F.lit(1.0) - ss) >= K.FLOOR_LOW_SMALL).alias("featured"))


def angle_donor_size(buckets: DataFrame) -> DataFrame:
    """X1 (flat): one row per chart row of every emitted donor-size angle."""
    s = donor_size_summary(buckets).filter("emitted")
    code = _bucket_code()
    rows = buckets.filter((code != "5") & (F.col("amount") > 0))
    j = rows.join(s.withColumnRenamed("cand_id", "_sid"), F.col("cand_id") == F.col("_sid"))
    return j.select(
        "cand_id",
        F.lit(K.ANGLE_DONOR_SIZE).alias("angle_id"),
        F.lit(K.DONOR_SIZE_METRIC).alias("metric"),
        r4(F.col("ss")).alias("metric_value"),
        "featured",
        F.coalesce(lookup(K.BUCKET_LABEL, code), F.col("bucket")).alias("bucket"),
        _d("amount").alias("amount"),
        F.col("n").alias("count"),
        r4(_d("amount") / _d("pos_amt")).alias("share_of_individual"),
        _d("pos_amt").alias("denominator_amount"),
        F.col("pos_n").alias("denominator_count"),
        _d("refund_amt").alias("refund_amount"),
        F.col("refund_n").alias("refund_count"))


# ------------------------------------------------------------------ X2
def geography_summary(facts: DataFrame, top_states: DataFrame) -> DataFrame:
    """Per candidate with individual money >= the floor: out-of-state share,
    featured flag, and the remainder outside the top states."""
    t = top_states.groupBy(F.col("cand_id").alias("_tid")).agg(
        F.sum("amount").alias("top_amt"), F.sum("n").alias("top_n"),
        F.count(F.lit(1)).alias("n_top"))
    f = facts.filter(F.col("ind") >= K.MIN_INDIVIDUAL)
    j = f.join(t, F.col("cand_id") == F.col("_tid"), "left")
    ind = _d("ind")
    oos = (ind - _d("instate")) / ind
    rem = F.col("ind") - F.coalesce(F.col("top_amt"), F.lit(0))
    return j.select(
        "cand_id", "CAND_NAME", F.col("CAND_OFFICE_ST").alias("home"), "ind", "ind_count",
        "instate", oos.alias("oos"), (oos >= K.FLOOR_OUT_OF_STATE).alias("featured"),
        rem.alias("rem"),
        (F.col("ind_count") - F.coalesce(F.col("top_n"), F.lit(0))).alias("rem_n"),
        F.coalesce(F.col("n_top"), F.lit(0)).alias("n_top"))


def angle_geography(facts: DataFrame, top_states: DataFrame) -> DataFrame:
    """X2 (flat): top states (with display label, share, home flag) plus an
    'Other states' row when the remainder exceeds 0.5."""
    g = geography_summary(facts, top_states)
    gs = g.withColumnRenamed("cand_id", "_gid")
    st = F.col("donor_state")
    name = F.coalesce(lookup(K.STATE_NAMES, st), st, F.lit("?"))
    is_home = F.coalesce(st == F.col("home"), F.lit(False))
    states = top_states.join(gs, F.col("cand_id") == F.col("_gid")).select(
        "cand_id", F.col("rank").alias("row_order"), st.alias("state"),
        F.when(is_home, F.concat(name, F.lit(K.GEOGRAPHY_HOME_SUFFIX))).otherwise(name)
         .alias("label"),
        _d("amount").alias("amount"), F.col("n").alias("count"),
        r4(_d("amount") / _d("ind")).alias("share_of_individual"),
        is_home.alias("in_state"),
        "oos", "featured", "ind", "instate")
    other = g.filter(_d("rem") > 0.5).select(
        "cand_id", F.lit(99).cast("long").alias("row_order"),
        F.lit(None).cast("string").alias("state"), F.lit(K.GEOGRAPHY_OTHER).alias("label"),
        _d("rem").alias("amount"), F.col("rem_n").alias("count"),
        r4(_d("rem") / _d("ind")).alias("share_of_individual"),
        F.lit(False).alias("in_state"), "oos", "featured", "ind", "instate")
    rows = states.unionByName(other)
    return rows.select(
        "cand_id", F.lit(K.ANGLE_GEOGRAPHY).alias("angle_id"),
        F.lit(K.GEOGRAPHY_METRIC).alias("metric"), r4(F.col("oos")).alias("metric_value"),
        "featured", "row_order", "state", "label", "amount", "count", "share_of_individual",
        "in_state", _d("ind").alias("denominator_amount"), _d("instate").alias("in_state_amount"),
        r4(F.lit(1.0) - F.col("oos")).alias("in_state_share"),
        (_d("ind") - _d("instate")).alias("out_of_state_amount"),
        r4(F.col("oos")).alias("out_of_state_share"))


# ------------------------------------------------------------------ X3
def angles_skipped(buckets: DataFrame, facts: DataFrame) -> DataFrame:
    """Angles not emitted although the channel has money, with the reason
    (a zero channel is silently skipped)."""
    ds = donor_size_summary(buckets).filter(~F.col("emitted") & (F.col("pos_amt") > 0))
    a = ds.select("cand_id", F.lit(K.ANGLE_DONOR_SIZE).alias("angle_id"),
                  _fmt(K.DONOR_SIZE_SKIP, money("pos_amt"), F.col("pos_n").cast("string"))
                  .alias("reason"))
    g = facts.filter((F.col("ind") > 0) & (F.col("ind") < K.MIN_INDIVIDUAL)).select(
        "cand_id", F.lit(K.ANGLE_GEOGRAPHY).alias("angle_id"),
        _fmt(K.GEOGRAPHY_SKIP, money("ind")).alias("reason"))
    return a.unionByName(g)


# ------------------------------------------------------------------ X4
def angle_documents(buckets: DataFrame, facts: DataFrame, top_states: DataFrame,
                    cards: DataFrame) -> DataFrame:
    """X4 (flat): one row per emitted angle document: angle block, texts,
    denominator and footnote count."""
    floor_small = pct1(F.lit(1.0 - K.FLOOR_LOW_SMALL))
    floor_oos = pct1(F.lit(K.FLOOR_OUT_OF_STATE))
    names = cards.select(F.col("cand_id").alias("_cid"), F.col("name").alias("_name"))

    ds = donor_size_summary(buckets).filter("emitted").join(
        names, F.col("cand_id") == F.col("_cid"), "left")
    ss, mp = F.col("ss"), F.col("mp_share")
    d1 = ds.select(
        "cand_id", F.lit(K.ANGLE_DONOR_SIZE).alias("angle_id"),
        F.lit(K.DONOR_SIZE_TITLE).alias("title"),
        F.when(F.col("featured"), _fmt(K.DONOR_SIZE_REASON_FEATURED, money("mp_amt"), pct1(mp),
                                       pct1(ss), floor_small))
         .otherwise(_fmt(K.DONOR_SIZE_REASON_CONTEXT, pct1(ss))).alias("reason"),
        F.lit(K.DONOR_SIZE_METRIC).alias("metric"), r4(ss).alias("metric_value"),
        _fmt(K.DONOR_SIZE_THRESHOLD, floor_small, pct1(ss)).alias("threshold"),
        "featured",
        F.when(F.col("featured"), _fmt(K.DONOR_SIZE_HEADLINE_FEATURED, pct1(ss), pct1(mp)))
         .otherwise(F.lit(K.DONOR_SIZE_HEADLINE_CONTEXT)).alias("headline"),
        _fmt(K.DONOR_SIZE_SUBHEAD, F.col("_name"), money("pos_amt")).alias("subhead"),
        F.lit(K.DONOR_SIZE_DENOMINATOR).alias("denominator_label"),
        _d("pos_amt").alias("denominator_amount"), F.col("pos_n").alias("denominator_count"),
        F.col("n_rows").cast("long").alias("n_rows"),
        (F.lit(len(K.DONOR_SIZE_NOTES)) + F.when(F.col("refund_amt") != 0, 1).otherwise(0))
         .alias("n_footnotes"),
        F.lit(K.DONOR_SIZE_SOURCE).alias("source"))

    g = geography_summary(facts, top_states).join(names, F.col("cand_id") == F.col("_cid"),
                                                  "left")
    oos = F.col("oos")
    home_name = F.coalesce(lookup(K.STATE_NAMES, F.col("home")), F.col("home"))
    d2 = g.select(
        "cand_id", F.lit(K.ANGLE_GEOGRAPHY).alias("angle_id"),
        F.lit(K.GEOGRAPHY_TITLE).alias("title"),
        F.when(F.col("featured"), _fmt(K.GEOGRAPHY_REASON_FEATURED, pct1(oos), F.col("home"),
                                       floor_oos))
         .otherwise(_fmt(K.GEOGRAPHY_REASON_CONTEXT, pct1(F.lit(1.0) - oos), F.col("home"),
                         pct1(oos), floor_oos)).alias("reason"),
        F.lit(K.GEOGRAPHY_METRIC).alias("metric"), r4(oos).alias("metric_value"),
        _fmt(K.GEOGRAPHY_THRESHOLD, floor_oos, pct1(oos)).alias("threshold"),
        "featured",
        F.when(F.col("featured"), _fmt(K.GEOGRAPHY_HEADLINE_FEATURED, pct1(oos)))
         .otherwise(_fmt(K.GEOGRAPHY_HEADLINE_CONTEXT, pct1(F.lit(1.0) - oos), home_name))
         .alias("headline"),
        _fmt(K.GEOGRAPHY_SUBHEAD, F.col("_name"), money("ind")).alias("subhead"),
        F.lit(K.GEOGRAPHY_DENOMINATOR).alias("denominator_label"),
        _d("ind").alias("denominator_amount"), F.col("ind_count").alias("denominator_count"),
        (F.col("n_top") + F.when(_d("rem") > 0.5, 1).otherwise(0)).cast("long").alias("n_rows"),
        F.lit(len(K.GEOGRAPHY_NOTES)).alias("n_footnotes"),
        F.lit(K.GEOGRAPHY_SOURCE).alias("source"))
    return d1.unionByName(d2)


def angle_documents_nested(buckets: DataFrame, facts: DataFrame, top_states: DataFrame,
                           cards: DataFrame) -> DataFrame:
    """X4 (nested): the full document per (candidate, angle): candidate,
    angle, headline, subhead, chart (denominator, rows, summary), footnotes,
    source -- the JSON layout of the export."""
    flat = angle_documents(buckets, facts, top_states, cards)
    card = cards.select(F.col("cand_id").alias("_kid"),
                        F.struct(*[F.col(c) for c in cards.columns]).alias("candidate"))
    ds_rows = (angle_donor_size(buckets).groupBy("cand_id", "angle_id").agg(
        F.sort_array(F.collect_list(F.struct(
            F.col("bucket").alias("bucket"), F.col("amount"), F.col("count"),
            F.col("share_of_individual")))).alias("rows")))
    geo = angle_geography(facts, top_states)
    geo_rows = geo.groupBy("cand_id", "angle_id").agg(
        F.transform(F.sort_array(F.collect_list(F.struct(
            F.col("row_order"), F.col("state"), F.col("label"), F.col("amount"),
            F.col("count"), F.col("share_of_individual"), F.col("in_state")))),
            lambda r: r.dropFields("row_order")).alias("rows"),
        F.first(F.struct(F.col("in_state_amount"), F.col("in_state_share"),
                         F.col("out_of_state_amount"), F.col("out_of_state_share"))
                ).alias("summary"))
    ds_rows = ds_rows.withColumn("rows", F.transform(
        "rows", lambda r: F.struct(r["bucket"], r["amount"], r["count"], r["share_of_individual"],
                                   F.lit(None).cast("string").alias("state"),
                                   F.lit(None).cast("string").alias("label"),
                                   F.lit(None).cast("boolean").alias("in_state"))))
    geo_rows = geo_rows.withColumn("rows", F.transform(
        "rows", lambda r: F.struct(F.lit(None).cast("string").alias("bucket"), r["amount"],
                                   r["count"], r["share_of_individual"], r["state"], r["label"],
                                   r["in_state"])))
    empty_summary = F.lit(None).cast(geo_rows.schema["summary"].dataType)
    rows = ds_rows.withColumn("summary", empty_summary).unionByName(geo_rows)
    notes_ds = F.array(*[F.lit(x) for x in K.DONOR_SIZE_NOTES])
    notes_geo = F.array(*[F.lit(x) for x in K.GEOGRAPHY_NOTES])
    facts_refund = donor_size_summary(buckets).select(
        F.col("cand_id").alias("_fid"), "refund_amt", "refund_n")
    j = (flat.join(rows.withColumnRenamed("cand_id", "_rc").withColumnRenamed("angle_id", "_ra"),
                   (F.col("cand_id") == F.col("_rc")) & (F.col("angle_id") == F.col("_ra")),
                   "left")
         .join(facts_refund, F.col("cand_id") == F.col("_fid"), "left")
         .join(card, F.col("cand_id") == F.col("_kid"), "left"))
    refund_note = F.when(
        (F.col("angle_id") == K.ANGLE_DONOR_SIZE) & (F.col("refund_amt") != 0),
        F.array(_fmt(K.DONOR_SIZE_REFUND_NOTE, money("refund_amt"),
                     F.col("refund_n").cast("string")))).otherwise(F.array().cast("array<string>"))
    notes = F.when(F.col("angle_id") == K.ANGLE_DONOR_SIZE, F.concat(notes_ds, refund_note)
                   ).otherwise(notes_geo)
    return j.select(
        "cand_id", "angle_id",
        "candidate",
        F.struct(F.col("angle_id").alias("id"), "title", "reason", "metric",
                 F.col("metric_value"), "threshold", "featured").alias("angle"),
        "headline", "subhead",
        F.struct(F.lit("bar").alias("type"), F.lit("USD").alias("unit"),
                 F.struct(F.col("denominator_label").alias("label"),
                          F.col("denominator_amount").alias("amount"),
                          F.col("denominator_count").alias("count")).alias("denominator"),
                 F.col("rows"), F.col("summary")).alias("chart"),
        notes.alias("footnotes"),
        "source")


# ------------------------------------------------------------------ X7, X8
def chart_reconciliation(donor_rows: DataFrame, geo_rows: DataFrame) -> DataFrame:
    """Per document, the chart rows' total against the denominator; ok
    when they agree within one dollar (geography can miss when the states
    outside the top list are net negative: no 'Other' row is added)."""
    a = donor_rows.select("cand_id", "angle_id", "amount", F.col("denominator_amount"))
    b = geo_rows.select("cand_id", "angle_id", "amount", "denominator_amount")
    r = a.unionByName(b).groupBy("cand_id", "angle_id").agg(
        F.sum(F.col("amount").cast(DEC)).cast(DBL).alias("rows_total"),
        F.first("denominator_amount").alias("denominator"))
    diff = F.col("rows_total") - F.col("denominator")
    return r.select("cand_id", "angle_id", "rows_total", "denominator",
                    F.bround(diff, 2).alias("diff"), (F.abs(diff) <= 1).alias("ok"))


def donor_inversion(donor_rows: DataFrame) -> DataFrame:
    """The numbers the donor-size chart derives: per tier the share of
    gifts and of dollars (a missing tier counts 0), and the max-out to small
    dollar ratio (0 when there is no small money)."""
    docs = donor_rows.groupBy("cand_id").agg(
        F.first("denominator_amount").alias("den_amt"),
        F.first("denominator_count").alias("den_n"),
        F.sum(F.when(F.col("bucket") == K.DONOR_TIERS[0], F.col("amount"))).alias("_small"),
        F.sum(F.when(F.col("bucket") == K.DONOR_TIERS[3], F.col("amount"))).alias("_max"))
    tiers = F.array(*[F.struct(F.lit(i).alias("tier_order"), F.lit(t).alias("tier"))
                      for i, t in enumerate(K.DONOR_TIERS, 1)])
    t = docs.select("*", F.explode(tiers).alias("_t")).select(
        "cand_id", "den_amt", "den_n", "_small", "_max", "_t.tier_order", "_t.tier")
    rows = donor_rows.select(F.col("cand_id").alias("_rc"), F.col("bucket").alias("_rb"),
                             F.col("amount").alias("_amt"), F.col("count").alias("_n"))
    j = t.join(rows, (F.col("cand_id") == F.col("_rc")) & (F.col("tier") == F.col("_rb")), "left")
    amt = F.coalesce(F.col("_amt"), F.lit(0.0))
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    small = F.coalesce(F.col("_small"), F.lit(0.0))
    return j.select(
        "cand_id", "tier_order", "tier", n.alias("count"), amt.alias("amount"),
        F.when(F.col("den_n") != 0, n.cast(DBL) / F.col("den_n").cast(DBL)).otherwise(0.0)
         .alias("gift_share"),
        F.when(F.col("den_amt") != 0, amt / F.col("den_amt")).otherwise(0.0).alias("money_share"),
        F.when(small != 0, F.coalesce(F.col("_max"), F.lit(0.0)) / small).otherwise(0.0)
         .alias("maxout_to_small_ratio"))

