"""Profile metrics (M1-M16) for every candidate at once.

The reference runs its report queries for one candidate and divides in
Python. Here one aggregation over ``candidate_money`` (joined to the broadcast
home state) yields every per-candidate total; shares are double divisions of
the exact decimal sums, written in the same order as the reference's float
arithmetic so the numbers are identical.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.functions.constants import HHI_CONCENTRATED, HHI_MODERATE
from moneytrail.operators.views import POSITIVE_BUCKETS, as_rollup
from moneytrail.plans.joins import join_small

DBL = T.DoubleType()


def dbl(c) -> Column:
    c = F.col(c) if isinstance(c, str) else c
    return c.cast(DBL)


def ratio(part: Column, whole: Column, otherwise=0.0) -> Column:
    """``part / whole`` in double, ``otherwise`` when the whole is 0."""
    return F.when(whole != 0, part / whole).otherwise(
        F.lit(otherwise).cast(DBL) if otherwise is not None else F.lit(None).cast(DBL))


def _sum_if(cond: Column) -> Column:
    return F.sum(F.when(cond, F.col("amount")))


def candidate_facts(money: DataFrame, candidates: DataFrame) -> DataFrame:
    """All per-candidate totals in one pass: channel sums and counts, in-state,
    small (bucket 1) and max+ (bucket 4) individual sums. One row per
    candidate of the dimension (zeros when no money)."""
    home = candidates.select(F.col("CAND_ID").alias("_cid"),
                             F.col("CAND_OFFICE_ST").alias("_home"))
    ch = F.col("channel")
    amt = F.col("amount")
    ind = ch == "individual"
    bucket = F.col("size_bucket")
    rows = F.col("n_rows")
    agg = join_small(as_rollup(money), home, F.col("cand_id") == F.col("_cid"), "left").groupBy(
        F.col("cand_id").alias("_fid")).agg(
        _sum_if(ind).alias("ind"),
        F.sum(F.when(ind, rows)).alias("ind_count"),
        _sum_if(ch == "direct_pac").alias("dpac_amt"),
        F.sum(F.when(ch == "direct_pac", rows)).alias("dpac_count"),
        _sum_if(ch == "ie_support").alias("ie_s"),
        _sum_if(ch == "ie_oppose").alias("ie_o"),
        _sum_if(ch.isin("individual", "direct_pac")).alias("raised"),
        _sum_if(ch != "ie_oppose").alias("backing"),
        _sum_if(ind & (F.col("donor_state") == F.col("_home"))).alias("instate"),
        _sum_if(ind & (bucket == "1")).alias("small_amt"),
        _sum_if(ind & (bucket == "4")).alias("maxplus_amt"),
        F.sum(F.when(ind & (bucket == "4"), rows)).alias("maxplus_count"),
    )
    c = candidates.select("CAND_ID", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST",
                          "CAND_OFFICE_DISTRICT", "CAND_PTY_AFFILIATION", "CAND_ICI",
                          "CAND_ELECTION_YR")
    # the aggregate is one row per candidate id: AQE measures it after the
    # shuffle and switches to a broadcast join when it is small
    j = c.join(agg, F.col("CAND_ID") == F.col("_fid"), "left").drop("_fid")
    zero = ["ind", "ind_count", "dpac_amt", "dpac_count", "ie_s", "ie_o", "raised",
            "backing", "instate", "small_amt", "maxplus_amt", "maxplus_count"]
    return j.select(F.col("CAND_ID").alias("cand_id"), *[x for x in c.columns if x != "CAND_ID"],
                    *[F.coalesce(F.col(z), F.lit(0)).alias(z) for z in zero])


# ------------------------------------------------------------------ M1, M2
GRAM = 3  # substring length of the name index


def _grams(text: Column, size: int) -> Column:
    """All substrings of ``size`` characters (empty for shorter text)."""
    return F.when(F.length(text) >= size, F.transform(
        F.sequence(F.lit(1), F.length(text) - size + 1),
        lambda i: F.substring(text, i, size))).otherwise(F.array().cast("array<string>"))


def _literal(term: Column) -> Column:
    """The longest part of a lower-cased term without ``%`` and ``_``."""
    parts = F.split(term, "[%_]+")
    return F.aggregate(parts, F.lit(""), lambda a, x: F.when(F.length(x) > F.length(a), x).otherwise(a))


def resolve_candidates(candidates: DataFrame, terms: DataFrame) -> DataFrame:
    """M1: resolve search terms. A term that looks like an id (H/S/P, a digit,
    at least 8 long) matches CAND_ID exactly (upper-cased); any other term is
    a case-insensitive substring of CAND_NAME (its ``%``/``_`` act as
    wildcards, as in the reference). Returns every (term, cand_id) match with
    the number of distinct candidates the term matched (> 1 = ambiguous).

    No term is paired with every name: ids are an equi-join on CAND_ID, and names
    are found through an index of their 1- to 3-grams. Each term is joined only to
    the names that hold the rarest gram of its longest literal part (3-grams when it
    is that long, else the part itself), then verified with ``ilike`` - exact, since
    every match holds all literal parts. A term of wildcards alone has the empty
    gram, which every name holds, as it may match every name.
    """
    t = terms.select(F.col("term")).filter(F.col("term").isNotNull()).distinct()
    looks_id = (F.substring("term", 1, 1).isin("H", "S", "P")
                & F.substring("term", 2, 1).rlike("^[0-9]$") & (F.length("term") >= 8))
    c = candidates.select("CAND_ID", "CAND_NAME").dropDuplicates(["CAND_ID"])

    by_id = t.filter(looks_id).join(c, F.col("CAND_ID") == F.upper(F.col("term")))

    name = F.lower("CAND_NAME")
    grams = F.concat(F.array(F.lit("")), *[_grams(name, n) for n in range(1, GRAM + 1)])
    name_grams = c.select("CAND_ID", F.explode(F.array_distinct(grams)).alias("gram"))
    freq = name_grams.groupBy("gram").agg(F.count(F.lit(1)).alias("_df"))
    part = F.col("_part")
    own = F.when(F.length(part) >= GRAM, _grams(part, GRAM)).otherwise(F.array(part))
    tg = (t.filter(~looks_id).withColumn("_part", _literal(F.lower("term")))
          .select("term", F.explode(own).alias("gram")).join(freq, "gram", "left"))
    rarest = tg.groupBy("term").agg(
        F.min_by("gram", F.struct(F.coalesce(F.col("_df"), F.lit(0)), F.col("gram"))).alias("gram"))
    by_name = (rarest.join(name_grams, "gram").join(c, "CAND_ID")
               .filter(F.ilike(F.col("CAND_NAME"), F.concat(F.lit("%"), F.col("term"), F.lit("%")))))

    m = (by_id.select("term", "CAND_ID", "CAND_NAME")
         .unionByName(by_name.select("term", "CAND_ID", "CAND_NAME")))
    n = m.groupBy(F.col("term").alias("_t")).agg(F.count(F.lit(1)).alias("n_matches"))
    return (m.join(n, F.col("term") == F.col("_t")).drop("_t")
            .select("term", F.col("CAND_ID").alias("cand_id"), "CAND_NAME", "n_matches"))


def committee_count(links: DataFrame, candidates: DataFrame) -> DataFrame:
    """M2: attributable committees per candidate (0 -> no profile, no export)."""
    n = links.groupBy(F.col("CAND_ID").alias("_cid")).agg(F.count(F.lit(1)).alias("n_committees"))
    c = candidates.select(F.col("CAND_ID").alias("cand_id")).distinct()
    return (c.join(n, F.col("cand_id") == F.col("_cid"), "left")
            .select("cand_id", F.coalesce(F.col("n_committees"), F.lit(0)).alias("n_committees")))


# ------------------------------------------------------------------ M3-M9, M13
def profile_shares(facts: DataFrame) -> DataFrame:
    """M3-M9 and M13 as columns of one row per candidate."""
    return facts.select("cand_id", *share_columns())


def share_columns() -> list[Column]:
    """The share columns of M3-M9 and M13 over a facts row."""
    ind, instate = dbl("ind"), dbl("instate")
    small_amt, maxplus = dbl("small_amt"), dbl("maxplus_amt")
    raised, backing = dbl("raised"), dbl("backing")
    dpac, ie_s = dbl("dpac_amt"), dbl("ie_s")
    return [
        F.col("instate").alias("in_state_amount"),
        ratio(ind - instate, ind).alias("out_of_state_share"),
        ratio(small_amt, ind).alias("small_dollar_share"),
        F.when(ind != 0, F.lit(1.0) - small_amt / ind).otherwise(F.lit(0.0))
         .alias("low_small_share"),
        ratio(maxplus, ind).alias("maxplus_share"),
        ratio(dpac, raised).alias("pac_share"),
        ratio(ie_s, backing).alias("outside_share"),
        # Composition of raised and of backing (None = n/a)
        ratio(ind, raised, None).alias("individual_of_raised"),
        ratio(dpac, raised, None).alias("direct_pac_of_raised"),
        ratio(raised, backing, None).alias("raised_of_backing"),
        ratio(ie_s, backing, None).alias("ie_support_of_backing"),
    ]


def in_state_amount(facts: DataFrame) -> DataFrame:
    """M3: individual money whose donor state equals the home state."""
    return facts.select("cand_id", F.col("instate").alias("in_state_amount"))


def channel_composition(facts: DataFrame) -> DataFrame:
    """Shares of raised (individual, direct PAC) and of backing (raised,
    IE support); NULL where the whole is zero (printed as n/a)."""
    p = profile_shares(facts)
    return p.select("cand_id", "individual_of_raised", "direct_pac_of_raised",
                    "raised_of_backing", "ie_support_of_backing")


# ------------------------------------------------------------------ M10, M14, M15
def interest_share(blocs: DataFrame, facts: DataFrame) -> DataFrame:
    """Per (candidate, tag): (direct PAC + IE support) / total backing."""
    f = facts.select(F.col("cand_id").alias("_cid"), "backing")
    j = blocs.join(f, F.col("cand_id") == F.col("_cid")).drop("_cid")
    total = dbl("direct_pac_amount") + dbl("ie_support_amount")
    return j.select("cand_id", "interest_category", "direct_pac_amount", "ie_support_amount",
                    total.alias("total"),
                    ratio(total, dbl("backing"), None).alias("share_of_backing"))


def bucket_shares(buckets: DataFrame, facts: DataFrame) -> DataFrame:
    """Bucket amount / net individual money (n/a when it is zero)."""
    f = facts.select(F.col("cand_id").alias("_cid"), "ind")
    j = buckets.join(f, F.col("cand_id") == F.col("_cid")).drop("_cid")
    return j.select("cand_id", "bucket", "n", "amount",
                    ratio(dbl("amount"), dbl("ind"), None).alias("share"))


def state_shares(top_states: DataFrame, facts: DataFrame) -> DataFrame:
    """Top-state amount / individual money, with the home-state flag."""
    f = facts.select(F.col("cand_id").alias("_cid"), "ind", F.col("CAND_OFFICE_ST").alias("_home"))
    j = top_states.join(f, F.col("cand_id") == F.col("_cid"))
    return j.select("cand_id", "donor_state", "amount", "n", "rank",
                    ratio(dbl("amount"), dbl("ind"), None).alias("share"),
                    F.coalesce(F.col("donor_state") == F.col("_home"), F.lit(False)).alias("is_home"))


# ------------------------------------------------------------------ M11, M12
def oos_pool(oos_states: DataFrame) -> DataFrame:
    """M11 + M12: out-of-state pool per candidate: total, number of states, the
    largest state and its share, and the HHI of state shares with its label.

    The HHI is sum(a^2) / (sum a)^2 with the squares summed exactly in decimal
    and divided once in double (rounded to 12 decimals)."""
    x = F.col("amount").cast(T.DecimalType(18, 2))
    # the largest state (amount desc, then state asc) in the same pass: the
    # struct (-amount, state) is smallest for it
    top = F.min_by(F.struct(F.col("donor_state"), F.col("amount")),
                   F.struct(-F.col("amount"), F.col("donor_state")))
    j = oos_states.groupBy("cand_id").agg(
        F.sum("amount").alias("oos_total"),
        F.count(F.lit(1)).alias("n_states"),
        F.sum(x * x).alias("_sq"),
        top.alias("_top")).select("*", F.col("_top.donor_state").alias("top_state"),
                                  F.col("_top.amount").alias("top_amount")).drop("_top")
    total = dbl("oos_total")
    hhi = F.when(total != 0, F.round(dbl("_sq") / (total * total), 12)).otherwise(F.lit(0.0))
    return j.select(
        "cand_id", "oos_total", "n_states", "top_state", "top_amount",
        ratio(dbl("top_amount"), total, None).alias("top_share"),
        hhi.alias("hhi"),
        F.when(hhi > HHI_CONCENTRATED, "concentrated").when(hhi > HHI_MODERATE, "moderate")
         .otherwise("diffuse").alias("hhi_label"))


# ------------------------------------------------------------------ M16
_FACTS = ["ind", "ind_count", "dpac_amt", "dpac_count", "ie_s", "ie_o", "raised", "backing",
          "small_amt", "maxplus_amt", "maxplus_count"]


def _dollars(cents: str) -> Column:
    return (F.col(cents).cast(T.DecimalType(20, 0)) * F.lit(0.01).cast(T.DecimalType(3, 2))).cast(T.DecimalType(24, 2))


def facts_with_pool(money: DataFrame, candidates: DataFrame) -> DataFrame:
    """The facts and the out-of-state pool of every candidate, from one pass over the
    money: summed per candidate and donor state first (pre-aggregated, so a candidate
    with a third of all gifts is a few rows a task), then per candidate, where the
    home state tells in-state from out-of-state sums."""
    ch, amt, rows, bucket = F.col("channel"), F.col("amount"), F.col("n_rows"), F.col("size_bucket")
    ind = ch == "individual"
    # whole cents add up exactly as longs, several times faster than wide decimals
    cents = as_rollup(money).withColumn("amount", (amt * 100).cast("bigint"))
    states = cents.groupBy(F.col("cand_id").alias("_cid"), "donor_state").agg(
        _sum_if(ind).alias("ind"),
        F.sum(F.when(ind, rows)).alias("ind_count"),
        _sum_if(ch == "direct_pac").alias("dpac_amt"),
        F.sum(F.when(ch == "direct_pac", rows)).alias("dpac_count"),
        _sum_if(ch == "ie_support").alias("ie_s"),
        _sum_if(ch == "ie_oppose").alias("ie_o"),
        _sum_if(ch.isin("individual", "direct_pac")).alias("raised"),
        _sum_if(ch != "ie_oppose").alias("backing"),
        _sum_if(ind & (bucket == "1")).alias("small_amt"),
        _sum_if(ind & (bucket == "4")).alias("maxplus_amt"),
        F.sum(F.when(ind & (bucket == "4"), rows)).alias("maxplus_count"),
        F.sum(F.when(ind & bucket.isin(*POSITIVE_BUCKETS), amt)).alias("_pos"))
    who = ["CAND_ID", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST", "CAND_OFFICE_DISTRICT",
           "CAND_PTY_AFFILIATION", "CAND_ICI", "CAND_ELECTION_YR"]
    j = candidates.select(*who).join(states, F.col("CAND_ID") == F.col("_cid"), "left")
    state, home = F.col("donor_state"), F.col("CAND_OFFICE_ST")
    away = F.when((state != home) & F.col("_pos").isNotNull(), F.col("_pos"))
    exact = away.cast(T.DecimalType(18, 0))
    top = F.min_by(F.struct(state.alias("s"), away.alias("a")),
                   F.when(away.isNotNull(), F.struct(-away, state)))
    agg = j.groupBy(*who).agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in _FACTS],
        F.coalesce(F.sum(F.when(state == home, F.col("ind"))), F.lit(0)).alias("instate"),
        F.sum(away).alias("oos_total"), F.count(away).alias("n_states"),
        F.sum(exact * exact).alias("_sq"), top.alias("_top"))
    total = _dollars("oos_total").cast(DBL)
    squares = (F.col("_sq").cast(T.DecimalType(33, 0)) * F.lit(0.0001).cast(T.DecimalType(4, 4))).cast(DBL)
    hhi = F.when(total != 0, F.round(squares / (total * total), 12)).otherwise(F.lit(0.0))
    facts = [F.col(c) if c.endswith("_count") else _dollars(c).alias(c) for c in _FACTS]
    return agg.select(
        F.col("CAND_ID").alias("cand_id"), *who[1:], *facts, _dollars("instate").alias("instate"),
        _dollars("oos_total").alias("oos_total"), "n_states",
        F.col("_top.s").alias("top_state"),
        F.when(total.isNotNull(), ratio(_dollars("_top.a").cast(DBL), total, None)).alias("top_share"),
        hhi.alias("hhi"),
        F.when(hhi > HHI_CONCENTRATED, "concentrated").when(hhi > HHI_MODERATE, "moderate")
         .otherwise("diffuse").alias("hhi_label"))


def candidate_profile(pool: DataFrame, links: DataFrame) -> DataFrame:
    """M16 (flat): one row per candidate with at least one attributable
    committee: totals, shares and the out-of-state pool summary (``pool``: see
    ``facts_with_pool``)."""
    n = links.groupBy(F.col("CAND_ID").alias("_nid")).agg(F.count(F.lit(1)).alias("n_committees"))
    p = (pool.select("*", *[c for c in share_columns()])
         .join(n, F.col("cand_id") == F.col("_nid")))
    return p.select(
        "cand_id", "CAND_NAME", "CAND_OFFICE", "CAND_OFFICE_ST", "CAND_OFFICE_DISTRICT",
        "CAND_PTY_AFFILIATION", "n_committees",
        "ind", "ind_count", "dpac_amt", "dpac_count", "ie_s", "ie_o", "raised", "backing",
        "instate", "small_amt", "maxplus_amt",
        "out_of_state_share", "small_dollar_share", "low_small_share", "maxplus_share",
        "pac_share", "outside_share",
        F.coalesce(F.col("oos_total"), F.lit(0).cast(T.DecimalType(24, 2))).alias("oos_total"),
        F.coalesce(F.col("n_states"), F.lit(0).cast("long")).alias("n_oos_states"),
        "top_state", "top_share",
        F.coalesce(F.col("hhi"), F.lit(0.0)).alias("hhi"),
        F.coalesce(F.col("hhi_label"), F.lit("diffuse")).alias("hhi_label"))


def candidate_profile_nested(pool: DataFrame, top_states: DataFrame, buckets: DataFrame,
                             blocs: DataFrame, top_pacs: DataFrame, top_ie: DataFrame,
                             links: DataFrame) -> DataFrame:
    """M16 (nested): the flat profile plus arrays of the small per-candidate
    lists (top states, buckets, blocs, top givers and spenders). Arrays are
    built only from already-limited rows (top-N or one row per bucket/tag)."""
    flat = candidate_profile(pool, links)

    def arr(df, name, order_cols, fields):
        return (df.groupBy(F.col("cand_id").alias("_k"))
                .agg(F.sort_array(F.collect_list(F.struct(*order_cols, *fields))).alias(name)))

    parts = [
        arr(top_states, "states", [F.col("rank")], ["donor_state", "amount", "n"]),
        arr(buckets, "buckets", [F.col("bucket")], ["n", "amount"]),
        arr(blocs, "blocs", [F.col("interest_category")],
            ["direct_pac_amount", "ie_support_amount"]),
        arr(top_pacs, "top_pacs", [F.col("rank")], ["CMTE_NM", "CMTE_TP", "amount", "n"]),
        arr(top_ie, "top_ie", [F.col("rank")], ["SPENDER_NAME", "SUPPORT_OPPOSE", "amount"]),
    ]
    out = flat
    for p in parts:
        out = out.join(p, F.col("cand_id") == F.col("_k"), "left").drop("_k")
    return out

