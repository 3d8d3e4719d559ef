"""DuckDB oracle SQL for each registered query (same column names; decimals
leave as DOUBLE, like :func:`moneytrail.catalog.comparable`)."""

from __future__ import annotations

from moneytrail.functions import constants as K
from moneytrail.operators.quality import TABLE_DOCS
from moneytrail.oracle.prefix import PREFIX
from moneytrail.sources.schemas import RAW_COLUMNS

ORACLE: dict[str, str] = {}


def q(name: str, body: str) -> None:
    ORACLE[name] = PREFIX + "\n" + body


def d(x: str) -> str:
    """A decimal amount as DOUBLE, via DECIMAL(18,2) (exact conversion)."""
    return f"CAST(CAST({x} AS DECIMAL(18,2)) AS DOUBLE)"


# ------------------------------------------------------------------ curated (P)
q("dim_candidates", "SELECT * FROM dim_candidates")
q("dim_committees", "SELECT * FROM dim_committees")
q("bridge_candidate_committee", "SELECT * FROM bridge_candidate_committee")
q("fact_contributions", """
SELECT SUB_ID, SOURCE_CMTE_ID, TARGET_CAND_ID, CAST(CAST(AMOUNT AS DECIMAL(18,2)) AS DOUBLE) AS AMOUNT, TRANSACTION_DT,
       TRANSACTION_TP, ENTITY_TP, OTHER_ID, IMAGE_NUM, FILE_NUM, TRAN_ID
FROM fact_contributions""")
q("fact_individual_contributions", """
SELECT SUB_ID, TARGET_CMTE_ID, CONTRIBUTOR_NAME, CITY, STATE, ZIP_CODE, EMPLOYER, OCCUPATION,
       CAST(CAST(AMOUNT AS DECIMAL(18,2)) AS DOUBLE) AS AMOUNT, TRANSACTION_DT, TRANSACTION_TP, ENTITY_TP, OTHER_ID,
       IMAGE_NUM, FILE_NUM, TRAN_ID, MEMO_CD
FROM fact_individual_contributions""")
IE_COLS = """IE_ID, SPENDER_CMTE_ID, TARGET_CAND_ID, SUPPORT_OPPOSE, CAST(CAST(AMOUNT AS DECIMAL(18,2)) AS DOUBLE) AS AMOUNT,
       EXPENDITURE_DT, CAST(CAST(AGGREGATE_AMOUNT AS DECIMAL(18,2)) AS DOUBLE) AS AGGREGATE_AMOUNT, PURPOSE, PAYEE,
       SPENDER_NAME, TARGET_CAND_NAME, ELECTION_TYPE, DISSEMINATION_DT, IMAGE_NUM, FILE_NUM,
       TRAN_ID, AMNDT_IND, PREV_FILE_NUM"""
q("fact_independent_expenditures", f"SELECT {IE_COLS} FROM fact_independent_expenditures")

# ------------------------------------------------------------------ views (V)
q("candidate_committees", "SELECT * FROM v_links")
q("clean_individual", """
SELECT SUB_ID, TARGET_CMTE_ID, CONTRIBUTOR_NAME, CITY, STATE, ZIP_CODE, EMPLOYER, OCCUPATION,
       CAST(CAST(AMOUNT AS DECIMAL(18,2)) AS DOUBLE) AS AMOUNT, TRANSACTION_DT, TRANSACTION_TP, ENTITY_TP, OTHER_ID,
       IMAGE_NUM, FILE_NUM, TRAN_ID, MEMO_CD, MEMO_TEXT
FROM v_gifts""")
q("clean_ie", f"SELECT {IE_COLS} FROM v_ie")
MONEY_SEL = """SELECT cand_id, channel, CAST(CAST(amount AS DECIMAL(18,2)) AS DOUBLE) AS amount, donor_state,
       contributor_name, employer, interest_category FROM """
q("candidate_money", MONEY_SEL + "v_money")
q("money_individual", MONEY_SEL + "arm_ind")
q("money_direct_pac", MONEY_SEL + "arm_pac")
q("money_ie_support", MONEY_SEL + "arm_sup")
q("money_ie_oppose", MONEY_SEL + "arm_opp")

# ------------------------------------------------------------------ reports (Q)
TOTALS = """
, by_cand AS (
    SELECT cand_id,
        sum(CASE WHEN channel = 'individual' THEN amount END) AS s_ind,
        count(CASE WHEN channel = 'individual' THEN 1 END) AS c_ind,
        sum(CASE WHEN channel = 'direct_pac' THEN amount END) AS s_pac,
        count(CASE WHEN channel = 'direct_pac' THEN 1 END) AS c_pac,
        sum(CASE WHEN channel = 'ie_support' THEN amount END) AS s_sup,
        sum(CASE WHEN channel = 'ie_oppose' THEN amount END) AS s_opp
    FROM v_money GROUP BY cand_id
),
totals AS (
    -- every candidate of the dimension, zero when it has no money
    SELECT d.CAND_ID AS cand_id,
        coalesce(b.s_ind, 0) AS individual_amount, coalesce(b.c_ind, 0) AS individual_count,
        coalesce(b.s_pac, 0) AS direct_pac_amount, coalesce(b.c_pac, 0) AS direct_pac_count,
        coalesce(b.s_sup, 0) AS ie_support_amount, coalesce(b.s_opp, 0) AS ie_oppose_amount,
        coalesce(b.s_ind, 0) + coalesce(b.s_pac, 0) AS raised,
        coalesce(b.s_ind, 0) + coalesce(b.s_pac, 0) + coalesce(b.s_sup, 0) AS total_backing
    FROM (SELECT CAND_ID FROM dim_candidates GROUP BY CAND_ID) d
    LEFT OUTER JOIN by_cand b ON b.cand_id = d.CAND_ID
)
"""
q("candidate_totals", TOTALS + f"""
SELECT cand_id, {d('individual_amount')} AS individual_amount, individual_count,
       {d('direct_pac_amount')} AS direct_pac_amount, direct_pac_count,
       {d('ie_support_amount')} AS ie_support_amount, {d('ie_oppose_amount')} AS ie_oppose_amount,
       {d('raised')} AS raised, {d('total_backing')} AS total_backing
FROM totals""")

BUCKETS = """
, gifts_sized AS (
    SELECT cand_id, amount,
        CASE WHEN amount < 0 THEN 5 WHEN amount <= 200 THEN 1 WHEN amount <= 999 THEN 2
             WHEN amount < 3500 THEN 3 ELSE 4 END AS code
    FROM v_money
    WHERE channel = 'individual' AND (amount > 0 OR amount < 0)
),
buckets AS (
    SELECT cand_id,
        CASE code WHEN 1 THEN '1 small  (<=$200)' WHEN 2 THEN '2 mid    ($201-999)'
                  WHEN 3 THEN '3 large  ($1k-max)' WHEN 4 THEN '4 max+   (>=$3500)'
                  ELSE '5 refund/negative' END AS bucket,
        count(*) AS n, sum(amount) AS amount
    FROM gifts_sized GROUP BY cand_id, code
)
"""
q("candidate_buckets", BUCKETS + f"SELECT cand_id, bucket, n, {d('amount')} AS amount FROM buckets")

TOP_STATES = """
, state_sums AS (
    SELECT cand_id, donor_state, sum(amount) AS amount, count(*) AS n
    FROM v_money WHERE channel = 'individual'
    GROUP BY cand_id, donor_state
),
top_states AS (
    SELECT *, row_number() OVER (PARTITION BY cand_id
                                 ORDER BY amount DESC NULLS LAST, donor_state ASC NULLS LAST) AS rank
    FROM state_sums
    QUALIFY rank <= 8
)
"""
q("candidate_top_states", TOP_STATES + f"""
SELECT cand_id, donor_state, {d('amount')} AS amount, n, rank FROM top_states""")

OOS = """
, oos AS (
    SELECT m.cand_id, m.donor_state, sum(m.amount) AS amount
    FROM v_money m, dim_candidates c
    WHERE c.CAND_ID = m.cand_id AND m.channel = 'individual' AND m.amount > 0
      AND m.donor_state <> c.CAND_OFFICE_ST
    GROUP BY m.cand_id, m.donor_state
)
"""
q("candidate_oos_states", OOS + f"SELECT cand_id, donor_state, {d('amount')} AS amount FROM oos")

BLOCS = """
, tagged_sums AS (
    SELECT cand_id, interest_category,
        sum(CASE WHEN channel = 'direct_pac' THEN amount END) AS p,
        sum(CASE WHEN channel = 'ie_support' THEN amount END) AS s,
        sum(amount) AS t
    FROM v_money
    WHERE interest_category IS NOT NULL AND channel IN ('ie_support', 'direct_pac')
    GROUP BY cand_id, interest_category
),
blocs AS (
    SELECT cand_id, interest_category, coalesce(p, 0) AS direct_pac_amount,
           coalesce(s, 0) AS ie_support_amount
    FROM tagged_sums WHERE coalesce(t, 0) <> 0
)
"""
q("candidate_interest_blocs", BLOCS + f"""
SELECT cand_id, interest_category, {d('direct_pac_amount')} AS direct_pac_amount,
       {d('ie_support_amount')} AS ie_support_amount FROM blocs""")

TOP_PAC = """
, pac_sums AS (
    SELECT c.TARGET_CAND_ID AS cand_id, k.CMTE_NM, k.CMTE_TP, sum(c.AMOUNT) AS amount, count(*) AS n
    FROM fact_contributions c, dim_committees k
    WHERE k.CMTE_ID = c.SOURCE_CMTE_ID AND NOT (c.TRANSACTION_TP IN ('24E', '24A', '24C', '24N'))
    GROUP BY c.TARGET_CAND_ID, k.CMTE_NM, k.CMTE_TP
),
top_pac AS (
    SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY amount DESC NULLS LAST,
                                 CMTE_NM ASC NULLS LAST, CMTE_TP ASC NULLS LAST) AS rank
    FROM pac_sums
    QUALIFY rank <= 12
)
"""
q("candidate_top_direct_pac", TOP_PAC + f"""
SELECT cand_id, CMTE_NM, CMTE_TP, {d('amount')} AS amount, n, rank FROM top_pac""")

TOP_IE = """
, ie_sums AS (
    SELECT TARGET_CAND_ID AS cand_id, SPENDER_NAME, SUPPORT_OPPOSE, sum(AMOUNT) AS amount
    FROM v_ie GROUP BY TARGET_CAND_ID, SPENDER_NAME, SUPPORT_OPPOSE
),
top_ie AS (
    SELECT *, row_number() OVER (PARTITION BY cand_id ORDER BY amount DESC NULLS LAST,
                                 SPENDER_NAME ASC NULLS LAST, SUPPORT_OPPOSE ASC NULLS LAST) AS rank
    FROM ie_sums
    QUALIFY rank <= 8
)
"""
q("candidate_top_ie_spenders", TOP_IE + f"""
SELECT cand_id, SPENDER_NAME, SUPPORT_OPPOSE, {d('amount')} AS amount, rank FROM top_ie""")

RANK_BASE = """
, members AS (
    -- default cohort: no office / state / incumbency restriction
    SELECT CAND_ID, CAND_NAME, CAND_OFFICE, CAND_OFFICE_ST, CAND_OFFICE_DISTRICT,
           CAND_PTY_AFFILIATION
    FROM dim_candidates
),
member_money AS (
    SELECT m.cand_id,
        sum(CASE WHEN m.channel = 'individual' THEN m.amount END) AS s_ind,
        sum(CASE WHEN m.channel = 'individual' AND m.donor_state = c.CAND_OFFICE_ST
                 THEN m.amount END) AS s_home,
        sum(CASE WHEN m.channel = 'individual' AND m.amount > 0 AND m.amount <= 200
                 THEN m.amount END) AS s_small,
        sum(CASE WHEN m.channel = 'direct_pac' THEN m.amount END) AS s_pac,
        sum(CASE WHEN m.channel = 'ie_support' THEN m.amount END) AS s_sup
    FROM v_money m INNER JOIN members c ON c.CAND_ID = m.cand_id
    GROUP BY m.cand_id
),
rank_base AS (
    SELECT c.CAND_ID, c.CAND_NAME, c.CAND_OFFICE, c.CAND_OFFICE_ST, c.CAND_OFFICE_DISTRICT,
           c.CAND_PTY_AFFILIATION,
           coalesce(x.s_ind, 0) AS indiv_total, coalesce(x.s_home, 0) AS in_state,
           coalesce(x.s_small, 0) AS small, coalesce(x.s_pac, 0) AS pac_total,
           coalesce(x.s_sup, 0) AS ie_support
    FROM member_money x INNER JOIN members c ON c.CAND_ID = x.cand_id
    WHERE coalesce(x.s_ind, 0) >= 50000
)
"""
q("rank_base", RANK_BASE + f"""
SELECT CAND_ID, CAND_NAME, CAND_OFFICE, CAND_OFFICE_ST, CAND_OFFICE_DISTRICT, CAND_PTY_AFFILIATION,
       {d('indiv_total')} AS indiv_total, {d('in_state')} AS in_state, {d('small')} AS small,
       {d('pac_total')} AS pac_total, {d('ie_support')} AS ie_support
FROM rank_base""")

RANK_CATS = """
, rank_cats AS (
    SELECT cand_id, interest_category, sum(amount) AS amount
    FROM v_money
    WHERE interest_category IS NOT NULL AND (channel = 'direct_pac' OR channel = 'ie_support')
    GROUP BY cand_id, interest_category
)
"""
q("rank_interest_categories", RANK_CATS + f"""
SELECT cand_id, interest_category, {d('amount')} AS amount FROM rank_cats""")

# ------------------------------------------------------------------ profile (M)
FACTS = """
, facts AS (
    SELECT c.CAND_ID AS cand_id, c.CAND_NAME, c.CAND_OFFICE, c.CAND_OFFICE_ST,
        c.CAND_OFFICE_DISTRICT, c.CAND_PTY_AFFILIATION, c.CAND_ICI, c.CAND_ELECTION_YR,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'individual'), 0) AS ind,
        count(m.channel) FILTER (WHERE m.channel = 'individual') AS ind_count,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'direct_pac'), 0) AS dpac_amt,
        count(m.channel) FILTER (WHERE m.channel = 'direct_pac') AS dpac_count,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'ie_support'), 0) AS ie_s,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'ie_oppose'), 0) AS ie_o,
        coalesce(sum(m.amount) FILTER (WHERE m.channel IN ('individual', 'direct_pac')), 0) AS raised,
        coalesce(sum(m.amount) FILTER (WHERE m.channel <> 'ie_oppose'), 0) AS backing,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'individual'
                                       AND m.donor_state = c.CAND_OFFICE_ST), 0) AS instate,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'individual' AND m.amount > 0
                                       AND m.amount <= 200), 0) AS small_amt,
        coalesce(sum(m.amount) FILTER (WHERE m.channel = 'individual' AND m.amount >= 3500), 0)
            AS maxplus_amt
    FROM dim_candidates c LEFT JOIN v_money m ON m.cand_id = c.CAND_ID
    GROUP BY c.CAND_ID, c.CAND_NAME, c.CAND_OFFICE, c.CAND_OFFICE_ST, c.CAND_OFFICE_DISTRICT,
             c.CAND_PTY_AFFILIATION, c.CAND_ICI, c.CAND_ELECTION_YR
),
fd AS (
    SELECT *, {ind} AS f_ind, {instate} AS f_instate, {small} AS f_small, {maxp} AS f_maxplus,
           {raised} AS f_raised, {backing} AS f_backing, {dpac} AS f_dpac, {ies} AS f_ies
    FROM facts
),
shares AS (
    SELECT cand_id,
        CASE WHEN f_ind <> 0 THEN (f_ind - f_instate) / f_ind ELSE 0.0 END AS out_of_state_share,
        CASE WHEN f_ind <> 0 THEN f_small / f_ind ELSE 0.0 END AS small_dollar_share,
        CASE WHEN f_ind <> 0 THEN CAST(1 AS DOUBLE) - f_small / f_ind ELSE 0.0 END AS low_small_share,
        CASE WHEN f_ind <> 0 THEN f_maxplus / f_ind ELSE 0.0 END AS maxplus_share,
        CASE WHEN f_raised <> 0 THEN f_dpac / f_raised ELSE 0.0 END AS pac_share,
        CASE WHEN f_backing <> 0 THEN f_ies / f_backing ELSE 0.0 END AS outside_share,
        CASE WHEN f_raised <> 0 THEN f_ind / f_raised END AS individual_of_raised,
        CASE WHEN f_raised <> 0 THEN f_dpac / f_raised END AS direct_pac_of_raised,
        CASE WHEN f_backing <> 0 THEN f_raised / f_backing END AS raised_of_backing,
        CASE WHEN f_backing <> 0 THEN f_ies / f_backing END AS ie_support_of_backing
    FROM fd
)
""".format(ind=d("ind"), instate=d("instate"), small=d("small_amt"), maxp=d("maxplus_amt"),
           raised=d("raised"), backing=d("backing"), dpac=d("dpac_amt"), ies=d("ie_s"))

TERMS = """
, terms AS (
    SELECT DISTINCT term FROM (
        SELECT CAND_ID AS term FROM dim_candidates
        UNION ALL SELECT lower(right(CAND_NAME, 4)) FROM dim_candidates
        UNION ALL SELECT lower(right(CAND_NAME, 2)) FROM dim_candidates
        UNION ALL SELECT right(CAND_ID, 1) || '_' || right(CAND_NAME, 1) FROM dim_candidates
    ) WHERE term IS NOT NULL
),
matches AS (
    SELECT t.term, c.CAND_ID AS cand_id, c.CAND_NAME
    FROM terms t JOIN (SELECT DISTINCT ON (CAND_ID) CAND_ID, CAND_NAME FROM dim_candidates) c
      ON CASE WHEN substr(t.term, 1, 1) IN ('H', 'S', 'P')
                   AND regexp_full_match(substr(t.term, 2, 1), '[0-9]') AND length(t.term) >= 8
              THEN c.CAND_ID = upper(t.term)
              ELSE c.CAND_NAME ILIKE '%' || t.term || '%' END
)
"""
q("resolve_candidates", TERMS + """
SELECT term, cand_id, CAND_NAME, count(*) OVER (PARTITION BY term) AS n_matches FROM matches""")

q("committee_count", """
SELECT c.cand_id, coalesce(n.n_committees, 0) AS n_committees
FROM (SELECT DISTINCT CAND_ID AS cand_id FROM dim_candidates) c
LEFT JOIN (SELECT CAND_ID, count(*) AS n_committees FROM v_links GROUP BY 1) n
  ON n.CAND_ID = c.cand_id""")

q("in_state_amount", FACTS + f"SELECT cand_id, {d('instate')} AS in_state_amount FROM facts")
for _k in ["out_of_state_share", "small_dollar_share", "low_small_share", "maxplus_share",
           "pac_share", "outside_share"]:
    q(_k, FACTS + f"SELECT cand_id, {_k} FROM shares")
q("channel_composition", FACTS + """
SELECT cand_id, individual_of_raised, direct_pac_of_raised, raised_of_backing, ie_support_of_backing
FROM shares""")

q("interest_share", FACTS + BLOCS + f"""
SELECT b.cand_id, b.interest_category, {d('b.direct_pac_amount')} AS direct_pac_amount,
       {d('b.ie_support_amount')} AS ie_support_amount,
       {d('b.direct_pac_amount')} + {d('b.ie_support_amount')} AS total,
       CASE WHEN fd.f_backing <> 0
            THEN ({d('b.direct_pac_amount')} + {d('b.ie_support_amount')}) / fd.f_backing END
            AS share_of_backing
FROM blocs b JOIN fd ON fd.cand_id = b.cand_id""")

OOS_POOL = OOS + f"""
, pool AS (
    SELECT cand_id, sum(amount) AS oos_total, count(*) AS n_states,
           sum(CAST(amount AS DECIMAL(18,2)) * CAST(amount AS DECIMAL(18,2))) AS sq
    FROM oos GROUP BY 1
),
pool_top AS (
    SELECT * FROM (
        SELECT cand_id, donor_state AS top_state, amount AS top_amount,
               row_number() OVER (PARTITION BY cand_id ORDER BY amount DESC NULLS LAST,
                                  donor_state ASC NULLS LAST) AS r
        FROM oos) WHERE r = 1
),
pool_all AS (
    SELECT p.cand_id, p.oos_total, p.n_states, t.top_state, t.top_amount,
           CASE WHEN {d('p.oos_total')} <> 0 THEN {d('t.top_amount')} / {d('p.oos_total')} END
               AS top_share,
           CASE WHEN {d('p.oos_total')} <> 0
                THEN round(CAST(p.sq AS DOUBLE) / ({d('p.oos_total')} * {d('p.oos_total')}), 12)
                ELSE 0.0 END AS hhi
    FROM pool p JOIN pool_top t ON t.cand_id = p.cand_id
),
pool_lbl AS (
    SELECT *, CASE WHEN hhi > 0.25 THEN 'concentrated' WHEN hhi > 0.15 THEN 'moderate'
                   ELSE 'diffuse' END AS hhi_label
    FROM pool_all
)
"""
q("oos_pool", OOS_POOL + f"""
SELECT cand_id, {d('oos_total')} AS oos_total, n_states, top_state, {d('top_amount')} AS top_amount,
       top_share FROM pool_lbl""")
q("oos_hhi", OOS_POOL + "SELECT cand_id, hhi, hhi_label FROM pool_lbl")

q("bucket_shares", FACTS + BUCKETS + f"""
SELECT b.cand_id, b.bucket, b.n, {d('b.amount')} AS amount,
       CASE WHEN fd.f_ind <> 0 THEN {d('b.amount')} / fd.f_ind END AS share
FROM buckets b JOIN fd ON fd.cand_id = b.cand_id""")

q("state_shares", FACTS + TOP_STATES + f"""
SELECT s.cand_id, s.donor_state, {d('s.amount')} AS amount, s.n, s.rank,
       CASE WHEN fd.f_ind <> 0 THEN {d('s.amount')} / fd.f_ind END AS share,
       coalesce(s.donor_state = fd.CAND_OFFICE_ST, false) AS is_home
FROM top_states s JOIN fd ON fd.cand_id = s.cand_id""")

q("candidate_profile", FACTS + OOS_POOL + f"""
, ncm AS (SELECT CAND_ID, count(*) AS n_committees FROM v_links GROUP BY 1)
SELECT fd.cand_id, fd.CAND_NAME, fd.CAND_OFFICE, fd.CAND_OFFICE_ST, fd.CAND_OFFICE_DISTRICT,
       fd.CAND_PTY_AFFILIATION, ncm.n_committees,
       fd.f_ind AS ind, fd.ind_count, fd.f_dpac AS dpac_amt, fd.dpac_count, fd.f_ies AS ie_s,
       {d('fd.ie_o')} AS ie_o, fd.f_raised AS raised, fd.f_backing AS backing,
       fd.f_instate AS instate, fd.f_small AS small_amt, fd.f_maxplus AS maxplus_amt,
       s.out_of_state_share, s.small_dollar_share, s.low_small_share, s.maxplus_share,
       s.pac_share, s.outside_share,
       coalesce({d('p.oos_total')}, 0.0) AS oos_total, coalesce(p.n_states, 0) AS n_oos_states,
       p.top_state, p.top_share, coalesce(p.hhi, 0.0) AS hhi,
       coalesce(p.hhi_label, 'diffuse') AS hhi_label
FROM fd JOIN ncm ON ncm.CAND_ID = fd.cand_id
JOIN shares s ON s.cand_id = fd.cand_id
LEFT JOIN pool_lbl p ON p.cand_id = fd.cand_id""")

# ------------------------------------------------------------------ ranking (R)
RANK = RANK_BASE + RANK_CATS + f"""
, sig AS (
    SELECT CAND_ID AS cand_id, CAND_NAME AS name,
        CAND_OFFICE || '-' || coalesce(nullif(CAND_OFFICE_DISTRICT, ''), '00') || ' ' || CAND_OFFICE_ST
            AS seat,
        CAND_PTY_AFFILIATION AS party,
        {d('indiv_total')} AS indiv,
        {d('indiv_total')} + {d('pac_total')} AS raised,
        {d('indiv_total')} + {d('pac_total')} + {d('ie_support')} AS backing,
        ({d('indiv_total')} - {d('in_state')}) / {d('indiv_total')} AS out_of_state,
        CAST(1 AS DOUBLE) - {d('small')} / {d('indiv_total')} AS concentration,
        CASE WHEN {d('indiv_total')} + {d('pac_total')} <> 0
             THEN {d('pac_total')} / ({d('indiv_total')} + {d('pac_total')}) ELSE 0.0 END AS pac,
        CASE WHEN {d('indiv_total')} + {d('pac_total')} + {d('ie_support')} <> 0
             THEN {d('ie_support')} / ({d('indiv_total')} + {d('pac_total')} + {d('ie_support')})
             ELSE 0.0 END AS outside
    FROM rank_base WHERE indiv_total > 0
),
cat_share AS (
    SELECT c.cand_id, c.interest_category AS tag,
           CASE WHEN s.backing <> 0 THEN coalesce({d('c.amount')}, 0.0) / s.backing ELSE 0.0 END AS share
    FROM rank_cats c JOIN sig s ON s.cand_id = c.cand_id
),
all_tags AS (SELECT DISTINCT interest_category AS tag FROM rank_cats),
tag_matrix AS (
    -- the reference's dense form: every cohort member x every tag, 0 when absent
    SELECT s.cand_id, t.tag, coalesce(cs.share, 0.0) AS share, cs.share IS NOT NULL AS present
    FROM sig s CROSS JOIN all_tags t
    LEFT JOIN cat_share cs ON cs.cand_id = s.cand_id AND cs.tag = t.tag
),
long_dense AS (
    SELECT cand_id, 'out_of_state' AS signal, 'out-of-state donors' AS label, 1 AS signal_order,
           CAST(0.40 AS DOUBLE) AS floor, out_of_state AS value, true AS present FROM sig
    UNION ALL SELECT cand_id, 'pac', 'PAC-funded', 2, CAST(0.30 AS DOUBLE), pac, true FROM sig
    UNION ALL SELECT cand_id, 'outside', 'outside-funded (IE)', 3, CAST(0.30 AS DOUBLE), outside, true
              FROM sig
    UNION ALL SELECT cand_id, 'concentration', 'few small-$ donors', 4, CAST(0.90 AS DOUBLE),
              concentration, true FROM sig
    UNION ALL SELECT cand_id, 'tag:' || tag, tag, 5, CAST(0.08 AS DOUBLE), share, present
              FROM tag_matrix
),
pct AS (
    SELECT cand_id, signal, label, signal_order, floor, value, present,
           CAST(rank() OVER (PARTITION BY signal ORDER BY value) - 1 AS DOUBLE)
             / CAST(count(*) OVER (PARTITION BY signal) AS DOUBLE) AS pctile
    FROM long_dense
),
eligible AS (SELECT * FROM pct WHERE present AND value >= floor),
best AS (
    SELECT * FROM (
        SELECT *, row_number() OVER (PARTITION BY cand_id
                                     ORDER BY pctile DESC, signal_order, label) AS r
        FROM eligible) WHERE r = 1
),
headline AS (
    SELECT s.cand_id, s.name, s.seat, s.party, s.indiv, s.raised, s.backing,
           coalesce(b.label, '(balanced / no standout)') AS headline,
           coalesce(b.value, 0.0) AS headline_value,
           coalesce(b.pctile, 0.0) AS headline_pctile
    FROM sig s LEFT JOIN best b ON b.cand_id = s.cand_id
),
ranking AS (
    SELECT *, row_number() OVER (ORDER BY headline_pctile DESC, cand_id ASC) AS rank FROM headline
)
"""
q("rank_signals", RANK + """
SELECT cand_id, name, seat, party, indiv, raised, backing, out_of_state, concentration, pac, outside
FROM sig""")
q("rank_category_shares", RANK + "SELECT cand_id, tag, share FROM cat_share")
q("rank_percentiles", RANK + """
SELECT cand_id, signal, label, signal_order, floor, value, pctile FROM pct WHERE present""")
q("rank_floors", RANK + """
SELECT cand_id, signal, label, signal_order, floor, value, pctile FROM eligible""")
q("rank_headline", RANK + "SELECT * FROM headline")
q("funding_headline_ranking", RANK + "SELECT * FROM ranking")
q("rank_display_fields", RANK + """
SELECT rank, cand_id, name, seat, party, backing, headline,
       CASE WHEN headline_value <> 0
            THEN CAST(CAST(round_even(headline_value * 100, 0) AS BIGINT) AS VARCHAR) || '%'
            ELSE '—' END AS value_display,
       CAST(round_even(headline_pctile * 100, 0) AS BIGINT) AS pctile_display
FROM ranking""")

# ------------------------------------------------------------------ angles (X)


def lit(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def money(x: str) -> str:
    return f"('$' || format('{{:,.0f}}', CAST({x} AS DOUBLE)))"


def pct1(x: str) -> str:
    return f"(format('{{:.1f}}', CAST(100 AS DOUBLE) * ({x})) || '%')"


def r4(x: str) -> str:
    return f"round_even({x}, 4)"


def mapping(m: dict, key: str) -> str:
    whens = " ".join(f"WHEN {lit(k)} THEN {lit(v)}" for k, v in m.items())
    return f"(CASE {key} {whens} END)"


def display_name(n: str) -> str:
    swapped = (f"trim(trim(substr({n}, position(',' IN {n}) + 1)) || ' ' || "
               f"trim(substr({n}, 1, position(',' IN {n}) - 1)))")
    s = f"(CASE WHEN position(',' IN {n}) > 0 THEN {swapped} ELSE {n} END)"
    words = f"string_split_regex(trim({s}), '\\s+')"
    fixed = (f"list_transform({words}, lambda w: CASE WHEN w = upper(w) AND w <> lower(w) "
             f"THEN upper(substr(w, 1, 1)) || lower(substr(w, 2)) ELSE w END)")
    return (f"(CASE WHEN {n} IS NULL OR {n} = '' THEN {n} "
            f"ELSE array_to_string(list_filter({fixed}, lambda w: w <> ''), ' ') END)")


ONE_MINUS_FLOOR_SMALL = f"(CAST(1 AS DOUBLE) - CAST({K.FLOOR_LOW_SMALL} AS DOUBLE))"
FLOOR_OOS = f"CAST({K.FLOOR_OUT_OF_STATE} AS DOUBLE)"

CARDS = f"""
, cards AS (
    SELECT CAND_ID AS cand_id, {display_name('CAND_NAME')} AS name, CAND_NAME AS name_fec,
        CAND_PTY_AFFILIATION AS party,
        coalesce({mapping(K.OFFICE_LABEL, 'CAND_OFFICE')}, CAND_OFFICE) AS office,
        CAND_OFFICE_ST AS state, CAND_OFFICE_DISTRICT AS district,
        coalesce({mapping(K.ICI_LABEL, 'CAND_ICI')}, CAND_ICI) AS incumbency,
        coalesce(CAND_ELECTION_YR, 0) AS election_year,
        CASE WHEN CAND_OFFICE = 'H'
             THEN coalesce({mapping(K.OFFICE_LABEL, 'CAND_OFFICE')}, CAND_OFFICE) || ' '
                  || CAND_OFFICE_ST || '-' || CAND_OFFICE_DISTRICT
             ELSE coalesce({mapping(K.OFFICE_LABEL, 'CAND_OFFICE')}, CAND_OFFICE) || ', '
                  || CAND_OFFICE_ST END AS region_note
    FROM dim_candidates
)
"""
q("candidate_card", CARDS + "SELECT * FROM cards")

DIRS = f"""
, dirs AS (
    SELECT CAND_ID AS cand_id,
        concat_ws('-', lower(CAND_OFFICE_ST),
                  coalesce({mapping(K.OFFICE_SLUG, 'CAND_OFFICE')}, lower(CAND_OFFICE)),
                  CASE WHEN CAND_OFFICE = 'H' THEN
                      CASE WHEN length(coalesce(CAND_OFFICE_DISTRICT, 'None')) < 2
                           THEN lpad(coalesce(CAND_OFFICE_DISTRICT, 'None'), 2, '0')
                           ELSE coalesce(CAND_OFFICE_DISTRICT, 'None') END END,
                  regexp_replace(regexp_replace(lower(CAND_NAME), '[^a-z0-9]+', '-', 'g'),
                                 '^-+|-+$', '', 'g')) AS dirname
    FROM dim_candidates
)
"""
q("canonical_dirname", DIRS + "SELECT * FROM dirs")

LINKED = """
, linked AS (SELECT DISTINCT CAND_ID AS lc FROM v_links)
"""

DS = f"""
, ds AS (
    SELECT cand_id,
        coalesce(sum(amount) FILTER (WHERE substr(bucket, 1, 1) <> '5' AND amount > 0), 0) AS pos_amt,
        coalesce(sum(n) FILTER (WHERE substr(bucket, 1, 1) <> '5' AND amount > 0), 0) AS pos_n,
        coalesce(sum(amount) FILTER (WHERE substr(bucket, 1, 1) = '1'), 0) AS small_amt,
        coalesce(sum(amount) FILTER (WHERE substr(bucket, 1, 1) = '4'), 0) AS mp_amt,
        coalesce(sum(amount) FILTER (WHERE substr(bucket, 1, 1) = '5'), 0) AS refund_amt,
        coalesce(sum(n) FILTER (WHERE substr(bucket, 1, 1) = '5'), 0) AS refund_n
    FROM buckets GROUP BY cand_id
),
ds_emit AS (
    SELECT *, {d('small_amt')} / {d('pos_amt')} AS ss, {d('mp_amt')} / {d('pos_amt')} AS mp_share,
           CAST(1 AS DOUBLE) - {d('small_amt')} / {d('pos_amt')} >= {K.FLOOR_LOW_SMALL} AS featured
    FROM ds WHERE pos_amt >= {K.MIN_INDIVIDUAL} AND pos_n >= {K.MIN_DONORS}
),
ds_rows AS (
    SELECT b.cand_id, {lit(K.ANGLE_DONOR_SIZE)} AS angle_id, {lit(K.DONOR_SIZE_METRIC)} AS metric,
        {r4('e.ss')} AS metric_value, e.featured,
        coalesce({mapping(K.BUCKET_LABEL, 'substr(b.bucket, 1, 1)')}, b.bucket) AS bucket,
        {d('b.amount')} AS amount, b.n AS count,
        {r4(d('b.amount') + ' / ' + d('e.pos_amt'))} AS share_of_individual,
        {d('e.pos_amt')} AS denominator_amount, CAST(e.pos_n AS BIGINT) AS denominator_count,
        {d('e.refund_amt')} AS refund_amount, CAST(e.refund_n AS BIGINT) AS refund_count
    FROM buckets b JOIN ds_emit e ON e.cand_id = b.cand_id
    WHERE substr(b.bucket, 1, 1) <> '5' AND b.amount > 0
)
"""
q("angle_donor_size", BUCKETS + DS + LINKED + """
SELECT * FROM ds_rows WHERE cand_id IN (SELECT lc FROM linked)""")

GEO = FACTS + TOP_STATES + f"""
, geo AS (
    SELECT f.cand_id, f.CAND_NAME, f.CAND_OFFICE_ST AS home, f.ind, f.ind_count, f.instate,
        ({d('f.ind')} - {d('f.instate')}) / {d('f.ind')} AS oos,
        f.ind - coalesce(t.top_amt, 0) AS rem,
        CAST(f.ind_count - coalesce(t.top_n, 0) AS BIGINT) AS rem_n
    FROM facts f
    LEFT JOIN (SELECT cand_id, sum(amount) AS top_amt, sum(n) AS top_n FROM top_states GROUP BY 1) t
      ON t.cand_id = f.cand_id
    WHERE f.ind >= {K.MIN_INDIVIDUAL}
),
geo_rows AS (
    SELECT s.cand_id, CAST(s.rank AS BIGINT) AS row_order, s.donor_state AS state,
        CASE WHEN coalesce(s.donor_state = g.home, false)
             THEN coalesce({mapping(K.STATE_NAMES, 's.donor_state')}, s.donor_state, '?')
                  || {lit(K.GEOGRAPHY_HOME_SUFFIX)}
             ELSE coalesce({mapping(K.STATE_NAMES, 's.donor_state')}, s.donor_state, '?') END AS label,
        {d('s.amount')} AS amount, s.n AS count,
        {r4(d('s.amount') + ' / ' + d('g.ind'))} AS share_of_individual,
        coalesce(s.donor_state = g.home, false) AS in_state, g.oos, g.ind, g.instate
    FROM top_states s JOIN geo g ON g.cand_id = s.cand_id
    UNION ALL
    SELECT cand_id, 99, CAST(NULL AS VARCHAR), {lit(K.GEOGRAPHY_OTHER)}, {d('rem')}, rem_n,
        {r4(d('rem') + ' / ' + d('ind'))}, false, oos, ind, instate
    FROM geo WHERE {d('rem')} > 0.5
),
geo_flat AS (
    SELECT cand_id, {lit(K.ANGLE_GEOGRAPHY)} AS angle_id, {lit(K.GEOGRAPHY_METRIC)} AS metric,
        {r4('oos')} AS metric_value, oos >= {FLOOR_OOS} AS featured, row_order, state, label,
        amount, count, share_of_individual, in_state, {d('ind')} AS denominator_amount,
        {d('instate')} AS in_state_amount, {r4('CAST(1 AS DOUBLE) - oos')} AS in_state_share,
        {d('ind')} - {d('instate')} AS out_of_state_amount, {r4('oos')} AS out_of_state_share
    FROM geo_rows
)
"""
q("angle_geography", GEO + LINKED + """
SELECT * FROM geo_flat WHERE cand_id IN (SELECT lc FROM linked)""")

q("angles_skipped", FACTS + BUCKETS + DS + LINKED + f"""
SELECT * FROM (
    SELECT cand_id, {lit(K.ANGLE_DONOR_SIZE)} AS angle_id,
        printf({lit(K.DONOR_SIZE_SKIP)}, {money('pos_amt')}, CAST(pos_n AS VARCHAR)) AS reason
    FROM ds WHERE NOT (pos_amt >= {K.MIN_INDIVIDUAL} AND pos_n >= {K.MIN_DONORS}) AND pos_amt > 0
    UNION ALL
    SELECT cand_id, {lit(K.ANGLE_GEOGRAPHY)}, printf({lit(K.GEOGRAPHY_SKIP)}, {money('ind')})
    FROM facts WHERE ind > 0 AND ind < {K.MIN_INDIVIDUAL}
) WHERE cand_id IN (SELECT lc FROM linked)""")

q("angle_documents", GEO + BUCKETS + DS + CARDS + LINKED + f"""
, docs AS (
    SELECT e.cand_id, {lit(K.ANGLE_DONOR_SIZE)} AS angle_id, {lit(K.DONOR_SIZE_TITLE)} AS title,
        CASE WHEN e.featured
             THEN printf({lit(K.DONOR_SIZE_REASON_FEATURED)}, {money('e.mp_amt')}, {pct1('e.mp_share')},
                         {pct1('e.ss')}, {pct1(ONE_MINUS_FLOOR_SMALL)})
             ELSE printf({lit(K.DONOR_SIZE_REASON_CONTEXT)}, {pct1('e.ss')}) END AS reason,
        {lit(K.DONOR_SIZE_METRIC)} AS metric, {r4('e.ss')} AS metric_value,
        printf({lit(K.DONOR_SIZE_THRESHOLD)}, {pct1(ONE_MINUS_FLOOR_SMALL)}, {pct1('e.ss')}) AS threshold,
        e.featured,
        CASE WHEN e.featured
             THEN printf({lit(K.DONOR_SIZE_HEADLINE_FEATURED)}, {pct1('e.ss')}, {pct1('e.mp_share')})
             ELSE {lit(K.DONOR_SIZE_HEADLINE_CONTEXT)} END AS headline,
        printf({lit(K.DONOR_SIZE_SUBHEAD)}, c.name, {money('e.pos_amt')}) AS subhead,
        {lit(K.DONOR_SIZE_DENOMINATOR)} AS denominator_label,
        {d('e.pos_amt')} AS denominator_amount, CAST(e.pos_n AS BIGINT) AS denominator_count,
        (SELECT count(*) FROM buckets b WHERE b.cand_id = e.cand_id
            AND substr(b.bucket, 1, 1) <> '5' AND b.amount > 0) AS n_rows,
        {len(K.DONOR_SIZE_NOTES)} + CASE WHEN e.refund_amt <> 0 THEN 1 ELSE 0 END AS n_footnotes,
        {lit(K.DONOR_SIZE_SOURCE)} AS source
    FROM ds_emit e LEFT JOIN cards c ON c.cand_id = e.cand_id
    UNION ALL
    SELECT g.cand_id, {lit(K.ANGLE_GEOGRAPHY)}, {lit(K.GEOGRAPHY_TITLE)},
        CASE WHEN g.oos >= {FLOOR_OOS}
             THEN printf({lit(K.GEOGRAPHY_REASON_FEATURED)}, {pct1('g.oos')}, g.home, {pct1(FLOOR_OOS)})
             ELSE printf({lit(K.GEOGRAPHY_REASON_CONTEXT)}, {pct1('CAST(1 AS DOUBLE) - g.oos')}, g.home,
                         {pct1('g.oos')}, {pct1(FLOOR_OOS)}) END,
        {lit(K.GEOGRAPHY_METRIC)}, {r4('g.oos')},
        printf({lit(K.GEOGRAPHY_THRESHOLD)}, {pct1(FLOOR_OOS)}, {pct1('g.oos')}),
        g.oos >= {FLOOR_OOS},
        CASE WHEN g.oos >= {FLOOR_OOS}
             THEN printf({lit(K.GEOGRAPHY_HEADLINE_FEATURED)}, {pct1('g.oos')})
             ELSE printf({lit(K.GEOGRAPHY_HEADLINE_CONTEXT)}, {pct1('CAST(1 AS DOUBLE) - g.oos')},
                         coalesce({mapping(K.STATE_NAMES, 'g.home')}, g.home)) END,
        printf({lit(K.GEOGRAPHY_SUBHEAD)}, c.name, {money('g.ind')}),
        {lit(K.GEOGRAPHY_DENOMINATOR)}, {d('g.ind')}, g.ind_count,
        (SELECT count(*) FROM top_states s WHERE s.cand_id = g.cand_id)
            + CASE WHEN {d('g.rem')} > 0.5 THEN 1 ELSE 0 END,
        {len(K.GEOGRAPHY_NOTES)}, {lit(K.GEOGRAPHY_SOURCE)}
    FROM geo g LEFT JOIN cards c ON c.cand_id = g.cand_id
)
SELECT * FROM docs WHERE cand_id IN (SELECT lc FROM linked)""")

q("chart_reconciliation", GEO + BUCKETS + DS + LINKED + """
, rec AS (
    SELECT cand_id, angle_id, CAST(sum(CAST(amount AS DECIMAL(24,2))) AS DOUBLE) AS rows_total,
           first(denominator_amount) AS denominator
    FROM (SELECT cand_id, angle_id, amount, denominator_amount FROM ds_rows
          UNION ALL SELECT cand_id, angle_id, amount, denominator_amount FROM geo_flat)
    GROUP BY 1, 2
)
SELECT cand_id, angle_id, rows_total, denominator, round_even(rows_total - denominator, 2) AS diff,
       abs(rows_total - denominator) <= 1 AS ok
FROM rec WHERE cand_id IN (SELECT lc FROM linked)""")

_TIERS = " UNION ALL ".join(f"SELECT {i} AS tier_order, {lit(t)} AS tier"
                            for i, t in enumerate(K.DONOR_TIERS, 1))
q("donor_inversion", BUCKETS + DS + LINKED + f"""
, tiers AS ({_TIERS}),
docs AS (
    SELECT cand_id, first(denominator_amount) AS den_amt, first(denominator_count) AS den_n,
        sum(amount) FILTER (WHERE bucket = {lit(K.DONOR_TIERS[0])}) AS small,
        sum(amount) FILTER (WHERE bucket = {lit(K.DONOR_TIERS[3])}) AS mx
    FROM ds_rows GROUP BY 1
)
SELECT d.cand_id, t.tier_order, t.tier, CAST(coalesce(r.count, 0) AS BIGINT) AS count,
    coalesce(r.amount, 0.0) AS amount,
    CASE WHEN d.den_n <> 0 THEN CAST(coalesce(r.count, 0) AS DOUBLE) / CAST(d.den_n AS DOUBLE)
         ELSE 0.0 END AS gift_share,
    CASE WHEN d.den_amt <> 0 THEN coalesce(r.amount, 0.0) / d.den_amt ELSE 0.0 END AS money_share,
    CASE WHEN coalesce(d.small, 0.0) <> 0 THEN coalesce(d.mx, 0.0) / coalesce(d.small, 0.0)
         ELSE 0.0 END AS maxout_to_small_ratio
FROM docs d JOIN tiers t ON true
LEFT JOIN ds_rows r ON r.cand_id = d.cand_id AND r.bucket = t.tier
WHERE d.cand_id IN (SELECT lc FROM linked)""")

# ------------------------------------------------------------------ semantic (L)
q("sem_candidate_count", """
SELECT CAND_OFFICE AS office, CAND_PTY_AFFILIATION AS party, CAND_OFFICE_ST AS home_state,
       CAND_ICI = 'I' AS is_incumbent, count(*) AS candidate_count
FROM dim_candidates GROUP BY 1, 2, 3, 4""")

q("sem_committee_interest", """
SELECT c.CMTE_ID, c.CMTE_NM, c.CMTE_TP AS committee_type, g.custom_category AS interest_category
FROM dim_committees c LEFT JOIN dim_group_mappings g ON g.CMTE_ID = c.CMTE_ID""")

q("sem_contributions", f"""
, j AS (
    SELECT f.*, cm.CMTE_TP AS committee_type, cd.CAND_OFFICE AS office,
           NOT (f.TRANSACTION_TP = '24E' OR f.TRANSACTION_TP = '24A' OR f.TRANSACTION_TP = '24C'
                OR f.TRANSACTION_TP = '24N') AS is_direct
    FROM fact_contributions f
    LEFT JOIN dim_committees cm ON cm.CMTE_ID = f.SOURCE_CMTE_ID
    LEFT JOIN dim_candidates cd ON cd.CAND_ID = f.TARGET_CAND_ID
)
SELECT office, committee_type,
    {d("coalesce(sum(AMOUNT) FILTER (WHERE is_direct), 0)")} AS direct_amount,
    {d("coalesce(sum(AMOUNT), 0)")} AS total_amount,
    {d("coalesce(sum(AMOUNT) FILTER (WHERE TRANSACTION_TP = '24E'), 0)")} AS ie_for_amount,
    {d("coalesce(sum(AMOUNT) FILTER (WHERE TRANSACTION_TP = '24A'), 0)")} AS ie_against_amount,
    count(*) AS n
FROM j GROUP BY 1, 2""")

q("sem_individual", f"""
SELECT cm.CMTE_TP AS committee_type, i.STATE AS donor_state,
       (i.AMOUNT <= 200 AND i.AMOUNT > 0) AS is_small_dollar,
       {d("coalesce(sum(i.AMOUNT), 0)")} AS total_amount, count(*) AS n
FROM fact_individual_contributions i
LEFT JOIN dim_committees cm ON cm.CMTE_ID = i.TARGET_CMTE_ID
GROUP BY 1, 2, 3""")

q("sem_ie", f"""
, j AS (
    SELECT i.*, sp.CMTE_ID AS spender, cd.CAND_OFFICE AS office, cd.CAND_PTY_AFFILIATION AS party
    FROM fact_independent_expenditures i
    LEFT JOIN (SELECT DISTINCT CMTE_ID FROM dim_committees) sp ON sp.CMTE_ID = i.SPENDER_CMTE_ID
    LEFT JOIN dim_candidates cd ON cd.CAND_ID = i.TARGET_CAND_ID
)
SELECT office, party,
    {d("coalesce(sum(AMOUNT) FILTER (WHERE AMNDT_IND = 'N' AND spender IS NOT NULL AND SUPPORT_OPPOSE = 'S'), 0)")} AS support_amount,
    {d("coalesce(sum(AMOUNT) FILTER (WHERE AMNDT_IND = 'N' AND spender IS NOT NULL AND SUPPORT_OPPOSE = 'O'), 0)")} AS oppose_amount,
    {d("coalesce(sum(AMOUNT), 0)")} AS raw_amount
FROM j GROUP BY 1, 2""")

MC = """
, mc AS (
    SELECT m.*, c.CAND_NAME, c.CAND_OFFICE, c.CAND_OFFICE_ST, c.CAND_OFFICE_DISTRICT,
           c.CAND_PTY_AFFILIATION
    FROM v_money m LEFT JOIN dim_candidates c ON c.CAND_ID = m.cand_id
)
"""
q("sem_money_measures", MC + f"""
, meas AS (
    SELECT CAND_OFFICE, CAND_PTY_AFFILIATION,
        coalesce(sum(amount) FILTER (WHERE channel = 'individual'), 0) AS ind,
        coalesce(sum(amount) FILTER (WHERE channel = 'direct_pac'), 0) AS dpac,
        coalesce(sum(amount) FILTER (WHERE channel = 'ie_support'), 0) AS sup,
        coalesce(sum(amount) FILTER (WHERE channel = 'ie_oppose'), 0) AS opp,
        coalesce(sum(amount) FILTER (WHERE channel = 'individual' AND donor_state = CAND_OFFICE_ST), 0) AS ins,
        coalesce(sum(amount) FILTER (WHERE channel = 'individual' AND amount > 0 AND amount <= 200), 0) AS sml,
        coalesce(sum(amount) FILTER (WHERE channel = 'individual' OR channel = 'direct_pac'), 0) AS raised,
        coalesce(sum(amount) FILTER (WHERE NOT (channel = 'ie_oppose')), 0) AS backing
    FROM mc GROUP BY 1, 2
)
SELECT CAND_OFFICE, CAND_PTY_AFFILIATION,
    {d('ind')} AS individual_amount, {d('dpac')} AS direct_pac_amount,
    {d('sup')} AS ie_support_amount, {d('opp')} AS ie_oppose_amount,
    {d('ins')} AS in_state_amount, {d('sml')} AS small_dollar_amount,
    {d('raised')} AS raised, {d('backing')} AS total_backing,
    CASE WHEN {d('raised')} <> 0 THEN {d('dpac')} / {d('raised')} END AS pac_share,
    CAST(1 AS DOUBLE) - CASE WHEN {d('ind')} <> 0 THEN {d('ins')} / {d('ind')} END AS out_of_state_share,
    CASE WHEN {d('ind')} <> 0 THEN {d('sml')} / {d('ind')} END AS small_dollar_share,
    CASE WHEN {d('backing')} <> 0 THEN {d('sup')} / {d('backing')} END AS outside_share
FROM meas""")

q("interest_backing", MC + f"""
SELECT cand_id, CAND_NAME, CAND_OFFICE, CAND_OFFICE_ST, CAND_OFFICE_DISTRICT, interest_category,
       {d('sum(amount)')} AS backing_in_category
FROM mc WHERE channel <> 'ie_oppose' AND interest_category IS NOT NULL
GROUP BY 1, 2, 3, 4, 5, 6""")

q("individual_by_state", MC + f"""
SELECT cand_id, CAND_NAME, CAND_OFFICE, CAND_OFFICE_ST, CAND_OFFICE_DISTRICT, donor_state,
       {d('sum(amount)')} AS state_amount
FROM mc WHERE channel = 'individual' AND amount > 0 AND donor_state <> CAND_OFFICE_ST
GROUP BY 1, 2, 3, 4, 5, 6""")

# ------------------------------------------------------------------ quality (D)

CURATED = [("dim_candidates", 10), ("dim_committees", 8), ("bridge_candidate_committee", 6),
           ("fact_contributions", 11), ("fact_individual_contributions", 17),
           ("fact_independent_expenditures", 18), ("dim_group_mappings", 3)]
q("table_profile", "\n" + " UNION ALL ".join(
    f"SELECT {lit(t)} AS \"table\", count(*) AS rows, CAST({n} AS BIGINT) AS cols, "
    f"{lit(TABLE_DOCS[t]['grain'])} AS grain FROM {t}" for t, n in CURATED))

RAWS = [("cn", 15), ("cm", 15), ("ccl", 7), ("pas2", 22), ("indiv", 21), ("ie", 23)]
q("raw_profile", "\n" + " UNION ALL ".join(
    f"SELECT 'raw_{ds}.parquet' AS file, count(*) AS rows, CAST({n} AS BIGINT) AS cols "
    f"FROM raw_{ds}" for ds, n in RAWS))

_LATER = {"fact_contributions": "SUB_ID % 10 <> 3",
          "fact_individual_contributions": "SUB_ID % 10 <> 3"}
_GRAINS = " UNION ALL ".join(f"""
SELECT {lit(t)} AS "table", (SELECT count(*) FROM {t}) AS fresh,
       (SELECT count(*) FROM {t} WHERE {_LATER.get(t, 'true')}) AS older,
       CAST({n} AS BIGINT) AS cols, {lit(TABLE_DOCS[t]['grain'])} AS grain""" for t, n in CURATED)
q("profile_staleness", f"""
, p AS ({_GRAINS})
SELECT "table", older AS rows, cols, grain, 'stored' AS side FROM p WHERE older <> fresh
UNION ALL SELECT "table", fresh, cols, grain, 'fresh' FROM p WHERE older <> fresh""")

_TABLE_OF = {"cn": "dim_candidates", "cm": "dim_committees", "ccl": "bridge_candidate_committee",
             "pas2": "fact_contributions", "indiv": "fact_individual_contributions",
             "ie": "fact_independent_expenditures"}
q("raw_vs_curated_counts", "\n" + " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, '{t}' AS \"table\", (SELECT count(*) FROM raw_{ds}) AS raw_rows, "
    f"(SELECT count(*) FROM {t}) AS table_rows, "
    f"(SELECT count(*) FROM raw_{ds}) = (SELECT count(*) FROM {t}) AS equal"
    for ds, t in _TABLE_OF.items()))

q("dictionary_tag_report", """
SELECT e.category, count(*) AS entries, count(*) FILTER (WHERE k.CMTE_ID IS NOT NULL) AS valid,
       count(*) FILTER (WHERE k.CMTE_ID IS NULL) AS unknown
FROM dict_entries e LEFT JOIN (SELECT DISTINCT CMTE_ID FROM dim_committees) k ON k.CMTE_ID = e.cmte_id
GROUP BY 1""")

q("tag_conflicts", """
SELECT cmte_id, count(DISTINCT category) AS n_categories,
       array_to_string(list_sort(list_distinct(list(category))), '|') AS categories
FROM dict_entries GROUP BY 1 HAVING count(DISTINCT category) > 1""")

q("channel_counts", f"""
SELECT channel, count(*) AS n, {d('sum(amount)')} AS amount FROM v_money GROUP BY 1""")

q("null_checks", """
SELECT count(*) FILTER (WHERE amount IS NULL) AS null_amount,
       count(*) FILTER (WHERE contributor_name IS NULL) AS null_name
FROM v_money WHERE channel = 'individual'""")

q("link_checks", """
SELECT count(*) FILTER (WHERE NOT CMTE_DSGN IN ('P', 'A')) AS bad_designation,
       count(*) FILTER (WHERE NOT CMTE_TP IN ('H', 'S', 'P')) AS bad_type
FROM v_links""")

q("derived_total_identity", TOTALS + f"""
SELECT cand_id, {d('raised')} AS raised, {d('individual_amount + direct_pac_amount')} AS individual_plus_pac,
       {d('total_backing')} AS total_backing,
       {d('raised + ie_support_amount')} AS raised_plus_ie_support,
       round(raised, 0) = round(individual_amount + direct_pac_amount, 0) AS raised_ok,
       round(total_backing, 0) = round(raised + ie_support_amount, 0) AS backing_ok
FROM totals""")

q("pac_types_by_category", f"""
SELECT g.custom_category AS category, f.TRANSACTION_TP, count(*) AS n,
       {d('sum(f.AMOUNT)')} AS amount,
       coalesce(f.TRANSACTION_TP IN ('24E', '24A', '24C', '24N'), true) AS excluded
FROM fact_contributions f JOIN dim_group_mappings g ON g.CMTE_ID = f.SOURCE_CMTE_ID
GROUP BY 1, 2""")

q("ie_raw_vs_clean", f"""
, sums AS (
    SELECT (SELECT sum(AMOUNT) FROM fact_independent_expenditures) AS raw_amount,
           (SELECT sum(AMOUNT) FROM v_ie) AS clean_amount
)
SELECT {d('raw_amount')} AS raw_amount, {d('clean_amount')} AS clean_amount,
       CASE WHEN clean_amount <> 0 THEN {d('raw_amount')} / {d('clean_amount')} END AS raw_to_clean
FROM sums""")

q("category_ie_support", f"""
SELECT i.TARGET_CAND_ID AS cand_id, g.custom_category AS category, {d('sum(i.AMOUNT)')} AS amount
FROM v_ie i JOIN dim_group_mappings g ON g.CMTE_ID = i.SPENDER_CMTE_ID
WHERE i.SUPPORT_OPPOSE = 'S' GROUP BY 1, 2""")

_KEYS = [("fact_individual_contributions", "SUB_ID"), ("fact_contributions", "SUB_ID"),
         ("fact_independent_expenditures", "IE_ID"), ("dim_candidates", "CAND_ID"),
         ("dim_committees", "CMTE_ID")]
q("key_uniqueness", "\n" + " UNION ALL ".join(f"""
SELECT '{t}' AS "table", '{k}' AS key, CAST(sum(c) AS BIGINT) AS rows,
       count(*) FILTER (WHERE kk IS NOT NULL) AS distinct_keys,
       count(*) FILTER (WHERE kk IS NOT NULL AND c > 1) AS dup_keys,
       CAST(coalesce(sum(c) FILTER (WHERE kk IS NOT NULL AND c > 1), 0) AS BIGINT) AS dup_rows,
       CAST(coalesce(sum(c) FILTER (WHERE kk IS NULL), 0) AS BIGINT) AS null_keys
FROM (SELECT {k} AS kk, count(*) AS c FROM {t} GROUP BY 1)""" for t, k in _KEYS))

_REFS = [("fact_independent_expenditures", "TARGET_CAND_ID", "dim_candidates", "CAND_ID"),
         ("fact_independent_expenditures", "SPENDER_CMTE_ID", "dim_committees", "CMTE_ID"),
         ("fact_contributions", "TARGET_CAND_ID", "dim_candidates", "CAND_ID"),
         ("fact_contributions", "SOURCE_CMTE_ID", "dim_committees", "CMTE_ID"),
         ("fact_individual_contributions", "TARGET_CMTE_ID", "dim_committees", "CMTE_ID")]
q("orphan_references", "\n" + " UNION ALL ".join(f"""
SELECT '{f}' AS fact, '{k}' AS key, '{dm}' AS dimension, count(*) AS rows,
       count(*) FILTER (WHERE dd.x IS NOT NULL) AS matched,
       CASE WHEN count(*) > 0 THEN CAST(count(*) FILTER (WHERE dd.x IS NOT NULL) AS DOUBLE)
            / CAST(count(*) AS DOUBLE) END AS matched_share
FROM {f} ff LEFT JOIN (SELECT DISTINCT {dk} AS x FROM {dm}) dd ON dd.x = ff.{k}"""
    for f, k, dm, dk in _REFS))

_TYPED = [("cn", "CAND_ELECTION_YR", "int"), ("ccl", "FEC_ELECTION_YR", "int"),
          ("pas2", "SUB_ID", "bigint"), ("pas2", "TRANSACTION_AMT", "money"),
          ("pas2", "TRANSACTION_DT", "mdy"),
          ("indiv", "SUB_ID", "bigint"), ("indiv", "TRANSACTION_AMT", "money"),
          ("indiv", "TRANSACTION_DT", "mdy"),
          ("ie", "exp_amo", "money"), ("ie", "exp_date", "dmy"),
          ("ie", "agg_amo", "money"), ("ie", "dissem_dt", "dmy")]


def _typed(kind: str, c: str) -> str:
    return {"int": f"TRY_CAST(round(TRY_CAST({c} AS DECIMAL(38,10))) AS INTEGER)",
            "bigint": f"TRY_CAST(round(TRY_CAST({c} AS DECIMAL(38,10))) AS BIGINT)",
            "money": f"TRY_CAST({c} AS DECIMAL(14,2))",
            "mdy": f"TRY_STRPTIME({c}, '%m%d%Y')",
            "dmy": f"TRY_STRPTIME({c}, '%d-%b-%y')"}[kind]


q("unparsed_values", "\n" + " UNION ALL ".join(f"""
SELECT '{ds}' AS dataset, '{c}' AS "column",
       count(*) FILTER (WHERE {c} IS NULL OR trim({c}) = '') AS blank,
       count(*) FILTER (WHERE NOT ({c} IS NULL OR trim({c}) = '') AND {_typed(k, c)} IS NULL) AS unparsed
FROM raw_{ds}""" for ds, c, k in _TYPED))

# ------------------------------------------------------------------ sources (S)
_COLUMNS = {ds: RAW_COLUMNS[ds] for ds, _ in RAWS}


def _lines(ds: str) -> str:
    nulls = " + ".join(f"({c} IS NULL)::INT" for c in _COLUMNS[ds])
    fields = ", ".join(f"coalesce({c}, '')" for c in _COLUMNS[ds])
    return f"SELECT '{ds}' AS dataset, {nulls} AS n_null, concat_ws('|', {fields}) AS line FROM raw_{ds}"


q("scan_pipe_raw", "\n" + " UNION ALL ".join(_lines(ds) for ds in _COLUMNS if ds != "ie"))
q("scan_ie_csv", "SELECT * FROM raw_ie")
q("land_raw_parquet", "\n" + " UNION ALL ".join(
    f"SELECT '{ds}' AS dataset, count(*) AS rows, CAST({n} AS BIGINT) AS cols FROM raw_{ds}"
    for ds, n in RAWS))
q("scan_raw_parquet", "\n" + " UNION ALL ".join(map(_lines, _COLUMNS)))
CURATED_KEYS = {"dim_candidates": "CAND_ID", "dim_committees": "CMTE_ID",
                "bridge_candidate_committee": "CAND_ID", "fact_contributions": "TARGET_CAND_ID",
                "fact_individual_contributions": "TARGET_CMTE_ID",
                "fact_independent_expenditures": "SPENDER_CMTE_ID", "dim_group_mappings": "CMTE_ID"}
q("replace_curated", "\n" + " UNION ALL ".join(
    f"SELECT '{t}' AS \"table\", {k} AS key, count(*) AS rows FROM {t} GROUP BY {k}"
    for t, k in CURATED_KEYS.items()))
q("scan_interest_dictionary", "SELECT cmte_id, category, notes FROM dict_entries")
q("load_group_mappings", "SELECT * FROM dim_group_mappings")

# The fingerprints restated. The older manifest has no ccl (new now), knew a
# dataset old that is gone (missing) and saw cm before its C1 committees were filed (changed).
def _print(ds: str, where: str = "true") -> str:
    fields = ", ".join(f"coalesce('v' || {c}, 'n')" for c in _COLUMNS[ds])
    return f"""SELECT '{ds}' AS dataset, count(*) AS rows, count(*) || ':' ||
    coalesce(CAST(sum(CAST(('0x' || substr(md5(concat_ws(chr(31), {fields})), 1, 15)) AS BIGINT)) AS VARCHAR), '0')
    AS fp FROM raw_{ds} WHERE {where}"""


_CHANGES = f"""
, present AS ({" UNION ALL ".join(_print(ds) for ds in _COLUMNS if ds != "cn")}),
stored AS ({" UNION ALL ".join(_print(ds, "CMTE_ID NOT LIKE 'C1%'" if ds == "cm" else "true")
                               for ds in _COLUMNS if ds != "ccl")}),
changes AS (
    SELECT coalesce(c.dataset, s.dataset) AS dataset, c.rows, c.fp AS fingerprint,
           CASE WHEN s.fp IS NULL THEN 'new' WHEN c.fp IS NULL THEN 'missing'
                WHEN c.fp <> s.fp THEN 'changed' ELSE 'unchanged' END AS status
    FROM present c FULL OUTER JOIN stored s ON s.dataset = c.dataset
)"""
q("snapshot_changes", _CHANGES + " SELECT dataset, rows, fingerprint, status FROM changes")
# the table of pas2 is not there
q("rebuild_set", _CHANGES + f"""
, tables AS (SELECT * FROM (VALUES {", ".join(f"('{ds}', '{t}')" for ds, t in _TABLE_OF.items())}) AS v(dataset, "table"))
SELECT t.dataset, t."table",
       CASE WHEN c.status IN ('new', 'changed') THEN c.status ELSE 'table missing' END AS reason
FROM tables t JOIN changes c ON c.dataset = t.dataset
WHERE c.status IN ('new', 'changed') OR (c.status = 'unchanged' AND t.dataset = 'pas2')""")
q("single_cycle_guard", """
, found AS (
    SELECT 'cn' AS dataset, CAND_ELECTION_YR AS cycle FROM raw_cn
    UNION ALL SELECT 'ccl', FEC_ELECTION_YR FROM raw_ccl
    UNION ALL SELECT 'pas2', right(TRANSACTION_PGI, 4) FROM raw_pas2
    UNION ALL SELECT 'indiv', right(TRANSACTION_PGI, 4) FROM raw_indiv
    UNION ALL SELECT 'ie', fec_election_yr FROM raw_ie
)
SELECT cycle, count(DISTINCT dataset) AS datasets, count(*) AS rows, cycle = '2026' AS ok
FROM found WHERE cycle IS NOT NULL GROUP BY 1""")


# The written documents' key fields (same docs as angle_documents)
_DOCS_SQL = ORACLE["angle_documents"].replace(
    "SELECT * FROM docs WHERE cand_id IN (SELECT lc FROM linked)", "")
q("write_angles", _DOCS_SQL.replace(PREFIX + "\n", "", 1) + DIRS + """
SELECT dirs.dirname, docs.angle_id, docs.cand_id, docs.metric_value, docs.featured,
       CAST(docs.n_rows AS BIGINT) AS n_rows, CAST(docs.n_footnotes AS BIGINT) AS n_footnotes
FROM docs JOIN dirs ON dirs.cand_id = docs.cand_id
WHERE docs.cand_id IN (SELECT lc FROM linked)""")


# The columns of the curated tables, in order.
CURATED_COLUMNS = {
    "dim_candidates": ["CAND_ID", "CAND_NAME", "CAND_PTY_AFFILIATION", "CAND_ELECTION_YR",
                       "CAND_OFFICE_ST", "CAND_OFFICE", "CAND_OFFICE_DISTRICT", "CAND_ICI",
                       "CAND_STATUS", "CAND_PCC"],
    "dim_committees": ["CMTE_ID", "CMTE_NM", "CMTE_TP", "CMTE_DSGN", "CMTE_PTY_AFFILIATION",
                       "ORG_TP", "CONNECTED_ORG_NM", "AFFILIATED_CAND_ID"],
    "bridge_candidate_committee": ["CAND_ID", "CMTE_ID", "FEC_ELECTION_YR", "CMTE_TP", "CMTE_DSGN",
                                   "LINKAGE_ID"],
    "fact_contributions": ["SUB_ID", "SOURCE_CMTE_ID", "TARGET_CAND_ID", "AMOUNT", "TRANSACTION_DT",
                           "TRANSACTION_TP", "ENTITY_TP", "OTHER_ID", "IMAGE_NUM", "FILE_NUM",
                           "TRAN_ID"],
    "fact_individual_contributions": ["SUB_ID", "TARGET_CMTE_ID", "CONTRIBUTOR_NAME", "CITY", "STATE",
                                      "ZIP_CODE", "EMPLOYER", "OCCUPATION", "AMOUNT",
                                      "TRANSACTION_DT", "TRANSACTION_TP", "ENTITY_TP", "OTHER_ID",
                                      "IMAGE_NUM", "FILE_NUM", "TRAN_ID", "MEMO_CD"],
    "fact_independent_expenditures": ["IE_ID", "SPENDER_CMTE_ID", "TARGET_CAND_ID", "SUPPORT_OPPOSE",
                                      "AMOUNT", "EXPENDITURE_DT", "AGGREGATE_AMOUNT", "PURPOSE",
                                      "PAYEE", "SPENDER_NAME", "TARGET_CAND_NAME", "ELECTION_TYPE",
                                      "DISSEMINATION_DT", "IMAGE_NUM", "FILE_NUM", "TRAN_ID",
                                      "AMNDT_IND", "PREV_FILE_NUM"],
    "dim_group_mappings": ["CMTE_ID", "custom_category", "notes"],
}


# Every column with how many of its values are there, from the tables themselves
def _live_columns() -> str:
    return " UNION ALL ".join(f"""
SELECT {lit(t)} AS "table", CAST({i} AS INTEGER) AS ordinal, {lit(c)} AS "column",
       count(*) AS rows, count({c}) AS present
FROM {t}""" for t, columns in CURATED_COLUMNS.items() for i, c in enumerate(columns, 1))


def _docs_values() -> str:
    rows = [f"({lit(t)}, {lit(c)}, {lit(d)})" for t, m in TABLE_DOCS.items()
            for c, d in m["columns"].items()]
    return "SELECT * FROM (VALUES " + ", ".join(rows) + ') AS v("table", "column", description)'


q("column_dictionary", f"""
, live AS ({_live_columns()}),
docs AS ({_docs_values()})
SELECT l."table", l.ordinal, l."column", l.rows, l.present,
       coalesce(d.description, '(undocumented)') AS description
FROM live l LEFT JOIN docs d ON d."table" = l."table" AND d."column" = l."column"
""")

q("dictionary_drift", f"""
, live AS ({_live_columns()}),
docs AS ({_docs_values()})
SELECT l."table", l."column", CASE WHEN d."column" IS NULL THEN 'undocumented' ELSE 'empty' END AS kind,
       l.present
FROM live l LEFT JOIN docs d ON d."table" = l."table" AND d."column" = l."column"
WHERE d."column" IS NULL OR l.present = 0
UNION ALL
SELECT d."table", d."column", 'stale', 0 FROM docs d
WHERE NOT EXISTS (SELECT 1 FROM live l WHERE l."table" = d."table" AND l."column" = d."column")
""")
