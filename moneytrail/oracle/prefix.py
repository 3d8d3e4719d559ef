"""DuckDB re-statement of the test-table mapping, the curated tables and the
canonical views, as one ``WITH`` prefix. Written independently of the Spark
code, in DuckDB's dialect; every oracle query appends its final SELECT.
"""

PREFIX = r"""
WITH
nsup AS (SELECT count(*) AS n FROM supplier),
cbase AS (
    SELECT
        s.s_suppkey AS k,
        substr('HSP', CAST(s.s_suppkey % 3 AS INTEGER) + 1, 1) AS office,
        substr('HSP', CAST(s.s_suppkey % 3 AS INTEGER) + 1, 1) || '0'
            || lpad(CAST(s.s_suppkey AS VARCHAR), 7, '0') AS cand_id,
        upper(replace(s.s_name, '#', ', ')) AS cname,
        s.s_name AS s_name,
        nn.n_name AS state,
        CASE WHEN s.s_suppkey % 3 = 0
             THEN lpad(CAST(s.s_suppkey % 20 + 1 AS VARCHAR), 2, '0') ELSE '00' END AS district,
        CASE (s.s_suppkey + s.s_suppkey % 7) % 3 WHEN 0 THEN 'DEM' WHEN 1 THEN 'REP' ELSE 'IND' END
            AS party,
        CASE WHEN s.s_suppkey % 9 < 3 THEN 'I' WHEN s.s_suppkey % 9 < 6 THEN 'C' ELSE 'O' END AS ici,
        CASE s.s_suppkey % 13 WHEN 0 THEN CAST(NULL AS VARCHAR) WHEN 1 THEN '2024' ELSE '2026' END AS yr
    FROM supplier s JOIN nation nn ON nn.n_nationkey = s.s_nationkey
),
raw_cn AS (
    SELECT cand_id AS CAND_ID, cname AS CAND_NAME, party AS CAND_PTY_AFFILIATION,
           yr AS CAND_ELECTION_YR, state AS CAND_OFFICE_ST, office AS CAND_OFFICE,
           district AS CAND_OFFICE_DISTRICT, ici AS CAND_ICI, 'C' AS CAND_STATUS,
           'C0' || lpad(CAST(k AS VARCHAR), 7, '0') AS CAND_PCC,
           CAST(NULL AS VARCHAR) AS CAND_ST1, CAST(NULL AS VARCHAR) AS CAND_ST2,
           CAST(NULL AS VARCHAR) AS CAND_CITY, state AS CAND_ST, CAST(NULL AS VARCHAR) AS CAND_ZIP
    FROM cbase
),
cm_rows AS (
    SELECT 'C0' || lpad(CAST(k AS VARCHAR), 7, '0') AS CMTE_ID, s_name AS CMTE_NM, state AS CMTE_ST,
           'P' AS CMTE_DSGN, office AS CMTE_TP, party AS CMTE_PTY_AFFILIATION,
           CAST(NULL AS VARCHAR) AS ORG_TP, CAST(NULL AS VARCHAR) AS CONNECTED_ORG_NM, cand_id AS CAND_ID
    FROM cbase
    UNION ALL
    SELECT 'C3' || lpad(CAST(k AS VARCHAR), 7, '0'), s_name, state, 'A', office, party,
           CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), cand_id
    FROM cbase WHERE k % 3 = 0
    UNION ALL
    SELECT 'C5' || lpad(CAST(k AS VARCHAR), 7, '0'), s_name, state, 'J', 'N', party,
           CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), cand_id
    FROM cbase
    UNION ALL
    SELECT 'C1' || lpad(CAST(p_partkey AS VARCHAR), 7, '0'), p_name, CAST(NULL AS VARCHAR), 'U',
           CASE p_partkey % 3 WHEN 0 THEN 'O' WHEN 1 THEN 'Q' ELSE 'N' END,
           CAST(NULL AS VARCHAR),
           substr('CLMTVW', CAST(p_partkey % 6 AS INTEGER) + 1, 1), p_brand, CAST(NULL AS VARCHAR)
    FROM part
),
raw_cm AS (
    SELECT CMTE_ID, CMTE_NM, CAST(NULL AS VARCHAR) AS TRES_NM, CAST(NULL AS VARCHAR) AS CMTE_ST1,
           CAST(NULL AS VARCHAR) AS CMTE_ST2, CAST(NULL AS VARCHAR) AS CMTE_CITY, CMTE_ST,
           CAST(NULL AS VARCHAR) AS CMTE_ZIP, CMTE_DSGN, CMTE_TP, CMTE_PTY_AFFILIATION,
           'Q' AS CMTE_FILING_FREQ, ORG_TP, CONNECTED_ORG_NM, CAND_ID
    FROM cm_rows
),
raw_ccl AS (
    SELECT cand_id AS CAND_ID, '2026' AS CAND_ELECTION_YR, '2026' AS FEC_ELECTION_YR,
           'C0' || lpad(CAST(k AS VARCHAR), 7, '0') AS CMTE_ID, office AS CMTE_TP, 'P' AS CMTE_DSGN,
           CAST(k * 10 + 1 AS VARCHAR) AS LINKAGE_ID
    FROM cbase
    UNION ALL
    SELECT cand_id, '2026', '2026', 'C0' || lpad(CAST(k AS VARCHAR), 7, '0'), office, 'P',
           CAST(k * 10 + 1 AS VARCHAR)
    FROM cbase WHERE k % 4 = 0
    UNION ALL
    SELECT cand_id, '2026', '2026', 'C3' || lpad(CAST(k AS VARCHAR), 7, '0'), office, 'A',
           CAST(k * 10 + 3 AS VARCHAR)
    FROM cbase WHERE k % 3 = 0
    UNION ALL
    SELECT cand_id, '2026', '2026', 'C5' || lpad(CAST(k AS VARCHAR), 7, '0'), 'N', 'J',
           CAST(k * 10 + 5 AS VARCHAR)
    FROM cbase
),
ord_k AS (
    SELECT o.*, o.o_orderkey % (SELECT n FROM nsup) AS k FROM orders o
),
raw_pas2 AS (
    SELECT
        'C1' || lpad(CAST(o_custkey AS VARCHAR), 7, '0') AS CMTE_ID,
        'N' AS AMNDT_IND, 'Q2' AS RPT_TP, 'G2026' AS TRANSACTION_PGI,
        CAST(o_orderkey AS VARCHAR) AS IMAGE_NUM,
        CASE o_orderpriority
            WHEN '1-URGENT' THEN '24E'
            WHEN '2-HIGH' THEN '24A'
            WHEN '3-MEDIUM' THEN CASE WHEN o_orderkey % 2 = 0 THEN '24C' ELSE '24N' END
            WHEN '4-NOT SPECIFIED' THEN CASE WHEN o_orderkey % 7 = 0 THEN CAST(NULL AS VARCHAR)
                                             ELSE '24Z' END
            WHEN '5-LOW' THEN '24K'
        END AS TRANSACTION_TP,
        'PAC' AS ENTITY_TP,
        CAST(NULL AS VARCHAR) AS NAME, CAST(NULL AS VARCHAR) AS CITY, CAST(NULL AS VARCHAR) AS STATE,
        CAST(NULL AS VARCHAR) AS ZIP_CODE, CAST(NULL AS VARCHAR) AS EMPLOYER,
        CAST(NULL AS VARCHAR) AS OCCUPATION,
        strftime(o_orderdate, '%m%d%Y') AS TRANSACTION_DT,
        CAST(CAST(CAST(
            (CASE WHEN o_orderstatus = 'P' AND o_orderkey % 10 = 0 THEN -1 ELSE 1 END)
            * (CAST(round(o_totalprice * 100) AS BIGINT)
               % (CASE WHEN k % 5 = 0 THEN 20000000 WHEN k % 4 = 1 THEN 100000 ELSE 1000000 END))
            AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS VARCHAR)
            AS TRANSACTION_AMT,
        CAST(NULL AS VARCHAR) AS OTHER_ID,
        substr('HSP', CAST(k % 3 AS INTEGER) + 1, 1) || '0' || lpad(CAST(k AS VARCHAR), 7, '0')
            AS CAND_ID,
        'T' || CAST(o_orderkey AS VARCHAR) AS TRAN_ID,
        CAST(o_orderkey // 100 AS VARCHAR) AS FILE_NUM,
        CAST(NULL AS VARCHAR) AS MEMO_CD, CAST(NULL AS VARCHAR) AS MEMO_TEXT,
        CAST(o_orderkey AS VARCHAR) AS SUB_ID
    FROM ord_k
),
li_src AS (
    SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_returnflag, l.l_linestatus,
           l.l_shipdate, o.o_custkey, c.c_name, c.c_mktsegment, cn.n_name AS c_state,
           sn.n_name AS s_state,
           CAST(round(l.l_extendedprice * 100) AS BIGINT) AS cents
    FROM lineitem l
    JOIN orders o ON o.o_orderkey = l.l_orderkey
    JOIN customer c ON c.c_custkey = o.o_custkey
    JOIN nation cn ON cn.n_nationkey = c.c_nationkey
    JOIN supplier s ON s.s_suppkey = l.l_suppkey
    JOIN nation sn ON sn.n_nationkey = s.s_nationkey
),
raw_indiv AS (
    SELECT
        CASE WHEN l_partkey % 11 = 0 THEN 'C5'
             WHEN l_linestatus = 'O' AND l_suppkey % 3 = 0 THEN 'C3'
             ELSE 'C0' END || lpad(CAST(l_suppkey AS VARCHAR), 7, '0') AS CMTE_ID,
        'N' AS AMNDT_IND, 'Q1' AS RPT_TP, 'P2026' AS TRANSACTION_PGI,
        CAST(NULL AS VARCHAR) AS IMAGE_NUM, '15' AS TRANSACTION_TP,
        CASE WHEN l_partkey % 13 = 0 THEN 'ORG' ELSE 'IND' END AS ENTITY_TP,
        CASE WHEN l_orderkey % 7 = 3 THEN 'JOSÉ "PEPE" ' || c_name
             WHEN l_orderkey % 7 = 5 THEN 'A\B ' || c_name ELSE c_name END AS NAME,
        CAST(NULL AS VARCHAR) AS CITY,
        CASE WHEN o_custkey % 17 = 0 THEN CAST(NULL AS VARCHAR)
             WHEN l_orderkey % 10 < l_suppkey % 10 THEN s_state
             ELSE c_state END AS STATE,
        CAST(NULL AS VARCHAR) AS ZIP_CODE, c_mktsegment AS EMPLOYER,
        CAST(NULL AS VARCHAR) AS OCCUPATION,
        CASE WHEN l_orderkey % 19 = 0 THEN CAST(NULL AS VARCHAR)
             ELSE strftime(l_shipdate, '%m%d%Y') END AS TRANSACTION_DT,
        CAST(CAST(CAST(
            CASE WHEN l_linenumber = 6 AND l_partkey % 50 = 0 THEN 0
                 WHEN l_returnflag = 'R' AND l_linenumber = 7 THEN -(cents % 100000)
                 WHEN l_suppkey % 29 = 5 THEN cents % 50
                 WHEN l_suppkey % 4 = 1 THEN cents % 60000
                 ELSE cents % 400000 END
            AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS VARCHAR)
            AS TRANSACTION_AMT,
        CAST(NULL AS VARCHAR) AS OTHER_ID,
        'L' || CAST(l_orderkey AS VARCHAR) || '-' || CAST(l_linenumber AS VARCHAR) AS TRAN_ID,
        CAST(l_orderkey // 100 AS VARCHAR) AS FILE_NUM,
        CASE l_linenumber WHEN 5 THEN 'X' WHEN 4 THEN 'Y' END AS MEMO_CD,
        CASE l_linenumber WHEN 5 THEN 'EARMARKED' WHEN 4 THEN 'REATTRIBUTION' END AS MEMO_TEXT,
        CAST(l_orderkey * 10 + l_linenumber AS VARCHAR) AS SUB_ID
    FROM li_src
),
ev_k AS (
    SELECT e.*, e.event_id % (SELECT n FROM nsup) AS k FROM events e
),
raw_ie AS (
    SELECT
        cb.cand_id AS cand_id, cb.cname AS cand_name,
        CASE WHEN e.event_id % 20 = 0 THEN 'C9' ELSE 'C1' END
            || lpad(CAST(e.user_id AS VARCHAR), 7, '0') AS spe_id,
        CASE WHEN e.event_id % 20 = 0 THEN 'UNKNOWN ' || CAST(e.user_id AS VARCHAR)
             ELSE coalesce(p.p_name, 'UNKNOWN ' || CAST(e.user_id AS VARCHAR)) END AS spe_nam,
        'G' AS ele_type, cb.state AS can_office_state, cb.district AS can_office_dis,
        cb.office AS can_office, cb.party AS cand_pty_aff,
        CAST(CAST(CAST(CAST(round(e.value * 100) AS BIGINT)
             * (CASE WHEN e.event_id % 20 = 0 THEN 100000 WHEN e.k % 7 = 2 THEN 20000
                     WHEN e.k % 4 = 1 THEN 10 ELSE 100 END)
             AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS VARCHAR) AS exp_amo,
        CASE WHEN e.event_id % 7 = 0 THEN CAST(NULL AS VARCHAR)
             ELSE upper(strftime(e.ts, '%d-%b-%y')) END AS exp_date,
        CAST(CAST(CAST(CAST(round(e.value * 100) AS BIGINT)
             * (CASE WHEN e.event_id % 20 = 0 THEN 100000 WHEN e.k % 7 = 2 THEN 20000
                     WHEN e.k % 4 = 1 THEN 10 ELSE 100 END)
             AS DECIMAL(16,0)) * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(14,2)) AS VARCHAR) AS agg_amo,
        CASE e.event_type WHEN 'view' THEN 's' WHEN 'error' THEN 'o' WHEN 'click' THEN 'O'
             ELSE 'S' END AS sup_opp,
        CASE WHEN e.event_id % 5 = 1 THEN 'TV, "PRIME"' || chr(10) ELSE '' END || upper(e.event_type) AS pur, e.props AS pay,
        CAST(e.event_id // 10 AS VARCHAR) AS file_num,
        CASE WHEN e.event_id % 6 = 0 THEN 'A1' ELSE 'N' END AS amndt_ind,
        CAST(e.event_id AS VARCHAR) AS tran_id,
        CAST(NULL AS VARCHAR) AS image_num, CAST(NULL AS VARCHAR) AS receipt_dat,
        '2026' AS fec_election_yr, CAST(NULL AS VARCHAR) AS prev_file_num,
        CASE WHEN e.event_id % 7 = 0 THEN CAST(NULL AS VARCHAR)
             ELSE upper(strftime(e.ts, '%d-%b-%y')) END AS dissem_dt
    FROM ev_k e
    LEFT JOIN cbase cb ON cb.k = e.k
    LEFT JOIN part p ON p.p_partkey = e.user_id
),
dict_entries AS (
    SELECT 'C1' || lpad(CAST(p_partkey AS VARCHAR), 7, '0') AS cmte_id, p_type AS category,
           CASE WHEN p_size = 3 THEN 'see "A",' || chr(10) || 'line two ' ELSE '' END || p_brand AS notes
    FROM part WHERE p_size <= 10
    UNION ALL
    SELECT 'C1' || lpad(CAST(p_partkey AS VARCHAR), 7, '0'), 'SECOND TAG', '' FROM part WHERE p_size = 7
    UNION ALL
    SELECT 'C8' || lpad(CAST(p_partkey AS VARCHAR), 7, '0'), p_type, '' FROM part WHERE p_size = 9
),
dim_candidates AS (
    SELECT CAND_ID, CAND_NAME, CAND_PTY_AFFILIATION,
           TRY_CAST(round(TRY_CAST(CAND_ELECTION_YR AS DECIMAL(38,10))) AS INTEGER) AS CAND_ELECTION_YR,
           CAND_OFFICE_ST, CAND_OFFICE, CAND_OFFICE_DISTRICT, CAND_ICI, CAND_STATUS, CAND_PCC
    FROM raw_cn
),
dim_committees AS (
    SELECT CMTE_ID, CMTE_NM, CMTE_TP, CMTE_DSGN, CMTE_PTY_AFFILIATION, ORG_TP, CONNECTED_ORG_NM,
           CAND_ID AS AFFILIATED_CAND_ID
    FROM raw_cm
),
bridge_candidate_committee AS (
    SELECT CAND_ID, CMTE_ID,
           TRY_CAST(round(TRY_CAST(FEC_ELECTION_YR AS DECIMAL(38,10))) AS INTEGER) AS FEC_ELECTION_YR,
           CMTE_TP, CMTE_DSGN, LINKAGE_ID
    FROM raw_ccl
),
fact_contributions AS (
    SELECT TRY_CAST(SUB_ID AS BIGINT) AS SUB_ID, CMTE_ID AS SOURCE_CMTE_ID,
           CAND_ID AS TARGET_CAND_ID, TRY_CAST(TRANSACTION_AMT AS DECIMAL(14,2)) AS AMOUNT,
           TRY_STRPTIME(TRANSACTION_DT, '%m%d%Y')::DATE AS TRANSACTION_DT,
           TRANSACTION_TP, ENTITY_TP, OTHER_ID, IMAGE_NUM, FILE_NUM, TRAN_ID
    FROM raw_pas2
),
fact_individual_contributions AS (
    SELECT TRY_CAST(SUB_ID AS BIGINT) AS SUB_ID, CMTE_ID AS TARGET_CMTE_ID,
           NAME AS CONTRIBUTOR_NAME, CITY, STATE, ZIP_CODE, EMPLOYER, OCCUPATION,
           TRY_CAST(TRANSACTION_AMT AS DECIMAL(14,2)) AS AMOUNT,
           TRY_STRPTIME(TRANSACTION_DT, '%m%d%Y')::DATE AS TRANSACTION_DT,
           TRANSACTION_TP, ENTITY_TP, OTHER_ID, IMAGE_NUM, FILE_NUM, TRAN_ID, MEMO_CD
    FROM raw_indiv
),
fact_independent_expenditures AS (
    SELECT file_num || '-' || tran_id AS IE_ID, spe_id AS SPENDER_CMTE_ID,
           cand_id AS TARGET_CAND_ID, upper(sup_opp) AS SUPPORT_OPPOSE,
           TRY_CAST(exp_amo AS DECIMAL(14,2)) AS AMOUNT,
           TRY_STRPTIME(exp_date, '%d-%b-%y')::DATE AS EXPENDITURE_DT,
           TRY_CAST(agg_amo AS DECIMAL(14,2)) AS AGGREGATE_AMOUNT,
           pur AS PURPOSE, pay AS PAYEE, spe_nam AS SPENDER_NAME, cand_name AS TARGET_CAND_NAME,
           ele_type AS ELECTION_TYPE,
           TRY_STRPTIME(dissem_dt, '%d-%b-%y')::DATE AS DISSEMINATION_DT,
           image_num AS IMAGE_NUM, file_num AS FILE_NUM, tran_id AS TRAN_ID,
           amndt_ind AS AMNDT_IND, prev_file_num AS PREV_FILE_NUM
    FROM raw_ie
),
dim_group_mappings AS (
    SELECT d.cmte_id AS CMTE_ID, d.category AS custom_category, d.notes AS notes
    FROM dict_entries d
    WHERE d.cmte_id IN (SELECT CMTE_ID FROM dim_committees)
),
v_links AS (
    -- attribution links: principal or authorized committees of H/S/P candidates
    SELECT CAND_ID, CMTE_ID, CMTE_TP, CMTE_DSGN
    FROM bridge_candidate_committee
    WHERE CMTE_TP IN ('H', 'S', 'P') AND CMTE_DSGN IN ('P', 'A')
    GROUP BY CAND_ID, CMTE_ID, CMTE_TP, CMTE_DSGN
),
v_gifts AS (
    -- people only, and not the memo copy of an earmarked gift
    SELECT TRY_CAST(SUB_ID AS BIGINT) AS SUB_ID, CMTE_ID AS TARGET_CMTE_ID,
           NAME AS CONTRIBUTOR_NAME, CITY, STATE, ZIP_CODE, EMPLOYER, OCCUPATION,
           TRY_CAST(TRANSACTION_AMT AS DECIMAL(14,2)) AS AMOUNT,
           TRY_STRPTIME(TRANSACTION_DT, '%m%d%Y')::DATE AS TRANSACTION_DT,
           TRANSACTION_TP, ENTITY_TP, OTHER_ID, IMAGE_NUM, FILE_NUM, TRAN_ID, MEMO_CD, MEMO_TEXT
    FROM raw_indiv
    WHERE coalesce(MEMO_CD, '') <> 'X' AND ENTITY_TP = 'IND'
),
v_ie AS (
    -- original filings by a spender that is a known committee (inner join keeps
    -- the fan-out of a duplicated committee row)
    SELECT e.IE_ID, e.SPENDER_CMTE_ID, e.TARGET_CAND_ID, e.SUPPORT_OPPOSE, e.AMOUNT,
           e.EXPENDITURE_DT, e.AGGREGATE_AMOUNT, e.PURPOSE, e.PAYEE, e.SPENDER_NAME,
           e.TARGET_CAND_NAME, e.ELECTION_TYPE, e.DISSEMINATION_DT, e.IMAGE_NUM, e.FILE_NUM,
           e.TRAN_ID, e.AMNDT_IND, e.PREV_FILE_NUM
    FROM fact_independent_expenditures e
    INNER JOIN (SELECT CMTE_ID AS known_id FROM dim_committees) k ON k.known_id = e.SPENDER_CMTE_ID
    WHERE e.AMNDT_IND = 'N'
),
arm_ind AS (
    SELECT l.CAND_ID AS cand_id, 'individual' AS channel, g.AMOUNT AS amount,
           g.STATE AS donor_state, g.CONTRIBUTOR_NAME AS contributor_name,
           g.EMPLOYER AS employer, NULL::VARCHAR AS interest_category
    FROM v_links l INNER JOIN v_gifts g ON g.TARGET_CMTE_ID = l.CMTE_ID
),
arm_pac AS (
    -- IE and coordinated types leave; a NULL type fails NOT IN and leaves too
    SELECT c.TARGET_CAND_ID AS cand_id, 'direct_pac' AS channel, c.AMOUNT AS amount,
           NULL::VARCHAR AS donor_state, NULL::VARCHAR AS contributor_name,
           NULL::VARCHAR AS employer, t.custom_category AS interest_category
    FROM fact_contributions c
    LEFT OUTER JOIN dim_group_mappings t ON t.CMTE_ID = c.SOURCE_CMTE_ID
    WHERE NOT (c.TRANSACTION_TP IN ('24E', '24A', '24C', '24N'))
),
ie_tagged AS (
    SELECT e.TARGET_CAND_ID AS cand_id,
           CASE e.SUPPORT_OPPOSE WHEN 'S' THEN 'ie_support' WHEN 'O' THEN 'ie_oppose' END
               AS channel,
           e.AMOUNT AS amount, NULL::VARCHAR AS donor_state, NULL::VARCHAR AS contributor_name,
           NULL::VARCHAR AS employer, t.custom_category AS interest_category
    FROM v_ie e
    LEFT OUTER JOIN dim_group_mappings t ON t.CMTE_ID = e.SPENDER_CMTE_ID
),
arm_sup AS (SELECT * FROM ie_tagged WHERE channel = 'ie_support'),
arm_opp AS (SELECT * FROM ie_tagged WHERE channel = 'ie_oppose'),
v_money AS (
    SELECT * FROM arm_ind UNION ALL SELECT * FROM arm_pac
    UNION ALL SELECT * FROM arm_sup UNION ALL SELECT * FROM arm_opp
)
"""
