"""The test tables in the shape of the six raw filing datasets.

The driver ships TPC-H-like tables only. This module re-expresses them as the
raw bulk-file layouts (every column text), using plain integer arithmetic that
the DuckDB oracle repeats independently. The mapping:

* candidates: one per supplier ``k``; office H/S/P by ``k % 3``;
* committees: a principal (``C0``), an authorized one for ``k % 3 = 0``
  (``C3``), a joint one (``C5``) per candidate, and one PAC (``C1``) per part;
* links: C0 as principal (twice when ``k % 4 = 0`` to exercise DISTINCT), C3 as
  authorized, C5 as joint (filtered out by the view);
* individual gifts from ``lineitem`` (with orders, customers, nations);
* committee -> candidate transactions from ``orders``;
* independent expenditures from ``events``;
* interest tags from parts with ``p_size <= 10``.

Every frame here is a lazy plan over the given tables; nothing goes through the
driver except the row counts of dimensions (one scalar each).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from moneytrail.plans.joins import join_small, sized
from moneytrail.sources.schemas import RAW_COLUMNS

STR = T.StringType()

# Fixed values of the mapping.
OFFICES = "HSP"
CYCLE = "2026"
LAST_CYCLE = "2024"


def load_tables(spark: SparkSession, sf_dir: str, names) -> dict[str, DataFrame]:
    return {n: spark.read.parquet(f"{sf_dir}/{n}.parquet") for n in names}


def _id(prefix: str, x) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.concat(F.lit(prefix), F.lpad(x.cast(STR), 7, "0"))


def _cents(x) -> Column:
    x = F.col(x) if isinstance(x, str) else x
    return F.round(x * 100).cast(T.LongType())


def _money_text(cents: Column) -> Column:
    m = (cents.cast(T.DecimalType(16, 0)) * F.lit(0.01).cast(T.DecimalType(3, 2)))
    return m.cast(T.DecimalType(14, 2)).cast(STR)


def _null() -> Column:
    return F.lit(None).cast(STR)


def _office(k: Column) -> Column:
    return F.substring(F.lit(OFFICES), (k % 3).cast("int") + 1, 1)


def _cand_id(k: Column) -> Column:
    return F.concat(_office(k), F.lit("0"), F.lpad(k.cast(STR), 7, "0"))


def _finish(df: DataFrame, dataset: str) -> DataFrame:
    return df.select(*[F.col(c).cast(STR).alias(c) for c in RAW_COLUMNS[dataset]])


class Fixture:
    """Raw text datasets derived from one scale-factor folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir
        self.t = load_tables(spark, sf_dir, ["nation", "supplier", "customer", "part",
                                             "orders", "lineitem", "events"])
        self._rows: dict[str, int] = {}

    def rows(self, table: str) -> int:
        """Rows of a given table; one scalar from a metadata-sized count."""
        if table not in self._rows:
            self._rows[table] = self.t[table].count()
        return self._rows[table]

    # number of candidates (= suppliers)
    @property
    def n(self) -> int:
        return self.rows("supplier")

    def candidate_base(self) -> DataFrame:
        """(k, office, cand_id, name, state, district, party, ici, year)."""
        s = self.t["supplier"]
        nat = self.t["nation"].select(F.col("n_nationkey"), F.col("n_name"))
        k = F.col("s_suppkey")
        office = _office(k)
        return (join_small(s, nat, s.s_nationkey == nat.n_nationkey)
                .select(
                    k.alias("k"),
                    office.alias("office"),
                    _cand_id(k).alias("cand_id"),
                    F.upper(F.replace(F.col("s_name"), F.lit("#"), F.lit(", "))).alias("name"),
                    F.col("s_name").alias("s_name"),
                    F.col("n_name").alias("state"),
                    F.when(office == "H", F.lpad(((k % 20) + 1).cast(STR), 2, "0"))
                     .otherwise(F.lit("00")).alias("district"),
                    F.element_at(F.array(F.lit("DEM"), F.lit("REP"), F.lit("IND")),
                                 ((k + k % 7) % 3).cast("int") + 1).alias("party"),
                    F.when(k % 9 < 3, "I").when(k % 9 < 6, "C").otherwise("O").alias("ici"),
                    F.when(k % 13 == 0, _null()).when(k % 13 == 1, F.lit(LAST_CYCLE))
                     .otherwise(F.lit(CYCLE)).alias("year"),
                ))

    # ------------------------------------------------------------------ cn
    def raw_cn(self) -> DataFrame:
        c = self.candidate_base()
        return _finish(c.select(
            F.col("cand_id").alias("CAND_ID"),
            F.col("name").alias("CAND_NAME"),
            F.col("party").alias("CAND_PTY_AFFILIATION"),
            F.col("year").alias("CAND_ELECTION_YR"),
            F.col("state").alias("CAND_OFFICE_ST"),
            F.col("office").alias("CAND_OFFICE"),
            F.col("district").alias("CAND_OFFICE_DISTRICT"),
            F.col("ici").alias("CAND_ICI"),
            F.lit("C").alias("CAND_STATUS"),
            _id("C0", F.col("k")).alias("CAND_PCC"),
            _null().alias("CAND_ST1"), _null().alias("CAND_ST2"), _null().alias("CAND_CITY"),
            F.col("state").alias("CAND_ST"), _null().alias("CAND_ZIP"),
        ), "cn")

    # ------------------------------------------------------------------ cm
    def raw_cm(self) -> DataFrame:
        c = self.candidate_base()
        k = F.col("k")

        def cand_cmte(prefix, dsgn, tp, keep):
            return c.filter(keep).select(
                _id(prefix, k).alias("CMTE_ID"),
                F.col("s_name").alias("CMTE_NM"),
                F.col("state").alias("CMTE_ST"),
                F.lit(dsgn).alias("CMTE_DSGN"),
                tp.alias("CMTE_TP"),
                F.col("party").alias("CMTE_PTY_AFFILIATION"),
                _null().alias("ORG_TP"),
                _null().alias("CONNECTED_ORG_NM"),
                F.col("cand_id").alias("CAND_ID"),
            )

        principal = cand_cmte("C0", "P", F.col("office"), F.lit(True))
        authorized = cand_cmte("C3", "A", F.col("office"), k % 3 == 0)
        joint = cand_cmte("C5", "J", F.lit("N"), F.lit(True))
        p = self.t["part"]
        pk = F.col("p_partkey")
        pacs = p.select(
            _id("C1", pk).alias("CMTE_ID"),
            F.col("p_name").alias("CMTE_NM"),
            _null().alias("CMTE_ST"),
            F.lit("U").alias("CMTE_DSGN"),
            F.element_at(F.array(F.lit("O"), F.lit("Q"), F.lit("N")),
                         (pk % 3).cast("int") + 1).alias("CMTE_TP"),
            _null().alias("CMTE_PTY_AFFILIATION"),
            F.substring(F.lit("CLMTVW"), (pk % 6).cast("int") + 1, 1).alias("ORG_TP"),
            F.col("p_brand").alias("CONNECTED_ORG_NM"),
            _null().alias("CAND_ID"),
        )
        allc = principal.unionByName(authorized).unionByName(joint).unionByName(pacs)
        return _finish(allc.select(
            "CMTE_ID", "CMTE_NM", _null().alias("TRES_NM"), _null().alias("CMTE_ST1"),
            _null().alias("CMTE_ST2"), _null().alias("CMTE_CITY"), "CMTE_ST",
            _null().alias("CMTE_ZIP"), "CMTE_DSGN", "CMTE_TP", "CMTE_PTY_AFFILIATION",
            F.lit("Q").alias("CMTE_FILING_FREQ"), "ORG_TP", "CONNECTED_ORG_NM", "CAND_ID",
        ), "cm")

    # ------------------------------------------------------------------ ccl
    def raw_ccl(self) -> DataFrame:
        c = self.candidate_base()
        k = F.col("k")

        def link(prefix, tp, dsgn, code, keep):
            return c.filter(keep).select(
                F.col("cand_id").alias("CAND_ID"),
                F.lit(CYCLE).alias("CAND_ELECTION_YR"),
                F.lit(CYCLE).alias("FEC_ELECTION_YR"),
                _id(prefix, k).alias("CMTE_ID"),
                tp.alias("CMTE_TP"),
                F.lit(dsgn).alias("CMTE_DSGN"),
                (k * 10 + code).cast(STR).alias("LINKAGE_ID"),
            )

        rows = (link("C0", F.col("office"), "P", 1, F.lit(True))
                .unionByName(link("C0", F.col("office"), "P", 1, k % 4 == 0))
                .unionByName(link("C3", F.col("office"), "A", 3, k % 3 == 0))
                .unionByName(link("C5", F.lit("N"), "J", 5, F.lit(True))))
        return _finish(rows, "ccl")

    # ------------------------------------------------------------------ pas2
    def raw_pas2(self) -> DataFrame:
        o = self.t["orders"]
        ok = F.col("o_orderkey")
        k = ok % F.lit(self.n)
        tp = (F.when(F.col("o_orderpriority") == "1-URGENT", "24E")
               .when(F.col("o_orderpriority") == "2-HIGH", "24A")
               .when(F.col("o_orderpriority") == "3-MEDIUM",
                     F.when(ok % 2 == 0, "24C").otherwise("24N"))
               .when(F.col("o_orderpriority") == "4-NOT SPECIFIED",
                     F.when(ok % 7 == 0, _null()).otherwise(F.lit("24Z")))
               .when(F.col("o_orderpriority") == "5-LOW", "24K"))
        modulus = (F.when(k % 5 == 0, F.lit(20000000)).when(k % 4 == 1, F.lit(100000))
                    .otherwise(F.lit(1000000)))
        sign = F.when((F.col("o_orderstatus") == "P") & (ok % 10 == 0), F.lit(-1)).otherwise(1)
        cents = sign * (_cents("o_totalprice") % modulus)
        return _finish(o.select(
            _id("C1", F.col("o_custkey")).alias("CMTE_ID"),
            F.lit("N").alias("AMNDT_IND"), F.lit("Q2").alias("RPT_TP"),
            F.lit("G" + CYCLE).alias("TRANSACTION_PGI"),
            ok.cast(STR).alias("IMAGE_NUM"),
            tp.alias("TRANSACTION_TP"), F.lit("PAC").alias("ENTITY_TP"),
            _null().alias("NAME"), _null().alias("CITY"), _null().alias("STATE"),
            _null().alias("ZIP_CODE"), _null().alias("EMPLOYER"), _null().alias("OCCUPATION"),
            F.date_format("o_orderdate", "MMddyyyy").alias("TRANSACTION_DT"),
            _money_text(cents).alias("TRANSACTION_AMT"),
            _null().alias("OTHER_ID"),
            _cand_id(k).alias("CAND_ID"),
            F.concat(F.lit("T"), ok.cast(STR)).alias("TRAN_ID"),
            (ok.cast(T.LongType()) / 100).cast(T.LongType()).cast(STR).alias("FILE_NUM"),
            _null().alias("MEMO_CD"), _null().alias("MEMO_TEXT"),
            ok.cast(STR).alias("SUB_ID"),
        ), "pas2")

    # ------------------------------------------------------------------ indiv
    def raw_indiv(self) -> DataFrame:
        li = self.t["lineitem"].select(
            "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_extendedprice",
            "l_returnflag", "l_linestatus", "l_shipdate")
        o = self.t["orders"].select("o_orderkey", "o_custkey")
        nat = self.t["nation"].select("n_nationkey", "n_name")
        cust = join_small(
            self.t["customer"].select("c_custkey", "c_name", "c_mktsegment", "c_nationkey"),
            nat.withColumnRenamed("n_name", "c_state"),
            F.col("c_nationkey") == F.col("n_nationkey")).drop("n_nationkey", "c_nationkey")
        supp = join_small(
            self.t["supplier"].select("s_suppkey", "s_nationkey"),
            nat.withColumnRenamed("n_name", "s_state"),
            F.col("s_nationkey") == F.col("n_nationkey")).select("s_suppkey", "s_state")
        # lineitem x orders is the one large join of the mapping (shuffle on the
        # order key); customers and suppliers are dimension joins. Customers meet the
        # orders first: where that takes a shuffle, no line crosses it.
        o = join_small(o, sized(cust, self.rows("customer")), F.col("o_custkey") == F.col("c_custkey"))
        j = li.join(o, F.col("l_orderkey") == F.col("o_orderkey"))
        j = join_small(j, sized(supp, self.n), F.col("l_suppkey") == F.col("s_suppkey"))
        sk, pk, okey, ln = (F.col("l_suppkey"), F.col("l_partkey"), F.col("l_orderkey"),
                            F.col("l_linenumber"))
        prefix = (F.when(pk % 11 == 0, "C5")
                   .when((F.col("l_linestatus") == "O") & (sk % 3 == 0), "C3")
                   .otherwise("C0"))
        cmte = F.concat(prefix, F.lpad(sk.cast(STR), 7, "0"))
        state = (F.when(F.col("o_custkey") % 17 == 0, _null())
                  .when(okey % 10 < sk % 10, F.col("s_state"))
                  .otherwise(F.col("c_state")))
        c = _cents("l_extendedprice")
        cents = (F.when((ln == 6) & (pk % 50 == 0), F.lit(0).cast(T.LongType()))
                  .when((F.col("l_returnflag") == "R") & (ln == 7), -(c % 100000))
                  .when(sk % 29 == 5, c % 50)  # a few candidates below every floor
                  .when(sk % 4 == 1, c % 60000)
                  .otherwise(c % 400000))
        memo = F.when(ln == 5, "X").when(ln == 4, "Y")
        # accents, quotes and backslashes are data in the pipe files
        name = (F.when(okey % 7 == 3, F.concat(F.lit("JOSÉ \"PEPE\" "), F.col("c_name")))
                 .when(okey % 7 == 5, F.concat(F.lit("A\\B "), F.col("c_name")))
                 .otherwise(F.col("c_name")))
        return _finish(j.select(
            cmte.alias("CMTE_ID"),
            F.lit("N").alias("AMNDT_IND"), F.lit("Q1").alias("RPT_TP"),
            F.lit("P" + CYCLE).alias("TRANSACTION_PGI"), _null().alias("IMAGE_NUM"),
            F.lit("15").alias("TRANSACTION_TP"),
            F.when(pk % 13 == 0, "ORG").otherwise("IND").alias("ENTITY_TP"),
            name.alias("NAME"), _null().alias("CITY"), state.alias("STATE"),
            _null().alias("ZIP_CODE"), F.col("c_mktsegment").alias("EMPLOYER"),
            _null().alias("OCCUPATION"),
            F.when(okey % 19 == 0, _null())
             .otherwise(F.date_format("l_shipdate", "MMddyyyy")).alias("TRANSACTION_DT"),
            _money_text(cents).alias("TRANSACTION_AMT"),
            _null().alias("OTHER_ID"),
            F.concat(F.lit("L"), okey.cast(STR), F.lit("-"), ln.cast(STR)).alias("TRAN_ID"),
            (okey / 100).cast(T.LongType()).cast(STR).alias("FILE_NUM"),
            memo.alias("MEMO_CD"),
            F.when(ln == 5, F.lit("EARMARKED")).when(ln == 4, F.lit("REATTRIBUTION"))
             .alias("MEMO_TEXT"),
            (okey * 10 + ln).cast(STR).alias("SUB_ID"),
        ), "indiv")

    # ------------------------------------------------------------------ ie
    def raw_ie(self) -> DataFrame:
        e = self.t["events"]
        eid = F.col("event_id")
        e = e.withColumn("k", eid % F.lit(self.n))
        cand = self.candidate_base().select(
            F.col("k").alias("ck"), "cand_id", "name", "state", "district", "office", "party")
        e = join_small(e, sized(cand, self.n), F.col("k") == F.col("ck"), "left")
        parts = sized(self.t["part"].select("p_partkey", "p_name"), self.rows("part"))
        e = join_small(e, parts, F.col("user_id") == F.col("p_partkey"), "left")
        k = F.col("k")
        unknown = eid % 20 == 0
        et = F.col("event_type")
        sup = (F.when(et == "view", "s").when(et == "error", "o").when(et == "click", "O")
                .otherwise("S"))
        mult = (F.when(unknown, F.lit(100000)).when(k % 7 == 2, F.lit(20000))
                 .when(k % 4 == 1, F.lit(10)).otherwise(F.lit(100)))
        amt = _money_text(_cents("value") * mult)
        date_txt = F.when(eid % 7 == 0, _null()).otherwise(
            F.upper(F.date_format("ts", "dd-MMM-yy")))
        return _finish(e.select(
            F.col("cand_id").alias("cand_id"),
            F.col("name").alias("cand_name"),
            F.when(unknown, _id("C9", F.col("user_id"))).otherwise(_id("C1", F.col("user_id")))
             .alias("spe_id"),
            F.when(unknown, F.concat(F.lit("UNKNOWN "), F.col("user_id").cast(STR)))
             .otherwise(F.coalesce(F.col("p_name"),
                                   F.concat(F.lit("UNKNOWN "), F.col("user_id").cast(STR))))
             .alias("spe_nam"),
            F.lit("G").alias("ele_type"),
            F.col("state").alias("can_office_state"),
            F.col("district").alias("can_office_dis"),
            F.col("office").alias("can_office"),
            F.col("party").alias("cand_pty_aff"),
            amt.alias("exp_amo"),
            date_txt.alias("exp_date"),
            amt.alias("agg_amo"),
            sup.alias("sup_opp"),
            F.when(eid % 5 == 1, F.concat(F.lit("TV, \"PRIME\"\n"), F.upper(et))).otherwise(F.upper(et))
             .alias("pur"),
            F.col("props").alias("pay"),
            (eid / 10).cast(T.LongType()).cast(STR).alias("file_num"),
            F.when(eid % 6 == 0, "A1").otherwise("N").alias("amndt_ind"),
            eid.cast(STR).alias("tran_id"),
            _null().alias("image_num"), _null().alias("receipt_dat"),
            F.lit(CYCLE).alias("fec_election_yr"),
            _null().alias("prev_file_num"),
            date_txt.alias("dissem_dt"),
        ), "ie")

    # ------------------------------------------------------------------ tags
    def interest_entries(self) -> DataFrame:
        """Curated tag entries (cmte_id, category, notes). Some committees carry two
        tags, some tagged ids are no committee, some notes need quoting."""
        p = self.t["part"]
        notes = F.when(F.col("p_size") == 3, F.concat(F.lit("see \"A\",\nline two "), F.col("p_brand"))
                       ).otherwise(F.col("p_brand"))
        first = p.filter(F.col("p_size") <= 10).select(
            _id("C1", F.col("p_partkey")).alias("cmte_id"), F.col("p_type").alias("category"),
            notes.alias("notes"))
        second = p.filter(F.col("p_size") == 7).select(
            _id("C1", F.col("p_partkey")).alias("cmte_id"), F.lit("SECOND TAG").alias("category"),
            F.lit("").alias("notes"))
        unknown = p.filter(F.col("p_size") == 9).select(
            _id("C8", F.col("p_partkey")).alias("cmte_id"), F.col("p_type").alias("category"),
            F.lit("").alias("notes"))
        return first.unionByName(second).unionByName(unknown)

    def raw(self, dataset: str) -> DataFrame:
        return getattr(self, f"raw_{dataset}")()
