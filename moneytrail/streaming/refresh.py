"""Snapshot refresh: change detection (S9), rebuild set (S10), cycle guard.

The bulk files are full snapshots, not row deltas. The reference asks the web
server whether a file changed; here the question is asked of the data itself:
a dataset's fingerprint is its row count plus an order-free sum of 60-bit row
hashes (computed in parallel, one partial sum per task). A refresh compares
the fingerprints of the newly landed rows with the stored manifest and
rebuilds only the curated tables of changed datasets (or missing tables).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

MANIFEST_SCHEMA = "dataset string, cycle string, rows long, fingerprint string"


def row_hash(df: DataFrame) -> Column:
    """60 bits of a whole row: the first 15 hex digits of the md5 of its fields,
    each marked as a value or as NULL, so ('a', NULL) and (NULL, 'a') differ. Any
    engine with md5 computes the same number."""
    cols = [F.coalesce(F.concat(F.lit("v"), F.col(c).cast("string")), F.lit("n")) for c in df.columns]
    return F.conv(F.substring(F.md5(F.concat_ws("\x1f", *cols).cast("binary")), 1, 15), 16, 10)


# A sum of 60-bit hashes is kept as three sums of 20 bits each, in longs (exact up to 2 ** 43 rows).
# The hash is a column before it is summed: an aggregate evaluates what it sums more than once a row.
BITS = 20


def _hashed(df: DataFrame) -> DataFrame:
    return df.withColumn("_h", row_hash(df).cast("long"))


def _sums() -> list[Column]:
    return [F.sum(F.shiftright("_h", BITS * i).bitwiseAND((1 << BITS) - 1)).alias(f"h{i}") for i in range(3)]


def dataset_fingerprint(df: DataFrame, dataset: str, cycle: str) -> DataFrame:
    """(dataset, cycle, rows, fingerprint) of one landed dataset."""
    total = sum((F.col(f"h{i}").cast(T.DecimalType(38, 0)) * F.lit(1 << (BITS * i)) for i in (1, 2)),
                F.col("h0").cast(T.DecimalType(38, 0))).cast(T.DecimalType(38, 0))
    return _hashed(df).select("_h").agg(F.count(F.lit(1)).alias("rows"), *_sums()).select(
        F.lit(dataset).alias("dataset"), F.lit(cycle).alias("cycle"), "rows",
        F.concat_ws(":", F.col("rows").cast("string"),
                    F.coalesce(total.cast("string"), F.lit("0"))).alias("fingerprint"))


def landed_fingerprint(df: DataFrame, write) -> tuple[int, str]:
    """(rows, fingerprint) of ``df``, taken while ``write`` writes it: its rows are read once."""
    seen = Observation()
    write(_hashed(df).observe(seen, F.count(F.lit(1)).alias("rows"), *_sums()).drop("_h"))
    rows, total = seen.get["rows"], sum((seen.get[f"h{i}"] or 0) << (BITS * i) for i in range(3))
    return rows, f"{rows}:{total}"


def manifest(raws: dict[str, DataFrame], cycle: str) -> DataFrame:
    out = None
    for ds, df in raws.items():
        f = dataset_fingerprint(df, ds, cycle)
        out = f if out is None else out.unionByName(f)
    return out


def snapshot_changes(current: DataFrame, stored: DataFrame) -> DataFrame:
    """Status per dataset: new, changed, unchanged or missing."""
    c = current.select("dataset", F.col("rows").alias("rows"), F.col("fingerprint").alias("fp"))
    s = stored.select("dataset", F.col("fingerprint").alias("stored_fp"))
    j = c.join(s, "dataset", "full_outer")
    status = (F.when(F.col("stored_fp").isNull(), "new")
               .when(F.col("fp").isNull(), "missing")
               .when(F.col("fp") != F.col("stored_fp"), "changed")
               .otherwise("unchanged"))
    return j.select("dataset", "rows", F.col("fp").alias("fingerprint"), status.alias("status"))


def rebuild_set(changes: DataFrame, existing_tables: DataFrame, table_of: dict[str, str],
                requested: list[str] | None = None, force: bool = False) -> DataFrame:
    """Datasets whose curated table must be (re)built: changed or new
    snapshots, plus landed datasets whose table is missing; ``force`` rebuilds
    every requested dataset. Each dataset is independent, so one failing
    rebuild does not stop the others."""
    spark = changes.sparkSession
    tmap = spark.createDataFrame(list(table_of.items()), "dataset string, table string")
    if requested is not None:
        tmap = tmap.filter(F.col("dataset").isin(requested))
    j = tmap.join(changes.select("dataset", "status"), "dataset", "left")
    have = existing_tables.select(F.col("table").alias("_t"), F.lit(True).alias("_exists"))
    j = j.join(have, F.col("table") == F.col("_t"), "left")
    landed = F.col("status").isNotNull() & (F.col("status") != "missing")
    reason = (F.when(F.lit(force), "forced")
               .when(F.col("status").isin("new", "changed"), F.col("status"))
               .when(landed & F.col("_exists").isNull(), "table missing"))
    return j.select("dataset", "table", reason.alias("reason")).filter(F.col("reason").isNotNull())


def check_cycle(cycle: str) -> str:
    if not re.fullmatch(r"[0-9]{4}", cycle or ""):
        raise ValueError("cycle must be a 4-digit year, e.g. 2026")
    return cycle


# Where each dataset says which cycle its rows belong to (the last four characters).
CYCLE_COLUMN = {"cn": "CAND_ELECTION_YR", "ccl": "FEC_ELECTION_YR", "pas2": "TRANSACTION_PGI",
                "indiv": "TRANSACTION_PGI", "ie": "fec_election_yr"}


def cycles_in_data(raws: dict[str, DataFrame]) -> DataFrame:
    """(dataset, cycle, rows) as the rows themselves name their cycle (rows without one are left out)."""
    out = None
    for ds, column in CYCLE_COLUMN.items():
        if ds in raws:
            one = (raws[ds].select(F.right(F.col(column), F.lit(4)).alias("cycle")).filter("cycle IS NOT NULL")
                   .groupBy("cycle").agg(F.count(F.lit(1)).alias("rows"))
                   .select(F.lit(ds).alias("dataset"), "cycle", "rows"))
            out = one if out is None else out.unionByName(one)
    return out


def single_cycle_guard(stored: DataFrame, cycle: str) -> DataFrame:
    """The stored manifest's cycles against the requested one; a store
    holds one cycle, so any other cycle is refused (see ``assert_one_cycle``)."""
    check_cycle(cycle)
    return (stored.groupBy("cycle").agg(F.count(F.lit(1)).alias("datasets"),
                                        F.sum("rows").alias("rows"))
            .withColumn("ok", F.col("cycle") == F.lit(cycle)))


def assert_one_cycle(stored: DataFrame, cycle: str) -> None:
    bad = single_cycle_guard(stored, cycle).filter(~F.col("ok")).limit(1).collect()
    if bad:
        raise ValueError(f"store is for cycle {bad[0]['cycle']}; refusing to mix cycle {cycle}")

