"""Mixing sources to target weights by Poisson replication.

A source's size is the bytes of its texts plus one byte a row; its *rate* is target weight x target size /
own size. Each document draws its number of copies from a Poisson distribution with that mean: a
seeded hash of its id gives a uniform number, which is inverted through the source's table of
cumulative probabilities. Copies are exploded and the whole output is sorted by a seeded hash: a
global shuffle in which every run gives the same order.

Without given weights a source's weight is its size to the power ``ALPHA``: large sources are damped, small
ones raised. Nothing is collected: sources are one row each in a table that is broadcast up to
``BROADCAST_SOURCES`` rows, and beyond it joined by source and salt so that a hot source is dealt over
``SALTS`` tasks.

Defined cases: a null source is a source of its own; a null text counts one byte; a null id draws by its text;
rows of one id draw alike; a source without a given weight gets none and leaves; an empty table stays
empty; all columns are kept, and columns named ``copy``, ``n_copies`` or ``shuffle_key`` give way to the result's.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import cut

ALPHA, SEED = 0.7, 11
BROADCAST_SOURCES, SALTS = 50_000, 16


def _hash(*parts: Column) -> Column:
    """52 bits of md5 over the parts joined by colons, as a long."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts).cast("binary")), 1, 13), 16, 10).cast("bigint")


def rates(docs: DataFrame, source: str, text: str, weights: Mapping[str | None, float] | None, target_ratio: float) -> DataFrame:
    """One row a source: source, rate and cdf (P(copies <= k) for k = 0, 1, ... up to where it is one)."""
    spark = docs.sparkSession
    sizes = cut(docs.groupBy(F.col(source).alias("source")).agg(F.sum(F.coalesce(F.octet_length(F.col(text)), F.lit(0)).cast("bigint") + 1).alias("size")))
    if weights is None:
        weighted = sizes.withColumn("weight", F.pow(F.col("size").cast("double"), F.lit(ALPHA)))
    else:
        given = spark.createDataFrame([(k, float(v)) for k, v in weights.items()], "s string, weight double")
        weighted = sizes.join(given, sizes["source"].eqNullSafe(given["s"])).drop("s")
    weighted = cut(weighted)
    all_weight, all_size = weighted.agg(F.sum("weight")).first()[0] or 1.0, sizes.agg(F.sum("size")).first()[0] or 0
    rated = weighted.select("source", (F.col("weight") / F.lit(all_weight) * F.lit(target_ratio * all_size) / F.col("size")).alias("rate"))
    last = F.ceil(F.col("rate") + 12 * F.sqrt("rate") + 30).cast("int")
    # log p(k) = log p(k - 1) + log(rate / k)
    step = lambda a, k: F.struct(
        (a["log_p"] + F.log(a["rate"] / k)).alias("log_p"), a["rate"].alias("rate"), (a["sum"] + F.exp(a["log_p"] + F.log(a["rate"] / k))).alias("sum"),
        F.concat(a["cdf"], F.array(a["sum"] + F.exp(a["log_p"] + F.log(a["rate"] / k)))).alias("cdf"),
    )
    start = F.struct((-F.col("rate")).alias("log_p"), F.col("rate").alias("rate"), F.exp(-F.col("rate")).alias("sum"), F.array(F.exp(-F.col("rate"))).alias("cdf"))
    cdf = F.aggregate(F.sequence(F.lit(1), last), start, step, lambda a: a["cdf"])
    return rated.where("rate > 0").select("source", "rate", cdf.alias("cdf"))


def mix(docs: DataFrame, weights: Mapping[str | None, float] | None = None, *, source: str = "source", doc_id: str = "doc_id", text: str = "text", target_ratio: float = 1.0, seed: int = SEED) -> DataFrame:
    """Every document as often as drawn, with copy (from 1), n_copies and shuffle_key, in shuffle_key order."""
    table = cut(rates(docs, source, text, weights, target_ratio))
    small = table.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES
    name = F.coalesce(F.col(doc_id).cast("string"), F.concat(F.lit("text"), F.md5(F.coalesce(F.col(text), F.lit("")).cast("binary"))))
    keyed = docs.select(F.struct("*").alias("row"), F.col(source).alias("_source"), name.alias("name"))
    if small:
        joined = keyed.join(F.broadcast(table), F.col("_source").eqNullSafe(F.col("source")))
    else:
        salted = table.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        joined = keyed.withColumn("own", F.pmod(F.xxhash64("name"), F.lit(SALTS)).cast("int")).join(salted, F.col("_source").eqNullSafe(F.col("source")) & (F.col("own") == F.col("salt")))
    uniform = _hash(F.lit(str(seed)), F.col("name")) / F.lit(float(1 << 52))
    drawn = joined.withColumn("u", uniform).withColumn("n_copies", F.size(F.filter("cdf", lambda c: c <= F.col("u"))))
    copies = drawn.where("n_copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("n_copies"))))
    key = _hash(F.lit(str(seed)), F.col("name"), F.col("copy").cast("string")).alias("shuffle_key")
    kept = [F.col(f"row.`{c}`") for c in docs.columns if c not in ("copy", "n_copies", "shuffle_key")]
    return copies.select(*kept, "copy", "n_copies", key).orderBy("shuffle_key", doc_id, "copy")


#: What ``mix`` gives for the table documents, as SQL.
SQL = f"""
WITH sizes AS (SELECT source, sum(coalesce(strlen(text), 0) + 1)::DOUBLE AS size FROM documents GROUP BY source),
total AS (SELECT sum(size) AS all_size, sum(pow(size, {ALPHA})) AS all_weight FROM sizes),
rated AS (SELECT source, pow(size, {ALPHA}) / all_weight * all_size / size AS rate FROM sizes, total),
terms AS (SELECT source, k, exp(-rate + sum(CASE WHEN k = 0 THEN 0 ELSE ln(rate / k) END) OVER (PARTITION BY source ORDER BY k)) AS p
          FROM (SELECT source, rate, unnest(range(0, ceil(rate + 12 * sqrt(rate) + 30)::BIGINT + 1)) AS k FROM rated)),
cdf AS (SELECT source, list(c ORDER BY c) AS cdf FROM (SELECT source, sum(p) OVER (PARTITION BY source ORDER BY k) AS c FROM terms) GROUP BY source),
drawn AS (SELECT d.*, len(list_filter(cdf, lambda c: c <= ('0x' || substr(md5('{SEED}:' || doc_id), 1, 13))::BIGINT / 4503599627370496.0))::INT AS n_copies
          FROM documents d JOIN cdf ON d.source IS NOT DISTINCT FROM cdf.source),
copies AS (SELECT *, unnest(range(1, n_copies + 1))::INT AS copy FROM drawn WHERE n_copies > 0)
SELECT doc_id, text, lang, source, n_chars, copy, n_copies, ('0x' || substr(md5('{SEED}:' || doc_id || ':' || copy), 1, 13))::BIGINT AS shuffle_key FROM copies
"""
