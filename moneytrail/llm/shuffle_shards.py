"""Sharding by a two-pass external shuffle, in DataFrame operations only.

Pass one scatters the records uniformly over buckets that fit into a task's memory, by a seeded hash of
the record; the number of buckets follows the input's bytes. Pass two shuffles each bucket by
itself (Spark's ``shuffle`` is a seeded Fisher-Yates shuffle of an array) and lays the buckets end to end.
Shards are equal stretches of that order: the row at position p of N goes to shard floor(p * shards / N), so
row counts differ by one at most (law ``rows``). A bucket's array is sorted first and bucket b always
is in the same partition, so a task that runs again writes the same rows.

Defined cases: a null text counts 8 bytes; null and repeated ids are spread by their texts; equal rows
go to one bucket and are all kept; with fewer rows than shards some shards are empty; an empty
table gives empty shards; all columns are kept, and a column named ``shard`` or ``slot`` gives way to the result's.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import cut, fresh_path, offsets_before

SHARDS, SEED = 24, 17
#: Bytes of records in a bucket, on average.
BUCKET_BYTES = 24 << 20
#: Up to so many buckets their offsets are broadcast (24 bytes each), beyond it they are joined by a shuffle.
BROADCAST_BUCKETS = 100_000


def record_size(text):
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint") + 8


def shuffled(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Every input row with ``shard`` and ``slot`` (gapless from 0 in each shard), in that order within each partition."""
    total, n_rows = docs.agg(F.sum(record_size(F.col(text))), F.count("*")).first()
    n_buckets = max(1, -(-(total or 0) // bucket_bytes))
    mark = F.xxhash64(F.lit(seed), F.col(doc_id), F.col(text))
    keyed = docs.select(F.pmod(mark, F.lit(n_buckets)).cast("int").alias("bucket"), F.struct(F.xxhash64(F.lit(seed + 1), F.col(doc_id), F.col(text)).alias("order"), F.struct("*").alias("row")).alias("record"))
    offsets = cut(offsets_before(keyed.groupBy("bucket").agg(F.count("*").alias("n")), "bucket"))
    dealt = keyed.repartitionById(n_buckets, "bucket").groupBy("bucket").agg(F.sort_array(F.collect_list("record")).alias("records"))
    dealt = dealt.sortWithinPartitions("bucket").select("bucket", F.shuffle("records", seed).alias("records"))
    placed = dealt.join(F.broadcast(offsets) if n_buckets <= BROADCAST_BUCKETS else offsets, "bucket").select("offset", F.posexplode("records").alias("pos", "record"))
    n = max(1, n_rows)
    at = placed.select("record.row", (F.col("offset") + F.col("pos")).alias("at")).withColumn("shard", F.expr(f"cast(at * {shards} div {n} as int)"))
    at = at.withColumn("slot", F.col("at") - F.expr(f"(cast(shard as bigint) * {n} + {shards - 1}) div {shards}"))
    return at.select(*[F.col(f"row.`{c}`") for c in docs.columns if c not in ("shard", "slot")], "shard", "slot")


def write_shards(docs: DataFrame, path: str, **options) -> str:
    """Write the shuffled rows as Parquet below ``path``, one folder ``shard=N`` each, in slot order."""
    rows = shuffled(docs, **options).sortWithinPartitions("shard", "slot")
    rows.write.partitionBy("shard").option("compression", "zstd").parquet(path)
    return path


def shards_of(docs: DataFrame, **options) -> DataFrame:
    """The shards of ``docs``, written to the shared folder and read back."""
    spark = docs.sparkSession
    path = write_shards(docs, fresh_path(spark, "shards"), **options)
    kept = [f for f in docs.schema.fields if f.name not in ("shard", "slot")]
    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + ["slot bigint", "shard int"])
    return spark.read.schema(schema).parquet(path)
