"""Connected components of a link table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from moneytrail.llm.common import cut


#: Parts that the rows of one key are dealt into where its minimum goes back to them.
PARTS = 256


def with_least(rows: DataFrame, key: str, value: str, by: str, least: str) -> DataFrame:
    """``rows`` and the smallest ``value`` of all rows of their key (no null keys), as column ``least``.

    A key that holds most rows is no single task's load: its rows are dealt into parts by the hash of ``by``, each
    part gives one minimum, and the key's minimum goes back part by part. There are never more parts than rows.
    The hint keeps the driver from collecting a side for a broadcast. Without null parts, and where the caller pushes no
    filter below, both sides read one shuffle of the rows.
    """
    part = F.coalesce(F.pmod(F.xxhash64(by), F.lit(PARTS)).cast("int"), F.lit(0))
    dealt = rows.withColumn("_part", part).repartition(key, "_part")
    parts = dealt.groupBy(key, "_part").agg(F.min(value).alias(least))
    back = parts.withColumn(least, F.min(least).over(Window.partitionBy(key)))  # PARTS rows a key at most
    return dealt.join(back.hint("merge"), [key, "_part"]).drop("_part")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (columns a, b); root is the smallest node of its component.

    Each round hangs every node's larger neighbours, then its smaller ones, below the smallest node
    it knows; rounds end when nothing moves (some log of the longest path). A node with very many links
    has them dealt into parts (``with_least``). Each round ends in a checkpoint, which counts what it writes.
    Links with a null end and links of a node to itself are left out; an empty table has no nodes.
    """
    ends = [F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")]
    now, mark = _marked(links.where("a is not null and b is not null and a <> b").select(*ends).distinct())
    while mark[0]:
        ways = F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("way")
        both = now.select(ways).select("way.u", "way.v")
        hung = F.when(F.col("v") > F.col("u"), F.least("u", "m"))  # no filter that is pushed below with_least
        large = with_least(both, "u", "v", "v", "m").select(F.col("v").alias("u"), hung.alias("v")).where("v is not null")
        small = with_least(large, "u", "v", "v", "m").select(F.when(F.col("v") == F.col("m"), F.col("u")).otherwise(F.col("v")).alias("u"), F.col("m").alias("v"))
        before = mark
        now, mark = _marked(small.distinct())
        if mark == before:
            break
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).union(now.select(F.col("v"), F.col("v")).distinct())


def _marked(links: DataFrame) -> tuple[DataFrame, tuple]:
    """A checkpoint of ``links`` and, observed as it is written, their number and the sum of their hashes."""
    seen = Observation()
    now = cut(links.observe(seen, F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("total")))
    found = seen.get
    return now, (found["n"], found["total"])
