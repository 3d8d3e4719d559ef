"""SpotSigs document fingerprints, in DataFrame operations only.

Words are runs of letters and digits, lowered. Common words are *anchors*; every anchor with the
``CHAIN`` content words that follow it is a spot signature, hashed to 32 bits. A document's fingerprint is its
sorted set of signatures; a document with words but no signature has one signature of all its words, and a
document without words has none. Likeness is the Jaccard coefficient of two sets (two empty sets: 1).

``similar_pairs`` finds all pairs at or above a threshold among *different* sets: sets are partitioned by length, so
that only partitions whose lengths allow the threshold meet; within them pairs meet on the rarest signatures of
each set (a set's prefix), are pruned by their lengths once more, and only then compared in full.

``with_next`` gives each row the row that follows it in descending id without one global sort: ids fall into
buckets of ``SPAN`` consecutive values (so a bucket has at most that many different ids), each bucket looks one
row ahead in a window, and only its last row takes the head of the next bucket that has rows (``successors``).

Defined cases: a null text is an empty one; null ids follow all others, ordered by a hash of their texts; rows of one id
are ordered by that hash too; a single row is its own next; an empty table gives an empty result; other columns are
not read.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from moneytrail.llm.common import cut

# Common words by language.
_COMMON = (
    ("English", "a an and are as at be but by for from had has have he her his in is it not of on or she that the their they this to was were which will with you"),
    ("German", "als am an auch auf aus bei das dem den der des die durch ein eine einer es für im in ist mit nach nicht oder sich sie sind um und von war wie wird zu zum zur"),
    ("French", "au aux avec ce ces dans de des du elle en est et il ils je la le les leur mais ne on ou par pas pour qu que qui sa se son sont sur un une"),
    ("Spanish", "al como con de del el ella en es esta este fue ha la las le lo los más no o para pero por que se ser si sin sobre su sus un una y"),
)
ANCHORS = tuple(sorted({w for _, words in _COMMON for w in words.split()}))
CHAIN = 2
SPAN = 512
THRESHOLD = 0.8
#: Up to so many rows (three numbers each) a table of bucket heads is broadcast, beyond it it is shuffled.
BROADCAST_ROWS = 100_000


def _let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once a row (a column used in a lambda is computed again for each element)."""
    return F.transform(F.array(value), use)[0]


def signatures(text: Column, anchors: tuple[str, ...] = ANCHORS, chain: int = CHAIN) -> Column:
    """The sorted set of spot signatures (array of int) of a text."""
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"[^\p{L}\p{N}]+"), lambda w: w != "")

    def spots(v: Column) -> Column:
        # the j-th anchor (from 0), at word i, has i - j content words before it
        found = F.transform(v["anchors"], lambda a, j: F.when(a["at"] - j < F.size(v["content"]), F.hash(a["word"], F.slice(v["content"], a["at"] - j + 1, chain))))
        sigs = F.array_compact(F.array_distinct(found))
        return F.when(F.size(sigs) > 0, F.array_sort(sigs)).when(F.size(v["content"]) + F.size(v["anchors"]) > 0, F.array(F.hash(v["words"]))).otherwise(F.array().cast("array<int>"))

    def tagged(ws: Column) -> Column:
        marks = F.transform(ws, lambda w, i: F.when(w.isin(*anchors), F.struct(w.alias("word"), i.alias("at"))))
        content = F.filter(ws, lambda w: ~w.isin(*anchors))
        return _let(F.struct(ws.alias("words"), content.alias("content"), F.array_compact(marks).alias("anchors")), spots)

    return _let(words, tagged)


def fingerprint_string(sigs: Column) -> Column:
    return F.array_join(sigs.cast("array<string>"), ",")


def likeness(a: Column, b: Column) -> Column:
    """Jaccard coefficient of two sets."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


# --------------------------------------------------------------------------- the next row

_BUCKET = ["late", "bucket"]


def _placed(docs: DataFrame, doc_id: str, text: str) -> DataFrame:
    """doc_id, text and the place in the order: late (null ids), bucket, doc_id, mark."""
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    mark = F.xxhash64("text")
    bucket = F.floor(F.coalesce(F.col("doc_id") / F.lit(SPAN), mark / F.lit(1 << 52))).cast("bigint")
    return rows.select("doc_id", "text", F.col("doc_id").isNull().alias("late"), bucket.alias("bucket"), mark.alias("mark"))


def successors(buckets: DataFrame) -> DataFrame:
    """(late, bucket, next_late, next_bucket) for the buckets that have rows; the last one's next is the first.

    Buckets are dealt by range, in order. A range looks one bucket ahead in a window of its own; its last bucket takes
    the head of the next range. Only these heads, one a partition, are ordered by one task, however the ids lie.
    """
    this = F.struct("late", "bucket")
    dealt = buckets.repartitionByRange("late", F.desc("bucket")).withColumn("range", F.spark_partition_id())
    rows = cut(dealt)  # the ranges of a second sampling could differ
    inside = Window.partitionBy("range").orderBy("late", F.desc("bucket"))
    all_ranges = Window.orderBy("range")
    top = rows.groupBy("range").agg(F.min_by(this, F.struct("late", -F.col("bucket"))).alias("head"))
    first = F.first("head").over(all_ranges.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    top = top.select("range", F.coalesce(F.lead("head").over(all_ranges), first).alias("head"))
    found = rows.withColumn("after", F.lead(this).over(inside)).join(top, "range").withColumn("next", F.coalesce("after", "head"))
    return found.select("late", "bucket", F.col("next.late").alias("next_late"), F.col("next.bucket").alias("next_bucket"))


def with_next(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, text, sigs and next_text, next_sigs of the row that follows in descending id."""
    rows = _placed(docs, doc_id, text)
    heads = cut(rows.groupBy(*_BUCKET).agg(F.max(F.struct("doc_id", "mark")).alias("head")).select(*_BUCKET, "head.*"))
    few = heads.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    named = heads.select(F.col("late").alias("l"), F.col("bucket").alias("b"), F.col("doc_id").alias("d"), F.col("mark").alias("m"))
    same = (F.col("late") == F.col("l")) & (F.col("bucket") == F.col("b")) & (F.col("mark") == F.col("m")) & F.col("doc_id").eqNullSafe(F.col("d"))
    head_rows = rows.join(F.broadcast(named) if few else named, same).dropDuplicates(["l", "b"]).select("l", "b", F.col("text").alias("head_text"))
    ahead = successors(heads.select(*_BUCKET)).join(head_rows, (F.col("next_late") == F.col("l")) & (F.col("next_bucket") == F.col("b")))
    ahead = cut(ahead.select(*_BUCKET, "head_text", signatures(F.col("head_text")).alias("head_sigs")))
    order = Window.partitionBy(*_BUCKET).orderBy(F.desc_nulls_last("doc_id"), F.desc("mark"))
    looked = rows.withColumn("sigs", signatures(F.col("text"))).select("*", F.lead("text").over(order).alias("lead_text"), F.lead("sigs").over(order).alias("lead_sigs"))
    joined = looked.join(ahead, _BUCKET)
    return joined.select("doc_id", "text", "sigs", F.coalesce("lead_text", "head_text").alias("next_text"), F.coalesce("lead_sigs", "head_sigs").alias("next_sigs"))


def edited(text: Column, next_text: Column) -> Column:
    """The text with its last floor(n / 2) characters replaced by as many, or all, of the next text's first."""
    half = F.floor(F.char_length(text) / 2).cast("int")
    return F.concat(F.left(text, F.char_length(text) - half), F.left(next_text, half))


def edit_report(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text, and how alike neighbours are."""
    rows = with_next(docs, doc_id=doc_id, text=text).withColumn("edited", edited(F.col("text"), F.col("next_text")))
    rows = rows.select("*", signatures(F.col("edited")).alias("edited_sigs"))
    return rows.select(
        "doc_id", F.char_length("text").cast("bigint").alias("n_chars"), F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint_string(F.col("sigs")).alias("fingerprint"), fingerprint_string(F.col("edited_sigs")).alias("edited_fingerprint"),
        likeness(F.col("sigs"), F.col("edited_sigs")).alias("near_edited"), likeness(F.col("sigs"), F.col("next_sigs")).alias("near_next"),
    )


# --------------------------------------------------------------------------- near duplicates


def classes(docs: DataFrame, *, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(doc_id and set_id of each row, set_id and sigs of each different set); set_id hashes the set."""
    rows = docs.select(F.col(doc_id).alias("doc_id"), signatures(F.col(text)).alias("sigs")).withColumn("set_id", F.sha2(fingerprint_string(F.col("sigs")).cast("binary"), 256))
    rows = cut(rows)
    return rows.select("doc_id", "set_id"), rows.select("set_id", "sigs").dropDuplicates(["set_id"])


def similar_pairs(sets: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(a, b, likeness) of all pairs of different sets (columns set_id, sigs) whose likeness is ``threshold`` or more, a < b."""
    sets = sets.where(F.size("sigs") > 0)
    often = sets.select(F.explode("sigs").alias("sig")).groupBy("sig").agg(F.count("*").alias("often"))
    long = sets.select("set_id", F.size("sigs").alias("n"), F.explode("sigs").alias("sig")).join(often, "sig")
    rank = F.row_number().over(Window.partitionBy("set_id").orderBy("often", "sig"))
    # sets at least ``threshold`` alike share a signature among the n - ceil(threshold * n) + 1 rarest of each
    rare = long.withColumn("rank", rank).where(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * F.lit(threshold) - F.lit(1e-9)) + 1)
    part = F.floor(F.log(F.col("n").cast("double")) / F.lit(max(1e-12, -math.log(threshold)))).cast("int")
    left = rare.select(F.col("set_id").alias("a"), F.col("n").alias("n_a"), "sig", part.alias("part"))
    # lengths that can reach the threshold lie in the same partition or the one beside it
    right = rare.select(F.col("set_id").alias("b"), F.col("n").alias("n_b"), "sig", F.explode(F.array(part, part - 1, part + 1)).alias("part"))
    able = (F.col("a") < F.col("b")) & (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * F.lit(threshold) - F.lit(1e-9))
    met = left.join(right, ["sig", "part"]).where(able).select("a", "b").distinct()
    full = met.join(sets.select(F.col("set_id").alias("a"), F.col("sigs").alias("sigs_a")), "a").join(sets.select(F.col("set_id").alias("b"), F.col("sigs").alias("sigs_b")), "b")
    return full.select("a", "b", likeness(F.col("sigs_a"), F.col("sigs_b")).alias("likeness")).where(F.col("likeness") >= F.lit(threshold) - F.lit(1e-12))
