"""Finding new snapshots in an inbox with Structured Streaming.

A snapshot is a folder of part files directly below the inbox, or files directly in the
inbox: one file, or all parts of one write (``part-NNNNN-<id>...``). A file-source stream
with ``trigger(availableNow=True)`` lists what arrived since the last run (its checkpoint
in the shared folder records what was seen) without reading any content; what it saw is
kept as a table, one folder per micro-batch, so a batch that runs again overwrites itself.
The newest snapshot is the one with the latest modification time (ties: the larger name), and
it is read whole - all its files, with the same strict reader as any bulk file - once it is complete:
files named ``*.part``, ``*.tmp`` or ``*.crdownload`` are still being written and are no part of any snapshot.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.plans.session import fs_exists, fs_listing, fs_read, fs_write
from moneytrail.sources import files

LISTED = "path string, modificationTime timestamp, length long, content binary"
SEEN = "path string, snapshot string, modified timestamp"
#: Names of files that a writer has not finished.
UNFINISHED = (".part", ".tmp", ".crdownload")
#: A folder's file that lists its parts, one name per line.
PARTS = "_PARTS"


def snapshot_of(path: Column, inbox: str) -> Column:
    """The folder a file lies in, or for files directly in the inbox the write they are parts of."""
    below = F.regexp_extract(path, "(?:^|/)" + _quoted(inbox) + "/(.+)$", 1)
    part = F.regexp_extract(below, r"^part-\d+-([^/.]*[0-9a-f])(?:-c\d+)?(?:\.[^/]*)?$", 1)
    return (F.when(below.contains("/"), F.substring_index(below, "/", 1))
             .when(part != "", part).otherwise(below))


def _quoted(inbox: str) -> str:
    return "\\Q" + inbox.rstrip("/").rsplit("/", 1)[-1] + "\\E"


def see_new_files(spark: SparkSession, inbox: str, seen: str, checkpoint: str) -> int:
    """Add the files that arrived since the last call to the table ``seen``;
    returns the number of micro-batches (0: nothing new)."""
    batches = []

    def keep(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{seen}/batch={number}")
        batches.append(number)

    found = (spark.readStream.format("binaryFile").schema(LISTED).option("recursiveFileLookup", "true")
             .load(inbox).select("path", F.col("modificationTime").alias("modified"))
             .filter(~F.col("path").rlike(r"\.(part|tmp|crdownload)$")))
    query = (found.select("path", snapshot_of(F.col("path"), inbox).alias("snapshot"), "modified")
             .writeStream.foreachBatch(keep).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return len(batches)


def newest_snapshot(spark: SparkSession, seen: str):
    """(snapshot, modified) of the newest snapshot ever seen, or None."""
    if not fs_exists(spark, seen):
        return None
    times = (spark.read.schema(SEEN).parquet(f"{seen}/batch=*")
             .groupBy("snapshot").agg(F.max("modified").alias("modified")))
    return times.orderBy(F.desc("modified"), F.desc("snapshot")).first()


def is_complete(spark: SparkSession, inbox: str, snapshot: str, kept: str) -> bool:
    """Whether all of a snapshot has arrived.

    A file directly in the inbox is complete under its final name. A folder is complete with a
    ``_SUCCESS`` marker, or when all names that its ``_PARTS`` file lists are there; without either,
    and for parts that lie directly in the inbox, the files must be the same, with the same lengths and
    times, as at the last look, which ``kept`` remembers. A file of an unfinished name keeps
    its folder incomplete."""
    base = inbox.rstrip("/")
    whole = fs_listing(spark, base)
    if snapshot in whole and not whole[snapshot][2]:
        return True
    folder = snapshot in whole
    names = fs_listing(spark, f"{base}/{snapshot}") if folder else {
        n: v for n, v in whole.items() if n.startswith("part-") and snapshot in n}
    if any(n.endswith(UNFINISHED) for n in names):
        return False
    if folder and "_SUCCESS" in names:
        return True
    if folder and PARTS in names:
        listed = fs_read(spark, f"{base}/{snapshot}/{PARTS}").split()
        return all(n in names for n in listed)
    now = {"snapshot": snapshot, "files": {n: list(v[:2]) for n, v in sorted(names.items())}}
    before = json.loads(fs_read(spark, kept)) if fs_exists(spark, kept) else None
    fs_write(spark, kept, json.dumps(now))
    return before == now


def read_snapshot(spark: SparkSession, inbox: str, seen: str, snapshot: str, dataset: str) -> DataFrame:
    """All rows of a snapshot. A folder is read as it is now, parts that came later included."""
    folder = f"{inbox.rstrip('/')}/{snapshot}"
    rows = spark.read.schema(SEEN).parquet(f"{seen}/batch=*").filter(F.col("snapshot") == snapshot)
    paths = sorted({r["path"] for r in rows.select("path").collect()})  # the parts of one snapshot
    if any(f"/{snapshot}/" in p for p in paths):
        return files.scan_bulk(spark, folder, dataset)
    return files.scan_bulk(spark, paths, dataset)
