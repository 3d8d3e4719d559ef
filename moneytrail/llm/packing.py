"""Documents packed into sequences of a fixed number of tokens, by the sum of squares.

A document is its token ids and an end id. Only longer ones than a sequence are cut, into whole sequences; what is left
over is their first piece. Pieces are placed longest first: of the open sequences that have room, a piece goes where the sum
over all residual gaps of (open sequences with that gap) squared becomes smallest (ties: the smallest gap); a new sequence is
opened only where none has room.

The rule looks at lengths alone, and a length is at most ``capacity``, so the plan is made from the counts of pieces per length
(``capacity`` numbers, whatever the corpus): equal lengths are placed in up to ``BATCHES`` batches, each batch where its
pieces belong by the rule. Sequences of one make-up stay together as a recipe and a number of times; a batch splits one
recipe at most, so recipes number at most some capacity x ``BATCHES`` and the table of their places, which is broadcast, doesn't grow
with the corpus. Tasks count their pieces per length; a window over (length, task) turns the counts into ranks, and
the rank of a piece among those of its length is its place in the table. No task holds more than its own pieces.

Defined cases: null and empty texts are their end id alone; null ids and repeated rows are documents like any other; a text of any length
is read whole, by runs of rows of ``common.PIECE_BYTES``, one row at least; an empty table packs into nothing; other columns are not read.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from moneytrail.llm.common import bound_batches, row_ranges, whole, written
from moneytrail.llm.token_file import _kept_units

CAPACITY, END_ID = 1024, 2
#: Batches in which the pieces of one length are placed.
BATCHES = 32
_RANK_BITS = 44

Recipe = tuple[tuple[int, ...], int]


def recipes(counts: dict[int, int], capacity: int = CAPACITY, batches: int = BATCHES) -> list[Recipe]:
    """(lengths of a sequence, number of such sequences) for ``counts`` of pieces per length."""
    open_with: list[list[Recipe]] = [[] for _ in range(capacity + 1)]  # by tokens held; the last are full
    n = np.zeros(capacity + 1, np.int64)
    for length in sorted(counts, reverse=True):
        left, batch = counts[length], max(1, counts[length] // batches)
        while left:
            held = np.flatnonzero(n[1 : capacity - length + 1]) + 1
            if len(held):
                after = held + length
                change = np.where(after == capacity, 1 - 2 * n[held], 2 * (n[after] - n[held] + 1))
                at = int(held[len(held) - 1 - int(np.argmin(change[::-1]))])
                some = int(min(batch, left, n[at]))
                _move(open_with, at, length, some)
                n[at] -= some
            else:
                at, some = 0, min(batch, left)
                open_with[length].append(((length,), some))
            if at + length < capacity:
                n[at + length] += some
            left -= some
    return [r for level in open_with for r in level]


def _move(open_with: list[list[Recipe]], at: int, length: int, wanted: int) -> None:
    """Give ``wanted`` sequences that hold ``at`` tokens one more piece."""
    while wanted:
        lengths, times = open_with[at].pop()
        if times > wanted:
            open_with[at].append((lengths, times - wanted))
        some = min(times, wanted)
        open_with[at + length].append(((*lengths, length), some))
        wanted -= some


def places(found: list[Recipe]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(key, first sequence, offset) of stretches of places, by key: its length and the rank of its first piece among those."""
    ranks: dict[int, int] = {}
    rows, sequence = [], 0
    for lengths, times in found:
        offset = 0
        for length in lengths:
            rank = ranks.get(length, 0)
            rows.append((length << _RANK_BITS | rank, sequence, offset))
            ranks[length] = rank + times
            offset += length
        sequence += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 3)
    return table[:, 0].copy(), table[:, 1].copy(), table[:, 2].copy()


def piece_sizes(n: int, capacity: int) -> list[int]:
    """A document's pieces: whole sequences behind what is left over."""
    return ([n % capacity] if n % capacity else []) + [capacity] * (n // capacity)


_PIECE = "part int, doc_id bigint, piece int, start bigint, length bigint, nth bigint"


def _cut(tokenizer_json, capacity: int, end_id: int, digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, seen = _kept_units(tokenizer_json.value), np.zeros(capacity + 1, np.int64)
        for batch in batches:
            part, doc_ids = whole(batch.column("part")), whole(batch.column("doc_id"))
            for first, end, data, offsets in row_ranges(whole(batch.column("text"))):
                ids, counts = units.encode(data, offsets)
                ends = np.cumsum(counts)
                ids[ends - 1] = end_id
                sizes = [piece_sizes(n, capacity) for n in counts.tolist()]
                n_pieces = np.array([len(s) for s in sizes])
                lengths = np.concatenate([np.array(s, np.int64) for s in sizes])
                stops = np.cumsum(lengths)
                starts = stops - lengths
                nth = seen[lengths] + _running(lengths)
                seen += np.bincount(lengths, minlength=capacity + 1)
                rows = np.repeat(np.arange(len(sizes)), n_pieces)
                each = (ids[a:b].astype("<u4") for a, b in zip(starts.tolist(), stops.tolist(), strict=True))
                value = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()) if digest else pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [part.take(pa.array(rows + first)), doc_ids.take(pa.array(rows + first)), pa.array(_running(rows).astype(np.int32)), pa.array(starts - (ends - counts)[rows]), pa.array(lengths), pa.array(nth), value],
                    ["part", "doc_id", "piece", "start", "length", "nth", "value"],
                )

    return run


def _running(keys: np.ndarray) -> np.ndarray:
    """How many equal keys stand before each."""
    order = np.argsort(keys, kind="stable")
    fresh = np.flatnonzero(np.diff(keys[order], prepend=-1))
    out = np.empty(len(keys), np.int64)
    out[order] = np.arange(len(keys)) - np.repeat(fresh, np.diff(np.append(fresh, len(keys))))
    return out


def _place(table):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, sequences, offsets = table.value
        for batch in batches:
            key = batch.column("length").to_numpy() << _RANK_BITS | batch.column("rank").to_numpy()
            at = np.searchsorted(keys, key, "right") - 1
            kept = [batch.column(c) for c in ("doc_id", "piece", "start", "length", "value")]
            yield pa.RecordBatch.from_arrays([*kept, pa.array(sequences[at] + key - keys[at]), pa.array(offsets[at])], ["doc_id", "piece", "start", "length", "value", "sequence_id", "offset"])

    return run


def pack(docs: DataFrame, *, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", capacity: int = CAPACITY, end_id: int = END_ID, digest: bool = False) -> DataFrame:
    """doc_id, piece, start, length, ids (or, as a digest, ids_crc32), sequence_id and offset of each piece."""
    spark = docs.sparkSession
    bound_batches(spark)
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())  # a vocabulary: a few MB
    kind = "bigint" if digest else "array<int>"
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text")).withColumn("part", F.spark_partition_id())
    pieces = written(rows.mapInArrow(_cut(vocabulary, capacity, end_id, digest), f"{_PIECE}, value {kind}"), "pieces")
    per_task = pieces.groupBy("length", "part").agg(F.count("*").alias("n"))
    counts = {r["length"]: r["n"] for r in per_task.groupBy("length").agg(F.sum("n").alias("n")).collect()}  # at most ``capacity`` rows
    before = F.coalesce(F.sum("n").over(Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranked = pieces.join(per_task.select("length", "part", before.alias("before")), ["length", "part"]).withColumn("rank", F.col("before") + F.col("nth"))
    table = spark.sparkContext.broadcast(places(recipes(counts, capacity)))
    out = ranked.select("doc_id", "piece", "start", "length", "value", "rank").mapInArrow(_place(table), f"doc_id bigint, piece int, start bigint, length bigint, value {kind}, sequence_id bigint, offset bigint")
    return out.withColumnRenamed("value", "ids_crc32" if digest else "ids")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids, doc_ids, lengths): the packed sequences, each at most ``capacity`` tokens."""
    parts = F.array_sort(F.collect_list(F.struct("offset", "doc_id", "length", "ids")))
    return packed.groupBy("sequence_id").agg(parts.alias("p")).select("sequence_id", F.flatten("p.ids").alias("ids"), F.col("p.doc_id").alias("doc_ids"), F.col("p.length").alias("lengths"))
