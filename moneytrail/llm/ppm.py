"""Language-model scoring: prediction by partial matching over bytes, beside a word base line.

The model. Every training text (A-Z lowered, an end sign behind it) is read byte by byte; each byte is counted in its
context of the ``ORDER`` bytes before it. The counts of shorter contexts are sums of those, which makes the
trie: a byte is looked for in the longest context that was seen, and where it did not follow there an escape is
paid (method C: as likely as the context has different successors) and the next shorter context is asked, with
all successors of the longer one excluded from its counts, down to equal shares of all unseen signs. The code
length of a text is the sum over its bytes and its end.

How it is gathered. Documents are read in chunks. A chunk counts its own distinct words and contexts with numpy and
deals them, packed, to buckets by hash; a bucket adds up what all chunks say about its keys. So what is shuffled
are per-chunk distinct keys, and a very frequent word is one entry a chunk. Word totals go back to the chunks
the same way, so no vocabulary is broadcast. The trie is broadcast in shards of at most ``SHARD_CONTEXTS``
entries (whole families of contexts with the same last two bytes): one scan of the texts a shard, whose partial code lengths are
added up. Usually there is one.

Words of the base line are known by 64-bit hashes.

Defined cases: a null or empty text is its end alone; a null id counts as the empty text for the split; repeated
rows all count and are all scored; without training texts all signs are equally likely; an empty table gives an
empty result; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import row_ranges, whole, written
from moneytrail.llm.lookup import Table
from moneytrail.llm.words import LOWER, NONSPACE, Words, mix

ORDER = 5
#: Signs behind and before a text; UTF-8 has no such bytes.
END, PAD = 0xFE, 0xFF
#: Signs that can follow: all bytes but the pad.
SIGNS = 255
CHUNK_BYTES = 8 << 20
RUN_BYTES = 1 << 20
#: Bytes of text for which one bucket is made.
BUCKET_TEXT = 64 << 20
LEAST_BUCKETS = 64
SHARD_CONTEXTS = 2_000_000

# --------------------------------------------------------------------------- contexts


def laid_out(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Texts with ``ORDER`` pads before and an end behind each, and where each begins (and the end of all)."""
    n = len(offsets) - 1
    places = offsets + (ORDER + 1) * np.arange(n + 1)
    out = np.full(len(data) + (ORDER + 1) * n, PAD, np.uint8)
    out[np.arange(len(data)) + np.repeat(ORDER + (ORDER + 1) * np.arange(n), np.diff(offsets))] = LOWER[data]
    out[places[1:] - 1] = END
    return out, places


def context_runs(stream: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(positions, their last ORDER + 1 bytes as one number) for all signs but pads, run by run."""
    for a in range(0, len(stream), RUN_BYTES):
        b = min(len(stream), a + RUN_BYTES)
        low = max(0, a - ORDER)
        part = stream[low:b].astype(np.uint64)
        grams = part[a - low :].copy()
        for j in range(1, ORDER + 1):
            before = part[max(0, a - low - j) : max(0, b - low - j)]
            grams[len(grams) - len(before) :] |= before << np.uint64(8 * j)
        at = np.flatnonzero(stream[a:b] != PAD)
        yield at + a, grams[at]


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with their counts added up."""
    if not len(keys):
        return keys, counts
    order = np.argsort(keys, kind="stable")
    keys, counts = keys[order], counts[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    return keys[first], np.add.reduceat(counts, first)


class Trie:
    """Contexts of 0 to ORDER bytes with what follows them, for some of the last two bytes."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray):
        """``grams``: distinct runs of ORDER + 1 bytes, sorted; ``pairs``: distinct runs of two bytes of *all* texts, sorted."""
        levels: list = [None] * (ORDER + 1)
        levels[ORDER] = grams, counts.astype(np.float64)
        for k in range(ORDER - 1, 1, -1):
            keys, n = levels[k + 1]
            levels[k] = summed(keys & np.uint64((1 << 8 * (k + 1)) - 1), n)
        levels[1] = pairs, pair_counts.astype(np.float64)
        levels[0] = summed(pairs & np.uint64(255), levels[1][1])
        self.symbols, self.contexts, self.stats, self.counts = [], [], [], []
        for k, (keys, n) in enumerate(levels):
            contexts, of = np.unique(keys >> np.uint64(8), return_inverse=True)
            total, distinct = np.bincount(of, n, len(contexts)), np.bincount(of, minlength=len(contexts)).astype(np.float64)
            below = np.zeros(len(contexts))
            if k:  # what the next shorter context counts for the same successors
                shorter, n_shorter = levels[k - 1]
                below = np.bincount(of, n_shorter[np.searchsorted(shorter, keys & np.uint64((1 << 8 * k) - 1))], len(contexts))
            self.symbols.append(Table(keys))
            self.contexts.append(Table(contexts))
            self.stats.append(np.stack([total, distinct, below], 1))
            self.counts.append(n)
        total, distinct = self.stats[ORDER][np.searchsorted(self.contexts[ORDER].keys[: self.contexts[ORDER].n], grams >> np.uint64(8)), :2].T if len(grams) else (np.zeros(0), np.zeros(0))
        self.direct = np.log10(self.counts[ORDER] / (total + distinct)) if len(grams) else np.zeros(0)

    def log10(self, grams: np.ndarray) -> np.ndarray:
        """log10 of the probability of each run's last byte after the others."""
        out = np.zeros(len(grams))
        at = self.symbols[ORDER].find(grams)
        known = at >= 0
        out[known] = self.direct[at[known]]
        rest = np.flatnonzero(~known)
        excluded = np.zeros((len(rest), 2))  # counts and number of successors of the longer context
        for k in range(ORDER, -1, -1):
            if not len(rest):
                return out
            own = grams[rest] & np.uint64((1 << 8 * (k + 1)) - 1)
            context = self.contexts[k].find(own >> np.uint64(8))
            seen = context >= 0
            stats = np.zeros((len(rest), 3))
            stats[seen] = self.stats[k][context[seen]]
            total, distinct = stats[:, 0] - excluded[:, 0], stats[:, 1] - excluded[:, 1]
            symbol = self.symbols[k].find(own)
            hit = symbol >= 0
            out[rest[hit]] += np.log10(self.counts[k][symbol[hit]] / (total + distinct)[hit])
            escape = seen & ~hit & (distinct > 0)
            out[rest[escape]] += np.log10(distinct[escape] / (total + distinct)[escape])
            excluded = np.where(seen[:, None], np.stack([stats[:, 2], stats[:, 1]], 1), excluded)[~hit]
            rest = rest[~hit]
        out[rest] -= np.log10(np.maximum(1.0, SIGNS - (excluded[:, 1] if len(self.stats[0]) else 0.0)))
        return out


class Shard:
    """What is broadcast of a trie: its grams and counts. A worker process builds the trie once."""

    def __init__(self, mine: np.ndarray, grams: np.ndarray, counts: np.ndarray, pairs: np.ndarray, pair_counts: np.ndarray):
        small = np.uint32 if not len(counts) or counts.max() < 1 << 32 else np.uint64
        self.mine, self.parts, self.built = mine, (grams, counts.astype(small), pairs, pair_counts), None

    def __getstate__(self) -> dict:
        return {**self.__dict__, "built": None}

    def trie(self) -> Trie:
        if self.built is None:
            self.built = Trie(*self.parts)
        return self.built


# --------------------------------------------------------------------------- chunks

_CHUNK = "chunk bigint, doc_ids array<bigint>, keys array<bigint>, held array<boolean>, sizes array<bigint>, refs binary, hashes binary, counts binary, grams binary, gram_counts binary"


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words, number = Words(NONSPACE), TaskContext.get().partitionId() << 32
    for batch in batches:
        doc_ids, keys, held = (batch.column(c) for c in ("doc_id", "key", "held"))
        learn = ~np.array(held.to_numpy(zero_copy_only=False), bool)
        for first, end, data, offsets in row_ranges(whole(batch.column("text")), CHUNK_BYTES):
            _, _, hashes, of = words.split(data, offsets)
            distinct, refs = np.unique(hashes, return_inverse=True)
            mine = learn[first:end]
            counts = np.bincount(refs, mine[of], len(distinct)).astype("<u8")
            parts = []
            stream, places = laid_out(data, offsets)
            for at, grams in context_runs(stream):
                use = mine[np.searchsorted(places, at, "right") - 1] if not mine.all() else slice(None)
                parts.append(np.unique(grams[use], return_counts=True))
            grams, n = summed(*(np.concatenate(x) for x in zip(*parts, strict=True))) if parts else (np.zeros(0, np.uint64), np.zeros(0, np.int64))
            sizes = np.bincount(of, minlength=end - first)
            values = {"refs": refs.astype("<u4"), "hashes": distinct.astype("<u8"), "counts": counts, "grams": grams.astype("<u8"), "gram_counts": n.astype("<u8")}
            lists = [pa.array([x.to_pylist()], pa.list_(x.type)) for x in (doc_ids.slice(first, end - first), keys.slice(first, end - first), held.slice(first, end - first))]
            yield pa.RecordBatch.from_arrays([pa.array([number], pa.int64()), *lists, pa.array([sizes.tolist()], pa.list_(pa.int64())), *[pa.array([v.tobytes()], pa.binary()) for v in values.values()]], ["chunk", "doc_ids", "keys", "held", "sizes", *values])
            number += 1


def _dealt(keys: str, counts: str, bits: int):
    """Each chunk's keys and counts as one row a bucket, by the leading bits of the mixed key (word hashes are mixed already)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                key, n = np.frombuffer(row[keys], "<u8"), np.frombuffer(row[counts], "<u8")
                if keys == "hashes":
                    edges = np.searchsorted(key, np.arange(1, 1 << bits, dtype=np.uint64) << np.uint64(64 - bits))
                else:
                    bucket = (mix(key) >> np.uint64(64 - bits)).astype(np.int64)
                    order = np.argsort(bucket, kind="stable")
                    key, n, edges = key[order], n[order], np.searchsorted(bucket[order], np.arange(1, 1 << bits))
                parts = [(b, x, y) for b, (x, y) in enumerate(zip(np.split(key, edges), np.split(n, edges), strict=True)) if len(x)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([b for b, _, _ in parts], pa.int32()), pa.array([row["chunk"]] * len(parts), pa.int64()), pa.array([x.tobytes() for _, x, _ in parts], pa.binary()), pa.array([y.tobytes() for _, _, y in parts], pa.binary())],
                    ["bucket", "chunk", "keys", "counts"],
                )

    return run


_DEALT = "bucket int, chunk bigint, keys binary, counts binary"


def _word_totals(group: pa.Table) -> pa.Table:
    """For each chunk the totals of its keys, in their order; the first row has the bucket's sums."""
    parts = [np.frombuffer(x.as_py(), "<u8") for x in group["keys"]]
    sizes = np.array([len(p) for p in parts])
    distinct, of = np.unique(np.concatenate(parts), return_inverse=True)
    total = np.bincount(of, np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in group["counts"]]).astype(np.float64), len(distinct))
    back = np.split(total[of].astype("<u8"), np.cumsum(sizes)[:-1])
    first = np.arange(len(parts)) == 0
    return pa.table({"chunk": group["chunk"], "bucket": group["bucket"], "totals": pa.array([b.tobytes() for b in back], pa.binary()), "n": pa.array(np.where(first, int(total.sum()), 0)), "v": pa.array(np.where(first, int((total > 0).sum()), 0))})


def _gram_totals(group: pa.Table) -> pa.Table:
    keys, counts = summed(*(np.concatenate([np.frombuffer(x.as_py(), "<u8") for x in group[c]]) for c in ("keys", "counts")))
    return pa.table({"grams": pa.array([keys.astype("<u8").tobytes()], pa.binary()), "counts": pa.array([counts.astype("<u8").tobytes()], pa.binary()), "size": pa.array([len(keys)], pa.int64())})


def _marginal(shift: int, mask: int):
    """Sums of the counts, and numbers of the grams, by some of the gram's bits."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                part = (np.frombuffer(row["grams"], "<u8") >> np.uint64(shift)) & np.uint64(mask)
                n = np.bincount(part.astype(np.int64), np.frombuffer(row["counts"], "<u8").astype(np.float64), mask + 1)
                entries = np.bincount(part.astype(np.int64), minlength=mask + 1)
                some = np.flatnonzero(entries)
                yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some].astype(np.int64)), pa.array(entries[some].astype(np.int64))], ["pair", "n", "entries"])

    return run


def _by_pair(grams: DataFrame, shift: int) -> list:
    """At most 65,536 rows (pair, n, entries), sorted."""
    found = grams.select("grams", "counts").mapInArrow(_marginal(shift, 0xFFFF), "pair bigint, n bigint, entries bigint")
    return sorted((r["pair"], r["n"], r["entries"]) for r in found.groupBy("pair").agg(F.sum("n").alias("n"), F.sum("entries").alias("entries")).collect())


def shard_plan(entries: list[tuple[int, int]], limit: int) -> list[list[int]]:
    """Families (last two context bytes, entries) put together up to ``limit`` entries, one family at least."""
    plan, total = [[]], 0
    for family, n in entries:
        if plan[-1] and total + n > limit:
            plan.append([])
            total = 0
        plan[-1].append(family)
        total += n
    return plan


def shards(grams: DataFrame, limit: int = SHARD_CONTEXTS) -> Iterator[Shard]:
    """The trie in shards of some of the 65,536 last two context bytes; unseen ones go to the first."""
    last = _by_pair(grams, 0)
    pairs, pair_counts = np.array([p for p, _, _ in last], np.uint64), np.array([n for _, n, _ in last], np.int64)
    for i, families in enumerate(shard_plan([(p, e) for p, _, e in _by_pair(grams, 8)], limit)):
        mine = np.zeros(1 << 16, bool)
        mine[families] = True

        def pick(batches: Iterator[pa.RecordBatch], mine=mine) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for row in batch.to_pylist():
                    key, n = np.frombuffer(row["grams"], "<u8"), np.frombuffer(row["counts"], "<u8")
                    use = mine[(key >> np.uint64(8)) & np.uint64(0xFFFF)]
                    yield pa.RecordBatch.from_arrays([pa.array([key[use].tobytes()], pa.binary()), pa.array([n[use].tobytes()], pa.binary())], ["grams", "counts"])

        rows = grams.select("grams", "counts").mapInArrow(pick, "grams binary, counts binary").collect()  # up to ``limit`` entries
        keys, counts = (np.concatenate([np.frombuffer(r[c], "<u8") for r in rows] or [np.zeros(0, np.uint64)]) for c in ("grams", "counts"))
        order = np.argsort(keys)
        if i == 0:
            seen = np.zeros(1 << 16, bool)
            seen[[p for p, _, _ in _by_pair(grams, 8)]] = True
            mine = mine | ~seen
        yield Shard(mine, keys[order].astype(np.uint64), counts[order], pairs, pair_counts)


def _scorer(shard):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mine, trie = shard.value.mine, shard.value.trie()
        every = mine.all()
        for batch in batches:
            out = []
            for _, _, data, offsets in row_ranges(whole(batch.column("text"))):
                stream, places = laid_out(data, offsets)
                total = np.zeros(len(offsets) - 1)
                for at, grams in context_runs(stream):
                    if not every:
                        use = mine[(grams >> np.uint64(8)) & np.uint64(0xFFFF)]
                        at, grams = at[use], grams[use]
                    if len(at):
                        total += np.bincount(np.searchsorted(places, at, "right") - 1, trie.log10(grams), len(total))
                out.append(total)
            yield pa.RecordBatch.from_arrays([batch.column("key"), pa.array(np.concatenate(out) if out else np.zeros(0))], ["key", "part"])

    return run


def score(docs: DataFrame, held_out: Column, *, doc_id: str = "doc_id", text: str = "text", shard_contexts: int = SHARD_CONTEXTS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score (log10) of every row; rows for which ``held_out`` is not true are learned from."""
    spark = docs.sparkSession
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), F.xxhash64(F.col(doc_id), F.coalesce(F.col(text), F.lit(""))).alias("key"), F.coalesce(held_out, F.lit(False)).alias("held"))
    chunks = written(rows.mapInArrow(_chunks, _CHUNK), "ppm-chunks")
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    bits = max(LEAST_BUCKETS, size // BUCKET_TEXT).bit_length() - 1

    dealt = chunks.select("chunk", "hashes", "counts").mapInArrow(_dealt("hashes", "counts", bits), _DEALT)
    totals = written(dealt.groupBy("bucket").applyInArrow(_word_totals, "chunk bigint, bucket int, totals binary, n bigint, v bigint"), "ppm-words")
    n, v = totals.agg(F.sum("n"), F.sum("v")).first()
    ends = chunks.select(F.sum(F.size(F.filter("held", lambda h: ~h)).cast("bigint"))).first()[0] or 0
    n, v = (n or 0) + ends, (v or 0) + (ends > 0)
    end_log, whole_log = float(np.log10(ends + 1)), float(np.log10(n + v + 1))

    def base(left: pa.Table, right: pa.Table) -> pa.Table:
        row = left.to_pylist()[0]
        parts = sorted(zip(right["bucket"].to_pylist(), right["totals"].to_pylist(), strict=True))
        count = np.frombuffer(b"".join(t for _, t in parts), "<u8")
        refs, sizes = np.frombuffer(row["refs"], "<u4"), np.array(row["sizes"], np.int64)
        of = np.repeat(np.arange(len(sizes)), sizes)
        logs = np.bincount(of, np.log10(count + 1.0)[refs], len(sizes)) + end_log - (sizes + 1) * whole_log
        known = np.bincount(of, (count > 0)[refs], len(sizes)).astype(np.int64) + (ends > 0)
        return pa.table({"key": pa.array(row["keys"], pa.int64()), "doc_id": pa.array(row["doc_ids"], pa.int64()), "held_out": pa.array(row["held"], pa.bool_()), "n_tokens": pa.array(sizes + 1), "n_known": pa.array(known), "base_score": pa.array(logs)})

    chunk_rows = chunks.select("chunk", "doc_ids", "keys", "held", "sizes", "refs")
    word_rows = totals.select("chunk", "bucket", "totals").union(chunk_rows.select("chunk", F.lit(-1), F.lit(b"")))  # a chunk without words too
    based = chunk_rows.groupBy("chunk").cogroup(word_rows.groupBy("chunk")).applyInArrow(base, "key bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double")

    dealt = chunks.select("chunk", "grams", "gram_counts").mapInArrow(_dealt("grams", "gram_counts", bits), _DEALT)
    grams = written(dealt.groupBy("bucket").applyInArrow(_gram_totals, "grams binary, counts binary, size bigint"), "ppm-contexts")
    parts = None
    for number, shard in enumerate(shards(grams, shard_contexts)):
        part = rows.select("key", "text").mapInArrow(_scorer(spark.sparkContext.broadcast(shard)), "key bigint, part double").withColumn("shard", F.lit(number))
        parts = part if parts is None else parts.union(part)
    scored = parts.dropDuplicates(["key", "shard"]).groupBy("key").agg(F.sum("part").alias("score"))
    return based.join(scored, "key").select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("bigint").alias("train_tokens"), "base_score", "score")
