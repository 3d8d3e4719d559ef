"""SimHash near-duplicates: fingerprints of word shingles, linked within a Hamming radius.

A text's A-Z are lowered, its words are cut at white space, and the XXH64 (seed 42) of each run of
``shingle`` words votes on 64 bits. Fingerprints at most ``radius`` bits apart are linked.

Search. The 64 bits are cut into radius + 2 blocks. Two fingerprints within the radius agree on two
whole blocks at least, so each *distinct* fingerprint goes to one bucket per pair of blocks, and
only bucket mates are compared. A bucket of more than ``BUCKET`` members is dealt into parts, and
every two parts meet in a task of their own: no bucket is cut short and none is one task's load.
In a task the fingerprints lie as 64 vertical bit planes. All distances to the d-th next neighbour
are counted at once: carry-save counters take one plane after another, and a word of 64 positions is
abandoned as soon as all its counters have passed the radius. A bucket gives a spanning forest of
its links, not all of them, which is all that components need.

Defined cases: null and empty texts, and texts of white space only, have fingerprint zero and link
like any other; a text of fewer words than a shingle is one shingle; repeated rows are copies of one
another; null doc_ids join groups but never name one unless the group has no other id; an empty
table gives an empty result; other columns, whatever their names, are kept by ``keep_one``.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import cut, whole
from moneytrail.llm.components import components, with_least

SHINGLE, RADIUS, SEED = 3, 3, 42
#: Members of one bucket that are compared in one task.
BUCKET = 4096
#: Bytes of a long text that are read at once.
RUN_BYTES = 1 << 21
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def fingerprint(text: bytes, shingle: int = SHINGLE) -> int:
    """The 64-bit SimHash of a UTF-8 text."""
    ones, n, at, words = np.zeros(64, np.int64), 0, 0, []
    while at < len(text):
        end = at + RUN_BYTES
        end = m.start() if end < len(text) and (m := _SPACE.search(text, end)) else len(text)
        words = words[1 - shingle :] if shingle > 1 and n else words if not n else []
        words += text[at:end].lower().split()
        at = end
        if len(words) >= shingle:
            h = _shingle_hashes(words, shingle)
            ones += _bit_counts(h)
            n += len(h)
    if not n and words:
        h = _shingle_hashes(words, len(words))
        ones, n = _bit_counts(h), 1
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0]) if n else 0


def _shingle_hashes(words: list[bytes], shingle: int) -> np.ndarray:
    import xxhash

    joined = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(sizes + 1) - 1
    n, digest = len(words) - shingle + 1, xxhash.xxh64_intdigest
    spans = zip((ends - sizes)[:n].tolist(), ends[shingle - 1 :].tolist(), strict=True)
    return np.fromiter((digest(joined[s:e], SEED) for s, e in spans), np.uint64, n)


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    out = np.zeros(64, np.int64)
    for i in range(0, len(hashes), 1 << 14):
        bits = np.unpackbits(hashes[i : i + (1 << 14)].astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        out += bits.sum(0, dtype=np.uint32)
    return out


def add_fingerprint(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE) -> DataFrame:
    """``row_key`` (of id and text), ``doc_id`` and ``fp`` (the fingerprint's 64 bits as a long) of each row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = whole(batch.column("text"))
            fps = np.fromiter((fingerprint(x.as_buffer().to_pybytes(), shingle) for x in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([batch.column("row_key"), batch.column("doc_id"), pa.array(fps.view(np.int64))], ["row_key", "doc_id", "fp"])

    inputs = docs.select(row_key(F.col(doc_id), F.col(text)).alias("row_key"), F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).cast("binary").alias("text"))
    return inputs.mapInArrow(run, "row_key bigint, doc_id bigint, fp bigint")


def row_key(doc_id: Column, text: Column) -> Column:
    """Equal for rows of equal id and text."""
    return F.xxhash64(doc_id, text)


def bucket_keys(fp: Column, radius: int) -> Column:
    """The keys of the buckets that a fingerprint goes to: one for each two of radius + 2 blocks."""
    edges = [64 * i // (radius + 2) for i in range(radius + 3)]
    blocks = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    signed = lambda x: x - (1 << 64) if x >> 63 else x
    return F.array(*[F.xxhash64(F.lit(k), fp.bitwiseAND(F.lit(signed(x | y)).cast("bigint"))) for k, (x, y) in enumerate(combinations(blocks, 2))])


def near_pairs(fps: np.ndarray, sizes: np.ndarray, radius: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs (t, t + d) within the radius and in the same group, for d = 1, 2, ...

    ``fps`` lists the groups one after another, ``sizes`` their lengths, longest first.
    """
    n, top = len(fps), int(sizes[0]) if len(sizes) else 0
    bits = np.unpackbits(fps.astype("<u8").view(np.uint8).reshape(n, 8), axis=1, bitorder="little")
    planes = _packed(bits.T, -(-n // 64) + top // 64 + 2)
    left = np.concatenate([np.arange(s - 1, -1, -1) for s in sizes.tolist()]) if n else np.zeros(0, np.int64)
    ends = np.cumsum(sizes)
    n_counters = max(1, radius.bit_length())
    for d in range(1, top):
        upto = int(ends[np.searchsorted(-sizes, -d, "left") - 1])  # groups longer than d
        live = np.arange(-(-upto // 64))
        over = ~_packed((left[:upto] >= d)[None, :], len(live))[0]
        counters = [np.zeros(len(live), np.uint64) for _ in range(n_counters)]
        q, r = divmod(d, 64)
        for b in range(64):
            if b % 4 == 0 and b:  # abandon words of which all 64 positions are beyond the radius
                keep = over != ~np.uint64(0)
                if not keep.all():
                    live, over, counters = live[keep], over[keep], [c[keep] for c in counters]
                    if not len(live):
                        break
            p = planes[b]
            other = p[live + q] >> np.uint64(r)
            if r:
                other = other | (p[live + q + 1] << np.uint64(64 - r))
            carry = p[live] ^ other
            for k, c in enumerate(counters):
                counters[k], carry = c ^ carry, c & carry
            over = over | carry
        if not len(live):
            continue
        equal, more = ~np.uint64(0), np.uint64(0)
        for k in reversed(range(n_counters)):
            if radius >> k & 1:
                equal = equal & counters[k]
            else:
                more, equal = more | (equal & counters[k]), equal & ~counters[k]
        near = ~(over | more)
        hit = np.flatnonzero(near)
        if len(hit):
            at = np.flatnonzero(np.unpackbits(near[hit].astype("<u8").view(np.uint8), bitorder="little"))
            t = live[hit][at // 64] * 64 + at % 64
            yield t, t + d


def _packed(bits: np.ndarray, words: int) -> np.ndarray:
    """Rows of bits as rows of ``words`` 64-bit words."""
    out = np.zeros((len(bits), words * 8), np.uint8)
    packed = np.packbits(bits, axis=1, bitorder="little")
    out[:, : packed.shape[1]] = packed
    return out.view("<u8").astype(np.uint64, copy=False)


def forest(fps: np.ndarray, sizes: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
    """(member, smallest index of its linked group) for all members that are not that index themselves."""
    root = np.arange(len(fps))
    for t, u in near_pairs(fps, sizes, radius):
        while True:
            a, b = root[t], root[u]
            apart = a != b
            if not apart.any():
                break
            t, u, a, b = t[apart], u[apart], a[apart], b[apart]
            np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
            while (flat := root[root]).tobytes() != root.tobytes():
                root = flat
    moved = np.flatnonzero(root != np.arange(len(fps)))
    return moved, root[moved]


def _linker(radius: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups = whole(batch.column("members"))
            sizes, fps = np.diff(groups.offsets.to_numpy()), groups.flatten().to_numpy().view(np.uint64)
            starts = np.cumsum(sizes) - sizes
            order = np.argsort(-sizes, kind="stable")
            lined = np.concatenate([fps[a : a + s] for a, s in zip(starts[order].tolist(), sizes[order].tolist(), strict=True)]) if len(fps) else fps
            a, b = forest(lined, sizes[order], radius)
            yield pa.RecordBatch.from_arrays([pa.array(lined[a].view(np.int64)), pa.array(lined[b].view(np.int64))], ["a", "b"])

    return run


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """Links (a, b) that join all fingerprints (column fp, each once) within the radius of one another, some repeated."""
    keyed = distinct.select("fp", F.explode(bucket_keys(F.col("fp"), radius)).alias("key"))
    shared = keyed.groupBy("key").agg(F.count("*").alias("n")).where("n > 1")
    parts = F.ceil(F.col("n") / F.lit(bucket)).cast("int")
    part = F.pmod(F.xxhash64("fp", F.lit(1)), parts).cast("int")
    met = F.explode(F.transform(F.sequence(F.lit(0), parts - 1), lambda j: F.struct(F.least(part, j).alias("i"), F.greatest(part, j).alias("j")))).alias("m")
    grouped = keyed.join(shared, "key").select("key", "fp", met).groupBy("key", "m").agg(F.sort_array(F.collect_list("fp")).alias("members"))  # in order: links lead to the smallest
    return grouped.where(F.size("members") > 1).select("members").mapInArrow(_linker(radius), "a bigint, b bigint")


def groups(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", shingle: int = SHINGLE, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """row_key, doc_id, fp, component_id (the smallest doc_id of the row's group) and group (its smallest fingerprint) of each row."""
    rows = cut(add_fingerprint(docs, text=text, doc_id=doc_id, shingle=shingle))
    distinct = rows.groupBy("fp").agg(F.min("doc_id").alias("first_id"))
    linked = components(links(distinct.select("fp"), radius, bucket)).join(distinct, F.col("node") == F.col("fp")).select("fp", "root", "first_id")
    of = with_least(linked, "root", "first_id", "fp", "component_id").select(F.col("fp").alias("node"), "root", "component_id")
    each = distinct.join(of, F.col("fp") == F.col("node"), "left")
    each = each.select("fp", F.when(F.col("root").isNull(), F.col("first_id")).otherwise(F.col("component_id")).alias("component_id"), F.coalesce("root", "fp").alias("group"))
    return rows.join(cut(each), "fp").select("row_key", "doc_id", "fp", "component_id", "group")


def keep_one(docs: DataFrame, *, text: str = "text", doc_id: str = "doc_id", **options) -> DataFrame:
    """The input rows, one of each group: that with the smallest doc_id (rows that tie: any one)."""
    found = groups(docs, text=text, doc_id=doc_id, **options)
    first = found.groupBy("group").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "row_key")).alias("f")).select(F.col("f.row_key").alias("_kept"))
    keyed = docs.select(F.struct("*").alias("row"), row_key(F.col(doc_id), F.col(text)).alias("_key"))
    kept = keyed.join(first, F.col("_key") == F.col("_kept"), "left_semi")
    return kept.dropDuplicates(["_key"]).select("row.*")


def hex_fingerprint(fp: Column) -> Column:
    return F.lpad(F.lower(F.hex(fp)), 16, "0")
