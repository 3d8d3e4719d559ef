"""Benchmark decontamination by word windows.

A-Z are lowered and words are runs of letters, digits and characters beyond ASCII. The windows of a
test item are its runs of 13 consecutive words (an item of 1 to 12 words is one window). Their
hashes form a small set that is broadcast; training texts are scanned once, window hash by window
hash, and each hit is verified word by word. Words inside any verified window are *hit*.

The broadcast set is bounded: it is flat arrays and one copy of the items' words, some two to three
times their text, and the benchmark is cut into blocks of about ``BLOCK_BYTES`` of items. A benchmark
of one block takes one scan. One of several takes a scan each, which give only the hit texts' runs by
the text's 128-bit digest, and one more that lays these on the rows: more scans, not more memory, and
no copy of the corpus.

Defined cases: a very long text is read in runs and its result is that of the whole text; a null or empty text has no words and is clean; a null item text has no windows; a
null item_id is the empty string; repeated items count once by item_id; repeated documents are each
judged alone; every column of the input is kept as it is, and where its name clashes with a result
column of ``judge`` the result column is returned.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from functools import reduce
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import bound_batches, filled, input_columns, map_texts, row_ranges, written
from moneytrail.llm.words import ALNUM, LOWER, Words, mix

WINDOW = 13
#: A document is contaminated when hit words are at least one in so many of its words.
ONE_IN = 20
#: Items (ids and texts) of one scan.
BLOCK_BYTES = 16 << 20

#: The filter on window hashes has at most so many bits of them.
_FILTER_BITS = 22
_RESULT = "n_words bigint, n_hit bigint, items array<string>, runs binary, spans array<struct<start:bigint,end:bigint>>"
_STEP = np.uint64(0xD6E8FEB86659FD93)


def window_hashes(words: np.ndarray, size: int) -> np.ndarray:
    """Hash of each run of ``size`` consecutive word hashes."""
    n = len(words) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = words[:n].copy()
    for j in range(1, size):
        out = out * _STEP + words[j : j + n]
    return mix(out)


class Windows(NamedTuple):
    """The distinct windows of one size, sorted by hash: the hash's upper half and where the window
    starts in the items' words; and for windows of several items the items beside the first."""

    hashes: np.ndarray
    at: np.ndarray
    shared: np.ndarray
    bounds: np.ndarray
    others: np.ndarray

    def seen(self) -> tuple[np.ndarray, np.uint64]:
        """A table over the hash's first bits, and how far to shift for them."""
        bits = min(_FILTER_BITS, max(10, len(self.hashes).bit_length() + 2))
        table = np.zeros(1 << bits, bool)
        table[self.hashes >> np.uint32(32 - bits)] = True
        return table, np.uint64(64 - bits)


class Index:
    """The windows of one benchmark block: item ids, the items' lowered words with a space behind each,
    the place of each item in them, and the windows by size."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.ids = [i for i, _ in items]
        data = np.frombuffer(b"".join(t + b"\n" for _, t in items), np.uint8)
        offsets = np.cumsum([0, *(len(t) + 1 for _, t in items)])
        starts, ends, hashes, of = Words(ALNUM).split(data, offsets)
        keep = ALNUM[data]
        keep[ends] = True
        text = LOWER[data[keep]]
        text[~ALNUM[text]] = 32
        self.text = text.tobytes()
        size = np.minimum(window, np.bincount(of, minlength=len(items)))
        lengths = ends - starts
        at = np.concatenate([[0], np.cumsum(lengths + 1)])
        self.items = at[np.searchsorted(of, np.arange(len(items)))]
        self.sizes = {}
        for n in np.unique(size[size > 0]).tolist():
            h = window_hashes(hashes, n)
            own = of[: len(h)]
            w = np.flatnonzero((own == of[n - 1 :]) & (size[own] == n))
            w = w[np.argsort(h[w], kind="stable")]
            self.sizes[n] = self._distinct(h[w], at[w], at[w + n - 1] + lengths[w + n - 1], of[w])

    def _distinct(self, h: np.ndarray, start: np.ndarray, end: np.ndarray, of: np.ndarray) -> Windows:
        """Equal windows as one, compared byte by byte among those of one hash."""
        new = np.concatenate([[True], h[1:] != h[:-1]])
        head = np.maximum.accumulate(np.where(new, np.arange(len(h)), 0))
        same, run, known = [], -1, {}
        for i in np.flatnonzero(~new).tolist():
            if head[i] != run:
                run = head[i]
                known = {self.text[start[run] : end[run]]: run}
            first = known.setdefault(self.text[start[i] : end[i]], i)
            if first == i:
                new[i] = True
            elif of[first] != of[i]:
                same.append((first, of[i]))
        pairs = np.unique(np.array(same, np.int64).reshape(-1, 2), axis=0)
        pairs[:, 0] = (np.cumsum(new) - 1)[pairs[:, 0]]
        shared, bounds = np.unique(pairs[:, 0], return_index=True)
        kind = np.uint32 if len(self.text) < 1 << 32 else np.uint64
        return Windows((h[new] >> np.uint64(32)).astype(np.uint32), start[new].astype(kind), shared.astype(np.uint32), np.append(bounds, len(pairs)).astype(np.uint32), pairs[:, 1].astype(np.uint32))

    def found(self, windows: Windows, key: bytes, low: int, high: int) -> list[str]:
        """Ids of the items that hold the window ``key`` (words with a space behind each), among entries ``low`` to ``high``."""
        for entry in range(low, high):
            at = int(windows.at[entry])
            if self.text.startswith(key, at):
                own = [self.ids[np.searchsorted(self.items, at, "right") - 1]]
                i = int(np.searchsorted(windows.shared, entry))
                if i < len(windows.shared) and windows.shared[i] == entry:
                    own += [self.ids[j] for j in windows.others[windows.bounds[i] : windows.bounds[i + 1]].tolist()]
                return own
        return []


def _merged(runs: np.ndarray) -> np.ndarray:
    """Sorted, disjoint [start, end) runs with the same union (n x 2)."""
    if len(runs) < 2:
        return runs
    runs = runs[np.lexsort((runs[:, 1], runs[:, 0]))]
    reach = np.maximum.accumulate(runs[:, 1])
    opens = np.concatenate([[True], runs[1:, 0] > reach[:-1]])
    return np.stack([runs[opens, 0], reach[np.concatenate([np.flatnonzero(opens)[1:] - 1, [len(runs) - 1]])]], 1)


def _hits(index: Index, tables: dict, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, hashes: np.ndarray, of: np.ndarray) -> dict[int, list]:
    """text number -> (first word, end word, item ids) of each verified window."""
    hits: dict[int, list] = {}
    for size, windows in index.sizes.items():
        seen, shift = tables[size]
        h = window_hashes(hashes, size)
        at = np.flatnonzero(seen[h >> shift])
        at = at[of[at] == of[at + size - 1]]
        short = (h[at] >> np.uint64(32)).astype(np.uint32)
        low, high = np.searchsorted(windows.hashes, short, "left"), np.searchsorted(windows.hashes, short, "right")
        some = high > low
        for w, a, b in zip(at[some].tolist(), low[some].tolist(), high[some].tolist(), strict=True):
            words = [data[s:e].tobytes() for s, e in zip(starts[w : w + size].tolist(), ends[w : w + size].tolist(), strict=True)]
            if ids := index.found(windows, b" ".join([*words, b""]).lower(), a, b):
                hits.setdefault(int(of[w]), []).append((w, w + size, ids))
    return hits


def _scanner(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the hits of a broadcast ``index`` (None: no more) to those that the rows bring."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words(ALNUM)
        tables = {size: w.seen() for size, w in index.value.sizes.items()} if index else {}
        for batch in batches:
            texts, before = filled(batch.column("text")), [(set(i), r) for i, r in zip(batch.column("items").to_pylist(), batch.column("runs").to_pylist(), strict=True)]
            n_words, n_hit, items, runs, spans = [], [], [], [], []
            for first, end, data, offsets in row_ranges(texts):
                starts, ends, hashes, of = split.split(data, offsets)
                head = np.searchsorted(starts, offsets)  # first word of each text
                hits = _hits(index.value, tables, data, starts, ends, hashes, of) if index else {}
                for i in range(end - first):
                    had, old = before[first + i]
                    own = hits.get(i, ())
                    had.update(x for _, _, ids in own for x in ids)
                    run = _merged(np.concatenate([np.frombuffer(old, np.int64).reshape(-1, 2), np.array([(a - head[i], b - head[i]) for a, b, _ in own], np.int64).reshape(-1, 2)]))
                    n_words.append(int(head[i + 1] - head[i]))
                    n_hit.append(int((run[:, 1] - run[:, 0]).sum()))
                    items.append(list(had))
                    runs.append(run.tobytes())
                    spans.append([{"start": int(starts[head[i] + a] - offsets[i]), "end": int(ends[head[i] + b - 1] - offsets[i])} for a, b in run.tolist()])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), batch.column("text"), pa.array(n_words, pa.int64()), pa.array(n_hit, pa.int64()), pa.array(items, pa.list_(pa.string())), pa.array(runs, pa.binary()), pa.array(spans, kind)],
                ["row", "text", "n_words", "n_hit", "items", "runs", "spans"],
            )

    return scan


def _hit_texts(index) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Of each batch (digest, text) the texts with hits: digest, item ids and runs of words."""

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split = Words(ALNUM)
        tables = {size: w.seen() for size, w in index.value.sizes.items()}
        for batch in batches:
            digests, items, runs = [], [], []
            for first, _, data, offsets in row_ranges(filled(batch.column("text"))):
                words = split.split(data, offsets)
                head = np.searchsorted(words[0], offsets)
                for i, own in _hits(index.value, tables, data, *words).items():
                    digests.append(batch.column("digest")[first + i].as_py())
                    items.append(sorted({x for _, _, ids in own for x in ids}))
                    runs.append(_merged(np.array([(a - head[i], b - head[i]) for a, b, _ in own], np.int64)).tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(digests, pa.string()), pa.array(items, pa.list_(pa.string())), pa.array(runs, pa.binary())], ["digest", "items", "runs"])

    return scan


def _blocks(benchmark: DataFrame, item_id: str, text: str, window: int, block_bytes: int) -> list[Callable[[], Index]]:
    """The benchmark's distinct items in blocks of about ``block_bytes``, by a hash of the item: a function per block that indexes it."""
    rows = benchmark.select(F.coalesce(F.col(item_id).cast("string"), F.lit("")).alias("id"), F.col(text).alias("text")).where("text is not null").distinct()
    # an id, its place and its object beside the text
    total = rows.agg(F.sum(F.octet_length("text") + F.octet_length("id") + 64)).first()[0] or 0
    n = -(-total // block_bytes) or 1
    block = F.pmod(F.xxhash64("id", "text"), F.lit(n))
    return [lambda b=b: Index([(r["id"], r["text"].encode()) for r in rows.where(block == b).toLocalIterator()], window) for b in range(n)]


def scan_documents(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``row`` and ``text`` (see ``map_texts``), ``n_words``, ``n_hit``, ``items`` (found item ids) and ``spans``:
    the hit runs as [start, end) offsets into the text's UTF-8 bytes."""
    blocks, spark = _blocks(benchmark, item_id, item_text, window, block_bytes), docs.sparkSession
    none = {"items": F.array().cast("array<string>"), "runs": F.lit(b"")}
    if len(blocks) == 1:
        return map_texts(docs, text, _scanner(spark.sparkContext.broadcast(blocks[0]())), _RESULT, none)
    bound_batches(spark)
    digest = F.md5(F.col(f"`{text}`").cast("string").cast("binary"))
    parts, texts = [], docs.select(digest.alias("digest"), F.col(f"`{text}`").cast("string").alias("text")).where("text is not null")
    for indexed in blocks:
        index = spark.sparkContext.broadcast(indexed())
        hit = texts.mapInArrow(_hit_texts(index), "digest string, items array<string>, runs binary")
        parts.append(written(hit.groupBy("digest").agg(F.first("items").alias("items"), F.first("runs").alias("runs")), "decontaminate"))
        index.destroy()  # its result is written
    # a text has at most one row a block
    found = reduce(DataFrame.unionByName, parts).groupBy("digest").agg(F.flatten(F.collect_list("items")).alias("items"), F.collect_list("runs").alias("runs"))
    mark = uuid.uuid4().hex
    key, got = f"_k{mark}", f"_g{mark}"
    found = found.select(F.col("digest").alias(key), F.struct("items", F.aggregate("runs", F.lit(b""), lambda x, y: F.concat(x, y)).alias("runs")).alias(got))
    joined = docs.withColumn(key, digest).join(found, key, "left")
    return map_texts(joined.drop(key), text, _scanner(None), _RESULT, {k: F.coalesce(F.col(f"{got}.{k}"), v) for k, v in none.items()})


def judge(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """Every input row with n_words, n_hit, n_items, items_sha256, contaminated and hit_spans."""
    found = scan_documents(docs, benchmark, **options)
    result = {
        "n_words": F.col("n_words"),
        "n_hit": F.col("n_hit"),
        "n_items": F.size("items").cast("bigint"),
        "items_sha256": F.sha2(F.array_join(F.array_sort("items"), ",").cast("binary"), 256),
        "contaminated": (F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words")),
        "hit_spans": F.col("spans"),
    }
    return found.select(*input_columns(docs, options.get("text", "text"), result), *[v.alias(k) for k, v in result.items()])


def remove_documents(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The input rows that are not contaminated."""
    found = scan_documents(docs, benchmark, **options)
    return found.where(~((F.col("n_hit") > 0) & (F.col("n_hit") * ONE_IN >= F.col("n_words")))).select(*input_columns(docs, options.get("text", "text")))


def remove_spans(docs: DataFrame, benchmark: DataFrame, *, text: str = "text", **options) -> DataFrame:
    """Every input row with its hit runs cut out of the text."""
    found = scan_documents(docs, benchmark, text=text, **options)
    raw = F.col("text").cast("binary")
    # what lies between runs: from each end to the next start
    ends = F.concat(F.array(F.lit(0).cast("bigint")), F.transform("spans", lambda s: s["end"]))
    starts = F.concat(F.transform("spans", lambda s: s["start"]), F.array(F.octet_length("text").cast("bigint")))
    gaps = F.transform(F.arrays_zip(ends.alias("a"), starts.alias("b")), lambda g: F.substring(raw, (g["a"] + 1).cast("int"), (g["b"] - g["a"]).cast("int")).cast("string"))
    cleaned = F.when(F.size("spans") > 0, F.array_join(gaps, "")).otherwise(F.col("text"))
    return found.select(*input_columns(docs, text, new_text=cleaned))
