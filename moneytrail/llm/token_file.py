"""Token ids in files of frequency-ranked, byte-aligned variable-length codes.

Documents are laid out in ascending doc_id order (or, as an option, in the order of the Parquet files that
they are read from, so that a shuffle before holds), tokenised, and cut into blocks of about
``BLOCK_TOKENS`` ids (whole documents). A block ranks its ids by frequency (ties by id): rank 0 is the
most frequent, so most ranks fit into one byte. A rank takes 1 to 4 data bytes, little-endian; its
length minus one is two bits of a separate control byte, which holds four of them. Decoding looks the
control bytes up in a table of lengths and scatters the data bytes by it, all in numpy.

A block is one row of a Parquet file: part, block (both count upwards in that order), doc_ids, sizes (ids
per document with its end id), ranks (the ids by rank, 32 bits each), control and data. Spark's
committer writes the files, so lost or repeated tasks leave no halves, and each block decodes alone.

Tokenising gives what the tokenizers library gives for the whole text, at a fraction of its time: the
byte-level vocabulary's pattern never lets a token cross the place before a space that a visible character
follows, between an ASCII letter and a sign, or before a line end, so texts are cut there (in numpy), and each
distinct unit (known by 128 bits of hashes) is encoded by the library once per worker process and kept, up to
``CACHE_UNITS``. The pre-tokens of words and of ASCII units go to the library's BPE model directly; all other
units through its whole encoder, and so does, in one piece, a text with white space other than space, tab and
line ends, or with an added token of the vocabulary (such as ``<|endoftext|>``, which is one id there as by the library's default).

Defined cases: a null or empty text is its end id alone; null doc_ids come first; rows of one doc_id are
ordered by a hash of their texts; a very long text is one document of one block, read in runs
of ``RUN_BYTES``; an empty table gives no files' rows; other columns are not written.
"""

from __future__ import annotations

import re
import sys
import types
import zlib
from collections.abc import Iterator
from hashlib import blake2b
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.llm.common import fresh_path, offsets_before, row_ranges, whole, written
from moneytrail.llm.lookup import Table
from moneytrail.llm.words import powers, mix

END_ID = 0
BLOCK_TOKENS = 1 << 20
#: Bytes of text in one file, on average.
FILE_BYTES = 24 << 20
CACHE_UNITS, CACHE_IDS = 700_000, 8_000_000
#: Bytes of units that are looked up at once; a longer unit is a run of its own.
RUN_BYTES = 1 << 17
#: Up to so many blocks their offsets are broadcast (24 bytes each), beyond it they are joined by a shuffle.
BROADCAST_BLOCKS = 100_000

FILE = "part int, block int, doc_ids array<bigint>, sizes array<bigint>, ranks binary, control binary, data binary"

#: Bytes that may follow a space at which a text is cut (white space may not).
_VISIBLE = np.array([b > 32 and b != 127 for b in range(256)])
_LETTER = np.array([65 <= b < 91 or 97 <= b < 123 for b in range(256)])
_SIGN = np.array([33 <= b < 48 or 58 <= b < 65 or 91 <= b < 97 or 123 <= b < 127 for b in range(256)])
_LINE_END = np.array([9 <= b < 14 for b in range(256)])
# UTF-8 forms of white space (and of format signs that some classes count as such) beyond tab, line ends and space
_ODD_SINGLE = np.arange(0x1C, 0x20)
_ODD_PAIRS = np.array([0xC285, 0xC2A0])
_ODD_TRIPLES = np.array([0xE19A80, 0xE1A08E, *range(0xE28080, 0xE28090), *range(0xE280A8, 0xE280B0), *range(0xE2819F, 0xE281A5), 0xE38080, 0xEFBBBF])
_ODD_LEAD = np.array([0x1C <= b < 0x20 or b in (0xC2, 0xE1, 0xE2, 0xE3, 0xEF) for b in range(256)])
#: The vocabulary's pre-token pattern, as far as ASCII goes.
_ASCII_PATTERN = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+", re.ASCII)
_BASES = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
#: Names of the 256 bytes in a byte-level vocabulary: visible Latin-1 characters are themselves, the others follow from 256 on.
_PLAIN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTE_NAMES = {b: chr(256 + i) for i, b in enumerate(b for b in range(256) if b not in _PLAIN)}

# --------------------------------------------------------------------------- codes

#: The four lengths that a control byte holds.
LENGTHS = (np.arange(256)[:, None] >> np.array([0, 2, 4, 6]) & 3).astype(np.uint8) + np.uint8(1)
_BYTE = np.arange(4, dtype=np.uint8)


def encode_ranks(values: np.ndarray) -> tuple[bytes, bytes]:
    """(control bytes, data bytes) of unsigned 32-bit values."""
    values = values.astype("<u4", copy=False)
    length = 1 + (values > 0xFF).astype(np.uint8) + (values > 0xFFFF) + (values > 0xFFFFFF)
    two_bits = np.zeros(-(-len(values) // 4) * 4, np.uint8)
    two_bits[: len(values)] = length - 1
    control = (two_bits.reshape(-1, 4) << np.array([0, 2, 4, 6], np.uint8)).sum(1, dtype=np.uint8)
    return control.tobytes(), values.view(np.uint8).reshape(-1, 4)[_BYTE < length[:, None]].tobytes()


def decode_ranks(control: bytes, data: bytes, n: int) -> np.ndarray:
    """The ``n`` values of ``encode_ranks``."""
    length = LENGTHS[np.frombuffer(control, np.uint8)].reshape(-1)[:n]
    out = np.zeros((n, 4), np.uint8)
    out[_BYTE < length[:, None]] = np.frombuffer(data, np.uint8)
    return out.view("<u4").reshape(-1)


def encode_block(ids: np.ndarray) -> tuple[bytes, bytes, bytes]:
    """(ranks, control, data) of a block's ids."""
    top = int(ids.max()) + 1 if len(ids) else 0
    counts = np.bincount(ids, minlength=top)
    by_rank = np.lexsort((np.arange(top), -counts))[: int((counts > 0).sum())]
    rank_of = np.zeros(top, np.uint32)
    rank_of[by_rank] = np.arange(len(by_rank))
    return (by_rank.astype("<u4").tobytes(), *encode_ranks(rank_of[ids]))


def decode_block(ranks: bytes, control: bytes, data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(ranks, "<u4")[decode_ranks(control, data, n)] if n else np.zeros(0, "<u4")


# --------------------------------------------------------------------------- tokens


class Units:
    """Ids of texts, unit by unit; what was learned is kept between calls.

    With ``added_tokens`` the vocabulary's added tokens are known in texts, as they are by the library's default; without, they are plain text.
    """

    def __init__(self, tokenizer_json: str, *, added_tokens: bool = False):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(tokenizer_json)
        self.tokenizer.encode_special_tokens = not added_tokens
        self.added = [t.content for t in self.tokenizer.get_added_tokens_decoder().values() if t.content] if added_tokens else []
        self.added_pattern = re.compile(b"|".join(re.escape(t.encode()) for t in self.added)) if self.added else None
        self.up = [np.ones(1, np.uint64)] * 2
        self.down = [np.ones(1, np.uint64)] * 2
        self._forget()

    def _forget(self) -> None:
        self.table, self.check = Table(), np.zeros(0, np.uint64)
        self.starts, self.sizes, self.flat, self.n_flat = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(1 << 16, np.uint32), 0

    def _hashes(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> list[np.ndarray]:
        """Two independent 64-bit hashes of each stretch of the bytes, which are at most ``RUN_BYTES`` or one stretch."""
        n, out = len(data), []
        if n > RUN_BYTES:
            digest = np.frombuffer(blake2b(data.tobytes(), digest_size=16).digest(), "<u8").astype(np.uint64)
            return [digest[:1], digest[1:]]
        for k, base in enumerate(_BASES):
            if len(self.up[k]) <= n:
                self.up[k], self.down[k] = (powers(np.uint64(x), RUN_BYTES + 1) for x in (base, pow(base, -1, 1 << 64)))
            total = np.zeros(n + 1, np.uint64)
            np.cumsum((data.astype(np.uint64) + np.uint64(1)) * self.up[k][:n], out=total[1:])
            out.append(mix((total[ends] - total[starts]) * self.down[k][starts]))
        return out

    def _bpe(self, word: str) -> list[int]:
        """Ids of one pre-token."""
        mapped = word.replace(" ", "Ġ") if word.isascii() and word.isprintable() else word.encode().decode("latin-1").translate(_BYTE_NAMES)
        return [t.id for t in self.tokenizer.model.tokenize(mapped)]

    def _unit(self, unit: str) -> list[int]:
        if any(t in unit for t in self.added):
            return self.tokenizer.encode(unit, add_special_tokens=False).ids
        if unit.isalpha() or unit[0] == " " and unit[1:].isalpha():
            return self._bpe(unit)
        if unit.isascii():
            return [i for word in _ASCII_PATTERN.findall(unit) for i in self._bpe(word)]
        return self.tokenizer.encode(unit, add_special_tokens=False).ids

    def _learn(self, data: np.ndarray, starts: np.ndarray, ends: np.ndarray, key: np.ndarray, check: np.ndarray) -> None:
        raw = data.tobytes()
        ids = [self._unit(raw[a:b].decode()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
        sizes = np.fromiter(map(len, ids), np.int64, len(ids))
        new = np.fromiter(chain.from_iterable(ids), np.uint32, int(sizes.sum()))
        if self.n_flat + len(new) > len(self.flat):
            self.flat = np.concatenate([self.flat[: self.n_flat], np.zeros(self.n_flat + 2 * len(new), np.uint32)])
        self.flat[self.n_flat : self.n_flat + len(new)] = new
        here = slice(self.table.n, self.table.n + len(key))
        self.table.add(key)
        if here.stop > len(self.check):  # room for as many again
            self.check, self.starts, self.sizes = (np.concatenate([x, np.zeros(here.stop, x.dtype)]) for x in (self.check, self.starts, self.sizes))
        self.check[here], self.starts[here], self.sizes[here] = check, self.n_flat + np.cumsum(sizes) - sizes, sizes
        self.n_flat += len(new)

    def _ids(self, data: np.ndarray, begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids, how many each unit has) of the units of one run of bytes."""
        if self.table.n > CACHE_UNITS or self.n_flat > CACHE_IDS:
            self._forget()
        key, check = self._hashes(data, begins, ends)
        at = self.table.find(key)
        missing = np.flatnonzero(at < 0)
        if len(missing):
            _, first = np.unique(key[missing], return_index=True)
            some = missing[first]
            self._learn(data, begins[some], ends[some], key[some], check[some])
            at = self.table.find(key)
        if (self.check[at] != check).any():  # two units of one 64-bit hash: hardly ever
            raw = data.tobytes()
            ids = [np.array(self._unit(raw[a:b].decode()), np.uint32) for a, b in zip(begins.tolist(), ends.tolist(), strict=True)]
            return np.concatenate(ids), np.array([len(x) for x in ids], np.int64)
        sizes = self.sizes[at]
        before = np.cumsum(sizes) - sizes
        return self.flat[np.repeat(self.starts[at] - before, sizes) + np.arange(int(sizes.sum()))], sizes

    def encode(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts, each with its end id, and how many each has); text i is ``data[offsets[i]:offsets[i + 1]]``.

        Works on runs of ``RUN_BYTES`` (whole units), so that beside the ids little is held for a long text.
        """
        begins = _unit_starts(data, offsets, self.added_pattern)
        ends = np.append(begins[1:], len(data))[: len(begins)]
        n, first, tokens = len(offsets) - 1, 0, [np.zeros(0, np.uint32)]
        counts = np.ones(n, np.int64)
        while first < len(begins):
            start = int(begins[first])
            last = max(first + 1, int(np.searchsorted(ends, start + RUN_BYTES, "right")))
            mine = begins[first:last]
            ids, sizes = self._ids(data[start : int(ends[last - 1])], mine - start, ends[first:last] - start)
            tokens.append(ids)
            of = np.searchsorted(offsets, mine, "right") - 1
            counts[of[0] : of[-1] + 1] += np.bincount(of - of[0], sizes).astype(np.int64)
            first = last
        out = np.full(int(counts.sum()), END_ID, np.uint32)
        inner = np.ones(len(out), bool)
        inner[np.cumsum(counts) - 1] = False
        out[inner] = np.concatenate(tokens)
        return out, counts


def _unit_starts(data: np.ndarray, offsets: np.ndarray, added: re.Pattern[bytes] | None = None) -> np.ndarray:
    """Where units begin: at texts' starts, at spaces that a visible character follows, at signs after
    ASCII letters and at line ends and tabs after visible characters; texts with odd spaces or added tokens are one unit."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        cut[: n - 1] = (data[:-1] == 32) & _VISIBLE[data[1:]]
        cut[1:n] |= _LETTER[data[:-1]] & _SIGN[data[1:]] | _VISIBLE[data[:-1]] & _LINE_END[data[1:]]
    inner = offsets[(offsets > 0) & (offsets < n)]
    cut[inner - 1] = False  # a space that ends a text has nothing behind it
    lead = np.flatnonzero(_ODD_LEAD[data])
    if len(lead):
        after = np.append(data, np.zeros(2, np.uint8))
        one, two, three = (after[lead + k].astype(np.int32) for k in range(3))
        odd = lead[np.isin(one, _ODD_SINGLE) | np.isin(one << 8 | two, _ODD_PAIRS) | np.isin(one << 16 | two << 8 | three, _ODD_TRIPLES)]
        for text in np.unique(np.searchsorted(offsets, odd, "right") - 1).tolist():
            cut[offsets[text] : offsets[text + 1]] = False
    if added is not None and n:
        buffer = memoryview(np.ascontiguousarray(data))  # searched in place
        found = added.search(buffer)
        while found:
            text = int(np.searchsorted(offsets, found.start(), "right")) - 1
            cut[offsets[text] : offsets[text + 1]] = False
            found = added.search(buffer, int(offsets[text + 1]))
    cut[offsets[:-1]] = True
    return np.flatnonzero(cut[:n])


def _kept_units(tokenizer_json: str) -> Units:
    """This worker process's units: they outlive a task."""
    home = sys.modules.setdefault("_token_units_of_this_worker", types.ModuleType("_token_units_of_this_worker"))
    if getattr(home, "made_of", None) != tokenizer_json:
        home.made_of, home.units = tokenizer_json, Units(tokenizer_json, added_tokens=True)
    return home.units


def _write(tokenizer_json, block_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        units, block, held, total = _kept_units(tokenizer_json.value), 0, [], 0

        def row() -> pa.RecordBatch:
            ids, sizes = (np.concatenate([x[k] for x in held]) for k in (0, 1))
            doc_ids = pa.concat_arrays([x[2] for x in held])
            ranks, control, data = encode_block(ids)
            listed = [pa.ListArray.from_arrays(pa.array([0, len(sizes)], pa.int32()), x) for x in (doc_ids, pa.array(sizes))]
            return pa.RecordBatch.from_arrays([pa.array([held[0][3]], pa.int32()), pa.array([block], pa.int32()), *listed, *[pa.array([x], pa.binary()) for x in (ranks, control, data)]], ["part", "block", "doc_ids", "sizes", "ranks", "control", "data"])

        for batch in batches:
            doc_ids = whole(batch.column("doc_id"))
            for first, end, data, offsets in row_ranges(whole(batch.column("text"))):
                ids, sizes = units.encode(data, offsets)
                held.append((ids, sizes, doc_ids.slice(first, end - first), batch.column("part")[first].as_py()))
                total += len(ids)
                if total >= block_tokens:
                    yield row()
                    block, held, total = block + 1, [], 0
        if held:
            yield row()

    return run


def _given_order(docs: DataFrame) -> tuple[DataFrame, list[Column]]:
    """Documents and their place in the Parquet files of one write; what is no plain read of files is written first."""
    try:
        place = docs.metadataColumn("_metadata")
    except AnalysisException:
        docs = written(docs, "tokens-given")
        place = docs.metadataColumn("_metadata")
    name = place["file_name"]  # part-<number>-...: a longer name has a higher number
    return docs, [F.length(name), name, place["row_index"]]


def write_tokens(docs: DataFrame, path: str, *, tokenizer: str | None = None, doc_id: str = "doc_id", text: str = "text", given_order: bool = False, block_tokens: int = BLOCK_TOKENS, file_bytes: int = FILE_BYTES) -> None:
    """Write the ids of all documents below ``path``, in ascending doc_id order or, with ``given_order``, in that of their files."""
    spark = docs.sparkSession
    if tokenizer is None:
        import public_tokenizers

        tokenizer = public_tokenizers.path("byte_bpe_50k.json")
    with open(tokenizer, encoding="utf-8") as f:
        vocabulary = spark.sparkContext.broadcast(f.read())  # a vocabulary: a few MB
    docs, order = _given_order(docs) if given_order else (docs, [F.col(doc_id).cast("bigint"), F.xxhash64(F.coalesce(F.col(text), F.lit("")))])
    places = [f"place_{i}" for i in range(len(order))]
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"), *[c.alias(n) for c, n in zip(order, places, strict=True)])
    total = rows.agg(F.sum(F.octet_length("text").cast("bigint"))).first()[0] or 0
    laid = rows.repartitionByRange(max(1, -(-total // file_bytes)), *places).sortWithinPartitions(*places)
    laid.select("doc_id", "text", F.spark_partition_id().alias("part")).mapInArrow(_write(vocabulary, block_tokens), FILE).write.option("compression", "zstd").parquet(path)


def _read(digest: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                sizes = np.array(row["sizes"], np.int64)
                ends = np.cumsum(sizes)
                ids = decode_block(row["ranks"], row["control"], row["data"], int(ends[-1]))
                each = [ids[a:b] for a, b in zip((ends - sizes).tolist(), ends.tolist(), strict=True)]
                values = pa.array([zlib.crc32(x.tobytes()) for x in each], pa.int64()) if digest else pa.array([x.astype(np.int32) for x in each], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(row["doc_ids"], pa.int64()), pa.array([row["place"]] * len(each), pa.int64()), pa.array(ends - sizes), pa.array(sizes), values],
                    ["doc_id", "place", "before", "n_tokens", "ids_crc32" if digest else "ids"],
                )

    return run


def read_tokens(spark: SparkSession, path: str, *, digest: bool = False) -> DataFrame:
    """Per document: doc_id, start (ids before it), n_tokens, and ids (or, as a digest, ids_crc32)."""
    place = (F.col("part").cast("bigint") * (1 << 32) + F.col("block")).alias("place")
    blocks = spark.read.schema(FILE).parquet(path)
    sizes = blocks.select(place, F.aggregate("sizes", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n"))
    offsets = offsets_before(sizes, "place", 1 << 32)
    few = sizes.limit(BROADCAST_BLOCKS + 1).count() <= BROADCAST_BLOCKS
    value = "ids_crc32 bigint" if digest else "ids array<int>"
    docs = blocks.select(place, "doc_ids", "sizes", "ranks", "control", "data").mapInArrow(_read(digest), f"doc_id bigint, place bigint, before bigint, n_tokens bigint, {value}")
    joined = docs.join(F.broadcast(offsets) if few else offsets, "place")
    return joined.select("doc_id", (F.col("offset") + F.col("before")).alias("start"), "n_tokens", value.split()[0])


def round_trip(docs: DataFrame, *, digest: bool = True, **options) -> DataFrame:
    """Write token files to the shared folder and read them back."""
    path = fresh_path(docs.sparkSession, "tokens")
    write_tokens(docs, path, **options)
    return read_tokens(docs.sparkSession, path, digest=digest)
