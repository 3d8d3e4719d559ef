"""Alignment of two tokenizers' tokens over the same bytes.

Tokenizer A (byte-level, the tokenizers library) reads a space and the text, tokenizer B (sentencepiece) the text, before which it puts a
space itself. The byte offsets where tokens of both end cut the text into groups; all tokens of a group, one of A and one of B, are linked.

Offsets. A's character offsets and B's proto spans are coarse cuts: a token that ends where its successor begins ends on a character, and its
byte offset follows from the character's. Tokens that share a character (parts of a multibyte character in A, byte-fallback
pieces and the lone leading space in B) have no offset of their own there; theirs is counted from the last cut by the bytes that the tokens
decode to. The decoded bytes must join to the space and the text, else the text has no tokens.

Speed. No token of either vocabulary crosses the place before a single space that a letter, digit or ASCII sign follows, nor that between an ASCII letter and
such a sign of ``SIGNS`` as follows a letter in no entry of both vocabularies, so texts are cut there into units; the distinct units that a worker has not met are laid end to end, aligned as one text, and kept. Units
with other space around them are aligned alone. Tests hold this against the alignment of whole texts.

Memory. A worker reads runs of ``RUN_CHARS`` and keeps at most about ``CACHE_UNITS`` units, ``CACHE_PAIRS`` pairs and ``CACHE_BYTES`` of text, as columns as
narrow as their numbers allow. Beyond that it goes on with units that it met again, up to half of the units, or with none where these hold over half of the pairs or text.

Counts. A task's documents form chunks of about ``CHUNK_BYTES`` of text (one document at least). A chunk's distinct id pairs, with the number of its documents that
have them linked, are summed per pair over all chunks by Spark, and each A id's highest count is found. The counts go back to
the chunks that hold the pair by a join of one row per chunk and pair, and the chunk's documents stream past them. So a pair that all
documents have is one row per chunk, and nothing is broadcast or collected.

Defined cases: null and empty texts, and texts that B does not give back (such as those with U+2581), have no tokens: zeros; null ids and repeated rows
are documents like any other; a long text is read in runs of about ``RUN_CHARS`` cut between units, and of its links only distinct pairs are
kept; a stretch without a cut is aligned as a whole; ties for an A id's highest count are all highest; an empty table gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import sys
import types
from collections.abc import Iterator
from itertools import chain, compress

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import bound_batches, written

#: Text of one chunk, in characters; a document is never split.
CHUNK_BYTES = 8 << 20
#: Characters that are read, aligned and given back at once; a longer document is read in such runs.
RUN_CHARS = 1 << 17
#: What a worker keeps: a dict of up to 699,050 units takes half of what the next one would need.
CACHE_UNITS, CACHE_PAIRS, CACHE_BYTES = 650_000, 4_000_000, 32 << 20
#: So many pairs at least are held before they are summed.
SUM_PAIRS = 1 << 18
#: Groups of more links than this are counted by distinct ids, not link by link.
WIDE = 4096
#: Ids of B in a pair's code.
_B_BITS = 24

#: Signs at which a text may be cut behind a letter; each is looked for in the vocabularies first.
SIGNS = ".,!?;:"
#: A unit of one token of either, before units that begin with a sign.
_FILLER = " a"
_CUT = re.compile(r"(?<=[^ ])(?= (?:[!-~]|\w))")
_PLAIN = re.compile(r" (?:[!-~]|\w)")
#: Names of the 256 bytes in a byte-level vocabulary: visible Latin-1 characters are themselves, the others follow from 256 on.
_VISIBLE = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
_BYTES = {chr(b): b for b in _VISIBLE} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in _VISIBLE)}


class _Column:
    """Whole numbers from 0 on, appended to, as wide as the largest needs; room that is not used yet takes no memory."""

    def __init__(self):
        self.n, self.room = 0, np.empty(1 << 12, np.uint8)

    def add(self, new: np.ndarray) -> None:
        if not len(new):
            return
        kind = np.promote_types(self.room.dtype, np.min_scalar_type(int(new.max())))
        end = self.n + len(new)
        if end > len(self.room) or kind != self.room.dtype:
            room = np.empty(max(len(self.room), 2 * end if end > len(self.room) else 0), kind)
            room[: self.n] = self.room[: self.n]
            self.room = room
        self.room[self.n : end] = new
        self.n = end

    def at(self, where: np.ndarray) -> np.ndarray:
        return self.room[where].astype(np.int64)

    def keep(self, flags: np.ndarray) -> None:
        kept = self.room[: self.n][flags]
        self.n, self.room = 0, np.empty(max(1 << 12, len(kept)), self.room.dtype)
        self.add(kept)


class _Sums:
    """Numbers summed per pair, in parts."""

    def __init__(self):
        self.pairs = self.n = np.zeros(0, np.int64)
        self.held, self.waiting = [], 0

    def add(self, pairs: np.ndarray, n: np.ndarray) -> None:
        self.held.append((pairs, n))
        self.waiting += len(pairs)
        if self.waiting > max(SUM_PAIRS, len(self.pairs)):
            self.sums()

    def sums(self) -> tuple[np.ndarray, np.ndarray]:
        """Pairs, ascending, and their sums."""
        if self.held:
            pairs, n = (np.concatenate(x) for x in zip((self.pairs, self.n), *self.held, strict=True))
            _, self.pairs, self.n = _summed(np.zeros(len(pairs), np.int64), pairs, n)
            self.held, self.waiting = [], 0
        return self.pairs, self.n


class Aligner:
    """Aligns texts; what it learned of units is kept between calls."""

    def __init__(self, tokenizer_json: str, piece_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_str(tokenizer_json)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_proto=piece_model)
        names = self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            self.a_bytes[i] = bytes(_BYTES[c] for c in name) if all(c in _BYTES for c in name) else name.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)]
        behind = {x for t in chain(self.a_bytes, self.b_bytes) for x in re.findall(rb"(?<=[A-Za-z])[^A-Za-z]", t)}
        self.signs = "".join(c for c in SIGNS if c.encode() not in behind)
        self.cut = re.compile(f"{_CUT.pattern}|(?<=[A-Za-z])(?=[{re.escape(self.signs)}])") if self.signs else _CUT
        self.a_sizes, self.b_sizes = (np.array([len(x) for x in y], np.int64) for y in (self.a_bytes, self.b_bytes))
        self._forget()

    def _forget(self) -> None:
        self.index: dict[str, int] = {}
        self.chars = 0
        self.good, self.met = _Column(), _Column()  # met: again since it was learned, or since the last time room was made
        self.numbers = [_Column() for _ in range(4)]  # n_a, n_b, n_groups, n_links of units
        self.joined_starts, self.joined_sizes, self.joined = _Column(), _Column(), _Column()  # a unit's groups, each ended by a semicolon
        self.starts, self.sizes, self.pairs, self.links = _Column(), _Column(), _Column(), _Column()

    def _full(self, parts: int) -> bool:
        """Whether more is kept than one of so many parts of the room."""
        return max(len(self.index) / CACHE_UNITS, self.pairs.n / CACHE_PAIRS, (self.chars + self.joined.n) / CACHE_BYTES) * parts > 1

    def _make_room(self) -> None:
        """Go on with the units that were met again."""
        kept = np.flatnonzero(self.met.room[: self.met.n])[: CACHE_UNITS // 2]
        flags = np.zeros(self.met.n, bool)
        flags[kept] = True
        self.index = {u: i for i, u in enumerate(compress(self.index, flags.tolist()))}
        self.chars = sum(map(len, self.index))
        for starts, sizes, stretches in ((self.joined_starts, self.joined_sizes, (self.joined,)), (self.starts, self.sizes, (self.pairs, self.links))):
            inside = np.repeat(flags, sizes.room[: sizes.n])
            for column in stretches:
                column.keep(inside)
            sizes.keep(flags)
            length = sizes.room[: sizes.n].astype(np.int64)
            starts.n = 0
            starts.add(np.cumsum(length) - length)
        for column in (self.good, self.met, *self.numbers):
            column.keep(flags)
        self.met.room[: self.met.n] = 0
        if self._full(2):
            self._forget()

    # ----------------------------------------------------------------- offsets
    def _ends(self, coarse: np.ndarray, shared: np.ndarray, sizes: np.ndarray) -> np.ndarray | None:
        """Byte offsets of token ends: ``coarse`` where a token shares no character, else counted on by ``sizes``."""
        counted = np.cumsum(sizes)
        at = np.maximum.accumulate(np.where(shared, -1, np.arange(len(sizes))))  # the last cut at or before each token
        base = np.where(at >= 0, coarse[at] - counted[at], 0)
        ends = np.where(shared, base + counted, coarse)
        return ends if (np.diff(ends, prepend=0) == sizes).all() else None

    def align(self, full: str) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray] | None:
        """(A ids, their ends, B ids, their ends, common ends) over the bytes of ``full``, which begins with a space; None where bytes differ."""
        raw = full.encode()
        found = self.a.encode(full, add_special_tokens=False)
        a = np.array(found.ids, np.int64)
        if b"".join(map(self.a_bytes.__getitem__, found.ids)) != raw:
            return None
        points = np.frombuffer(full.encode("utf-32-le"), np.uint32)
        to_byte = np.concatenate([[0], np.cumsum(1 + (points > 0x7F) + (points > 0x7FF) + (points > 0xFFFF))])
        spans = _pairs(found.offsets, 2)
        shared = np.append(spans[1:, 0] != spans[:-1, 1], False)
        a_ends = self._ends(to_byte[spans[:, 1]], shared, self.a_sizes[a])
        pieces = self.b.encode(full[1:], return_type="proto").pieces
        rows = [(p.id, p.begin, p.end) for p in pieces]
        b, begin, end = _pairs(rows, 3).T
        if b"".join([self.b_bytes[r[0]] for r in rows]) != raw:
            return None
        b_ends = self._ends(end + 1, (begin == end) | np.append(begin[1:] != end[:-1], False), self.b_sizes[b])
        if a_ends is None:  # offsets that say something else than the bytes
            a_ends = np.cumsum(self.a_sizes[a])
        if b_ends is None:
            b_ends = np.cumsum(self.b_sizes[b])
        return a, a_ends, b, b_ends, np.intersect1d(a_ends, b_ends, assume_unique=True)

    # ------------------------------------------------------------------- units
    def _learn(self, units: list[str]) -> None:
        """Align units that are not known yet."""
        plain = [u for u in units if _PLAIN.match(u) and u[-1] != " "]
        signed = [u for u in units if u and u[0] in self.signs and u[-1] != " "]
        other = [u for u in units if not u or u[-1] == " " or not (_PLAIN.match(u) or u[0] in self.signs)]
        for some in (plain, signed):
            if some and not self._add(some):
                other += some
        for unit in other:
            unit and self._add([unit]) or self._record([unit], False, [""], np.zeros((1, 4), np.int64), np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64))

    def _add(self, units: list[str]) -> bool:
        """Align units laid end to end; False where they can't be told apart or bytes differ.

        Units that begin with a sign (then all do) each stand behind a filler, whose results are left out."""
        own, filled = units, units[0][0] in self.signs
        if filled:
            units = [x for u in own for x in (_FILLER, u)]
        found = self.align("".join(units))
        if found is None:
            return False
        a, a_ends, b, b_ends, cuts = found
        ends = np.cumsum([len(u.encode()) for u in units])
        last = np.searchsorted(cuts, ends)
        if (cuts[np.minimum(last, len(cuts) - 1)] != ends).any():
            return False
        a_group, b_group = np.searchsorted(cuts, a_ends), np.searchsorted(cuts, b_ends)
        n_a, n_b = np.bincount(a_group, minlength=len(cuts)), np.bincount(b_group, minlength=len(cuts))
        texts = [_listed(a, np.cumsum(n_a)), _listed(b, np.cumsum(n_b))]
        strings = [f"{x}|{y}" for x, y in zip(*texts, strict=True)]
        unit_of = np.searchsorted(ends, cuts)
        first = np.append(0, last[:-1] + 1)
        joined = [";".join(strings[i : j + 1]) for i, j in zip(first.tolist(), last.tolist(), strict=True)]
        totals = np.stack([np.bincount(unit_of, w, len(units)) for w in (n_a, n_b, np.ones(len(cuts)), n_a * n_b)], 1).astype(np.int64)
        unit, pairs, links = _links(a, b, n_a, n_b, unit_of)
        if filled:
            kept = unit % 2 == 1
            unit, pairs, links, joined, totals = unit[kept] // 2, pairs[kept], links[kept], joined[1::2], totals[1::2]
        order = np.argsort(unit, kind="stable")
        self._record(own, True, joined, totals, np.bincount(unit, minlength=len(own)), pairs[order], links[order])
        return True

    def _record(self, units, good, joined, totals, sizes, pairs, links) -> None:
        self.index.update(zip(units, range(len(self.index), len(self.index) + len(units)), strict=True))
        self.chars += sum(map(len, units))
        self.good.add(np.full(len(units), good, np.uint8))
        self.met.add(np.zeros(len(units), np.uint8))
        for column, n in zip(self.numbers, totals.T, strict=True):
            column.add(n)
        length = np.array([len(x) + 1 for x in joined], np.int64)
        self.joined_starts.add(self.joined.n + np.cumsum(length) - length)
        self.joined_sizes.add(length)
        self.joined.add(np.frombuffer(";".join([*joined, ""]).encode(), np.uint8))
        self.starts.add(self.pairs.n + np.cumsum(sizes) - sizes)
        self.sizes.add(sizes)
        self.pairs.add(pairs)
        self.links.add(links)

    def read(self, texts: list[str]) -> tuple[list[bool], np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(good, numbers, groups, text number, pair, links) of texts that begin with a space; pairs once per text, texts ascending.

        Numbers are n_a, n_b, n_groups, n_links; they and the pairs of a text that is not good mean nothing.
        """
        if self._full(1):
            self._make_room()
        split = [self.cut.split(t) for t in texts]
        known = len(self.index)
        missing = list(dict.fromkeys(u for units in split for u in units if u not in self.index))
        if missing:
            self._learn(missing)
        n = len(texts)
        text = np.repeat(np.arange(n), [len(units) for units in split])
        flat = np.fromiter(map(self.index.__getitem__, chain.from_iterable(split)), np.int64, len(text))
        good = (np.bincount(text, self.good.room[flat] == 0, n) == 0).tolist()
        numbers = np.stack([np.bincount(text, column.room[flat], n) for column in self.numbers], 1).astype(np.int64)
        size = self.joined_sizes.at(flat)
        start, joined = self.joined_starts.at(flat), memoryview(self.joined.room)
        raw = b"".join([joined[i:j] for i, j in zip(start.tolist(), (start + size).tolist(), strict=True)]).decode()
        ends = np.cumsum(np.bincount(text, size, n).astype(np.int64)).tolist()
        groups = [raw[i : j - 1] for i, j in zip([0, *ends], ends, strict=False)]
        key, times = np.unique(text << 32 | flat, return_counts=True)
        text, unit = key >> 32, key & 0xFFFFFFFF
        self.met.room[unit[unit < known]] = 1
        size = self.sizes.at(unit)
        at = np.repeat(self.starts.at(unit) - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))
        return good, numbers, groups, *_summed(np.repeat(text, size), self.pairs.at(at), self.links.at(at) * np.repeat(times, size))


def _pairs(rows: list[tuple], width: int) -> np.ndarray:
    return np.fromiter(chain.from_iterable(rows), np.int64, width * len(rows)).reshape(-1, width)


def _kept_aligner(vocabulary: str, model: bytes) -> Aligner:
    """This worker process's aligner: what it learned outlives a task."""
    home = sys.modules.setdefault("_aligner_of_this_worker", types.ModuleType("_aligner_of_this_worker"))
    if getattr(home, "made_of", None) != (vocabulary, model):
        home.made_of, home.aligner = (vocabulary, model), Aligner(vocabulary, model)
    return home.aligner


def _summed(text: np.ndarray, pairs: np.ndarray, links: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Links summed per text and pair, in that order."""
    order = np.lexsort((pairs, text))
    text, pairs, links = text[order], pairs[order], links[order]
    fresh = np.flatnonzero((np.diff(text, prepend=-1) != 0) | (np.diff(pairs, prepend=-1) != 0))
    return text[fresh], pairs[fresh], np.add.reduceat(links, fresh) if len(fresh) else links


def _listed(ids: np.ndarray, ends: np.ndarray) -> list[str]:
    """Comma-joined ids of the stretches that end at ``ends``."""
    words = list(map(str, ids.tolist()))
    stops = ends.tolist()
    return [words[i] if j - i == 1 else ",".join(words[i:j]) for i, j in zip([0, *stops[:-1]], stops, strict=True)]


def _links(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray, unit_of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(unit, pair, links) of all groups: link by link, in wide groups by distinct ids."""
    a_at, b_at = np.cumsum(n_a) - n_a, np.cumsum(n_b) - n_b
    wide = n_a * n_b > WIDE
    small_a = np.repeat(~wide, n_a)
    times = np.repeat(n_b, n_a)[small_a]  # every A token meets its group's B tokens
    group = np.repeat(np.arange(len(n_a)), n_a)[small_a]
    inner = np.arange(int(times.sum())) - np.repeat(np.cumsum(times) - times, times)
    pairs = [np.repeat(a[small_a], times) << _B_BITS | b[np.repeat(b_at[group], times) + inner]]
    units, links = [np.repeat(unit_of[group], times)], [np.ones(len(pairs[0]), np.int64)]
    for g in np.flatnonzero(wide).tolist():
        x, n_x = np.unique(a[a_at[g] : a_at[g] + n_a[g]], return_counts=True)
        y, n_y = np.unique(b[b_at[g] : b_at[g] + n_b[g]], return_counts=True)
        pairs.append((x[:, None] << _B_BITS | y).ravel())
        links.append((n_x[:, None] * n_y).ravel())
        units.append(np.full(len(pairs[-1]), unit_of[g]))
    return np.concatenate(units), np.concatenate(pairs), np.concatenate(links)


# --------------------------------------------------------------------------- documents

_ROW = "chunk bigint, kind int, doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups_sha256 string, pairs array<bigint>, links array<bigint>"
_TYPES = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "array<bigint>": pa.list_(pa.int64()), "boolean": pa.bool_()}


def _schema(text: str) -> pa.Schema:
    return pa.schema([(n, _TYPES[t]) for n, t in (x.split() for x in text.split(", "))])


def runs(text: str, size: int = RUN_CHARS) -> Iterator[str]:
    """The space and the text in runs of about ``size`` characters, cut between units."""
    full = " " + text
    at = 0
    while at < len(full):
        found = _CUT.search(full, at + size) if at + size < len(full) else None
        end = found.start() if found else len(full)
        yield full[at:end]
        at = end


def _long(aligner: Aligner, text: str) -> tuple[bool, np.ndarray, str, np.ndarray, np.ndarray]:
    """What ``Aligner.read`` gives for one text, run by run, with the digest of its groups."""
    digest, numbers, first = hashlib.sha256(), np.zeros(4, np.int64), True
    linked, empty = _Sums(), np.zeros(0, np.int64)
    for run in runs(text):
        good, n, groups, _, p, m = aligner.read([run])
        if not good[0]:
            return False, numbers, "", empty, empty
        digest.update(("" if first else ";").encode() + groups[0].encode())
        numbers, first = numbers + n[0], False
        linked.add(p, m)
    return True, numbers, digest.hexdigest(), *linked.sums()


def _aligned(vocabulary, model, chunk_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner, schema = _kept_aligner(vocabulary.value, model.value), _schema(_ROW)
        chunk, size, seen = None, 0, _Sums()
        empty = np.zeros(0, np.int64)

        def documents(ids, texts) -> pa.RecordBatch:
            good, numbers, digests, per_text = [], [], [], []
            if len(texts) == 1 and len(texts[0] or "") > RUN_CHARS:
                g, n, d, p, m = _long(aligner, texts[0])
                good, numbers, digests, per_text = [g], [n], [d], [(p, m)]
            elif any(texts):
                good, numbers, groups, text, p, m = aligner.read([" " + t if t else "" for t in texts])
                edges = np.searchsorted(text, np.arange(len(texts) + 1)).tolist()
                per_text = [(p[i:j], m[i:j]) for i, j in zip(edges, edges[1:], strict=False)]
                digests = [hashlib.sha256(x.encode()).hexdigest() for x in groups]
                good = [bool(g and t) for g, t in zip(good, texts, strict=True)]
            else:
                good, numbers, digests, per_text = [False] * len(texts), [empty] * len(texts), [""] * len(texts), [(empty, empty)] * len(texts)
            out = []
            for i, g, n, d, (p, m) in zip(ids, good, numbers, digests, per_text, strict=True):
                n = n.tolist() if g else [0] * 4
                out.append((chunk, 1, i, *n, d if g else "", p if g else empty, m if g else empty))
                if g:
                    seen.add(p, np.ones(len(p), np.int64))
            return pa.RecordBatch.from_arrays([pa.array(c, t.type) for c, t in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)

        def counts() -> pa.RecordBatch:
            pairs, n = seen.sums()
            return pa.RecordBatch.from_arrays([pa.array([x], t.type) for x, t in zip((chunk, 0, *[None] * 6, pairs, n), schema, strict=True)], schema=schema)

        for batch in batches:
            ids, texts = batch.column("doc_id"), batch.column("text")
            lengths = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            first = 0
            while first < len(ids):
                if chunk is None:
                    chunk = batch.column("part")[first].as_py() << 32
                end, held = first, 0
                while end < len(ids) and (end == first or held + lengths[end] <= RUN_CHARS):
                    held += lengths[end]
                    end += 1
                yield documents(ids[first:end].to_pylist(), texts[first:end].to_pylist())
                first, size = end, size + held
                if size >= chunk_bytes:
                    yield counts()
                    chunk, size, seen = chunk + 1, 0, _Sums()
        if len(seen.sums()[0]):
            yield counts()

    return run


_SUM = "doc_id bigint, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, n_best bigint, count_sum bigint, groups_sha256 string"


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A chunk's pairs with their counts come first, then its documents."""
    schema = _schema(_SUM)
    now, held, table = None, [], None
    for batch in batches:
        chunks, kinds = batch.column("chunk").to_numpy(), batch.column("kind").to_numpy()
        edges = np.flatnonzero(np.diff(chunks, prepend=-1) | np.diff(kinds, prepend=-1)).tolist() if len(chunks) else []
        for i, j in zip(edges, [*edges[1:], len(chunks)], strict=True):
            rows = batch.slice(i, j - i)
            if chunks[i] != now:
                now, held, table = chunks[i], [], None
            if kinds[i] == 0:
                held.append([rows.column(c).to_numpy(zero_copy_only=False) for c in ("pair", "n_docs", "best")])
                continue
            if table is None:
                columns = [np.concatenate(x) for x in zip(*held, strict=True)] if held else [np.zeros(1, np.int64)] * 3
                order = np.argsort(columns[0])
                table, held = [c[order].astype(np.int64) for c in columns], []
            pairs, links = rows.column("pairs"), rows.column("links").flatten().to_numpy()
            at = np.searchsorted(table[0], pairs.flatten().to_numpy())
            of = np.repeat(np.arange(j - i), pairs.value_lengths().to_numpy())
            sums = [np.bincount(of, table[k][at] * links, j - i).astype(np.int64) if len(at) else np.zeros(j - i, np.int64) for k in (2, 1)]
            numbers = [rows.column(c) for c in ("n_a", "n_b", "n_groups", "n_links")]
            yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *numbers, *map(pa.array, sums), rows.column("groups_sha256")], schema=schema)


def aligned(docs: DataFrame, *, tokenizer: str | None = None, pieces: str | None = None, doc_id: str = "doc_id", text: str = "text", chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """Written rows of documents (kind 1: numbers, digest, linked pairs and how often) and of chunks (kind 0: pairs and their documents)."""
    spark = docs.sparkSession
    bound_batches(spark)
    if tokenizer is None or pieces is None:
        import public_tokenizers

        tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")
        pieces = pieces or public_tokenizers.path("piece_bpe_32k.model")
    with open(tokenizer, encoding="utf-8") as f, open(pieces, "rb") as g:
        vocabulary, model = spark.sparkContext.broadcast(f.read()), spark.sparkContext.broadcast(g.read())  # vocabularies: a few MB
    rows = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).cast("string").alias("text")).withColumn("part", F.spark_partition_id().cast("bigint"))
    return written(rows.mapInArrow(_aligned(vocabulary, model, chunk_bytes), _ROW), "aligned")


def pair_counts(found: DataFrame) -> DataFrame:
    """(pair, n_docs, best): documents that have each id pair linked, and whether no pair of its A id has more; a pair is A id * 2**24 + B id."""
    counts = _in_chunks(found).groupBy("pair").agg(F.sum("n").alias("n_docs")).withColumn("a", F.shiftright("pair", _B_BITS))
    top = counts.groupBy("a").agg(F.max("n_docs").alias("top"))
    return counts.join(top, "a").select("pair", "n_docs", (F.col("n_docs") == F.col("top")).alias("best"))


def _in_chunks(found: DataFrame) -> DataFrame:
    each = F.explode(F.arrays_zip("pairs", "links")).alias("x")
    return found.where("kind = 0").select("chunk", each).select("chunk", F.col("x.pairs").alias("pair"), F.col("x.links").alias("n"))


def report(docs: DataFrame, **options) -> DataFrame:
    """Per document: n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256."""
    found = aligned(docs, **options)
    known = _in_chunks(found).select("chunk", "pair").join(pair_counts(found), "pair")
    documents = found.where("kind = 1")
    empty = lambda c: F.lit(None).cast(documents.schema[c].dataType).alias(c)
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "links"]
    front = known.select("chunk", F.lit(0).alias("kind"), "pair", "n_docs", "best", *map(empty, names))
    back = documents.select("chunk", "kind", F.lit(None).cast("bigint").alias("pair"), F.lit(None).cast("bigint").alias("n_docs"), F.lit(None).cast("boolean").alias("best"), *names)
    together = front.unionByName(back).repartition("chunk").sortWithinPartitions("chunk", "kind")
    return together.mapInArrow(_totals, _SUM)
