import random
import zlib

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from moneytrail.llm import packing, queries

from .conftest import SF

TOKENS = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))


def ids_of(text):
    return [*TOKENS.encode(text or "", add_special_tokens=False).ids, 2]


def pieces_of(ids, capacity):
    """Pieces from the end: all whole but the first."""
    out, end = [], len(ids)
    while end > 0:
        out.insert(0, (max(0, end - capacity), ids[max(0, end - capacity) : end]))
        end -= capacity
    return out


def held(pieces, capacity):
    """No two pieces overlap, no gap lies inside a sequence, none is too long; the number of sequences."""
    found = {}
    for sequence, offset, length in pieces:
        found.setdefault(sequence, []).append((offset, length))
    for parts in found.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at <= capacity
    return len(found)


def first_fit(lengths, capacity):
    room = []
    for n in sorted(lengths, reverse=True):
        i = next((i for i, r in enumerate(room) if r >= n), None)
        if i is None:
            room.append(capacity - n)
        else:
            room[i] -= n
    return len(room)


def one_by_one(lengths, capacity):
    """The rule applied to single pieces, the sum of squares counted anew for every choice."""
    held_by = []
    for n in sorted(lengths, reverse=True):
        best = None
        for level in sorted({h for h in held_by if h + n <= capacity}, reverse=True):
            after = list(held_by)
            after.remove(level)
            after.append(level + n)
            squares = sum(after.count(h) ** 2 for h in range(1, capacity))
            if best is None or squares < best[0]:
                best = squares, after
        held_by = best[1] if best else [*held_by, n]
    return sorted(held_by)


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 20), max_size=25))
def test_recipes_follow_the_rule(lengths):
    counts = {n: lengths.count(n) for n in set(lengths)}
    got = sorted(sum(r) for r, times in packing.recipes(counts, 20, 10**9) for _ in range(times))
    assert got == one_by_one(lengths, 20)


@settings(max_examples=80, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 3000), max_size=30))
def test_recipes_hold_every_piece(counts):
    found = packing.recipes(counts, 64)
    total = {}
    for lengths, times in found:
        assert times > 0 and sum(lengths) <= 64
        for n in lengths:
            total[n] = total.get(n, 0) + times
    assert total == counts and len(found) <= 64 * packing.BATCHES
    keys, first, offset = packing.places(found)
    assert len(set(keys.tolist())) == len(keys) == sum(len(r) for r, _ in found)
    some = [(s + k, o, n >> 44) for n, s, o, k in zip(keys.tolist(), first.tolist(), offset.tolist(), [0] * len(keys), strict=True)]
    held(some, 64)


def test_sequences_are_few():
    rng = random.Random(5)
    lengths = [min(1024, int(rng.lognormvariate(5.8, 0.9)) + 1) for _ in range(4000)]
    counts = {n: lengths.count(n) for n in set(lengths)}
    n = sum(times for _, times in packing.recipes(counts))
    assert n <= first_fit(lengths, 1024) * 1.005 and n <= -(-sum(lengths) // 1024) * 1.02


def check(rows, docs, capacity):
    want = sorted((i is not None, i or 0, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())) for i, text in docs for start, ids in pieces_of(ids_of(text), capacity))
    assert sorted((r.doc_id is not None, r.doc_id or 0, r.start, r.length, r.ids_crc32) for r in rows) == want
    for r in rows:
        assert (r.piece == 0) == (r.start == 0)
    return held([(r.sequence_id, r.offset, r.length) for r in rows], capacity)


def test_query_against_brute_force(spark, real):
    rows = queries.op11_best_fit_packing(spark, SF).collect()
    docs = [(r.doc_id, r.text) for r in real.collect()]
    n = check(rows, docs, 1024)
    lengths = [len(ids) for _, t in docs for _, ids in pieces_of(ids_of(t), 1024)]
    assert n <= first_fit(lengths, 1024) + 2


def test_odd_rows(odd, odd_rows, none):
    docs = [(r[0], r[1]) for r in odd_rows]
    assert check(packing.pack(odd, capacity=64, digest=True).collect(), docs, 64) >= sum(len(ids_of(t)) for _, t in docs) // 64
    assert packing.pack(none).count() == 0
    packed = packing.pack(odd, capacity=64)
    whole = {r.sequence_id: r for r in packing.sequences(packed).collect()}
    for r in packed.collect():
        assert whole[r.sequence_id].ids[r.offset : r.offset + r.length] == r.ids
    assert all(len(r.ids) == sum(r.lengths) <= 64 for r in whole.values())
