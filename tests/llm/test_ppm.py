import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moneytrail.llm import ppm, queries
from moneytrail.llm.common import crc_mod
from moneytrail.llm.lookup import Table

from .conftest import SF


def held(doc_id):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 7 == 2


class Brute:
    """Word counts and byte contexts in dictionaries, one training text after another."""

    def __init__(self, rows):
        self.words, self.contexts = Counter(), defaultdict(Counter)
        for _, text in (r for r in rows if not held(r[0])):
            self.words.update(self.tokens(text))
            s = self.signs(text)
            for p in range(ppm.ORDER, len(s)):
                for k in range(ppm.ORDER + 1):
                    self.contexts[tuple(s[p - k : p])][s[p]] += 1
        self.n, self.v = sum(self.words.values()), len(self.words)

    @staticmethod
    def tokens(text):
        return [*(text or "").encode().lower().split(), None]

    @staticmethod
    def signs(text):
        return [ppm.PAD] * ppm.ORDER + list((text or "").encode().lower()) + [ppm.END]

    def base(self, text):
        return sum(math.log10((self.words[w] + 1) / (self.n + self.v + 1)) for w in self.tokens(text))

    def score(self, text):
        s, total = self.signs(text), 0.0
        for p in range(ppm.ORDER, len(s)):
            gone = set()
            for k in range(ppm.ORDER, -1, -1):
                live = {a: n for a, n in self.contexts.get(tuple(s[p - k : p]), {}).items() if a not in gone}
                if not live:
                    continue
                whole = sum(live.values()) + len(live)
                if s[p] in live:
                    total += math.log10(live[s[p]] / whole)
                    break
                total += math.log10(len(live) / whole)
                gone |= set(live)
            else:
                total -= math.log10(ppm.SIGNS - len(gone))
        return total


def check(found, rows):
    brute = Brute(rows)
    want = sorted(((i, held(i), len(Brute.tokens(t)), sum(brute.words[w] > 0 for w in Brute.tokens(t)), brute.n) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens) for r in found), key=str) == want
    short = [(i, t) for i, t in rows if len(t or "") < 5000]
    for column, f in (("base_score", brute.base), ("score", brute.score)):
        got = sorted(getattr(r, column) for r in found)
        each = sorted(f(t) for _, t in short)
        # every short text's value is there
        at = np.clip(np.searchsorted(got, each), 1, len(got) - 1)
        near = np.minimum(np.abs(np.array(got)[at] - each), np.abs(np.array(got)[at - 1] - each))
        assert (near <= 1e-9 * np.abs(each) + 1e-9).all()


def test_query_against_brute_force(spark, real):
    check(queries.op9_lm_scoring(spark, SF).collect(), [(r.doc_id, r.text) for r in real.collect()])


def test_odd_rows_and_shards(odd, odd_rows, none):
    rows = [(i, t) for i, t, *_ in odd_rows]
    out = crc_mod(F.col("doc_id"), 7) == 2
    one = ppm.score(odd, out).collect()
    check(one, rows)
    many = ppm.score(odd, out, shard_contexts=20_000).collect()  # several scans, the same sums
    np.testing.assert_allclose(sorted(r.score for r in many), sorted(r.score for r in one))
    assert ppm.score(none, out).collect() == []
    blank = ppm.score(odd, F.lit(True)).collect()  # nothing to learn from
    assert {r.train_tokens for r in blank} == {0} and {r.n_known for r in blank} == {0}
    assert [r.score for r in blank if r.doc_id == 303] == pytest.approx([-2 * math.log10(255)])


@settings(max_examples=40, deadline=None)
@given(st.lists(st.integers(0, 2**64 - 1), unique=True, max_size=200), st.lists(st.integers(0, 2**64 - 1), max_size=20))
def test_table(keys, others):
    table = Table()
    for i in range(0, len(keys), 37):
        table.add(np.array(keys[i : i + 37], np.uint64))
    assert table.find(np.array(keys, np.uint64)).tolist() == list(range(len(keys)))
    assert table.find(np.array(others, np.uint64)).tolist() == [keys.index(x) if x in keys else -1 for x in others]


def test_probabilities_add_up():
    rows = [b"abracadabra", b"abba", b"cab"]
    data, offsets = np.frombuffer(b"".join(rows), np.uint8), np.array([0, 11, 15, 18])
    stream, _ = ppm.laid_out(data, offsets)
    grams, counts = ppm.summed(*np.unique(np.concatenate([g for _, g in ppm.context_runs(stream)]), return_counts=True))
    trie = ppm.Trie(grams, counts, *ppm.summed(grams & np.uint64(0xFFFF), counts))
    for context in (b"abrac", b"zzabr", b"zzzzz", b"\xff\xff\xff\xff\xff"):
        head = np.uint64(int.from_bytes(context[-ppm.ORDER :], "big") << 8)
        assert (10 ** trie.log10(head + np.arange(255, dtype=np.uint64))).sum() == pytest.approx(1)


def test_long_texts_in_runs(monkeypatch):
    data, offsets = np.frombuffer(b"some bytes to cut" * 9, np.uint8), np.array([0, 40, 40, 153])
    stream, _ = ppm.laid_out(data, offsets)
    whole = [np.concatenate(x) for x in zip(*ppm.context_runs(stream), strict=True)]
    for size in (1, 3, 50):
        monkeypatch.setattr(ppm, "RUN_BYTES", size)
        for a, b in zip(whole, zip(*ppm.context_runs(stream), strict=True), strict=True):
            assert a.tolist() == np.concatenate(b).tolist()
