import tracemalloc
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from moneytrail.llm import queries, token_file

from .conftest import SF

JSON = open(public_tokenizers.path("byte_bpe_50k.json")).read()
PLAIN = Tokenizer.from_str(JSON)
PLAIN.encode_special_tokens = True
UNITS = token_file.Units(JSON)


def ids_of(text):
    return PLAIN.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aZé漢🙂 \n\t.,!'st1٣\x1c\x85\xa0\u2003\u3000\u200b\r\x0b-_*", "  ", " the", "<|endoftext|>"]), max_size=20).map("".join), max_size=4))
def test_units_equal_whole_encoding(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, sizes = UNITS.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert ids.tolist() == [i for t in texts for i in ids_of(t)] and sizes.tolist() == [len(ids_of(t)) for t in texts]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 300), max_size=50))
def test_codes_round_trip(values):
    values = np.array(values, np.uint32)
    control, data = token_file.encode_ranks(values)
    assert len(control) == -(-len(values) // 4)
    assert token_file.decode_ranks(control, data, len(values)).tolist() == values.tolist()


def test_ranks_by_frequency():
    ranks, _, data = token_file.encode_block(np.array([9, 7, 7, 50_000, 9, 7], np.uint32))
    assert np.frombuffer(ranks, "<u4").tolist() == [7, 9, 50_000] and list(data) == [1, 0, 0, 2, 1, 0]


def test_query_against_brute_force(spark, real):
    start, want = 0, []
    for r in sorted(real.collect()):
        ids = ids_of(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, queries.op2_token_ids(spark, SF).collect())) == want


def test_odd_rows_in_small_blocks_and_files(odd, odd_rows, none):
    rows = token_file.round_trip(odd, digest=False, block_tokens=50, file_bytes=2000).collect()
    rows.sort(key=lambda r: r.start)
    assert [(r.doc_id is not None, r.doc_id) for r in rows] == sorted((i is not None, i) for i, *_ in odd_rows)
    at = 0
    for r in rows:
        assert r.start == at and r.n_tokens == len(r.ids)
        at += r.n_tokens
    assert sorted(str(list(r.ids)) for r in rows) == sorted(str(ids_of(t)) for _, t, *_ in odd_rows)
    assert token_file.round_trip(none).collect() == []


def test_cache_begins_anew(monkeypatch):
    monkeypatch.setattr(token_file, "CACHE_UNITS", 3)
    units = token_file.Units(JSON)
    for text in ("one two three four five", "six seven one two", "one"):
        raw = text.encode()
        assert units.encode(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))[0].tolist() == ids_of(text)


DEFAULT = Tokenizer.from_str(JSON)
KNOWING = token_file.Units(JSON, added_tokens=True)
END = "<|endoftext|>"


def default_ids(text):
    return DEFAULT.encode(text or "", add_special_tokens=False).ids + [0]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.lists(st.sampled_from([*"aé漢 \n.'1\u2003<|>", "  ", " the", END, END, "<|endof", "text|>"]), max_size=20).map("".join), max_size=5))
def test_added_tokens_as_by_the_librarys_default(texts):
    raw = [t.encode() for t in texts]
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])]).astype(np.int64)
    ids, sizes = KNOWING.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    assert ids.tolist() == [i for t in texts for i in default_ids(t)] and sizes.tolist() == [len(default_ids(t)) for t in texts]


def test_files_with_added_tokens(spark):
    texts = ["a <|endoftext|> b", "plain", "<|endof", "text|> x", END * 3, f"two words  {END}{END} \n it's", None]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    rows = sorted(token_file.round_trip(docs, digest=False).collect())
    assert rows[0].ids == [64, 220, 50256, 275, 0]
    start = 0
    for r, text in zip(rows, texts, strict=True):
        assert (r.start, r.ids) == (start, default_ids(text))
        start += r.n_tokens


@pytest.mark.parametrize("run_bytes", [1, 7, 64, 1000])
def test_runs_of_any_size(monkeypatch, run_bytes):
    monkeypatch.setattr(token_file, "RUN_BYTES", run_bytes)
    units = token_file.Units(JSON, added_tokens=True)
    texts = ["", "one two  three", " ", "a b long text with odd white space " * 9, "x" * 300, "", "it's <|endoftext|> here", "é漢🙂 end. " * 40, ""]
    raw = [t.encode() for t in texts]
    offsets = np.cumsum([0, *map(len, raw)])
    ids, sizes = units.encode(np.frombuffer(b"".join(raw), np.uint8), offsets)
    want = [DEFAULT.encode(t, add_special_tokens=False).ids + [0] for t in texts]
    assert sizes.tolist() == [len(x) for x in want] and ids.tolist() == [i for x in want for i in x]


def test_memory_of_a_long_text():
    """Beside its ids a long text needs some bytes a character, not tables as long as it."""
    rng = np.random.default_rng(3)
    raw = np.frombuffer(b" ".join([b"word%d" % i for i in rng.integers(0, 5000, 1_500_000)]), np.uint8)
    units = token_file.Units(JSON)
    units.encode(raw[:100_000], np.array([0, 100_000]))
    tracemalloc.start()
    ids, _ = units.encode(raw, np.array([0, len(raw)]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ids[-1] == 0 and peak < 12 * len(raw)
