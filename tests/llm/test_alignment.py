import collections
import hashlib
import random
import tracemalloc
import types

import pyarrow as pa
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from moneytrail.llm import alignment, queries

from .conftest import SF

A = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
A.encode_special_tokens = True
B = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
SEEN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b]
NAMED = {chr(b): b for b in SEEN} | {chr(256 + i): b for i, b in enumerate(sorted(set(range(256)) - set(SEEN)))}


def groups_of(text):
    """[(A ids, B ids)] of a whole text, by the decoded bytes alone."""
    if not text:
        return []
    full = (" " + text).encode()
    a = [(i, bytes(NAMED[c] for c in A.id_to_token(i))) for i in A.encode(" " + text, add_special_tokens=False).ids]
    b = [(i, bytes([int(B.id_to_piece(i)[1:-1], 16)]) if B.is_byte(i) else B.id_to_piece(i).replace("▁", " ").encode()) for i in B.encode(text)]
    if b"".join(x for _, x in a) != full or b"".join(x for _, x in b) != full:
        return []

    def ends(tokens):
        at, out = 0, []
        for _, x in tokens:
            at += len(x)
            out.append(at)
        return out

    e_a, e_b = ends(a), ends(b)
    out, i, j = [], 0, 0
    at_a, at_b = ({e: k + 1 for k, e in enumerate(x)} for x in (e_a, e_b))
    for cut in sorted(set(e_a) & set(e_b)):
        x, y = at_a[cut], at_b[cut]
        out.append(([t for t, _ in a[i:x]], [t for t, _ in b[j:y]]))
        i, j = x, y
    return out


def brute(rows):
    found = [(i, groups_of(t)) for i, t in rows]
    linked = [collections.Counter((a, b) for x, y in g for a in x for b in y) for _, g in found]
    docs = collections.Counter(p for c in linked for p in c)
    top = {}
    for (a, _), n in docs.items():
        top[a] = max(top.get(a, 0), n)
    out = []
    for (i, groups), c in zip(found, linked, strict=True):
        text = ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in groups)
        sha = hashlib.sha256(text.encode()).hexdigest() if groups else ""
        best = sum(m for p, m in c.items() if docs[p] == top[p[0]])
        out.append((i, sum(len(x) for x, _ in groups), sum(len(y) for _, y in groups), len(groups), sum(c.values()), best, sum(m * docs[p] for p, m in c.items()), sha))
    return out


def by_all(rows):
    return sorted(map(tuple, rows), key=str)


@pytest.fixture(scope="module")
def aligner():
    with open(public_tokenizers.path("byte_bpe_50k.json")) as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        return alignment.Aligner(f.read(), g.read())


ODD = [*"aZé漢🙂 \n\t.,!'st1٣\x1c\x85\xa0 　​᠎\r\x0b-_*▁\x00́﻿", "  ", " the", "<|endoftext|>", "</s>", "<0x41>", "👩‍👩‍👧", " 漢", "'s"]


@settings(max_examples=400, deadline=None)
@given(st.lists(st.lists(st.sampled_from(ODD), min_size=1, max_size=20).map("".join), min_size=1, max_size=4))
def test_units_equal_whole_texts(aligner, texts):
    good, numbers, groups, text, pairs, links = aligner.read([" " + t for t in texts])
    for k, t in enumerate(texts):
        want = groups_of(t)
        assert good[k] == bool(want)
        if want:
            assert groups[k] == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want)
            c = collections.Counter((a << 24) + b for x, y in want for a in x for b in y)
            assert dict(zip(pairs[text == k].tolist(), links[text == k].tolist(), strict=True)) == c
            assert numbers[k].tolist() == [sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), c.total()]


def test_coarse_cuts_give_the_decoded_ends(aligner):
    a, a_ends, b, b_ends, _ = aligner.align(" é漢🙂 x ﬁ\n𝒳 end")
    assert a_ends.tolist() == aligner.a_sizes[a].cumsum().tolist() and b_ends.tolist() == aligner.b_sizes[b].cumsum().tolist()
    spans = aligner.a.encode(" é漢🙂 x", add_special_tokens=False).offsets
    assert any(s[1] > t[0] for s, t in zip(spans, spans[1:], strict=False))  # tokens that share a character


def test_no_piece_crosses_a_cut():
    assert not [p for p in map(B.id_to_piece, range(B.get_piece_size())) if "▁" in p.lstrip("▁")]


@settings(max_examples=100, deadline=None)
@given(st.text(st.sampled_from("ab  \n.é"), max_size=60), st.integers(1, 12))
def test_runs_join_to_the_text(text, size):
    parts = list(alignment.runs(text, size))
    assert "".join(parts) == " " + text and [u for p in parts for u in alignment._CUT.split(p)] == alignment._CUT.split(" " + text)


def test_wide_groups_count_like_single_links(aligner, monkeypatch):
    text = " ͸" * 30 + "𝒳é漢" * 20
    before = [x.tolist() for x in aligner.read([text])[3:]]
    aligner._forget()
    monkeypatch.setattr(alignment, "WIDE", 1)
    assert [x.tolist() for x in aligner.read([text])[3:]] == before


def test_query_against_brute_force(spark, real):
    rows = [(r.doc_id, r.text) for r in real.collect()]
    assert by_all(queries.op12_tokenizer_alignment(spark, SF).collect()) == by_all(brute(rows))


def test_odd_rows_in_small_chunks(odd, odd_rows, none, monkeypatch):
    rows = [(r[0], r[1]) for r in odd_rows]
    got = alignment.report(odd, chunk_bytes=500).collect()
    assert by_all(got) == by_all(brute(rows))
    assert alignment.report(none).count() == 0


def test_long_text_in_runs(aligner, monkeypatch):
    monkeypatch.setattr(alignment, "RUN_CHARS", 50)
    text = "Some words, é漢 and  more. " * 40
    good, numbers, digest, pairs, links = alignment._long(aligner, text)
    want = groups_of(text)
    assert good and digest == hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want).encode()).hexdigest()
    assert links.sum() == numbers[3] == sum(len(x) * len(y) for x, y in want)
    assert not alignment._long(aligner, "a▁b " * 40)[0]


def equals_whole_texts(read, texts):
    good, numbers, groups, text, pairs, links = read
    for k, want in enumerate(map(groups_of, texts)):
        assert good[k] == bool(want)
        if want:
            assert groups[k] == ";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want)
            assert dict(zip(pairs[text == k].tolist(), links[text == k].tolist(), strict=True)) == collections.Counter((a << 24) + b for x, y in want for a in x for b in y)
            assert numbers[k].tolist() == [sum(len(x) for x, _ in want), sum(len(y) for _, y in want), len(want), sum(len(x) * len(y) for x, y in want)]


def test_full_worker_goes_on_with_units_met_again(aligner, monkeypatch):
    aligner._forget()
    monkeypatch.setattr(alignment, "CACHE_UNITS", 40)
    words = random.Random(3)
    for k in range(60):
        texts = ["the same words, é漢 and a▁b" if k % 7 == 0 else "the same words, é漢", f"{'x' * 300} {k}  {words.random()} 🙂 ͸{k}." + " ͸" * k]
        known = len(aligner.index)
        equals_whole_texts(aligner.read([" " + t for t in texts]), texts)
        assert len(aligner.index) <= 40 + 100
        if known > 40:  # room was made
            assert " same" in aligner.index and len(aligner.index) < known + 10
            assert aligner.index[" same"] < 20 and list(aligner.index.values()) == list(range(len(aligner.index)))


@pytest.mark.parametrize("name, size", [("CACHE_PAIRS", lambda x: x.pairs.n), ("CACHE_BYTES", lambda x: x.chars + x.joined.n)])
def test_kept_pairs_and_text_are_bounded(aligner, monkeypatch, name, size):
    aligner._forget()
    monkeypatch.setattr(alignment, name, 3000)
    most = 0
    for k in range(30):
        texts = [f"stay {'漢é' * 150}{k} stay", "stay" if k % 3 else "𝒳é漢͸" * 40]
        equals_whole_texts(aligner.read([" " + t for t in texts]), texts)
        most = max(most, size(aligner))
    assert 3000 < most < 12_000
    aligner._forget()


def test_long_text_of_several_runs(aligner):
    text = " ".join(f"word{i % 977} é漢 and  more{i % 31}." for i in range(15_000))
    assert len(list(alignment.runs(text))) >= 3
    good, numbers, digest, pairs, links = alignment._long(aligner, text)
    want = groups_of(text)
    assert good and digest == hashlib.sha256(";".join(f"{','.join(map(str, x))}|{','.join(map(str, y))}" for x, y in want).encode()).hexdigest()
    assert dict(zip(pairs.tolist(), links.tolist(), strict=True)) == collections.Counter((a << 24) + b for x, y in want for a in x for b in y)


def test_columns_widen():
    column = alignment._Column()
    parts = [[1, 255], [], [256], [1 << 31, 7], [1 << 40]]
    for part in parts:
        column.add(alignment.np.array(part, alignment.np.int64))
    every = [x for part in parts for x in part]
    assert column.at(alignment.np.arange(column.n)).tolist() == every
    column.keep(alignment.np.array(every) > 6)
    assert column.at(alignment.np.arange(column.n)).tolist() == [x for x in every if x > 6]


def test_sums_in_parts(monkeypatch):
    monkeypatch.setattr(alignment, "SUM_PAIRS", 5)
    sums, want, words = alignment._Sums(), collections.Counter(), random.Random(5)
    for _ in range(50):
        part = [words.randrange(40) for _ in range(words.randrange(8))]
        sums.add(alignment.np.array(part, alignment.np.int64), alignment.np.ones(len(part), alignment.np.int64))
        want.update(part)
    pairs, n = sums.sums()
    assert dict(zip(pairs.tolist(), n.tolist(), strict=True)) == want and pairs.tolist() == sorted(want)


def test_memory_of_a_batch_follows_runs():
    """A megabyte of words that are all new: it was aligned at once, in 195 MB of Python objects and arrays."""
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as f, open(public_tokenizers.path("piece_bpe_32k.model"), "rb") as g:
        made_of = [types.SimpleNamespace(value=x.read()) for x in (f, g)]
    aligner = alignment._kept_aligner(*(x.value for x in made_of))
    words = random.Random(1)
    texts = [" ".join("".join(words.choices("etaoinshrdlu", k=words.randint(3, 9))) for _ in range(1000)) for _ in range(150)]
    batch = pa.RecordBatch.from_pydict({"doc_id": list(range(150)), "text": texts, "part": [0] * 150})
    tracemalloc.start()
    try:
        rows = sum(len(x) for x in alignment._aligned(*made_of, alignment.CHUNK_BYTES)(iter([batch])))
        peak = tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()
    assert rows == 151 and len(aligner.index) > 100_000 and peak < 100e6
    aligner._forget()
