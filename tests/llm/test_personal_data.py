import hashlib
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from moneytrail.llm import personal_data, queries

from .conftest import SF

PATTERNS = (
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
)


def valid(kind, text):
    digits = re.sub("[^0-9]", "", text)
    return (True, all(int(p) <= 255 for p in text.split(".")) if kind == 1 else True, 14 <= len(digits) <= 19 and personal_data.luhn(digits), 10 <= len(digits) <= 15)[kind]


def brute(text):
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text or "") if valid(k, m[0]))


def joined(spans):
    return ",".join(f"{personal_data.KINDS[k]}:{a}:{b}" for a, k, b in spans)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.sampled_from([*"a.@-_1 23+()é%\n", "4111111111111111", "192.168.1.1", "x@y.z", "+1 (202) 555-0123", "0"]), max_size=25).map("".join))
def test_plain_against_the_patterns(text):
    assert personal_data.plain(text) == brute(text)
    assert [x[:3] for x in personal_data.identifiers(text) if x[3]] == brute(text)


def test_query_against_brute_force(spark, real):
    rows = {r.doc_id: r for r in queries.op8_pii(spark, SF).collect()}
    for r in real.collect():
        base, got = brute(r.text), rows[r.doc_id]
        assert tuple(got)[1:5] == tuple(sum(k == kind for _, k, _ in base) for kind in range(4))
        assert got.base_sha256 == hashlib.sha256(joined(base).encode()).hexdigest()
        assert set(joined(base).split(",")) <= set(got.spans.split(","))
    assert sum(r.n_email for r in rows.values())


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("é write to john [at] example [dot] com now", [("email", "john [at] example [dot] com")]),
        ("john.doe at example dot com", [("email", "john.doe at example dot com")]),
        ("jane(at)mail.example.org", [("email", "jane(at)mail.example.org")]),
        ("jоhn@exаmple.com", [("email", "jоhn@exаmple.com")]),
        ("jo\u200bhn@example.com", [("email", "jo\u200bhn@example.com"), ("email", "hn@example.com")]),
        ("＋1 (202) 555-0123", [("phone", "＋1 (202) 555-0123")]),
        ("call plus one two zero two five five five zero one two three four", [("phone", "plus one two zero two five five five zero one two three four")]),
        ("ip one nine two dot one six eight dot one dot one ok", [("ip", "one nine two dot one six eight dot one dot one")]),
        ("192[.]168[.]1[.]10", [("ip", "192[.]168[.]1[.]10")]),
        ("4l11 1111 1111 1111", [("card", "4l11 1111 1111 1111")]),
        ("we met at example.com today, look at this dot here", []),
        ("un deux trois, one or two at most", []),
        ("", []),
    ],
)
def test_disguises(text, found):
    spans = personal_data.identifiers(text)
    assert [(personal_data.KINDS[k], text[a:b]) for a, k, b, _ in spans] == found
    assert not any(p for *_, p in spans) or brute(text)


def test_odd_rows(odd, odd_rows, none, spark):
    found = personal_data.find(odd)
    assert found.columns == [c for c in odd.columns if c not in ("spans", "text")] + ["spans"]
    assert found.count() == len(odd_rows) and none.count() == personal_data.find(none).count() == 0
    docs = spark.createDataFrame([(1, "to a@b.cc and x at y dot com.", "z"), (2, None, "z"), (3, "", "z")], "doc_id bigint, text string, row string")
    assert [tuple(r) for r in personal_data.redact(docs).orderBy("doc_id").collect()] == [(1, "to <email> and <email>.", "z"), (2, None, "z"), (3, "", "z")]


def test_long_runs_take_linear_time():
    for text in ("a" * 400_000, "1" * 400_000, "a@" * 100_000, "1." * 100_000, "+1" + " " * 200_000):
        assert personal_data.plain(text) == [] or len(text) > 0


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("192 point 168 point 1 point 10", [("ip", "192 point 168 point 1 point 10")]),
        ("jane@example .com", [("email", "jane@example .com")]),
        ("(192.168.1.one two)", [("ip", "192.168.1.one two")]),
        ("e\u0130ns zwei", []),
    ],
)
def test_every_rule_alone_is_enough(text, found):
    assert [(personal_data.KINDS[k], text[a:b]) for a, k, b, _ in personal_data.identifiers(text)] == found


DISGUISED = ["192", "168", "1", "1l1", "one", "ZWEI", "n\u0130ne", "zéro", "jane", "example", "com", "fr", "it", "at", "arobase", "dot", "Point", "plus", "@", ".", "[at]", "( dot )", "<", "this", ",", "(", ")", "+1 202 555", "é", "\u200b", "4111 1111 1111 1111"]


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(DISGUISED), st.sampled_from(["", " ", "  ", "-", "\n"])), max_size=14).map(lambda x: "".join(a + b for a, b in x)))
def test_gate_against_no_gate(text):
    tape, free = personal_data.normalise(text), personal_data.rewritten(text)
    assert (tape.text if tape else text) == free.text
    assert tape is None or (tape.starts, tape.ends) == (free.starts, free.ends)


@pytest.mark.parametrize(
    ("text", "found"),
    [
        ("to jane at example dot it now", ["jane at example dot it"]),
        ("jane at mail dot example dot online", ["jane at mail dot example dot online"]),
        ("jane at example dot ca, bob at example dot co.", ["jane at example dot ca", "bob at example dot co"]),
        ("jane @ example.it", ["jane @ example.it"]),
        ("jane@ example.online, jane @example.it", ["jane@ example.online", "jane @example.it"]),
        ("jane@example .it or jane @ mail .example .it", ["jane@example .it", "jane @ mail .example .it"]),
        ("jane @ example . it", []),
        ("jane @ example . ca", ["jane @ example . ca"]),
        ("jean arobase exemple point fr", ["jean arobase exemple point fr"]),
        ("jean point dupont arobase mail point exemple point paris", ["jean point dupont arobase mail point exemple point paris"]),
        ("jean (arobase) exemple (point) fr", ["jean (arobase) exemple (point) fr"]),
        ("jean at exemple point fr, jean at exemple point ca", ["jean at exemple point fr", "jean at exemple point ca"]),
        ("jean@exemple point fr", ["jean@exemple point fr"]),
        ("juan arroba ejemplo punto pe, juan arroba ejemplo.pe", ["juan arroba ejemplo punto pe", "juan arroba ejemplo.pe"]),
        ("we met at some point in May, at boiling point it steams, look at the dot on it", []),
        ("thanks @jane.doe and see you @ noon. Then we go", []),
        ("jane@example.com point final, bob@example.com . Then", ["jane@example.com", "bob@example.com"]),
    ],
)
def test_addresses_of_any_end(text, found):
    assert [text[a:b] for a, _, b, _ in personal_data.identifiers(text)] == found
