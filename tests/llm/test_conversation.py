import hashlib
import itertools
import random
import zlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from moneytrail.llm import conversation, queries

from .conftest import SF

SPACE = " \t\n\x0b\x0c\r"
ROLES = ["user", "assistant", "system", "tool", "", "superuser"]


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        k = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if k == 1:
            text = ""
        if k == 2:
            text = "".join(c for c in text if c not in ".!?")
        if k == 4:
            role = "user"
        out += [(conv, turn, role, text)] * (0 if k == 0 else 2 if k == 3 else 1)
    return out


def faults(turns):
    """blank / duplicate / truncated / None of (role, text) in order."""
    seen, out = set(), []
    for role, text in turns:
        end = text.rstrip(SPACE)
        out.append("blank" if not end else "duplicate" if (role, text) in seen else "truncated" if end[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def well_formed(initials):
    body = initials[1:] if initials[:1] == "s" else initials
    return not initials or len(body) > 0 and len(body) % 2 == 0 and body == "ua" * (len(body) // 2)


def cheapest(turns):
    """Least (cost, audit, repaired) by a table over turns and the last role's initial (^: none yet)."""
    may = {("^", "s"), ("^", "u"), ("s", "u"), ("a", "u"), ("u", "a")}
    best = {"^": (0, "", ())}

    def offer(table, state, value):
        if state not in table or value[:2] < table[state][:2]:
            table[state] = value

    def with_inserts(table):
        for _ in range(2):
            for state, (cost, audit, done) in list(table.items()):
                for role in ("user", "assistant"):
                    if (state, role[0]) in may:
                        offer(table, role[0], (cost + 5, audit + "I", (*done, (role, ""))))
        return table

    for (role, text), fault in zip(turns, faults(turns), strict=True):
        after = {}
        for state, (cost, audit, done) in with_inserts(best).items():
            offer(after, state, (cost + 2, audit + "D", done))
            if fault not in ("blank", "duplicate"):
                more = 5 * (fault == "truncated")
                if (state, role[:1]) in may:
                    offer(after, role[0], (cost + more, audit + "K", (*done, (role, text))))
                for r in ("user", "assistant"):
                    if (state, r[0]) in may:
                        offer(after, r[0], (cost + 1 + more, audit + "R", (*done, (r, text))))
        best = after
    return min((v for k, v in with_inserts(best).items() if k in "^a"), key=lambda v: v[:2])


def every_edit(turns):
    """Least (cost, audit) of all edit strings with at most two inserts."""
    kinds, best = faults(turns), None
    for places in itertools.chain.from_iterable(itertools.combinations_with_replacement(range(len(turns) + 1), k) for k in range(3)):
        for edits in itertools.product("DKR", repeat=len(turns)):
            if any(k in ("blank", "duplicate") and e != "D" for k, e in zip(kinds, edits, strict=True)):
                continue
            audit = "".join("I" * places.count(i) + (edits[i] if i < len(turns) else "") for i in range(len(turns) + 1))
            cost = sum({"D": 2, "K": 0, "R": 1, "I": 5}[e] for e in audit) + 5 * sum(k == "truncated" and e != "D" for k, e in zip(kinds, edits, strict=True))
            options, source = [""], iter(turns)
            for e in audit:
                role = None if e == "I" else next(source)[0]
                added = [role[:1]] if e == "K" else ["u", "a"] if e in "RI" else [""]
                if e == "K" and not role:
                    added = ["?"]
                options = [o + x for o in options for x in added]
            if any(map(well_formed, options)) and (best is None or (cost, audit) < best):
                best = cost, audit
    return best


def brute(rows, ids):
    out = []
    for conv in ids:
        own = [r for r in rows if r[0] == conv]
        own.sort(key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
        turns, numbers = [(r[2], r[3]) for r in own], [r[1] for r in own if r[1] is not None]
        kinds = faults(turns)
        cost, audit, done = cheapest(turns) if turns else (0, "", ())
        gaps = max(numbers) - min(numbers) + 1 - len(set(numbers)) if numbers else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(turns))
        sha = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in done).encode()).hexdigest()
        out.append((conv, gaps, *[kinds.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit, sha))
    return out


def by_id(rows):
    return sorted(map(tuple, rows), key=lambda r: (r[0] is not None, r[0] or 0))


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    got = queries.op13_conversation_repair(spark, SF).collect()
    assert by_id(got) == by_id(brute(damaged(rows), {r[0] for r in rows}))


SIGNS = "suaoSUAOx"


def turns_of(signs):
    return [("t" if s.lower() == "o" else {"s": "system", "u": "user", "a": "assistant", "x": "user"}[s.lower()], "" if s == "x" else f"{i}" + ("" if s.isupper() else ".")) for i, s in enumerate(signs)]


@settings(max_examples=100, deadline=None)
@given(st.text(SIGNS, max_size=30))
def test_agenda_finds_the_cheapest_and_least_edits(signs):
    assert conversation.goal(conversation.stretch(signs)) == cheapest(turns_of(signs))[:2]


@settings(max_examples=60, deadline=None)
@given(st.text(SIGNS, max_size=4))
def test_agenda_equals_trying_every_edit(signs):
    assert conversation.goal(conversation.stretch(signs)) == every_edit(turns_of(signs))


@settings(max_examples=100, deadline=None)
@given(st.text(SIGNS, max_size=40), st.lists(st.integers(0, 40), max_size=5))
def test_joined_stretches_equal_the_whole(signs, cuts):
    edges = [0, *sorted(min(c, len(signs)) for c in cuts), len(signs)]
    parts = [conversation.stretch(signs[a:b]) for a, b in itertools.pairwise(edges)]
    assert conversation.joined(parts) == conversation.stretch(signs)


def odd_conversations():
    rng = random.Random(3)
    rows = [(conv, turn, rng.choice(ROLES[:3] if conv % 3 else ROLES), rng.choice(["Yes.", "No!", "what", "", " \n", "é漢 🙂?", "same."])) for conv in range(20) for turn in range(rng.randint(1, 6))]
    rows += [(50, 0, "user", "Hi."), (50, 0, "user", "Hi."), (50, 0, "assistant", "So."), (50, 5, "assistant", "So.")]
    rows += [(51, None, "user", "a."), (51, None, None, None), (51, 2, "assistant", None), (52, None, "user", "b."), (None, 1, "user", "c."), (None, 2, "assistant", "d."), (None, None, None, None)]
    rows += [(53, 1, "user", "x" * 200_000 + "."), (53, 2, "assistant", "y" * 200_000)]
    return rows


EXTRA = "place string, pos string, kind string, key string, block string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, *["x"] * 5) for r in rows], f"conv_id bigint, turn bigint, role string, text string, {EXTRA}")


def test_odd_rows(spark):
    rows = odd_conversations()
    df = frame(spark, rows).repartition(3)
    got = conversation.report(conversation.damage(df), df.select("conv_id"))
    assert by_id(got.collect()) == by_id(brute(damaged(rows), {r[0] for r in rows}))
    plain = conversation.report(df).collect()  # undamaged
    filled = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert by_id(plain) == by_id(brute(filled, {r[0] for r in rows}))


def test_dropped_conversations_are_reported(spark):
    drops = [c for c in range(2000) if zlib.crc32(f"{c}:0".encode()) % 20 == 0][:3]
    df = frame(spark, [(c, 0, "user", "Hi.") for c in drops])
    got = conversation.report(conversation.damage(df), df.select("conv_id")).collect()
    assert by_id(got) == [(c, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) for c in drops]


def test_empty_table(spark):
    df = frame(spark, [])
    assert conversation.report(conversation.damage(df), df.select("conv_id")).count() == 0
    assert conversation.repair(df).count() == 0


def test_long_conversation_is_repaired_in_stretches(spark):
    rng = random.Random(9)
    rows = [(7, i, rng.choice(ROLES[:3]), f"t{rng.randint(0, 400)}" + rng.choice([".", "", "!"])) for i in range(700)]
    rows += [(8, 0, "user", "Same.")] * 300 + [(9, i, "assistant", f"{i}.") for i in range(5)]
    df = frame(spark, rows).repartition(4)
    small = conversation.report(df, block_bits=4, fan_bits=2).collect()
    assert by_id(small) == by_id(conversation.report(df).collect())
    got = {r.conv_id: r for r in small}
    assert got[8].audit == "D" * 300 and got[8].cost == 600 and got[8].duplicate == 299
    turns = [(r[2], r[3]) for r in rows if r[0] == 7]
    signs = "".join("x" if f in ("blank", "duplicate") else r[0].upper() if f == "truncated" else r[0] for f, (r, _) in zip(faults(turns), turns, strict=True))
    assert (got[7].cost, got[7].audit) == conversation.goal(conversation.stretch(signs))
    lines = [r for r in conversation.repair(df, block_bits=4, fan_bits=2).where("conv_id = 7 and role is not null").orderBy("place").collect()]
    assert [r.place for r in lines] == list(range(len(lines))) and well_formed("".join(r.role[:1] for r in lines))
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in lines).encode()).hexdigest() == got[7].repaired_sha256


def test_agenda_refuses_nothing_final_twice():
    edges = {"a": [(("a",), "b", lambda w: (w[0] + 2, w[1] + "x")), (("a", "c"), "b", lambda w, v: (w[0] + v[0], w[1] + "y"))], "c": [(("a", "c"), "b", lambda w, v: (w[0] + v[0], w[1] + "y"))]}
    got = conversation.lightest({"a": (0, ""), "c": (1, "")}, lambda i: edges.get(i, []), "b")
    assert got["b"] == (1, "y")


@pytest.mark.parametrize("edit", ["K", "R", "D", "I"])
def test_replay_keeps_the_grammar(edit):
    table = conversation.stretch("uaU" + "x")
    audit = conversation.goal(table)[1]
    lines = list(conversation.replay(audit, [("user", "a."), ("assistant", "b."), ("user", "c"), ("user", "")]))
    assert well_formed("".join(r[0] for _, r, _ in lines if r)) and len([x for x in lines if x[0] == edit]) == audit.count(edit)


def test_damage_of_every_kind(spark):
    rows = [(c, 0, "assistant", "A. b!") for c in range(200)]
    got = sorted(map(tuple, conversation.damage(frame(spark, rows)).collect()))
    assert got == sorted(damaged(rows)) and F is not None
