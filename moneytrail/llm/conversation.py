"""Conversation structure repair by Knuth's lightest derivations.

A conversation is a sequence of turns; a well-formed one has role initials ``(s?(ua)+)?``. Its faults: a
*blank* turn holds nothing but white space, a *duplicate* repeats role and text of an earlier turn, a
*truncated* one does not end in ``.``, ``!`` or ``?`` (the first that holds counts). Edits: Keep (cost 0), Rerole
to user or assistant (1), Delete (2, the only edit of blank and duplicate turns), Insert an empty user or assistant
turn (5); a truncated turn that stays adds 5. Among the cheapest edits the ASCII-least string of initials wins.

Repair is deduction: the item (i, q) says "the first i turns are edited and what they give leads to state q of the
grammar". Every turn is an axiom of the least weight (0, ""); an edit is a hyperedge from an item and a turn to the next item,
whose function adds its cost and its initial. Weights (cost, audit) are ordered; two weights of one item hold
equally many turns, so neither audit of equal cost begins the other, and the functions are monotone and superior: the
first weight of an item that the agenda pops is its lightest, and the search ends when the goal is popped.

Distribution. Turns are laid out in order by a range partition (conversations of any length span partitions; turns
that tie are told apart by role, 64 characters of text and a hash) and get ascending positions. Earlier turns of equal role
and text are found by a pre-aggregated minimum of positions. Every 2**``BLOCK_BITS`` consecutive positions are one task's group,
whatever conversation they belong to: a stretch of a conversation in it becomes a table of lightest edits from
each state to each. Tables of consecutive stretches are joined by the same agenda, 2**``FAN_BITS`` at a time, in rounds, so no
task holds all turns of a long conversation before its audit is known. At last a conversation's turns stream in order
past its audit; only the audit (a byte per turn) and one batch are in memory. Its SHA-256 is one sequential pass by nature,
so the digest of one conversation is one task's work.

Defined cases: null roles and texts are one space; a null conv_id is a conversation; null turns come first; a role
that is empty or has another initial than s, u, a is never kept; repeated rows are duplicates; texts of any length are read
whole, one row at a time; a conversation of which nothing is left has zeros and an empty audit; an empty table gives
no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import heapq
from collections.abc import Callable, Hashable, Iterable, Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moneytrail.llm.common import bound_batches, written

RENAME, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
#: A group of the first search holds so many positions (a power of two: its exponent).
BLOCK_BITS = 9
#: So many stretches of one conversation are joined at once (an exponent again).
FAN_BITS = 6
#: Bytes of text in one partition, on average.
PARTITION_BYTES = 256 << 20
_SPACE = " \t\n\x0b\x0c\r"

START, SYSTEM, USER, ASSISTANT = range(4)
ACCEPTED = (START, ASSISTANT)
_NEXT = {("s", START): SYSTEM, ("u", START): USER, ("u", SYSTEM): USER, ("u", ASSISTANT): USER, ("a", USER): ASSISTANT}
_NAMES = {"u": "user", "a": "assistant"}

Weight = tuple[int, str]
Edge = tuple[tuple[Hashable, ...], Hashable, Callable[..., Weight]]
#: (from state, to state) -> lightest edits in between
Lightest = dict[tuple[int, int], Weight]

# --------------------------------------------------------------------------- deduction


def lightest(axioms: dict, edges_of: Callable[[Hashable], Iterable[Edge]], goal: Hashable = None) -> dict:
    """The lightest weights of all items that derive from ``axioms``, up to the goal's.

    ``edges_of(item)`` gives the hyperedges (tails, head, function) of which the item is a tail; an edge is used when
    its last tail is final. Functions must be monotone, and no lighter than their arguments.
    """
    agenda = [(weight, item) for item, weight in axioms.items()]
    heapq.heapify(agenda)
    final: dict = {}
    while agenda and goal not in final:
        weight, item = heapq.heappop(agenda)
        if item in final:
            continue
        final[item] = weight
        for tails, head, function in edges_of(item):
            if head not in final and all(t in final for t in tails):
                heapq.heappush(agenda, (function(*[final[t] for t in tails]), head))
    return final


def _plus(cost: int, audit: str) -> Callable[..., Weight]:
    return lambda before, *_: (before[0] + cost, before[1] + audit)


def turn_edits(sign: str) -> list[tuple[int, int, int, str]]:
    """(state, state after, cost, initial) of the edits of a turn.

    Its sign is x where it must go, else the initial of its role (o for any other), a capital where it is truncated.
    """
    found = [(q, q, DELETE, "D") for q in range(4)]
    if sign != "x":
        more = TRUNCATED * sign.isupper()
        found += [(q, to, more, "K") for (initial, q), to in _NEXT.items() if initial == sign.lower()]
        found += [(q, to, more + RENAME, "R") for (initial, q), to in _NEXT.items() if initial in _NAMES]
    return found


_INSERTS = [(q, to) for (initial, q), to in _NEXT.items() if initial in _NAMES]


def _derive(steps: list[list[tuple[int, int, int, str]]], start: int, inserts: bool) -> Lightest:
    """The lightest ways from ``start`` to each state, through all ``steps``: (state, state after, cost, audit)."""
    n = len(steps)

    def edges_of(item) -> Iterator[Edge]:
        kind, i, *state = item
        if i < n:
            for q, to, cost, audit in steps[i]:
                if kind == "turn" or q == state[0]:
                    yield (("at", i, q), ("turn", i)), ("at", i + 1, to), _plus(cost, audit)
        if kind == "at" and inserts:
            for q, to in _INSERTS:
                if q == state[0]:
                    yield (item,), ("at", i, to), _plus(INSERT, "I")

    axioms = {("turn", i): (0, "") for i in range(n)} | {("at", 0, start): (0, "")}
    final = lightest(axioms, edges_of)
    return {(start, q): final["at", n, q] for q in range(4) if ("at", n, q) in final}


def _stretch(signs: str) -> Lightest:
    found: Lightest = {}
    for start in range(4):
        found |= _derive([turn_edits(s) for s in signs], start, True)
    return found


@lru_cache(1 << 14)
def _kept_stretch(signs: str) -> Lightest:
    return _stretch(signs)


def stretch(signs: str) -> Lightest:
    """The lightest edits of a stretch of turns between all states; short stretches are remembered."""
    return _kept_stretch(signs) if len(signs) <= 24 else _stretch(signs)


def joined(tables: list[Lightest]) -> Lightest:
    """The table of consecutive stretches: each is a step whose edits are its entries."""
    if len(tables) == 1:
        return tables[0]
    found: Lightest = {}
    steps = [[(p, q, cost, audit) for (p, q), (cost, audit) in t.items()] for t in tables]
    for start in range(4):
        found |= _derive(steps, start, False)
    return found


def goal(table: Lightest) -> Weight:
    """The lightest derivation of a well-formed conversation."""
    edges = {("end", q): [((("end", q),), ("goal",), lambda w: w)] for q in ACCEPTED}
    ends = {("end", q): table[START, q] for q in ACCEPTED if (START, q) in table}
    return lightest(ends, lambda item: edges.get(item, []), ("goal",))["goal",]


def replay(audit: str, turns: Iterable[tuple[str, str]]) -> Iterator[tuple[str, str | None, str]]:
    """(edit, role, text) of each edit of ``audit`` over (role, text) of the turns; a deleted turn has no role."""
    state, source = START, iter(turns)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(source)
        if edit == "D":
            yield edit, None, text
            continue
        if edit != "K":  # the grammar leaves one role
            role = _NAMES["a" if state == USER else "u"]
        state = _NEXT[role[0], state]
        yield edit, role, text


# --------------------------------------------------------------------------- turns


def damage(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role and text with the faults that crc32(``conv_id:turn``) mod 20 says: 0 drops a turn, 1 empties its text, 2 removes
    its ends of sentences, 3 repeats it, 4 makes it the user's. A null is one space in the checksum, role and text."""
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    k = F.crc32(F.concat(filled(conv_id), F.lit(":"), filled(turn)).cast("binary")) % 20
    texts = F.when(F.col("k") == 1, "").when(F.col("k") == 2, F.translate(filled(text), ".!?", "")).otherwise(filled(text))
    roles = F.when(F.col("k") == 4, "user").otherwise(filled(role))
    times = F.array_repeat(F.lit(0), F.when(F.col("k") == 3, 2).otherwise(1))
    kept = rows.select(*[F.col(c) for c in dict.fromkeys((conv_id, turn, role, text))], k.alias("k")).where("k <> 0")
    out = kept.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), roles.alias("role"), texts.alias("text"), times.alias("times"))
    return out.select("conv_id", "turn", "role", "text", F.explode("times")).drop("col")


def _signs(role: Column) -> Column:
    first = F.left(role, F.lit(1))
    return F.when(first.isin("s", "u", "a"), first).otherwise("o")


def partitions_of(rows: DataFrame) -> int:
    """Partitions by bytes of text, at least Spark's own number."""
    size = rows.agg(F.sum(F.octet_length("text").cast("bigint") + 32)).first()[0] or 0
    return max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PARTITION_BYTES))


def laid_out(rows: DataFrame, parts: int) -> DataFrame:
    """Turns (conv_id, turn, role, text) in order, written: pos ascends with it; blank, truncated and key (of role and text)."""
    rows = rows.select("conv_id", "turn", *[F.coalesce(c, F.lit(" ")).alias(c) for c in ("role", "text")])
    order = [F.col("conv_id"), F.col("turn"), F.col("role"), F.left("text", F.lit(64)), F.xxhash64("text")]
    end = F.rtrim(F.col("text"), F.lit(_SPACE))
    key = F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary"))
    sorted_rows = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    return written(sorted_rows.select(F.monotonically_increasing_id().alias("pos"), "*", (end == "").alias("blank"), (~F.right(end, F.lit(1)).isin(".", "!", "?")).alias("truncated"), key.alias("key")), "turns")


_COUNTS = ("turns", "blank", "duplicate", "truncated", "illegal")
_STRETCH = ", ".join([f"{c} bigint" for c in _COUNTS]) + ", first string, last string, low bigint, high bigint, distinct_turns bigint, entries array<struct<p:int,q:int,cost:bigint,audit:string>>"
_ENTRIES = pa.list_(pa.struct([("p", pa.int32()), ("q", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_LEGAL = {"su", "ua", "au"}


def _summary(turns: list[dict]) -> dict:
    """Counts and table of a stretch of turns."""
    initials = [t["role"] for t in turns]
    numbers = [t["turn"] for t in turns if t["turn"] is not None]
    blank, copies = sum(t["blank"] for t in turns), sum(t["duplicate"] for t in turns)
    signs = "".join("x" if t["blank"] or t["duplicate"] else t["role"].upper() if t["truncated"] else t["role"] for t in turns)
    return {
        "turns": len(turns), "blank": blank, "duplicate": copies, "truncated": sum(s.isupper() for s in signs),
        "illegal": sum(a + b not in _LEGAL for a, b in zip(initials, initials[1:], strict=False)), "first": initials[0], "last": initials[-1],
        "low": numbers[0] if numbers else None, "high": numbers[-1] if numbers else None, "distinct_turns": len(set(numbers)), "entries": _entries(stretch(signs)),
    }


def _entries(table: Lightest) -> list[dict]:
    return [{"p": p, "q": q, "cost": cost, "audit": audit} for (p, q), (cost, audit) in table.items()]


def merged(parts: list[dict]) -> dict:
    """The summary of consecutive stretches of one conversation."""
    out = {c: sum(p[c] for p in parts) for c in _COUNTS}
    out["illegal"] += sum(a["last"] + b["first"] not in _LEGAL for a, b in zip(parts, parts[1:], strict=False))
    out |= {"first": parts[0]["first"], "last": parts[-1]["last"]}
    numbered = [p for p in parts if p["low"] is not None]  # turns without a number come first
    out |= {"low": numbered[0]["low"] if numbered else None, "high": numbered[-1]["high"] if numbered else None}
    out["distinct_turns"] = sum(p["distinct_turns"] for p in numbered) - sum(a["high"] == b["low"] for a, b in zip(numbered, numbered[1:], strict=False))
    out["entries"] = _entries(joined([{(e["p"], e["q"]): (e["cost"], e["audit"]) for e in p["entries"]} for p in parts]))
    return out


_SUMMARY = pa.schema([("conv_id", pa.int64()), ("block", pa.int64()), *[(c, pa.int64()) for c in _COUNTS], ("first", pa.string()), ("last", pa.string()), ("low", pa.int64()), ("high", pa.int64()), ("distinct_turns", pa.int64()), ("entries", _ENTRIES)])


def _grouped(batches: Iterator[pa.RecordBatch], key: Callable[[dict], Hashable], make: Callable[[list[dict]], dict]) -> Iterator[pa.RecordBatch]:
    """One row of each run of rows that ``key`` holds together."""
    held, now, out = [], None, []
    for batch in batches:
        for row in batch.to_pylist():
            if held and key(row) != now:
                out.append(make(held))
                held = []
                if len(out) >= 2048:
                    yield pa.RecordBatch.from_pylist(out, _SUMMARY)
                    out = []
            now = key(row)
            held.append(row)
    if held:
        out.append(make(held))
    yield pa.RecordBatch.from_pylist(out, _SUMMARY)


def stretches(laid: DataFrame, parts: int, block_bits: int = BLOCK_BITS) -> DataFrame:
    """(conv_id, block, summary) of each conversation's turns in each block of positions."""
    slim = laid.select("pos", "conv_id", "turn", _signs(F.col("role")).alias("role"), "blank", "truncated", "key")
    firsts = slim.where("not blank").groupBy("conv_id", "key").agg(F.min("pos").alias("pos")).select("pos", F.lit(False).alias("duplicate"))
    marked = slim.drop("key").join(firsts, "pos", "left").withColumn("duplicate", F.coalesce("duplicate", ~F.col("blank")))
    dealt = marked.withColumn("block", F.shiftright("pos", block_bits)).repartition(parts, "block").sortWithinPartitions("pos")
    make = lambda turns: {"conv_id": turns[0]["conv_id"], "block": turns[0]["block"], **_summary(turns)}
    return dealt.mapInArrow(lambda batches: _grouped(batches, lambda r: (r["block"], r["conv_id"]), make), f"conv_id bigint, block bigint, {_STRETCH}")


def _narrowed(found: DataFrame, parts: int, bits: int) -> DataFrame:
    """Stretches of one conversation in 2**``bits`` consecutive blocks, joined."""
    wide = found.withColumn("wide", F.shiftright("block", bits))
    dealt = wide.repartition(parts, "conv_id", "wide").sortWithinPartitions("conv_id", "wide", "block")
    make = lambda rows: {"conv_id": rows[0]["conv_id"], "block": rows[0]["block"], **merged(rows)}
    return dealt.mapInArrow(lambda batches: _grouped(batches, lambda r: (r["conv_id"], r["wide"]), make), f"conv_id bigint, block bigint, {_STRETCH}")


# --------------------------------------------------------------------------- repair

_TURNS = "conv_id bigint, place bigint, edit string, role string, text string"
_REPORT = "conv_id bigint, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string, repaired_sha256 string"


def _schema(text: str) -> pa.Schema:
    return pa.schema([(n, pa.string() if t == "string" else pa.int64()) for n, t in (x.split() for x in text.split(", "))])


def _repaired(batches: Iterator[pa.RecordBatch], report: bool) -> Iterator[pa.RecordBatch]:
    """A conversation's rows come as: itself, its stretches in order, its turns in order."""
    schema, out, size = _schema(_REPORT if report else _TURNS), [], 0

    def rows() -> Iterator[tuple]:
        for batch in batches:
            yield from zip(batch.column("conv_id").to_pylist(), batch.column("kind").to_pylist(), batch.column("stretch"), batch.column("role"), batch.column("text"), strict=True)

    stream = rows()
    row = next(stream, None)
    while row is not None:
        conv_id, parts = row[0], []
        while row is not None and row[0] == conv_id and row[1] < 2:
            if row[1] == 1:
                parts.append(row[2].as_py())
            row = next(stream, None)
        facts = merged(parts) if parts else None
        cost, audit = goal({(e["p"], e["q"]): (e["cost"], e["audit"]) for e in facts["entries"]}) if parts else (0, "")

        def turns() -> Iterator[tuple[str, str]]:
            nonlocal row
            while row is not None and row[0] == conv_id and row[1] == 2:  # noqa: B023 - used up before the next
                turn = row[3].as_py(), row[4].as_py()
                row = next(stream, None)
                yield turn

        digest, place = hashlib.sha256(), 0
        for edit, role, text in replay(audit, turns()):
            if not report:
                out.append({"conv_id": conv_id, "place": None if role is None else place, "edit": edit, "role": role, "text": text})
                size += 100 + len(text)
            elif role is not None:
                digest.update(f"{chr(10) if place else ''}{role}:{text}".encode())
            place += role is not None
            if size > 4 << 20:
                yield pa.RecordBatch.from_pylist(out, schema)
                out, size = [], 0
        if report:
            gaps = facts["high"] - facts["low"] + 1 - facts["distinct_turns"] if parts and facts["low"] is not None else 0
            out.append({"conv_id": conv_id, "gaps": gaps, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest(), **{c: facts[c] if parts else 0 for c in _COUNTS[1:]}})
            size += 200 + len(audit)
    yield pa.RecordBatch.from_pylist(out, schema)


def _streamed(rows: DataFrame, ids: DataFrame | None, report: bool, block_bits: int = BLOCK_BITS, fan_bits: int = FAN_BITS) -> DataFrame:
    bound_batches(rows.sparkSession)
    parts = partitions_of(rows)
    laid = laid_out(rows, parts)
    found = written(stretches(laid, parts, block_bits), "stretches")
    bits = 0
    while (found.groupBy("conv_id").count().agg(F.max("count")).first()[0] or 0) > 1 << fan_bits:
        bits += fan_bits
        found = written(_narrowed(found, parts, bits), "stretches")
    summary = F.struct(*[x.split()[0] for x in _STRETCH.split(", ")])
    nothing = F.lit(None).cast("string")
    no_stretch = F.lit(None).cast(found.select(summary.alias("s")).schema["s"].dataType)
    ids = (laid if ids is None else ids).select(F.col("conv_id").cast("bigint").alias("conv_id")).distinct()
    heads = ids.select("conv_id", F.lit(0).alias("kind"), F.lit(0).cast("bigint").alias("pos"), no_stretch.alias("stretch"), nothing.alias("role"), nothing.alias("text"))
    middle = found.select("conv_id", F.lit(1).alias("kind"), F.col("block").alias("pos"), summary.alias("stretch"), nothing.alias("role"), nothing.alias("text"))
    turns = laid.select("conv_id", F.lit(2).alias("kind"), "pos", no_stretch.alias("stretch"), "role", "text")
    together = heads.unionByName(middle).unionByName(turns).repartition(parts, "conv_id").sortWithinPartitions("conv_id", "kind", "pos")
    return together.select("conv_id", "kind", "stretch", "role", "text").mapInArrow(lambda batches: _repaired(batches, report), _REPORT if report else _TURNS)


def repair(rows: DataFrame, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **sizes: int) -> DataFrame:
    """(conv_id, place, edit, role, text) of every edit of the lightest repair; a deleted turn has neither place nor role."""
    return _streamed(_turns(rows, conv_id, turn, role, text), None, False, **sizes)


def report(rows: DataFrame, ids: DataFrame | None = None, *, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", **sizes: int) -> DataFrame:
    """Faults, cost, audit and the SHA-256 of the repaired ``role:text`` lines, per conversation.

    With ``ids`` (column conv_id) those conversations are reported, also where ``rows`` has nothing of them.
    """
    return _streamed(_turns(rows, conv_id, turn, role, text), ids, True, **sizes)


def _turns(rows: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    filled = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return rows.select(F.col(conv_id).cast("bigint").alias("conv_id"), F.col(turn).cast("bigint").alias("turn"), filled(role).alias("role"), filled(text).alias("text"))
