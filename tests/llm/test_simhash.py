import numpy as np
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st

from moneytrail.llm import queries, simhash
from moneytrail.llm import components as linked
from moneytrail.llm.components import components

from .conftest import SF


def brute_fingerprint(text):
    words = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "").encode().split()
    if not words:
        return 0
    k = min(3, len(words))
    h = [xxhash.xxh64_intdigest(b" ".join(words[i : i + k]), 42) for i in range(len(words) - k + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps, radius=3):
    root = list(range(len(fps)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(fps)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(fps))]


def test_query_against_brute_force(spark, real):
    rows = sorted((r.doc_id, r.text) for r in real.collect())
    fps = [brute_fingerprint(t) for _, t in rows]
    want = [(i, f"{f:016x}", rows[c][0]) for (i, _), f, c in zip(rows, fps, brute_components(fps), strict=True)]
    assert sorted(map(tuple, queries.op3_simhash_near_dedup(spark, SF).collect())) == want


def test_fingerprint_of_long_texts(monkeypatch):
    text = " ".join(f"w{i % 97} v{i % 31}" for i in range(3000))
    whole = simhash.fingerprint(text.encode())
    assert whole == brute_fingerprint(text)
    for size in (1, 7, 100, 5000):
        monkeypatch.setattr(simhash, "RUN_BYTES", size)
        assert simhash.fingerprint(text.encode()) == whole
    assert simhash.fingerprint(b"") == simhash.fingerprint(b" \n\x0b") == 0
    assert simhash.fingerprint(b"One two") == xxhash.xxh64_intdigest(b"one two", 42)


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 6), st.lists(st.integers(1, 90), min_size=1, max_size=5), st.integers(0, 2**32))
def test_near_pairs(radius, sizes, seed):
    rng = np.random.default_rng(seed)
    sizes = np.array(sorted(sizes, reverse=True))
    base = rng.integers(0, 2**63, 3, dtype=np.uint64)
    fps = base[rng.integers(0, 3, sizes.sum())]
    for _ in range(3):
        fps = fps ^ (np.uint64(1) << rng.integers(0, 64, len(fps)).astype(np.uint64))
    group = np.repeat(np.arange(len(sizes)), sizes)
    found = {(int(a), int(b)) for t, u in simhash.near_pairs(fps, sizes, radius) for a, b in zip(t, u, strict=True)}
    want = {(i, j) for i in range(len(fps)) for j in range(i + 1, len(fps)) if group[i] == group[j] and int(fps[i] ^ fps[j]).bit_count() <= radius}
    assert found == want


def test_links_with_full_buckets(spark):
    """One hot ball of fingerprints, dealt in parts of a few."""
    rng = np.random.default_rng(1)
    center = 0x0123456789ABCDEF
    fps = sorted({center ^ sum(1 << int(b) for b in rng.integers(0, 64, 3)) for _ in range(150)} | {int(x) for x in rng.integers(0, 2**63, 50)})
    signed = [(f - 2**64 if f >> 63 else f,) for f in fps]
    df = spark.createDataFrame(signed, "fp bigint")
    for bucket in (4096, 8):
        roots = {r.node % 2**64: r.root for r in components(simhash.links(df, 3, bucket)).collect()}
        want = brute_components(fps)
        named = {}
        for f, c in zip(fps, want, strict=True):
            if want.count(c) > 1:
                assert named.setdefault(c, roots[f]) == roots[f]
            else:
                assert f not in roots
        assert len(set(named.values())) == len(named)


def test_components(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100 + i, 100) for i in range(30)] + [(200, 201), (201, 200), (7, 7), (None, 3), (300, 40)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 300: 0, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}
    assert components(spark.createDataFrame([], "a bigint, b bigint")).collect() == []


def test_least_of_a_hot_key(spark, monkeypatch):
    rows = [(0, 5000 - i, i) for i in range(5000)] + [(k, k * 7, k) for k in range(1, 300)] + [(1, None, 9)]
    df = spark.createDataFrame(rows, "k bigint, v bigint, by bigint")
    for parts in (1, 256):
        monkeypatch.setattr(linked, "PARTS", parts)
        found = linked.with_least(df, "k", "v", "by", "least")
        least = {0: 1, **{k: k * 7 for k in range(1, 300)}}
        assert sorted(((r.k, r.v, r.by, r.least) for r in found.collect()), key=str) == sorted(((k, v, b, least[k]) for k, v, b in rows), key=str)


def test_odd_rows(odd, odd_rows, none):
    found = simhash.groups(odd).collect()
    fps = [brute_fingerprint(t) for _, t, *_ in odd_rows]
    ids = [i for i, *_ in odd_rows]
    comps = brute_components(fps)
    least = {c: min((i for i, d in zip(ids, comps, strict=True) if d == c and i is not None), default=None) for c in comps}
    want = sorted(((i, f, least[c]) for i, f, c in zip(ids, fps, comps, strict=True)), key=str)
    assert sorted(((r.doc_id, r.fp % 2**64, r.component_id) for r in found), key=str) == want
    kept = simhash.keep_one(odd)
    assert kept.columns == odd.columns
    rows = kept.collect()
    assert len(rows) == len(set(comps)) and {r.doc_id for r in rows if r.doc_id is not None} == {x for x in least.values() if x is not None}
    assert simhash.groups(none).collect() == [] == simhash.keep_one(none).collect()


def test_rounds_broadcast_nothing(spark):
    """A round's joins collect no side on the driver."""
    df = spark.createDataFrame([(k % 7, k) for k in range(100)], "u bigint, v bigint")
    found = linked.with_least(df, "u", "v", "v", "m")
    assert {r.m - r.u for r in found.collect()} == {0}
    plan = found._jdf.queryExecution().executedPlan().toString()  # as it ran
    assert "SortMergeJoin" in plan and "Broadcast" not in plan.partition("Initial Plan")[0]


def test_jobs_of_a_round(spark):
    """Each job of a round has as many tasks as the table has partitions, and the driver keeps a record of each."""
    spark.sparkContext.setJobGroup("rounds", "rounds")
    found = components(spark.createDataFrame([(100 + i, 100) for i in range(1, 300)], "a bigint, b bigint"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("rounds"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 12  # the first checkpoint, and the round in which nothing moves
    assert {r.root for r in found.collect()} == {100}


def test_links_lead_to_the_smallest(spark):
    """So that the rounds begin with the stars that they end with."""
    rng = np.random.default_rng(2)
    fps = {0x0123456789ABCDEF ^ sum(1 << int(b) for b in rng.integers(0, 64, 2)) for _ in range(200)}
    df = spark.createDataFrame([(f - 2**64 if f >> 63 else f,) for f in fps], "fp bigint")
    found = simhash.links(df).collect()
    assert found and all(r.b < r.a for r in found)
