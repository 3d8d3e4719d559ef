import hashlib

import regex
from hypothesis import given, settings
from hypothesis import strategies as st

from moneytrail.llm import queries, spotsigs
from pyspark.sql import functions as F

from .conftest import SF


def brute_sigs(text):
    found = [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]
    content = [w for w in found if w not in spotsigs.ANCHORS]
    out, seen = set(), 0
    for i, w in enumerate(found):
        if w in spotsigs.ANCHORS:
            if i - seen < len(content):
                out.add((w, *content[i - seen : i - seen + spotsigs.CHAIN]))
            seen += 1
    return out or ({tuple(found)} if found else set())


def jaccard(a, b):
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def expected(rows):
    """By doc_id, for rows with different ids, in descending order."""
    rows, out = sorted(rows, reverse=True), {}
    for n, (i, text) in enumerate(rows):
        after = rows[(n + 1) % len(rows)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        a, b, c = brute_sigs(text), brute_sigs(new), brute_sigs(after)
        out[i] = len(text), hashlib.sha256(new.encode()).hexdigest(), len(a), round(jaccard(a, b), 9), round(jaccard(a, c), 9)
    return out


def got(r):
    return r.n_chars, r.edited_sha256, r.fingerprint.count(",") + 1 if r.fingerprint else 0, round(r.near_edited, 9), round(r.near_next, 9)


def test_query_against_brute_force(spark, real):
    rows = {r.doc_id: got(r) for r in queries.op1_document_fingerprints(spark, SF).collect()}
    assert rows == expected([(r.doc_id, r.text) for r in real.collect()])


def test_buckets_far_apart(spark):
    rows = [(i, f"the text {i} of the number {i * i} and more") for i in (-5000, -3, 0, 511, 512, 9_000_000, 2**40, 2**40 + 1)]
    found = {r.doc_id: got(r) for r in spotsigs.edit_report(spark.createDataFrame(rows, "doc_id bigint, text string")).collect()}
    assert found == expected(rows)


def test_next_of_hashed_ids(spark):
    """Ids all over 64 bits: each is a bucket of its own, and ranges of buckets meet at their ends."""
    ids = sorted({hash((i, "id")) for i in range(600)})
    df = spark.createDataFrame([(i, f"the text {i}") for i in ids], "doc_id bigint, text string").repartition(5)
    found = {r.doc_id: r.next_text for r in spotsigs.with_next(df).collect()}
    assert found == {i: f"the text {ids[n - 1]}" for n, i in enumerate(ids)}
    spread = df.groupBy((F.col("doc_id") / 512).cast("bigint").alias("bucket")).count().select(F.lit(False).alias("late"), "bucket")
    after = {r.bucket: r.next_bucket for r in spotsigs.successors(spread).collect()}
    order = sorted(after)
    assert after == {b: order[n - 1] for n, b in enumerate(order)}


def test_odd_rows(odd, odd_rows, none):
    found = spotsigs.edit_report(odd).collect()
    assert len(found) == len(odd_rows)
    one = {r.doc_id: r for r in found}
    assert one[300].n_chars == 0 and one[300].fingerprint == "" == one[301].fingerprint == one[302].fingerprint
    assert one[100].fingerprint == one[0].fingerprint and one[401].n_chars == 300_000
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in found)
    assert spotsigs.edit_report(none).collect() == []


def test_single_row_is_its_own_next(spark):
    r = spotsigs.edit_report(spark.createDataFrame([(1, "abcd")], "doc_id bigint, text string")).first()
    assert r.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and r.near_next == 1.0


def test_similar_pairs_against_brute_force(real, odd):
    for docs, t in ((real, 0.8), (real, 0.5), (odd, 0.8)):
        _, sets = spotsigs.classes(docs)
        by_id = {r.set_id: set(r.sigs) for r in sets.collect()}
        ids = sorted(by_id)
        brute = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if by_id[a] and by_id[b] and jaccard(by_id[a], by_id[b]) >= t}
        assert {(r.a, r.b) for r in spotsigs.similar_pairs(sets, t).collect()} == brute


def test_native(spark):
    plan = queries.op1_document_fingerprints(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


@settings(max_examples=15, deadline=None)
@given(st.lists(st.sampled_from(["the", "of", "Der", "word", "übung", "x1", "-", "la"]), max_size=12))
def test_signatures(spark, parts):
    text = " ".join(parts)
    row = spark.createDataFrame([(text,)], "t string").select(spotsigs.signatures(F.col("t")).alias("s")).first()
    assert len(row.s) == len(brute_sigs(text)) and row.s == sorted(row.s)
