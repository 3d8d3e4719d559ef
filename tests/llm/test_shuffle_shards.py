import zlib
from collections import Counter, defaultdict

from moneytrail.llm import queries, shuffle_shards
from moneytrail.llm.common import offsets_before

from .conftest import SF


def test_query(spark, real):
    rows = queries.op10_sharding(spark, SF).collect()
    texts = {r.doc_id: r.text.encode() for r in real.collect()}
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    assert all((r.size, r.text_crc32, r.law, r.grown_shard) == (len(texts[r.doc_id]) + 8, zlib.crc32(texts[r.doc_id]), "rows", None) for r in rows)
    check(rows, 24)


def check(rows, shards):
    slots = defaultdict(list)
    for r in rows:
        slots[r.shard].append(r.slot)
    assert set(slots) <= set(range(shards))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    counts = [len(slots.get(k, ())) for k in range(shards)]
    assert max(counts) - min(counts) <= 1


def test_odd_rows_in_many_buckets(odd, odd_rows, none):
    for bucket in (1 << 24, 500):
        found = shuffle_shards.shards_of(odd, shards=7, bucket_bytes=bucket)
        assert sorted(found.columns) == sorted(odd.columns)
        rows = found.collect()
        check(rows, 7)
        assert Counter((r.doc_id, r.text) for r in rows) == Counter((i, t) for i, t, *_ in odd_rows)
    again = shuffle_shards.shards_of(odd.repartition(5), shards=7, bucket_bytes=500).collect()
    assert {(r.shard, r.slot, r.doc_id, r.text) for r in again} == {(r.shard, r.slot, r.doc_id, r.text) for r in rows}
    check(shuffle_shards.shards_of(odd, shards=100).collect(), 100)
    assert shuffle_shards.shards_of(none).collect() == []


def test_shuffled_evenly(spark):
    docs = spark.range(20_000).selectExpr("id AS doc_id", "'x' AS text")
    rows = shuffle_shards.shards_of(docs, shards=4, bucket_bytes=30_000).collect()
    check(rows, 4)
    halves = Counter((r.shard, r.doc_id >= 10_000) for r in rows)
    assert all(2300 < n < 2700 for n in halves.values())
    ordered = [r.doc_id for r in sorted(rows, key=lambda r: (r.shard, r.slot))]
    assert sum(b == a + 1 for a, b in zip(ordered, ordered[1:], strict=False)) < 20


def test_offsets(spark):
    rows = [(k, k % 3 + 1) for k in (0, 1, 5, 1023, 1024, 5000, 1 << 33)]
    found = {r.k: r.offset for r in offsets_before(spark.createDataFrame(rows, "k bigint, n bigint"), "k").collect()}
    assert found == {k: sum(n for j, n in rows if j < k) for k, _ in rows}


def test_native(spark):
    plan = shuffle_shards.shuffled(spark.read.parquet(f"{SF}/documents.parquet"))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
