import hashlib
import pickle
import random
import re

from moneytrail.llm import decontaminate, queries

from .conftest import SF

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def judged(text, items):
    w, hit, found = words(text), set(), set()
    for item_id, item in items:
        v = words(item)
        k = min(13, len(v))
        windows = {tuple(v[i : i + k]) for i in range(len(v) - k + 1)} if k else set()
        for i in range(len(w) - k + 1 if k else 0):
            if tuple(w[i : i + k]) in windows:
                hit.update(range(i, i + k))
                found.add("" if item_id is None else str(item_id))
    return len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), len(hit) > 0 and 20 * len(hit) >= len(w)


def test_query_against_brute_force(spark, real):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    rows = {r[0]: tuple(r)[1:] for r in queries.op4_benchmark_decontamination(spark, SF).collect()}
    assert rows == {r.doc_id: judged(r.text, items) for r in real.collect()}
    assert any(r[-1] for r in rows.values())


def items_of(odd_rows):
    text = [t for _, t, *_ in odd_rows]
    long = text[-3].split(" ")
    return [(1, "a"), (2, text[5]), (2, text[5]), (3, " ".join(text[9].split(" ")[2:20])), (4, None), (5, ""), (None, "another text of the id"), (6, " ".join(long[30_000:30_040])), (7, "Same SAME"), (10, "漢字"), (11, "x" * 300_000)]


def test_odd_rows(spark, odd, odd_rows, none):
    items = items_of(odd_rows)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    want = sorted(str((i, *judged(t, items))) for i, t, *_ in odd_rows)
    for size in (1 << 20, 100_000):  # one block, and many
        found = decontaminate.judge(odd, bench, block_bytes=size)
        assert [c for c in found.columns if c in odd.columns] == [c for c in odd.columns if c != "n_words"] + ["n_words"]
        assert sorted(str((r.doc_id, r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated)) for r in found.collect()) == want
    assert decontaminate.judge(none, bench).collect() == []
    assert not any(r.contaminated or r.n_items for r in decontaminate.judge(odd, bench.limit(0)).collect())


def test_index_is_bounded_by_the_text():
    rnd = random.Random(3)
    known = ["".join(rnd.choices("abcdefghijklmno", k=rnd.randint(2, 9))) for _ in range(20_000)]
    items = [(str(i), " ".join(rnd.choices(known, k=400)).encode()) for i in range(500)]
    index = decontaminate.Index(items, 13)
    assert len(pickle.dumps(index)) <= 3 * sum(len(t) for _, t in items)


def test_windows_of_several_items_and_one_hash(spark, monkeypatch):
    # all windows have one hash: only the comparison of words tells them apart
    monkeypatch.setattr(decontaminate, "mix", lambda h: h * 0)
    shared = " ".join(f"w{i}" for i in range(13))
    index = decontaminate.Index([("a", f"x {shared} y".encode()), ("b", b""), ("c", shared.upper().encode()), ("c", f"{shared} {shared}".encode()), ("d", b"w1 w2")], 13)
    windows = index.sizes[13]
    find = lambda t: sorted(set(index.found(windows, (t + " ").encode(), 0, len(windows.at))))
    assert find(shared) == ["a", "c"] and find("x " + shared[:-4]) == ["a"] and find(shared[:-1]) == []
    assert sorted(index.sizes) == [2, 13] and len(windows.at) == 3 + 12


def test_removal(spark, odd, odd_rows):
    items = items_of(odd_rows)
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    kept = decontaminate.remove_documents(odd, bench)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(i) for i, t, *_ in odd_rows if not judged(t, items)[-1])
    docs = spark.createDataFrame([(1, "Zé one Two, three! four é", "y"), (2, None, "y"), (3, "clean", "y")], "doc_id bigint, text string, spans string")
    cut = decontaminate.remove_spans(docs, spark.createDataFrame([(1, "two three")], "item_id bigint, text string"))
    assert [tuple(r) for r in cut.orderBy("doc_id").collect()] == [(1, "Zé one ! four é", "y"), (2, None, "y"), (3, "clean", "y")]
