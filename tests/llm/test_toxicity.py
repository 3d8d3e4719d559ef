import random

import numpy as np
from pyspark.sql import functions as F

from moneytrail.llm import queries, toxicity
from moneytrail.llm.common import crc_mod
from moneytrail.llm.words import ALNUM, Words

SF01 = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF01}/labels.parquet").select("doc_id", F.col("toxic").alias("y"))
    rows = queries.op6_toxicity(spark, SF01).join(labels, "doc_id").where("held_out").collect()
    assert sum(r.predicted == r.y for r in rows) / len(rows) > 0.92
    assert sum(r.predicted > r.y for r in rows) <= 0.02 * len(rows)


def planted(n, rng):
    rows = []
    for i in range(n):
        words = ["".join(rng.choice("bcdfgl") + rng.choice("aeiou") for _ in range(rng.randint(1, 3))) for _ in range(rng.randint(5, 80))]
        bad = rng.random() < 0.3
        if bad:
            words[rng.randrange(len(words))] = rng.choice(["vilescum", "vilescumly", "rotter"])
        rows.append((" ".join(words), int(bad)))
    return rows


def test_model_learns_and_is_the_same_in_runs(monkeypatch):
    rows = planted(400, random.Random(1))
    texts, y = [t.encode() for t, _ in rows], np.array([v for _, v in rows], np.float32)
    model = toxicity.train(texts[:300], y[:300])
    splitter = Words(ALNUM, toxicity.PREFIXES)
    data, offsets = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    ids, heads = toxicity.word_rows(splitter, data, offsets)
    z = model.logits(ids, heads)
    assert ((z[300:] > 0) == y[300:]).mean() > 0.9
    one = [model.logits(*toxicity.word_rows(splitter, np.frombuffer(t, np.uint8), np.array([0, len(t)])))[0] for t in texts]
    np.testing.assert_allclose(z, one, atol=1e-4)
    monkeypatch.setattr(toxicity, "RUN_WORDS", 7)  # texts cut over many runs
    np.testing.assert_allclose(model.logits(ids, heads), z, atol=1e-4)


def test_threshold():
    assert 0.3 < toxicity.best_threshold(np.array([0.9, 0.8, 0.2, 0.1]), np.array([1, 1, 0, 0])) < 0.8
    assert toxicity.best_threshold(np.array([0.6, 0.6, 0.6]), np.array([1, 0, 0])) >= 0.3


def test_odd_rows(spark, odd, odd_rows, none):
    rows = planted(150, random.Random(2))
    schema = odd.schema
    names = schema.names[4:]
    more = spark.createDataFrame([(1000 + i, t, "en", "s0", *names) for i, (t, _) in enumerate(rows)], schema)
    labels = spark.createDataFrame([(1000 + i, y) for i, (_, y) in enumerate(rows)] + [(None, 1), (1000, None), (1001, 0)], "doc_id bigint, toxic int")
    docs = odd.union(more)
    model = toxicity.fit(docs, labels, usable=crc_mod(F.col("id"), 3) != 1)
    found = toxicity.score(docs, model)
    assert found.columns == [c for c in docs.columns if c != "score"] + ["score", "threshold", "toxic"]
    got = found.collect()
    assert len(got) == len(odd_rows) + 150 and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.text in (None, "", " \n\t ")}) == 1
    kept = toxicity.remove_toxic(docs, labels)
    assert kept.columns == docs.columns and 0 < kept.count() < len(got)
    assert toxicity.score(none, model).collect() == []
    blank = toxicity.fit(docs, labels.limit(0))
    assert {r.score for r in toxicity.score(docs, blank).collect()} == {0.0}
