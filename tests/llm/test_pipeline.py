import zlib

import numpy as np
import pytest

import corpus_pipeline
from moneytrail.llm import queries

from .conftest import SF
from .test_decontaminate import judged
from .test_simhash import brute_components, brute_fingerprint
from .test_token_file import ids_of


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    docs, out = spark.read.parquet(f"{SF}/documents.parquet"), []
    for name, f in corpus_pipeline.STAGES:
        path = str(tmp_path_factory.mktemp("stage") / name)
        f(spark, docs, SF).write.parquet(path)
        before, docs = docs, spark.read.parquet(path)
        out.append((before, docs))
    return out


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_columns(stages):
    for before, after in stages[:-1]:
        assert after.columns == before.columns


def test_toxicity_drops_rows_as_they_are(stages):
    before, after = map(rows, stages[0])
    assert set(after) < set(before) and len(after) > 0.8 * len(before)


def test_one_of_each_group(stages):
    before, after = map(rows, stages[1])
    ordered = sorted(before)
    comps = brute_components([brute_fingerprint(r[1]) for r in ordered])
    assert after == sorted((r for i, r in enumerate(ordered) if comps[i] == i), key=str)


def test_decontamination(spark, stages):
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    before, after = map(rows, stages[2])
    assert after == [r for r in before if not judged(r[1], items)[-1]]


def test_mixing_repeats_rows(stages):
    before, after = map(rows, stages[3])
    assert set(after) <= set(before) and 0.7 * len(before) < len(after) < 1.3 * len(before)


def test_token_files(stages):
    before, after = stages[4]
    place = before.metadataColumn("_metadata")
    mixed = before.select("doc_id", "text", place["file_name"].alias("f"), place["row_index"].alias("i")).collect()
    start, want = 0, []
    for r in sorted(mixed, key=lambda r: (len(r.f), r.f, r.i)):  # the mixing stage's order
        ids = ids_of(r.text)
        want.append((r.doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    assert sorted(map(tuple, after.collect()), key=lambda r: r[1]) == want
    ids = [r[0] for r in want]
    assert ids != sorted(ids)  # copies are spread
    assert sum(a == b for a, b in zip(ids, ids[1:])) < len(ids) / 20


def test_empty_and_odd_rows(spark, odd, none):
    plain = ["doc_id", "text", "lang", "source", "fp", "key", "row"]
    for docs in (none.select(*plain), odd.select(*plain)):
        for name, f in corpus_pipeline.STAGES:
            out = f(spark, docs, SF)
            assert out.count() >= 0
            docs = out if name != "token_ids" else docs
    assert corpus_pipeline.run(spark, SF).columns == ["doc_id", "start", "n_tokens", "ids_crc32"]


def test_every_operator_has_a_query():
    assert {int(n[2:].split("_")[0]) for n in queries.QUERIES} == set(range(1, 14))
