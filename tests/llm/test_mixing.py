import math

import duckdb
import pytest
from pyspark.sql import functions as F

from moneytrail.llm import mixing, queries

from .conftest import SF


def test_query_against_sql(spark):
    db = duckdb.connect()
    db.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    rows = queries.op5_mixing_sources(spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(db.execute(mixing.SQL).fetchall())
    assert [r.shuffle_key for r in rows] == sorted(r.shuffle_key for r in rows)


@pytest.mark.parametrize("rate", [0.05, 0.7, 3.0, 40.0, 900.0])
def test_table_is_poisson(spark, rate):
    docs = spark.createDataFrame([("a", "x" * 9), ("b", "x" * 9)], "source string, text string")
    row = mixing.rates(docs, "source", "text", {"a": rate, "b": 2 - rate if rate < 2 else rate}, rate if rate >= 2 else 1.0).where("source = 'a'").first()
    p, cdf = math.exp(-row.rate), 0.0
    for k, got in enumerate(row.cdf):
        log_p = -row.rate + k * math.log(row.rate) - math.lgamma(k + 1)
        cdf += math.exp(log_p)
        assert got == pytest.approx(cdf, abs=1e-9)
    assert p == pytest.approx(row.cdf[0]) and row.cdf[-1] == pytest.approx(1, abs=1e-9)


def test_weights_are_met(spark):
    docs = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("0123456789").alias("text"), F.when(F.col("id") < 4000, "hot").when(F.col("id") < 5500, "b").otherwise("c").alias("source"))
    shares = {r.source: r["count"] / 6000 for r in mixing.mix(docs, {"hot": 0.2, "b": 0.5, "c": 0.3}).groupBy("source").count().collect()}
    assert shares == pytest.approx({"hot": 0.2, "b": 0.5, "c": 0.3}, abs=0.04)
    assert {r.source for r in mixing.mix(docs, {"c": 1.0}).select("source").distinct().collect()} == {"c"}


def test_odd_rows(odd, odd_rows, none, monkeypatch):
    found = mixing.mix(odd)
    assert found.columns == [c for c in odd.columns if c != "copy"] + ["copy", "n_copies", "shuffle_key"]
    rows = found.collect()
    assert all(1 <= r.copy <= r.n_copies for r in rows)
    assert any(r.source is None for r in mixing.mix(odd, {None: 1.0}).collect())
    monkeypatch.setattr(mixing, "BROADCAST_SOURCES", 0)  # the salted way
    assert sorted(map(str, mixing.mix(odd).collect())) == sorted(map(str, rows))
    assert mixing.mix(none).collect() == []
