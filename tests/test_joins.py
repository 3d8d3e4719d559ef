"""What the driver builds for joins: no hash table of a dimension that has many rows, however small its files."""
import contextlib

import pytest
from pyspark.sql import functions as F

from moneytrail.operators import angles, profile, reports, views
from moneytrail.plans import joins
from moneytrail.plans.store import Store
from moneytrail.sources.fixture import Fixture

SF = "/root/testdata/sf0.001"


@contextlib.contextmanager
def threshold(spark, value):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", value)
    try:
        yield
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def store(spark):
    """The store of the test tables as a new reader has it."""
    return Store.attach(spark, Store.open(spark, SF).complete().root)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()  # noqa: SLF001


def test_many_rows_in_a_small_file_are_not_broadcast(spark, tmp_path):
    at = str(tmp_path / "dim")
    spark.range(300_000, numPartitions=1).select(
        (F.col("id") * 0).cast("string").alias("x"), F.col("id").alias("k"), *[F.lit(None).cast("string").alias(f"c{i}") for i in range(12)]
    ).write.parquet(at)
    dim = spark.read.parquet(at)
    big = spark.range(1_000_000).withColumnRenamed("id", "b")
    on = F.col("b") == F.col("k")
    assert "BroadcastHashJoin" in plan(big.join(dim.select("k"), on))  # by the size of its files
    kept = joins.join_small(big, joins.sized(dim, 300_000).filter("x = '0'").select("k"), on)
    assert "BroadcastHashJoin" not in plan(kept) and "SortMergeJoin" in plan(kept)
    assert kept.count() == 300_000
    few = joins.sized(dim.limit(1000), 1000).select("k")
    assert "hint" not in few._jdf.queryExecution().analyzed().toString().lower()  # noqa: SLF001


def test_dimensions_of_a_store_are_joined_by_their_rows(spark, store):
    """2,000 bytes are more than the ids in the committees' file take, and less than a hash table of them."""
    frames = {"clean_ie": lambda s: s.clean_ie, "direct_pac": lambda s: s.money_direct_pac,
              "individual": lambda s: s.money_individual,
              "tagged rollup": lambda s: views.tagged_rollup(s.spark.read.parquet(s.state["paid"]["direct_pac"]), s.tags)}
    rows = {k: sorted(map(str, f(store).collect())) for k, f in frames.items()}
    assert all("BroadcastHashJoin" in plan(f(store)) for f in frames.values())
    with threshold(spark, "2k"):
        again = Store.attach(spark, store.root)
        for k, f in frames.items():
            assert "BroadcastHashJoin" not in plan(f(again)), k
            assert sorted(map(str, f(again).collect())) == rows[k]


def test_raw_rows_do_not_depend_on_how_dimensions_are_joined(spark):
    for ds in ("indiv", "ie"):
        rows = sorted(map(str, Fixture(spark, SF).raw(ds).collect()))
        with threshold(spark, "2k"):
            df = Fixture(spark, SF).raw(ds)
            assert "SortMergeJoin" in plan(df)
            assert sorted(map(str, df.collect())) == rows


def test_geography_of_many_candidates_is_broadcast_nowhere(spark):
    """100 candidates are more than 4,000 bytes of a hash table, their file's columns less."""
    sf = "/root/testdata/sf0.01"
    root = Store.open(spark, sf).complete().root

    def geography():
        s = Store.attach(spark, root)
        df = angles.angle_geography(profile.candidate_facts(s.rollup, s.candidates), reports.candidate_top_states(s.rollup))
        links = s.links.select(F.col("CAND_ID").alias("_lc")).distinct()
        return df.join(links, F.col("cand_id") == F.col("_lc"), "left_semi")

    rows = sorted(map(str, geography().collect()))
    with threshold(spark, "4k"):
        df = geography()
        assert "BroadcastHashJoin" not in plan(df)
        assert sorted(map(str, df.collect())) == rows


def test_what_is_grouped_from_the_rollup_is_joined_by_the_number_of_candidates(spark, tmp_path):
    at = str(tmp_path / "rollup")
    spark.range(1000, numPartitions=1).select(
        F.lit("H00000001").alias("cand_id"), *[F.lit("x").alias(c) for c in views.ROLLUP_KEYS[1:]],
        F.lit(1).cast("decimal(24,2)").alias("amount"), F.lit(1).cast("long").alias("n_rows")).write.parquet(at)

    def joined(candidates):
        s = Store(spark, str(tmp_path))
        s.state |= {"prints": {"cn": [candidates, ""]}, "rollup": {c: at for c in views.CHANNELS}}
        per = s.rollup.groupBy("cand_id").agg(F.sum("n_rows").alias("n"))
        return spark.range(1_000_000).select(F.col("id").cast("string").alias("c")).join(per, F.col("c") == F.col("cand_id"))

    assert "BroadcastHashJoin" in plan(joined(1))  # by the size of its files
    assert "BroadcastHashJoin" not in plan(joined(300_000)) and "SortMergeJoin" in plan(joined(300_000))
