"""What a landing computes, and how much of it a query needs."""
from pyspark.sql import functions as F

from moneytrail.streaming import refresh

SF = "/root/testdata/sf0.001"


def test_a_landed_row_is_hashed_once(spark):
    rows = [(str(i), None if i % 3 else "x", "é" * (i % 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "a string, b string, c string")
    plans = []

    def write(out):
        plans.append(out._jdf.queryExecution().optimizedPlan().toString())
        assert out.columns == ["a", "b", "c"] and out.count() == 500

    landed = refresh.landed_fingerprint(df, write)
    metrics = [line for line in plans[0].splitlines() if "CollectMetrics" in line]
    assert len(metrics) == 1 and "md5" not in metrics[0] and plans[0].count("md5(") == 1
    want = sum(int(r.h) for r in df.select(refresh.row_hash(df).alias("h")).collect())
    assert landed == (500, f"500:{want}")
    assert refresh.dataset_fingerprint(df, "cn", "2026").first().fingerprint == landed[1]
    assert refresh.landed_fingerprint(df.filter(F.lit(False)), lambda out: out.count()) == (0, "0:0")
    assert refresh.dataset_fingerprint(df.filter(F.lit(False)), "cn", "2026").first().fingerprint == "0:0"


def opened(spark, monkeypatch):
    """A store of the test tables that nothing has read yet."""
    import tempfile

    from moneytrail.plans import store
    root = tempfile.mkdtemp(prefix="moneytrail-landing-")
    monkeypatch.setattr(store, "_stores", {})
    monkeypatch.setattr(store, "scratch_path", lambda spark, *parts: root + "/" + "/".join(parts))
    return store.Store.open(spark, SF)


def has(st):
    return set(st.state["raw"]), set(st.state["table"]), set(st.state["rollup"])


def test_a_query_lands_what_it_reads(spark, monkeypatch):
    from moneytrail import catalog
    from moneytrail.plans.store import Store
    from moneytrail.sources.schemas import DATASETS, TABLE_OF_DATASET
    st = opened(spark, monkeypatch)
    assert has(st) == (set(), set(), set())
    q = catalog.REGISTRY
    assert q["dim_committees"](spark, SF).count() > 0 and has(st) == ({"cm"}, {"dim_committees"}, set())
    committees = st.table_path("dim_committees")
    assert q["candidate_committees"](spark, SF).count() > 0
    assert has(st) == ({"cm", "ccl"}, {"dim_committees", "bridge_candidate_committee"}, set())
    q["sem_individual"](spark, SF)
    assert has(st)[0] == {"cm", "ccl", "indiv"} and not st.state["fact"]
    assert q["scan_raw_parquet"](spark, SF).select("dataset").distinct().count() == 6
    assert has(st)[0] == set(DATASETS) and "fact_contributions" not in has(st)[1] and not has(st)[2]
    assert q["rank_display_fields"](spark, SF).count() > 0 and len(has(st)[2]) == 4
    whole = Store.open(spark, SF).complete()
    assert whole is st and has(st)[1] == {*TABLE_OF_DATASET.values(), "dim_group_mappings"}
    assert st.table_path("dim_committees") == committees  # landed once
    again = Store.attach(spark, st.root)
    assert again.state == st.state and again.money.count() == st.money_view.count() == st.money.count()


def test_two_jobs_land_into_one_store(spark, monkeypatch):
    from moneytrail.plans import store
    one = opened(spark, monkeypatch)
    one.raw_path("cm")
    monkeypatch.setattr(store, "_stores", {})
    two = store.Store.open(spark, SF)
    assert two is not one and two.root == one.root and two.raw_path("cm") == one.raw_path("cm")
    build, inner = store.Store._build, []

    def late(self, ds, path):  # the other job lands the same dataset, and one more, meanwhile
        if self is one and not inner:
            inner.append((two.table_path("dim_candidates"), two.table_path("dim_committees")))
        return build(self, ds, path)

    monkeypatch.setattr(store.Store, "_build", late)
    assert one.candidates.count() == two.candidates.count() and inner[0][0] == one.table_path("dim_candidates")
    assert one.table_path("dim_committees") == inner[0][1] and one.state == two.state
    # a snapshot that replaces a dataset: what was made from the old one is not published
    assert [r.action for r in two.refresh({"cn": two.raw("cn").limit(3)}).collect()] == ["rebuilt"]
    one._add({"table": {"x": "made from the old cn"}}, {"raw": {"cn": one.state["raw"]["cn"]}, "table": {"dim_committees": "gone"}})
    assert "x" not in one.state["table"]
    one.load()
    assert one.candidates.count() == 3 and one.rollup.count() == two.rollup.count()
