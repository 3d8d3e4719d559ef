"""The JSON export: required keys, folder names, reconciliation, determinism."""
import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F

from moneytrail.plans import api
from moneytrail.sources import files

SF = "/root/testdata/sf0.001"
TOP_KEYS = {"candidate", "angle", "headline", "subhead", "chart", "footnotes", "source"}
ANGLE_KEYS = {"id", "title", "reason", "metric", "metric_value", "threshold", "featured"}


def read_docs(root):
    docs = {}
    for d, _, files in os.walk(root):
        for f in files:
            if f.endswith(".json"):
                with open(os.path.join(d, f)) as fh:
                    docs.setdefault(os.path.join(os.path.relpath(d, root), f), []).append(json.load(fh))
    return docs


def test_export_layout_keys_and_determinism(spark):
    a = os.path.join(tempfile.mkdtemp(prefix="mt-exp-"), "a")
    b = os.path.join(tempfile.mkdtemp(prefix="mt-exp-"), "b")
    api.export_angles(spark, SF, a)
    api.export_angles(spark, SF, b)
    da, db = read_docs(a), read_docs(b)
    assert da and da.keys() == db.keys()
    for folder, docs in da.items():
        assert len(docs) == 1  # one document per <dirname>/<angle_id>.json
        doc = docs[0]
        _, name = folder.split(os.sep)  # <dirname>/<angle_id>.json
        assert name == doc["angle"]["id"] + ".json"
        assert TOP_KEYS <= set(doc) and ANGLE_KEYS <= set(doc["angle"])
        rows = doc["chart"]["rows"]
        total = sum(r["amount"] for r in rows)
        den = doc["chart"]["denominator"]["amount"]
        if doc["angle"]["id"] == "geography":  # "Other states" has no state, and says so
            assert all("state" in r for r in rows)
        if doc["angle"]["id"] == "donor-size":
            assert abs(total - den) <= 1
        assert doc == db[folder][0]  # deterministic


def small_docs(spark, names, amount=1.0):
    return spark.createDataFrame([(n, "geography", amount) for n in names], "dirname string, angle_id string, amount double")


def test_a_new_export_drops_stale_documents(spark):
    home = tempfile.mkdtemp(prefix="mt-exp-")
    out = os.path.join(home, "angles")
    files.write_angles(small_docs(spark, ["a", "b", "c"]), out)
    files.write_angles(small_docs(spark, ["b", "d"], 2.0), out)
    docs = read_docs(out)
    assert sorted(docs) == ["b/geography.json", "d/geography.json"]
    assert docs["b/geography.json"][0]["amount"] == 2.0
    assert [n for n in os.listdir(home) if "-export" not in n] == ["angles"]  # neither staged nor replaced folders stay
    files.write_angles(small_docs(spark, []), out)  # nobody qualifies
    assert not read_docs(out) and os.path.isdir(out)


def test_a_failed_export_changes_nothing(spark):
    home = tempfile.mkdtemp(prefix="mt-exp-")
    out = os.path.join(home, "angles")
    files.write_angles(small_docs(spark, ["a"]), out)
    bad = small_docs(spark, ["a", "b"], 3.0).withColumn(
        "amount", F.when(F.col("dirname") == "b", F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("amount")))
    with pytest.raises(Exception, match="lost"):
        files.write_angles(bad, out)
    assert read_docs(out) == {"a/geography.json": [{"amount": 1.0}]}
    assert [n for n in os.listdir(home) if "-export" not in n] == ["angles"]


def test_a_folder_of_other_files_is_refused(spark):
    out = tempfile.mkdtemp(prefix="mt-exp-")
    with open(os.path.join(out, "notes.txt"), "w") as f:
        f.write("mine")
    with pytest.raises(ValueError, match="no export wrote"):
        files.write_angles(small_docs(spark, ["a"]), out)
    assert os.listdir(out) == ["notes.txt"]


def test_namesakes_keep_their_documents(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="mt-exp-"), "angles")
    one, two = small_docs(spark, ["a", "b"], 1.0), small_docs(spark, ["a"], 2.0)
    files.write_angles(two.unionByName(one), out)
    docs = read_docs(out)
    assert docs == {"a/geography.json": [{"amount": 1.0}], "a/geography.2.json": [{"amount": 2.0}],
                    "b/geography.json": [{"amount": 1.0}]}
    back = files.read_angles(spark, out, one.select("amount").schema)
    assert sorted(map(tuple, back.collect())) == [(1.0, "a", "geography"), (1.0, "b", "geography"), (2.0, "a", "geography")]
    files.write_angles(one, out)
    assert sorted(read_docs(out)) == ["a/geography.json", "b/geography.json"]


def test_documents_are_listed_and_read_by_tasks(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="mt-exp-"), "angles")
    docs = small_docs(spark, [f"d {i}%" for i in range(40)])
    files.write_angles(docs, out)
    with open(os.path.join(out, "d 0%", "_hidden.json"), "w") as f:
        f.write('{"amount": 9.0}')
    with open(os.path.join(out, "d 1%", "geography.json"), "w") as f:
        f.write("no json")
    back = files.read_angles(spark, out, docs.select("amount").schema)
    assert back.inputFiles() == []  # the driver keeps no list of them
    assert sorted(map(str, back.collect())) == sorted(
        str(r) for r in docs.select(F.when(F.col("dirname") != "d 1%", F.col("amount")).alias("amount"), "dirname", "angle_id").collect())
    files.write_angles(small_docs(spark, []), out)
    assert files.read_angles(spark, out, docs.select("amount").schema).count() == 0


def test_written_documents_of_repeated_names_are_those_of_the_query(spark, tmp_path):
    """Candidates of other ids with the names, states and districts of the first ones."""
    import duckdb

    import __spark_entry__ as entry
    from moneytrail.oracle.sql import ORACLE
    shift = {"supplier": {"s_suppkey": 600}, "lineitem": {"l_suppkey": 600, "l_orderkey": 600_000},
             "orders": {"o_orderkey": 600_000}}
    for t in ("nation", "supplier", "customer", "part", "orders", "lineitem", "events"):
        df = spark.read.parquet(f"{SF}/{t}.parquet")
        if t in shift:
            df = df.unionByName(df.withColumns({c: (F.col(c) + n).cast(df.schema[c].dataType) for c, n in shift[t].items()}))
        df.write.parquet(str(tmp_path / f"{t}.parquet"))
    rows = [tuple(r) for r in entry.queries()["write_angles"](spark, str(tmp_path)).collect()]
    con = duckdb.connect()
    for t in ("nation", "supplier", "customer", "part", "orders", "lineitem", "events"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tmp_path}/{t}.parquet/*.parquet'")
    expected = con.execute(ORACLE["write_angles"]).fetchall()
    assert sorted(rows) == sorted(expected)
    assert len({r[:2] for r in rows}) < len(rows)  # some share a name


def test_one_candidate_into_a_given_folder(spark):
    out = os.path.join(tempfile.mkdtemp(prefix="mt-exp-"), "angles")
    api.export_angles(spark, SF, out)
    whole = read_docs(out)
    cid = next(iter(whole.values()))[0]["candidate"]["cand_id"]
    own = {k for k, v in whole.items() if v[0]["candidate"]["cand_id"] == cid}
    folder = next(iter(own)).split(os.sep)[0]
    with open(os.path.join(out, folder, "mine.txt"), "w") as f:
        f.write("stays")
    api.export_angles(spark, SF, out, query=cid, region_note="northern half")
    again = read_docs(out)
    assert again.keys() == whole.keys()
    for k, v in again.items():
        assert (v == whole[k]) == (k not in own)
        assert (v[0]["candidate"]["region_note"] == "northern half") == (k in own)
    assert os.path.exists(os.path.join(out, folder, "mine.txt"))
    # a candidate without documents any more: its old ones go, the rest stays
    files.write_folder(small_docs(spark, []), out, folder, ("donor-size", "geography"))
    assert read_docs(out).keys() == whole.keys() - own
