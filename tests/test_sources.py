"""Sources, sinks and refresh on small hand-made files."""
import os
import shutil
import tempfile
import time

import pytest
from pyspark.sql import functions as F

from moneytrail.sources import files, interests
from moneytrail.sources.schemas import DATASETS, RAW_COLUMNS
from moneytrail.streaming import landing, refresh


def tmpdir():
    return tempfile.mkdtemp(prefix="mt-test-")


def test_pipe_text_is_lossless(spark):
    d = tmpdir()
    line1 = '|'.join(['C001', 'N', 'Q1', 'P', '', '15', 'IND', 'O"BRIEN, PAT', 'SANTA FE',
                      'NM', '87501', 'ACME \\ SONS', ' TEACHER', '01022026', '250', '', 'T1',
                      '9', '', '#not a comment', '1'])
    line2 = '|'.join(['C002', 'N', 'Q1', 'P', '', '15', 'IND', 'PEÑA, JOSÉ', '', 'NM', '', '',
                      '', '01022026', '-5', '', 'T2', '9', 'X', '', '2'])
    with open(os.path.join(d, "itcont.txt"), "wb") as fh:
        fh.write((line1 + "\n" + line2 + "\n").encode("latin-1"))
    df = files.scan_pipe_raw(spark, d, "indiv")
    rows = {r.SUB_ID: r for r in df.collect()}
    assert rows["1"].NAME == 'O"BRIEN, PAT' and rows["1"].EMPLOYER == "ACME \\ SONS"
    assert rows["1"].OCCUPATION == " TEACHER" and rows["1"].MEMO_TEXT == "#not a comment"
    assert rows["2"].NAME == "PEÑA, JOSÉ" and rows["2"].CITY is None


def test_ie_csv_quotes_commas_newlines(spark):
    d = tmpdir()
    cols = RAW_COLUMNS["ie"]
    header = ",".join(c.upper() for c in cols)
    vals = ['H001', '"DOE, JANE"', 'C1', '"SPENDER ""X"" PAC"', 'G', 'NM', '01', 'H', 'DEM',
            '100.50', '05-JAN-26', '100.50', 's', '"LINE1\nLINE2"', 'PAYEE', '12', 'N', '7',
            '', '', '2026', '', '05-JAN-26']
    with open(os.path.join(d, "ie.csv"), "w") as fh:
        fh.write(header + "\n" + ",".join(vals) + "\n")
    r = files.scan_ie_csv(spark, d).first()
    assert r.cand_name == "DOE, JANE" and r.spe_nam == 'SPENDER "X" PAC'
    assert r.pur == "LINE1\nLINE2" and r.exp_amo == "100.50" and r.image_num is None


def test_interest_dictionary_comments_and_blanks(spark):
    d = tmpdir()
    text = ("# header comment\n\n   # indented comment\ncmte_id,category,notes\n"
            "C001, Israel-aligned ,  note one\nC002,,missing category\n,X,no id\n"
            "C003,\"Labor, public\",\n")
    with open(os.path.join(d, "tags.csv"), "w") as fh:
        fh.write(text)
    e = {r.cmte_id: r for r in interests.scan_interest_dictionary(spark, d).collect()}
    assert set(e) == {"C001", "C003"}
    assert e["C001"].category == "Israel-aligned" and e["C001"].notes == "note one"
    assert e["C003"].category == "Labor, public" and e["C003"].notes == ""
    cm = spark.createDataFrame([("C001",), ("C001",)], "CMTE_ID string")
    tags = interests.load_group_mappings(interests.scan_interest_dictionary(spark, d), cm)
    assert tags.count() == 1  # semi join: a duplicated committee does not multiply


def test_snapshot_changes_and_rebuild(spark):
    a = spark.createDataFrame([("x", None), (None, "x")], "c1 string, c2 string")
    b = spark.createDataFrame([(None, "x"), ("x", None)], "c1 string, c2 string")
    c = spark.createDataFrame([("x", "x"), (None, None)], "c1 string, c2 string")
    fa = refresh.dataset_fingerprint(a, "cn", "2026").first().fingerprint
    fb = refresh.dataset_fingerprint(b, "cn", "2026").first().fingerprint
    fc = refresh.dataset_fingerprint(c, "cn", "2026").first().fingerprint
    assert fa == fb and fa != fc  # order-free, NULL position matters
    stored = refresh.manifest({"cn": a, "cm": a, "ie": a}, "2026")
    current = refresh.manifest({"cn": b, "cm": c, "ccl": a}, "2026")
    st = {r.dataset: r.status for r in refresh.snapshot_changes(current, stored).collect()}
    assert st == {"cn": "unchanged", "cm": "changed", "ccl": "new", "ie": "missing"}
    existing = spark.createDataFrame([("dim_candidates",), ("dim_committees",)], "table string")
    table_of = {"cn": "dim_candidates", "cm": "dim_committees", "ccl": "bridge_candidate_committee",
                "ie": "fact_independent_expenditures"}
    rb = {r.dataset: r.reason for r in refresh.rebuild_set(
        refresh.snapshot_changes(current, stored), existing, table_of).collect()}
    assert rb == {"cm": "changed", "ccl": "new"}
    st2 = refresh.snapshot_changes(refresh.manifest({"cn": a}, "2026"),
                                   refresh.manifest({"cn": a}, "2026"))
    rb2 = refresh.rebuild_set(st2, spark.createDataFrame([], "table string"), {"cn": "dim_candidates"})
    assert [r.reason for r in rb2.collect()] == ["table missing"]


def test_cycle_guard(spark):
    m = refresh.manifest({"cn": spark.createDataFrame([("x",)], "c string")}, "2024")
    import pytest
    with pytest.raises(ValueError):
        refresh.assert_one_cycle(m, "2026")
    with pytest.raises(ValueError):
        refresh.check_cycle("26")
    refresh.assert_one_cycle(m, "2024")


def touch(path, text, age=0):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="latin-1") as fh:
        fh.write(text)
    then = time.time() - age
    os.utime(path, (then, then))


def link(i):
    return f"H{i}|2026|2026|C{i}|H|P|{i}\n"


def seen_newest(spark, inbox, work, ds="ccl"):
    n = landing.see_new_files(spark, inbox, work + "/seen", work + "/ck")
    newest = landing.newest_snapshot(spark, work + "/seen")
    return n, newest, landing.read_snapshot(spark, inbox, work + "/seen", newest["snapshot"], ds)


def test_newest_snapshot_by_time_with_all_its_parts(spark):
    inbox, work = tmpdir(), tmpdir()
    touch(f"{inbox}/z_old.txt", link(1), age=86400)
    touch(f"{inbox}/a_new.txt", link(1) + link(2), age=3600)
    n, newest, rows = seen_newest(spark, inbox, work)
    assert n == 1 and newest["snapshot"] == "a_new.txt" and rows.count() == 2
    n, *_ = seen_newest(spark, inbox, work)
    assert n == 0  # nothing new
    for i in range(4):  # a folder of parts, and one of them comes late
        touch(f"{inbox}/snap7/part-0000{i}.txt", "".join(link(25 * i + j) for j in range(25)), age=60 - i)
    n, newest, rows = seen_newest(spark, inbox, work)
    assert newest["snapshot"] == "snap7" and rows.count() == 100
    touch(f"{inbox}/snap7/part-00004.txt", link(999), age=10)
    assert seen_newest(spark, inbox, work)[2].count() == 101
    files.write_pipe_text(spark.createDataFrame([tuple("abcdefg")] * 40, ", ".join(
        f"{c} string" for c in RAW_COLUMNS["ccl"])).repartition(4), work + "/out")
    for f in os.listdir(work + "/out"):  # parts of one write directly in the inbox
        if f.startswith("part-"):
            shutil.copy(f"{work}/out/{f}", f"{inbox}/{f}")
    assert seen_newest(spark, inbox, work)[2].count() == 40


def test_write_pipe_roundtrip(spark):
    df = spark.createDataFrame([tuple(["a"] * 7), tuple([None] * 6 + ["z"])],
                               ", ".join(f"{c} string" for c in RAW_COLUMNS["ccl"]))
    d = os.path.join(tmpdir(), "ccl")
    files.write_pipe_text(df, d)
    back = files.scan_pipe_raw(spark, d, "ccl")
    assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, df.collect()), key=str)


def bulk_files(spark, root):
    """The six datasets of the smallest tables as pipe and CSV files, and the tag file."""
    from moneytrail.plans.store import Store
    st = Store.open(spark, "/root/testdata/sf0.001")
    for ds in DATASETS:
        (files.write_ie_csv if ds == "ie" else files.write_pipe_text)(st.raw(ds), f"{root}/{ds}")
    return st, {ds: f"{root}/{ds}" for ds in DATASETS}, st.dictionary_path()


def bulk_store(spark):
    from moneytrail.plans.store import Store
    st, paths, dictionary = bulk_files(spark, tmpdir())
    return st, Store.from_files(spark, tmpdir() + "/store", paths, dictionary)


def actions(df):
    return {r.dataset: (r.status, r.action) for r in df.collect()}


def test_store_from_bulk_files_equals_the_fixture(spark):
    from moneytrail.operators import reports
    from moneytrail.plans import api
    st, own = bulk_store(spark)
    for make in (lambda s: reports.candidate_totals(s.rollup, s.candidates), lambda s: reports.candidate_buckets(s.rollup),
                 lambda s: reports.candidate_top_states(s.rollup), lambda s: reports.rank_base(s.rollup, s.candidates),
                 lambda s: reports.candidate_oos_states(s.rollup, s.candidates), lambda s: reports.candidate_interest_blocs(s.rollup),
                 lambda s: reports.candidate_top_direct_pac(s.contributions, s.committees),
                 lambda s: reports.candidate_top_ie_spenders(s.clean_ie), lambda s: reports.rank_interest_categories(s.rollup),
                 lambda s: s.money, lambda s: s.individual, lambda s: s.ie):
        assert sorted(map(str, make(own).collect())) == sorted(map(str, make(st).collect()))
    assert api.candidate_profile(spark, own, own.candidates.first().CAND_ID)["totals"].count() == 1
    # money and types stay exact
    assert dict(own.money.dtypes)["amount"] == dict(own.individual.dtypes)["AMOUNT"] == "decimal(14,2)"


def test_store_without_a_dictionary_has_an_empty_tag_table(spark):
    from moneytrail.plans.store import Store
    _, paths, _ = bulk_files(spark, tmpdir())
    root = tmpdir() + "/store"
    st = Store.from_files(spark, root, paths)
    assert st.tags.count() == 0 and st.tags.columns == ["CMTE_ID", "custom_category", "notes"]
    assert Store.attach(spark, root).money.count() == st.money.count()
    with pytest.raises(ValueError, match="already"):
        Store.from_files(spark, root, paths)
    with pytest.raises(ValueError, match="no file for: ie"):
        Store.from_files(spark, tmpdir() + "/x", {k: v for k, v in paths.items() if k != "ie"})
    with pytest.raises(LookupError):
        Store.attach(spark, tmpdir())


def test_refresh_rebuilds_only_changed_and_readers_keep_their_state(spark):
    from moneytrail.plans.store import Store
    _, st = bulk_store(spark)
    reader = Store.attach(spark, st.root)
    before = reader.money.count()
    drop = st.raw("cn").orderBy("CAND_ID").first().CAND_ID
    new_cn, same_ccl = st.raw("cn").filter(F.col("CAND_ID") != drop), st.raw("ccl")
    n = st.candidates.count()
    assert actions(st.refresh({"cn": new_cn, "ccl": same_ccl})) == {"cn": ("changed", "rebuilt"), "ccl": ("unchanged", "skipped")}
    assert st.candidates.count() == n - 1
    assert actions(st.refresh({"cn": st.raw("cn")})) == {"cn": ("unchanged", "skipped")}
    with pytest.raises(ValueError):
        st.refresh({"cn": new_cn}, cycle="2024")
    # an open reader still sees the whole old state, a new one the whole new one
    assert reader.candidates.count() == n and reader.money.count() == before
    assert Store.attach(spark, st.root).candidates.count() == n - 1
    assert st.vacuum() and st.candidates.count() == n - 1 and st.money.count() >= 0


def test_failed_dataset_is_tried_again(spark, monkeypatch):
    from moneytrail.operators import curate
    _, st = bulk_store(spark)
    cut = {ds: st.raw(ds).filter(F.crc32(F.col("CAND_ID").cast("binary")) % 2 == 0) for ds in ("ccl", "cn")}
    rows = cut["ccl"].count()
    good = curate.CURATE["ccl"]

    def broken(raw):
        raise RuntimeError("no")

    monkeypatch.setitem(curate.CURATE, "ccl", broken)
    first = actions(st.refresh(cut))
    assert first == {"ccl": ("changed", "failed"), "cn": ("changed", "rebuilt")}
    monkeypatch.setitem(curate.CURATE, "ccl", good)
    assert actions(st.refresh({"ccl": cut["ccl"]})) == {"ccl": ("changed", "rebuilt")}
    assert st.bridge.count() == st.raw("ccl").count() == rows


def test_missing_table_is_rebuilt(spark):
    _, st = bulk_store(spark)
    shutil.move(st.table_path("fact_contributions"), tmpdir() + "/away")
    assert actions(st.refresh({})) == {"pas2": ("table missing", "rebuilt")}
    assert st.contributions.count() == st.raw("pas2").count()


def test_refresh_from_inbox(spark):
    _, st = bulk_store(spark)
    inbox = tmpdir()
    lines = ["|".join("" if v is None else v for v in r) + "\n" for r in st.raw("ccl").collect()]
    touch(f"{inbox}/ccl_a.txt", "".join(lines), age=900)  # same content as landed
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": ("unchanged", "skipped")}
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "no new files")}
    touch(f"{inbox}/ccl_b.txt", "".join(lines[1:]) + "short|line\n", age=600)  # a bad line
    for _ in range(2):  # it stays pending
        assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "failed")}
    assert st.bridge.count() == len(lines)
    touch(f"{inbox}/ccl_c.txt", "".join(lines[1:]), age=300)  # one link less
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": ("changed", "rebuilt")}
    assert st.bridge.count() == len(lines) - 1
    touch(f"{inbox}/a_late.txt", "".join(lines), age=700)  # an older one that came late
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "no new files")}


def test_money_files_are_sorted_by_candidate(spark):
    import pyarrow.parquet as pq
    _, st = bulk_store(spark)
    found = 0
    for folder, _, names in os.walk(st.money_path()):
        for f in names:
            if f.endswith(".parquet"):
                ids = [x for x in pq.read_table(os.path.join(folder, f), columns=["cand_id"]).column(0).to_pylist() if x is not None]
                assert ids == sorted(ids)
                found += len(ids) > 1
    assert found


def test_tag_file_by_header_name(spark):
    from moneytrail.sources import interests
    path = tmpdir() + "/tags.csv"
    with open(path, "w", encoding="utf-8") as fh:
        fh.write('# a, comment\n\n  # another\ncategory,extra, cmte_id ,notes\n'
                 'LABOR,x, C1 ,"two\nlines, and ""quotes"""\nENERGY,,C2,\n,x,C3,no category\nOIL,x,,no id\n')
    rows = sorted(map(tuple, interests.scan_interest_dictionary(spark, path).collect()))
    assert rows == [("C1", "LABOR", 'two\nlines, and "quotes"'), ("C2", "ENERGY", "")]
    with open(path, "w") as fh:
        fh.write("cmte_id,notes\nC1,x\n")
    with pytest.raises(ValueError, match="category"):
        interests.scan_interest_dictionary(spark, path)


def test_pipe_files_keep_accents_quotes_and_backslashes(spark):
    row = ("JOSÉ", 'a "b" \'c', "x\\y", " lead", "trail ", None, "é")
    df = spark.createDataFrame([row], ", ".join(f"{c} string" for c in RAW_COLUMNS["ccl"]))
    path = tmpdir() + "/p"
    files.write_pipe_text(df, path)
    raw = b"".join(open(os.path.join(path, f), "rb").read() for f in os.listdir(path) if f.startswith("part-"))
    assert "JOSÉ".encode("latin-1") in raw
    assert tuple(files.scan_pipe_raw(spark, path, "ccl").first()) == row


def test_shared_folder_is_needed_on_a_cluster(spark):
    from moneytrail.plans import session

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

        def getConf(self):
            return Conf()

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.checkpoint_dir(Session())


def test_building_a_ranking_runs_no_job(spark):
    from moneytrail import catalog
    from moneytrail.plans.store import Store
    s = Store.open(spark, "/root/testdata/sf0.001")
    assert s.rollup.columns and s.candidates.columns and s.bridge.columns  # read their schemas
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("build", "build")
    for name in ("rank_percentiles", "funding_headline_ranking", "resolve_candidates", "candidate_profile"):
        catalog.REGISTRY[name](spark, "/root/testdata/sf0.001")
    assert not tracker.getJobIdsForGroup("build")
    spark.sparkContext.setJobGroup("", "")
