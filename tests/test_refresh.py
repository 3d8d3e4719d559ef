"""What a refresh publishes, and what it leaves alone."""
import os
import shutil

import pytest
from pyspark.sql import functions as F

from moneytrail.operators import profile, reports
from moneytrail.plans import session
from moneytrail.plans.store import Store
from tests.test_sources import actions, bulk_store, link, tmpdir, touch


def rows_of(df):
    return sorted(map(str, df.collect()))


def fresh(spark, st, **replaced):
    """A store landed anew from the raw rows of ``st`` and its dictionary."""
    out = Store(spark, tmpdir() + "/fresh")
    out.land({**st.raws(), **replaced}, st.interest_entries())
    return out


def results(st):
    facts = profile.candidate_facts(st.rollup, st.candidates)
    return [rows_of(x) for x in (st.money, st.rollup.select(*sorted(st.rollup.columns)), reports.candidate_interest_blocs(st.rollup),
                                 profile.interest_share(reports.candidate_interest_blocs(st.rollup), facts), reports.rank_interest_categories(st.rollup))]


def test_half_a_snapshot_is_not_published(spark):
    _, st = bulk_store(spark)
    n, lines = st.bridge.count(), ["|".join("" if v is None else v for v in r) + "\n" for r in st.raw("ccl").collect()]
    inbox = tmpdir()
    quarter = [lines[i::4] for i in range(4)]
    for i in range(2):
        touch(f"{inbox}/day2/part-0000{i}.txt", "".join(quarter[i]), age=500)
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "incomplete")}
    touch(f"{inbox}/day2/part-00002.txt", "".join(quarter[2]), age=400)  # still arriving
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "incomplete")}
    touch(f"{inbox}/day2/part-00003.txt.part", "half a li", age=300)
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "incomplete")}
    assert st.bridge.count() == n == Store.attach(spark, st.root).bridge.count()
    shutil.move(f"{inbox}/day2/part-00003.txt.part", tmpdir() + "/away")
    touch(f"{inbox}/day2/part-00003.txt", "".join(quarter[3][1:]), age=300)
    touch(f"{inbox}/day2/_SUCCESS", "")
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": ("changed", "rebuilt")}
    assert st.bridge.count() == n - 1
    # a list of parts, and neither marker nor list: the same files twice
    touch(f"{inbox}/day3/_PARTS", "a.txt\nb.txt\n", age=100)
    touch(f"{inbox}/day3/a.txt", "".join(lines[:5]), age=100)
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "incomplete")}
    touch(f"{inbox}/day3/b.txt", "".join(lines[5:]), age=90)
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": ("changed", "rebuilt")}
    touch(f"{inbox}/day4/a.txt", link(1), age=10)
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": (None, "incomplete")}
    assert actions(st.refresh_from_inbox(inbox, "ccl")) == {"ccl": ("changed", "rebuilt")}
    assert st.bridge.count() == 1


def test_two_refreshes_at_once(spark, monkeypatch):
    _, one = bulk_store(spark)
    drop = lambda st, ds: st.raw(ds).filter(F.crc32(F.col("CAND_ID").cast("binary")) % 2 == 0)
    two = Store.attach(spark, one.root)
    number, commit, inner = one.state["number"], Store._commit, []

    def late(self, state):
        if self is one and not inner:  # the other refresh ends between this one's build and commit
            inner.append(actions(two.refresh({"ccl": drop(two, "ccl")})))
        return commit(self, state)

    monkeypatch.setattr(Store, "_commit", late)
    cn = drop(one, "cn").collect()
    assert actions(one.refresh({"cn": drop(one, "cn")})) == {"cn": ("changed", "rebuilt")} and inner == [{"ccl": ("changed", "rebuilt")}]
    now = Store.attach(spark, one.root)
    assert now.state["number"] == number + 2 and now.candidates.count() == len(cn)
    assert now.bridge.count() == two.bridge.count()  # both are visible
    assert results(now) == results(fresh(spark, now))
    inner.clear()
    two.load()

    def both(self, state):
        if self is one and not inner:
            inner.append(actions(two.refresh({"cn": two.raw("cn").limit(3)})))
        return commit(self, state)

    monkeypatch.setattr(Store, "_commit", both)
    with pytest.raises(RuntimeError, match="cn"):
        one.refresh({"cn": one.raw("cn").limit(1)})
    assert Store.attach(spark, one.root).candidates.count() == 3


def test_exclusive_create(spark):
    d = tmpdir()
    assert session.fs_create(spark, d + "/staged/a", d + "/state/1", "first")
    assert not session.fs_create(spark, d + "/staged/b", d + "/state/1", "second")
    assert open(d + "/state/1").read() == "first" == session.fs_read(spark, d + "/state/1") and os.listdir(d + "/state") == ["1"]


def test_only_channels_of_changed_datasets_are_rebuilt_and_fingerprints_stay(spark):
    _, st = bulk_store(spark)
    before = dict(st.state["fact"])
    cut = st.raw("ie").filter(F.crc32(F.col("tran_id").cast("binary")) % 3 > 0)
    shutil.move(st.raw_path("indiv"), tmpdir() + "/away")  # individual gifts can't be read at all
    assert actions(st.refresh({"ie": cut})) == {"ie": ("changed", "rebuilt")}
    assert {c for c in before if st.state["fact"][c] != before[c]} == {"ie_support", "ie_oppose"}
    gone = st.vacuum()
    assert before["ie_support"] in gone and before["individual"] not in gone
    assert len(st.manifest().collect()) == 6  # no rows are read for it
    again = Store.attach(spark, st.root)
    assert again.money.count() == st.money.count() and actions(again.refresh({"cn": again.raw("cn")})) == {"cn": ("unchanged", "skipped")}


def test_each_channel_equals_a_full_rebuild(spark):
    _, st = bulk_store(spark)
    for ds, column in (("ie", "tran_id"), ("pas2", "SUB_ID"), ("ccl", "LINKAGE_ID"), ("cm", "CMTE_ID")):
        rows = st.raw(ds).filter(F.crc32(F.col(column).cast("binary")) % 4 > 0)
        assert actions(st.refresh({ds: rows})) == {ds: ("changed", "rebuilt")}
    assert results(st) == results(fresh(spark, st))


def test_new_tags_rewrite_no_fact(spark):
    _, st = bulk_store(spark)
    old, fact = st.tags.count(), dict(st.state["fact"])
    ids = [r.CMTE_ID for r in st.committees.orderBy("CMTE_ID").limit(100).collect()]
    path = tmpdir() + "/tags.csv"
    with open(path, "w") as fh:
        fh.write("# new tags\n\ncmte_id,category,notes\n" + "".join(f"{c},NEW{i % 3},\n" for i, c in enumerate(ids)) + "C-NONE,NEW0,no such committee\n")
    report = {r.category: (r.entries, r.matched, r.unknown) for r in st.load_tags(path, dry_run=True).collect()}
    assert sum(r[1] for r in report.values()) == 100 and report["NEW0"][2] == 1 and st.tags.count() == old
    st.load_tags(path)
    assert st.tags.count() == 100 and st.state["fact"] == fact
    other = fresh(spark, st)
    assert results(st) == results(other)
    with open(path, "w") as fh:
        fh.write("cmte_id,notes\nC1,x\n")
    with pytest.raises(ValueError, match="category"):
        st.load_tags(path)
