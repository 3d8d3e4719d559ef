"""User-facing helpers: one candidate's profile, cohort ranking, chart export."""
import os
import tempfile

import pytest

from moneytrail.plans import api
from moneytrail.plans.store import Store

SF = "/root/testdata/sf0.001"


def test_profile_for_one_candidate_matches_batch(spark):
    s = Store.open(spark, SF)
    cid = s.rollup.groupBy("cand_id").count().orderBy("count", ascending=False).first().cand_id
    p = api.candidate_profile(spark, SF, cid)
    one = p["totals"].collect()
    assert len(one) == 1 and one[0].cand_id == cid
    from moneytrail.operators import reports
    batch = reports.candidate_totals(s.rollup, s.candidates).filter(f"cand_id = '{cid}'").first()
    assert one[0].asDict() == batch.asDict()
    assert p["top_states"].count() <= 8


def test_ambiguous_and_missing(spark):
    with pytest.raises(api.AmbiguousCandidate) as e:
        api.candidate_profile(spark, SF, "supplier")
    assert e.value.matches.count() == Store.open(spark, SF).candidates.count()  # all of them
    with pytest.raises(LookupError):
        api.candidate_profile(spark, SF, "no such name")


def test_no_committee_no_profile(spark, monkeypatch):
    s = Store.open(spark, SF)
    cid = s.candidates.first().CAND_ID
    bare = Store(spark, s.root)
    bare.load()
    bare._frames["v_links"] = s.links.filter(s.links.CAND_ID != cid)
    with pytest.raises(LookupError, match="committee"):
        api.candidate_profile(spark, bare, cid)


def test_cohort_and_export(spark):
    r = api.cohort_ranking(spark, SF, limit=3).collect()
    assert [x["rank"] for x in r] == [1, 2, 3][:len(r)]
    out = os.path.join(tempfile.mkdtemp(prefix="mt-export-"), "angles")
    api.export_angles(spark, SF, out)
    assert os.listdir(out) and all(f.endswith(".json") for _, _, fs in os.walk(out) for f in fs)
