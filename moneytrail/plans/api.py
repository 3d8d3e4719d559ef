"""User-facing entry points: one candidate's profile, a cohort ranking, the
chart export.

The reference's command line works on one candidate at a time. Here the batch
operators compute every candidate; these helpers resolve a search term and
filter the batch results to that candidate. Catalyst pushes the ``cand_id``
predicate down to the parquet scans (row-group statistics of the sorted money
files skip the rest).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.functions.constants import ANGLE_DONOR_SIZE, ANGLE_GEOGRAPHY, RANK_MIN_INDIVIDUAL
from moneytrail.operators import angles, profile, rank, reports
from moneytrail.plans.store import Store
from moneytrail.sources import files


class AmbiguousCandidate(ValueError):
    """A term that several candidates match; ``matches`` is a DataFrame of all of them."""

    def __init__(self, query: str, n: int, matches: DataFrame):
        super().__init__(f"{query!r} matches {n} candidates (see .matches)")
        self.matches = matches


def _store(spark: SparkSession, source: str | Store) -> Store:
    """A store as it is, or the store of a folder of test tables."""
    return source if isinstance(source, Store) else Store.open(spark, source)


def matches(store: Store, query: str) -> DataFrame:
    """(term, cand_id, CAND_NAME, n_matches) of every candidate that a search term matches, by name."""
    terms = store.spark.createDataFrame([(query,)], "term string")
    return profile.resolve_candidates(store.candidates, terms).orderBy("CAND_NAME", "cand_id")


def resolve(store: Store, query: str) -> str:
    """The CAND_ID a search term resolves to; raises when nothing or more than
    one candidate matches."""
    found = matches(store, query)
    rows = found.limit(2).collect()  # one is the answer, two are too many
    if not rows:
        raise LookupError(f"No candidate matches {query!r}.")
    if len(rows) > 1:
        raise AmbiguousCandidate(query, rows[0].n_matches, found)
    return rows[0].cand_id


def candidate_profile(spark: SparkSession, source: str | Store, query: str) -> dict[str, DataFrame]:
    """Every section of the one-candidate profile, as DataFrames filtered to it.
    A candidate without an attributable committee has no profile: LookupError."""
    s = _store(spark, source)
    cid = resolve(s, query)
    one = F.col("cand_id") == cid
    if not s.links.filter(F.col("CAND_ID") == cid).limit(1).collect():
        raise LookupError(f"{cid} has no principal or authorized committee; nothing to attribute.")
    money = s.rollup.filter(one)
    cands = s.candidates.filter(F.col("CAND_ID") == cid)
    facts = profile.candidate_facts(money, cands)
    oos = reports.candidate_oos_states(money, cands)
    return {
        "candidate": cands,
        "committees": profile.committee_count(s.links.filter(F.col("CAND_ID") == cid), cands),
        "totals": reports.candidate_totals(money, cands),
        "shares": profile.profile_shares(facts),
        "top_states": reports.candidate_top_states(money),
        "buckets": reports.candidate_buckets(money),
        "interest_blocs": profile.interest_share(reports.candidate_interest_blocs(money), facts),
        "out_of_state": profile.oos_pool(oos),
        "top_direct_pac": reports.candidate_top_direct_pac(
            s.contributions.filter(F.col("TARGET_CAND_ID") == cid), s.committees),
        "top_ie_spenders": reports.candidate_top_ie_spenders(
            s.clean_ie.filter(F.col("TARGET_CAND_ID") == cid)),
    }


def cohort_ranking(spark: SparkSession, source: str | Store, office: str | None = None,
                   state: str | None = None, incumbents: bool = False,
                   min_individual: float = RANK_MIN_INDIVIDUAL, limit: int = 0) -> DataFrame:
    """The funding-headline ranking of a cohort with its display fields."""
    s = _store(spark, source)
    base = reports.rank_base(s.rollup, s.candidates, office, state, incumbents, min_individual)
    cr = rank.CohortRanking(base, reports.rank_interest_categories(s.rollup), limit)
    return rank.rank_display_fields(cr.ranking).orderBy("rank")


def export_angles(spark: SparkSession, source: str | Store, out_dir: str,
                  query: str | None = None, region_note: str | None = None) -> DataFrame:
    """Write the chart documents as JSON under ``out_dir/<dirname>/<angle_id>.json``; returns
    the skipped angles with reasons. An export of all candidates replaces what an earlier one
    left in ``out_dir``; one of a single candidate (``query``) touches that candidate's
    documents only. ``region_note`` goes into every document's candidate card."""
    s = _store(spark, source)
    money, cands = s.rollup, s.candidates
    if query is not None:
        cid = resolve(s, query)
        money = money.filter(F.col("cand_id") == cid)
        cands = cands.filter(F.col("CAND_ID") == cid)
    linked = s.links.select(F.col("CAND_ID").alias("_lc")).distinct()
    buckets = reports.candidate_buckets(money)
    facts = profile.candidate_facts(money, cands)
    docs = angles.angle_documents_nested(buckets, facts, reports.candidate_top_states(money),
                                         angles.candidate_card(cands, region_note))
    docs = docs.join(linked, F.col("cand_id") == F.col("_lc"), "left_semi")
    dirs = angles.canonical_dirname(cands).withColumnRenamed("cand_id", "_dc")
    docs = docs.join(dirs, F.col("cand_id") == F.col("_dc")).drop("_dc")
    if query is None:
        files.write_angles(docs, out_dir)
    else:
        files.write_folder(docs, out_dir, dirs.first()["dirname"], (ANGLE_DONOR_SIZE, ANGLE_GEOGRAPHY))
    return angles.angles_skipped(buckets, facts).join(
        linked, F.col("cand_id") == F.col("_lc"), "left_semi")
