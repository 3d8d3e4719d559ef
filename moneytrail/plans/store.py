"""The landed store: raw text parquet -> curated typed parquet -> views.

A store is a folder. Every dataset and derived table is written to a folder of
its own version; a small state (one row of JSON) names the versions that belong
together, and is written last, under the next number, in one step that fails where that
number is taken: of two refreshes that end at once one is first, and the other is laid on top of
it, or refused where both changed the same dataset. Readers take the newest state once and keep
it, so they see one whole refresh or none of it; a job that dies leaves versions that no state
names (``vacuum`` removes them).

The money fact has a version per channel and names the paying committee, not its tag. A refresh
rebuilds the channels that read a changed dataset (only ``indiv`` and ``ccl`` touch individual
gifts); new tags rewrite no fact, they are joined to a rollup by committee.

``Store.open(spark, sf_dir)`` serves the test tables (re-expressed as raw
datasets by :mod:`moneytrail.sources.fixture`) and lands each dataset and table when it is first
read, ``Store.from_files`` lands real bulk files whole, ``Store.attach`` opens an existing store. ``refresh`` takes new
snapshots and reads each once: the landing write takes its fingerprint. A dataset's fingerprint describes the raw version that its curated
table was built from, since both change in the same state: a dataset whose
build failed stays "changed" and is tried again.
"""

from __future__ import annotations

import functools
import hashlib
import json
import os
import threading
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from moneytrail.operators import curate, views
from moneytrail.plans.joins import sized
from moneytrail.plans.session import (app_id, fs_create, fs_delete, fs_exists, fs_list, fs_modified,
                                      fs_status, prepare, scratch_path)
from moneytrail.sources import files, interests
from moneytrail.sources.fixture import CYCLE, Fixture
from moneytrail.sources.schemas import (DATASETS, INTEREST_DICTIONARY_SCHEMA, TABLE_OF_DATASET,
                                         raw_schema)
from moneytrail.streaming import landing, refresh

INPUT_TABLES = ["nation", "supplier", "customer", "part", "orders", "lineitem", "events"]
REPORT = "dataset string, status string, action string, error string"
FORMAT = 2
#: The channels of the money fact that read a dataset, directly or through its curated table.
CHANNELS_OF = {"cn": [], "cm": ["ie_support", "ie_oppose"], "ccl": ["individual"], "pas2": ["direct_pac"],
               "indiv": ["individual"], "ie": ["ie_support", "ie_oppose"]}
#: The dimensions that have a row, or less, per row of their dataset.
DIMENSIONS = {TABLE_OF_DATASET[ds]: ds for ds in ("cn", "cm", "ccl")}

_lock = threading.Lock()
_stores: dict[tuple[str, str], "Store"] = {}


# Code that decides what is landed: a change to it lands a new store.
_LANDING_MODULES = ["sources/fixture.py", "sources/schemas.py", "sources/interests.py",
                    "sources/files.py", "operators/curate.py", "functions/parse.py",
                    "functions/constants.py", "plans/store.py", "streaming/refresh.py",
                    "operators/views.py", "plans/joins.py"]


def _code_fingerprint() -> bytes:
    h = hashlib.sha256()
    pkg = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    for m in _LANDING_MODULES:
        with open(os.path.join(pkg, m), "rb") as fh:
            h.update(hashlib.sha256(fh.read()).digest())
    return h.digest()


# taken once, at import: the landing code this process actually runs
_CODE = _code_fingerprint()


def input_fingerprint(spark: SparkSession, sf_dir: str) -> str:
    h = hashlib.sha256(sf_dir.rstrip("/").encode())
    h.update(_CODE)
    for t in INPUT_TABLES:
        st = fs_status(spark, f"{sf_dir.rstrip('/')}/{t}.parquet")
        h.update(f"{t}:{st}".encode())
    return h.hexdigest()[:16]


class Store:
    def __init__(self, spark: SparkSession, root: str, cycle: str = CYCLE):
        self.spark = spark
        self.root = root
        self.state: dict = {"format": FORMAT, "number": 0, "cycle": refresh.check_cycle(cycle), "raw": {},
                            "table": {}, "prints": {}, "rows": {}, "fact": {}, "paid": {}, "rollup": {},
                            "inbox": {}}
        self._frames: dict[str, DataFrame] = {}
        self._source = None  # makes the Fixture that missing parts are landed from; None: the store is whole
        self._landing, self._adding = threading.RLock(), threading.Lock()

    # ---------------------------------------------------------------- open
    @classmethod
    def open(cls, spark: SparkSession, sf_dir: str) -> "Store":
        """The store of a folder of test tables. Each part is landed when it is first read, once per
        content of the inputs."""
        prepare(spark)
        key = (app_id(spark), input_fingerprint(spark, sf_dir))
        with _lock:
            st = _stores.get(key)
            if st is None:
                # each landing has its own folder, so two jobs that land the same
                # inputs at once don't touch each other; any with a finished part will do
                base = scratch_path(spark, "store", key[1])
                for name in fs_list(spark, base):
                    found = cls(spark, os.path.join(base, name))
                    if found.load():
                        st = found
                        break
                else:
                    st = cls(spark, os.path.join(base, uuid.uuid4().hex[:12]))
                st._source = functools.cache(lambda: Fixture(spark, sf_dir))
                _stores[key] = st
        return st

    @classmethod
    def from_files(cls, spark: SparkSession, root: str, paths: dict[str, str],
                   dictionary: str | None = None, cycle: str = CYCLE) -> "Store":
        """Land bulk files (one path per dataset, all six) into ``root`` and open them.
        Without a ``dictionary`` file the tag table is empty (P7)."""
        prepare(spark)
        missing = [ds for ds in DATASETS if ds not in paths]
        if missing:
            raise ValueError(f"no file for: {', '.join(missing)}")
        st = cls(spark, root, cycle)
        if st.load():
            raise ValueError(f"{root} holds a store already; attach to it and refresh it")
        entries = None
        if dictionary is not None:
            entries = interests.scan_interest_dictionary(spark, dictionary)
        st.land({ds: files.scan_bulk(spark, paths[ds], ds) for ds in DATASETS}, entries)
        return st

    @classmethod
    def attach(cls, spark: SparkSession, root: str) -> "Store":
        """An existing store, as its newest state has it."""
        prepare(spark)
        st = cls(spark, root)
        if not st.load():
            raise LookupError(f"{root} holds no finished store")
        return st

    # ---------------------------------------------------------------- state
    def path(self, *parts: str) -> str:
        return os.path.join(self.root, *parts)

    def _new(self, kind: str, name: str) -> str:
        return self.path(kind, name, uuid.uuid4().hex[:12])

    def load(self) -> bool:
        """Take the newest finished state; False when there is none."""
        done = [n for n in fs_list(self.spark, self.path("state")) if n.isdigit()]
        if not done:
            return False
        if int(max(done, key=int)) == self.state["number"]:
            return True
        line = self.spark.read.text(self.path("state", max(done, key=int))).first()["value"]
        state = json.loads(line)
        if state.get("format") != FORMAT:
            raise ValueError(f"{self.root} was landed by an earlier version: land it again")
        self.state = {"rows": {}, **state}
        self._frames.clear()
        return True

    def _commit(self, state: dict) -> bool:
        """Write ``state`` under the next number and take it; False when another refresh
        has taken that number."""
        state = {**state, "number": self.state["number"] + 1}
        if not fs_create(self.spark, self._new("staging", "state"),
                         self.path("state", str(state["number"])), json.dumps(state)):
            return False
        self.state = state
        self._frames.clear()
        return True

    def _publish(self, change: dict) -> None:
        """Commit new versions (``raw``, ``table`` and ``prints`` by dataset or table, ``dictionary``,
        ``inbox``) with all that derives from them. Where another refresh was first, the change is laid
        on its state, unless both changed the same dataset, or both the tags."""
        while True:
            state = {**self.state, **{k: {**self.state.get(k, {}), **change.get(k, {})}
                                      for k in ("raw", "table", "prints", "rows", "inbox")}}
            if "dictionary" in change:
                state["dictionary"] = change["dictionary"]
            tags = "dictionary" in change or "cm" in change["built"] or "dim_group_mappings" not in state["table"]
            if tags:
                state["table"]["dim_group_mappings"], state["rows"]["dim_group_mappings"] = self._tags(state)
            channels = {c for ds in change["built"] for c in CHANNELS_OF[ds]}
            if change["built"] or tags:
                state = self._derived(state, channels, tags)
            if self._commit(state):
                return
            before = self.state
            self.load()
            both = [ds for ds in change["built"] if self.state["raw"].get(ds) != before["raw"].get(ds)
                    or self.state["table"].get(TABLE_OF_DATASET[ds]) != before["table"].get(TABLE_OF_DATASET[ds])]
            if "dictionary" in change and self.state.get("dictionary") != before.get("dictionary"):
                both.append("tags")
            if both:
                raise RuntimeError(f"another refresh has changed {', '.join(both)} meanwhile")

    # ---------------------------------------------------------------- landing on demand
    def _add(self, parts: dict, made_from: dict) -> None:
        """Commit landed ``parts`` (kind -> name -> version) beside what the store has; what it has got
        meanwhile stays. Parts whose sources (``made_from``) a refresh has replaced are left out: they are
        still missing then, and made again."""
        with self._adding:
            while all(self.state[kind].get(name) == v for kind, of in made_from.items() for name, v in of.items()):
                state, frames = dict(self.state), dict(self._frames)
                for k, new in parts.items():
                    state[k] = {**new, **self.state[k]} if isinstance(new, dict) else self.state.get(k, new)
                if state == self.state:
                    return
                if self._commit(state):
                    self._frames.update(frames)  # nothing that was there has changed
                    return
                self.load()

    def _add_dataset(self, ds: str, table: bool) -> None:
        """Land a dataset, and its curated table where one is asked for."""
        if ds not in self.state["raw"]:
            path, prints = self._land_raw(ds, self._source().raw(ds))
            self._add({"raw": {ds: path}, "prints": {ds: prints}}, {})
        name, path = TABLE_OF_DATASET[ds], self.state["raw"][ds]
        if table and name not in self.state["table"]:
            self._add({"table": {name: self._build(ds, path)}}, {"raw": {ds: path}})

    def _add_dictionary(self) -> None:
        path = self._new("dictionary", "committee_interests")
        interests.write_interest_dictionary(self._source().interest_entries(), path)
        self._add({"dictionary": path}, {})

    def _need(self, raws=(), tables=(), dictionary: bool = False, money: bool = False) -> None:
        """Land what is missing of these raw datasets, curated tables (the tag table among them), the tag
        dictionary and the money fact with its rollups, and what they are made from. Datasets are landed
        at once; those that nothing asked for are left alone."""
        if self._source is None:
            return
        tables, raws = set(tables), set(raws)
        if money:  # individual gifts are read from their raw rows
            raws.add("indiv")
            tables |= {TABLE_OF_DATASET[ds] for ds in ("cm", "ccl", "pas2", "ie")} | {"dim_group_mappings"}
        tags = "dim_group_mappings" in tables
        if tags:
            tables.add("dim_committees")
        built = {ds for ds in DATASETS if TABLE_OF_DATASET[ds] in tables}

        def lacking() -> list:
            raw, table = self.state["raw"], self.state["table"]
            jobs = [functools.partial(self._add_dataset, ds, ds in built) for ds in DATASETS
                    if ds in raws | built and ds not in raw or ds in built and TABLE_OF_DATASET[ds] not in table]
            if (dictionary or tags) and "dictionary" not in self.state:
                jobs.append(self._add_dictionary)
            return jobs

        with self._landing:
            if lacking():
                self.load()  # another job may have landed it
            while True:
                jobs = lacking()
                if jobs:
                    self._source()
                    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:  # they share nothing
                        list(pool.map(lambda job: job(), jobs))
                    continue
                state = self.state
                if tags and "dim_group_mappings" not in state["table"]:
                    path, rows = self._tags(state)
                    self._add({"table": {"dim_group_mappings": path}, "rows": {"dim_group_mappings": rows}},
                              {"table": {"dim_committees": state["table"]["dim_committees"]}})
                elif money and set(views.CHANNELS) - set(state["rollup"]):
                    done = self._derived(state, [], True)
                    self._add({k: done[k] for k in ("fact", "paid", "rollup")},
                              {"raw": {"indiv": state["raw"]["indiv"]}, "table": {t: state["table"][t] for t in tables}})
                else:
                    return

    def complete(self) -> "Store":
        """Land every part that is missing."""
        self._need(tables=[*TABLE_OF_DATASET.values(), "dim_group_mappings"], money=True)
        return self

    def vacuum(self, keep_seconds: float = 0) -> list[str]:
        """Remove versions that the newest state does not name: replaced ones, and those of jobs
        that died. Versions made after the newest state, or within ``keep_seconds`` before it, stay: a
        refresh may still be writing them. Call it when no reader holds an older state."""
        self.load()
        self.complete()
        named = set(_paths(self.state))
        bound = fs_modified(self.spark, self.path("state", str(self.state["number"]))) - 1000 * keep_seconds
        gone = []
        for kind in ("raw", "curated", "derived", "rollups", "dictionary", "staging"):
            for name in fs_list(self.spark, self.path(kind)):
                for version in fs_list(self.spark, self.path(kind, name)):
                    p = self.path(kind, name, version)
                    if p not in named and fs_modified(self.spark, p) <= bound:
                        fs_delete(self.spark, p)
                        gone.append(p)
        for n in fs_list(self.spark, self.path("state")):
            if n.isdigit() and int(n) < self.state["number"]:
                fs_delete(self.spark, self.path("state", n))
        return gone

    def raw_path(self, ds: str) -> str:
        self._need(raws=[ds])
        return self.state["raw"][ds]

    def raw_paths(self) -> dict[str, str]:
        """Where each raw dataset is; missing ones are landed at once."""
        self._need(raws=DATASETS)
        return {ds: self.state["raw"][ds] for ds in DATASETS}

    def table_path(self, name: str) -> str:
        self._need(tables=[name])
        return self.state["table"][name]

    def dictionary_path(self) -> str | None:
        self._need(dictionary=True)
        return self.state.get("dictionary")

    def money_path(self) -> str:
        """The folder of the money fact's channels and their versions."""
        self._need(money=True)
        return self.path("derived")

    def manifest(self) -> DataFrame:
        """(dataset, cycle, rows, fingerprint) of the state's raw versions, as they were landed."""
        self._need(raws=DATASETS)
        rows = [(ds, self.state["cycle"], n, print_) for ds, (n, print_) in sorted(self.state["prints"].items())]
        return self.spark.createDataFrame(rows, refresh.MANIFEST_SCHEMA)

    def curated_tables(self) -> dict[str, DataFrame]:
        names = [TABLE_OF_DATASET[ds] for ds in DATASETS] + ["dim_group_mappings"]
        self._need(tables=names)
        return {n: self.table(n) for n in names}

    def raws(self) -> dict[str, DataFrame]:
        self._need(raws=DATASETS)
        return {ds: self.raw(ds) for ds in DATASETS}

    # ---------------------------------------------------------------- build
    def _land_raw(self, ds: str, rows: DataFrame) -> tuple[str, list]:
        """Write a dataset to a new version; its rows and fingerprint are taken by the same pass."""
        path = self._new("raw", ds)
        return path, list(refresh.landed_fingerprint(rows, lambda df: files.land_raw_parquet(df, path)))

    def _build(self, ds: str, raw_path: str) -> str:
        """Write the curated table of a landed dataset to a new version."""
        path = self._new("curated", TABLE_OF_DATASET[ds])
        files.replace_curated(curate.CURATE[ds](files.scan_raw_parquet(self.spark, raw_path, ds)), path)
        return path

    def _land(self, ds: str, rows: DataFrame) -> tuple[str, str, list]:
        raw_path, prints = self._land_raw(ds, rows)
        return raw_path, self._build(ds, raw_path), prints

    def _tags(self, state: dict) -> tuple[str, int]:
        """Write the tag table for the state's dictionary and committees; its version and rows."""
        path = self._new("curated", "dim_group_mappings")
        if state.get("dictionary") is None:
            tags = curate.empty_group_mappings(self.spark)
        else:
            entries = interests.scan_interest_dictionary(self.spark, state["dictionary"])
            committees = self.spark.read.parquet(state["table"]["dim_committees"])
            tags = interests.load_group_mappings(entries, sized(committees, _rows(state, "dim_committees")))
        return path, files.replace_curated(tags, path).count()

    def _derived(self, state: dict, channels, tags: bool) -> dict:
        """The state with new versions of the fact's ``channels`` and of all rollups that they, or new
        ``tags``, change."""
        build = Store(self.spark, self.root, state["cycle"])
        build.state = {**state, **{k: dict(state.get(k, {})) for k in ("fact", "paid", "rollup")}}
        channels = set(channels) | {c for c in views.CHANNELS if c not in build.state["fact"]}
        with ThreadPoolExecutor(max_workers=len(views.CHANNELS)) as pool:  # channels share nothing
            list(pool.map(build._materialize, [c for c in views.CHANNELS if c in channels]))
            again = channels | set(views.PAID_BY_COMMITTEES if tags else [])
            list(pool.map(build._tag_rollup, [c for c in views.CHANNELS if c in again]))
        return build.state

    def land(self, raws: dict[str, DataFrame], entries: DataFrame | None) -> None:
        """Land raw datasets, build curated tables, load the tag dictionary."""
        # The six datasets are independent: their jobs are submitted
        # concurrently so small datasets do not leave the cluster idle while a
        # large one lands. Failures surface here (all must land).
        with ThreadPoolExecutor(max_workers=len(DATASETS)) as pool:
            jobs = {ds: pool.submit(self._land, ds, raws[ds]) for ds in DATASETS}
            built = {ds: job.result() for ds, job in jobs.items()}
        change = {"raw": {ds: r for ds, (r, _, _) in built.items()},
                  "table": {TABLE_OF_DATASET[ds]: t for ds, (_, t, _) in built.items()},
                  "prints": {ds: f for ds, (_, _, f) in built.items()}, "built": list(built)}
        if entries is not None:
            change["dictionary"] = self._new("dictionary", "committee_interests")
            interests.write_interest_dictionary(entries, change["dictionary"])
        self._publish(change)

    def load_tags(self, path: str, dry_run: bool = False) -> DataFrame:
        """Replace the tags by those of a tag file: (category, entries, matched, unknown) of the file.

        Only the tag table and the small rollups that carry tags are written; no fact is. A file
        without the required columns is refused, ids that are no committee are counted as unknown and left
        out. With ``dry_run`` nothing is written."""
        self.load()
        self.complete()
        entries = interests.scan_interest_dictionary(self.spark, path)
        ids = self.committees.select(F.col("CMTE_ID").alias("_id")).distinct()
        known = entries.join(ids, F.col("cmte_id") == F.col("_id"), "left")
        report = known.groupBy("category").agg(
            F.count(F.lit(1)).alias("entries"), F.count("_id").alias("matched"),
            F.count(F.when(F.col("_id").isNull(), 1)).alias("unknown"))
        if not dry_run:
            kept = self._new("dictionary", "committee_interests")
            interests.write_interest_dictionary(entries, kept)
            self._publish({"dictionary": kept, "built": []})
        return report

    def refresh(self, snapshots: dict[str, DataFrame], cycle: str | None = None,
                force: bool = False, inbox: dict | None = None) -> DataFrame:
        """Refresh from new full snapshots of some datasets (S9-S11 end to end).

        The cycle must match the store's (one cycle per store). Each given
        snapshot is fingerprinted and compared with the manifest; new or changed
        datasets are rebuilt (all given ones with ``force``), and so is any
        landed dataset whose curated table is missing, from its raw version. A
        failing dataset is reported, keeps its old versions and does not stop
        the others. All that changed becomes visible at once, at the end.
        Returns one row per dataset looked at: status, action, error.
        """
        cycle = refresh.check_cycle(cycle if cycle is not None else self.state["cycle"])
        self.load()
        self.complete()
        stored = self.manifest()
        refresh.assert_one_cycle(stored, cycle)
        status, results, landed, prints = {}, [], {}, dict(self.state["prints"])
        for ds, rows in snapshots.items():  # one by one: a snapshot that can't be read is its own failure
            try:
                landed[ds] = self._land_raw(ds, rows)
                known = prints.get(ds)
                status[ds] = "new" if known is None else "unchanged" if known[1] == landed[ds][1][1] else "changed"
            except Exception as e:  # noqa: BLE001 - reported; the others go on
                results.append((ds, None, "failed", _said(e)))
        have = {ds for ds in self.state["raw"]
                if fs_exists(self.spark, self.table_path(TABLE_OF_DATASET[ds]) + "/_SUCCESS")}
        gone = [ds for ds in self.state["raw"] if ds not in have and status.get(ds, "unchanged") == "unchanged"]
        changes = self.spark.createDataFrame(
            [*status.items(), *((ds, "unchanged") for ds in gone if ds not in status)],
            "dataset string, status string")
        tables = [(t,) for t in self.state["table"] if t not in {TABLE_OF_DATASET[d] for d in gone}]
        rebuild = refresh.rebuild_set(changes, self.spark.createDataFrame(tables, "table string"),
                                      TABLE_OF_DATASET, [*status, *gone], force)
        reasons = {r["dataset"]: r["reason"] for r in rebuild.collect()}  # one row per dataset
        change: dict = {"raw": {}, "table": {}, "prints": {}, "built": []}
        for ds in [*status, *(d for d in gone if d not in status)]:
            st = status.get(ds, "table missing")
            if ds not in reasons:
                results.append((ds, st, "skipped", None))
                fs_delete(self.spark, landed[ds][0])  # the same rows as the version that is kept
                continue
            try:
                raw_path, print_ = landed.get(ds) or (self.raw_path(ds), prints[ds])
                change["table"][TABLE_OF_DATASET[ds]] = self._build(ds, raw_path)
                change["raw"][ds], change["prints"][ds] = raw_path, print_
                change["built"].append(ds)
                results.append((ds, st, "rebuilt", None))
            except Exception as e:  # noqa: BLE001 - reported; the others go on
                results.append((ds, st, "failed", _said(e)))
        failed = any(r[2] == "failed" for r in results)
        if inbox and not failed:  # a snapshot from an inbox stays pending until it is built
            change["inbox"] = inbox
        if change["built"] or change.get("inbox"):
            self._publish(change)
        return self.spark.createDataFrame(results, REPORT)

    def refresh_from_inbox(self, inbox: str, dataset: str, cycle: str | None = None) -> DataFrame:
        """The scheduled refresh loop for one dataset: an availableNow file stream
        lists what arrived in ``inbox``; the newest snapshot ever seen, unless it is
        the one that was built last (the state says which), is read whole and given
        to ``refresh``. A snapshot that could not be read or built stays pending and is
        tried again by the next call, or gives way to a newer one. One that may still be
        arriving (see ``landing.is_complete``) is "incomplete": nothing is read or published."""
        self.load()
        seen = self.path("inbox", dataset, "seen")
        landing.see_new_files(self.spark, inbox, seen, self.path("inbox", dataset, "stream"))
        newest = landing.newest_snapshot(self.spark, seen)
        mark = newest and [newest["snapshot"], str(newest["modified"])]
        if newest is None or mark == self.state.get("inbox", {}).get(dataset):
            return self.spark.createDataFrame([(dataset, None, "no new files", None)], REPORT)
        if not landing.is_complete(self.spark, inbox, newest["snapshot"], self.path("inbox", dataset, "listing")):
            return self.spark.createDataFrame([(dataset, None, "incomplete", None)], REPORT)
        rows = landing.read_snapshot(self.spark, inbox, seen, newest["snapshot"], dataset)
        return self.refresh({dataset: rows}, cycle, inbox={dataset: mark})

    def _materialize(self, channel: str) -> None:
        """Parse once, join once: one channel of the money fact is written as zstd parquet, rows
        sorted by candidate inside each file so row-group statistics prune a single-candidate filter. No
        shuffle: a candidate holding a third of all rows stays spread over the scan tasks it came
        from. Then its rollup by paying committee (individual gifts: by state), which is bounded by
        candidates x states x committees x 7 buckets, not by the number of gifts."""
        rows = (views.fact_individual(self.clean_individual, self.links) if channel == "individual" else
                views.fact_direct_pac(self.contributions) if channel == "direct_pac" else
                views.fact_ie(self.clean_ie, channel))
        fact, paid = self._new("derived", f"fact_{channel}"), self._new("rollups", f"paid_{channel}")
        (rows.sortWithinPartitions("cand_id").write.option("compression", "zstd").parquet(fact))
        (views.committee_rollup(self.spark.read.parquet(fact))
         .write.option("compression", "zstd").parquet(paid))
        self.state["fact"][channel], self.state["paid"][channel] = fact, paid

    def _tag_rollup(self, channel: str) -> None:
        """The rollup that reports read: one channel's by candidate, state, tag and size bucket.
        Range-partitioned and sorted by candidate, so files and row groups cover disjoint candidate
        ranges and a one-candidate filter reads one of them (a candidate has at most a few hundred
        rollup rows, so the range shuffle cannot be skewed)."""
        path = self._new("rollups", f"rollup_{channel}")
        paid = self.spark.read.parquet(self.state["paid"][channel])
        (views.tagged_rollup(paid, self.tags).orderBy("cand_id")
         .write.option("compression", "zstd").parquet(path))
        self.state["rollup"][channel] = path

    # ---------------------------------------------------------------- frames
    def _memo(self, name, make) -> DataFrame:
        df = self._frames.get(name)
        if df is None:
            df = make()
            self._frames[name] = df
        return df

    def raw(self, ds: str) -> DataFrame:
        return self._memo("raw_" + ds, lambda: self.spark.read.schema(raw_schema(ds))
                          .parquet(self.raw_path(ds)))

    def table(self, name: str) -> DataFrame:
        def read() -> DataFrame:
            at = self.table_path(name)
            return sized(self.spark.read.parquet(at), _rows(self.state, name))

        return self._memo(name, read)

    @property
    def candidates(self) -> DataFrame:
        return self.table("dim_candidates")

    @property
    def committees(self) -> DataFrame:
        return self.table("dim_committees")

    @property
    def bridge(self) -> DataFrame:
        return self.table("bridge_candidate_committee")

    @property
    def contributions(self) -> DataFrame:
        return self.table("fact_contributions")

    @property
    def individual(self) -> DataFrame:
        return self.table("fact_individual_contributions")

    @property
    def ie(self) -> DataFrame:
        return self.table("fact_independent_expenditures")

    @property
    def tags(self) -> DataFrame:
        return self.table("dim_group_mappings")

    def interest_entries(self) -> DataFrame:
        return self._memo("interest_entries", lambda: interests.scan_interest_dictionary(
            self.spark, self.dictionary_path()) if self.dictionary_path() else
            self.spark.createDataFrame([], INTEREST_DICTIONARY_SCHEMA))

    # views
    @property
    def links(self) -> DataFrame:
        return self._memo("v_links", lambda: views.candidate_committees(self.bridge))

    @property
    def clean_individual(self) -> DataFrame:
        return self._memo("v_clean_ind", lambda: views.clean_individual(self.raw("indiv")))

    @property
    def clean_ie(self) -> DataFrame:
        return self._memo("v_clean_ie", lambda: views.clean_ie(self.ie, self.committees))

    @property
    def money_individual(self) -> DataFrame:
        return self._memo("v_m_ind", lambda: views.money_individual(self.clean_individual,
                                                                     self.links))

    @property
    def money_direct_pac(self) -> DataFrame:
        return self._memo("v_m_pac", lambda: views.money_direct_pac(self.contributions,
                                                                     self.tags))

    @property
    def money_ie_support(self) -> DataFrame:
        return self._memo("v_m_sup", lambda: views.money_ie_support(self.clean_ie, self.tags))

    @property
    def money_ie_oppose(self) -> DataFrame:
        return self._memo("v_m_opp", lambda: views.money_ie_oppose(self.clean_ie, self.tags))

    @property
    def money_view(self) -> DataFrame:
        """candidate_money computed from its definition (V4)."""
        return self._memo("v_money", lambda: views.candidate_money(
            self.money_individual, self.money_direct_pac, self.money_ie_support,
            self.money_ie_oppose))

    @property
    def money(self) -> DataFrame:
        """candidate_money as materialised at landing, with the tags as they are now (same rows as V4)."""
        def read() -> DataFrame:
            self._need(money=True)
            at = self.state["fact"]
            own = self.spark.read.parquet(at["individual"]).withColumn("interest_category", F.lit(None).cast("string"))
            paid = self.spark.read.parquet(*[at[c] for c in views.PAID_BY_COMMITTEES])
            return own.select(*views.MONEY_COLUMNS).unionByName(
                views.with_tags(paid, self.tags).select(*views.MONEY_COLUMNS))

        return self._memo("m_money", read)

    @property
    def rollup(self) -> DataFrame:
        """candidate_money pre-aggregated (see ``views.money_rollup``). What is grouped from it has a row or
        more per candidate, so it is joined as a table of so many rows."""
        def read() -> DataFrame:
            self._need(money=True)
            rows = self.spark.read.parquet(*[self.state["rollup"][c] for c in views.CHANNELS])
            return sized(rows, _rows(self.state, "dim_candidates"))

        return self._memo("m_rollup", read)

    def register_views(self) -> None:
        """Expose tables and views to ``spark.sql`` under their canonical names."""
        for ds in DATASETS:
            self.raw(ds).createOrReplaceTempView(f"raw_{ds}")
            self.table(TABLE_OF_DATASET[ds]).createOrReplaceTempView(TABLE_OF_DATASET[ds])
        self.tags.createOrReplaceTempView("dim_group_mappings")
        self.links.createOrReplaceTempView("candidate_committees")
        self.clean_individual.createOrReplaceTempView("clean_individual_contributions")
        self.clean_ie.createOrReplaceTempView("clean_independent_expenditures")
        self.money.createOrReplaceTempView("candidate_money")


def _rows(state: dict, table: str) -> int | None:
    """The rows of a dimension, as far as the state tells: joins with it depend on them."""
    if table in DIMENSIONS:
        return state["prints"].get(DIMENSIONS[table], [None])[0]
    return state["rows"].get(table)


def _paths(state) -> list[str]:
    """Every text in a state: the versions that it names are among them."""
    if isinstance(state, dict):
        return [p for v in state.values() for p in _paths(v)]
    if isinstance(state, list):
        return [p for v in state for p in _paths(v)]
    return [state] if isinstance(state, str) else []


def _said(e: Exception) -> str:
    return f"{type(e).__name__}: {str(e)[:300]}"
