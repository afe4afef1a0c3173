"""The full load: feeds -> raw -> curated and quarantine -> dimensions -> facts -> reports, with an audit trail.

Each step reads tables from the store and writes one, so a step is a plan of its own and what it hands on is files.
A step whose input is missing or failed in this run is skipped; the last audit row sums up the run.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from surestar import schemas
from surestar.functions.parse import clean_reference
from surestar.operators import quality as q
from surestar.operators import scd
from surestar.operators.keys import max_key
from surestar.operators.lookup import UNKNOWN_SK
from surestar.operators.rules import ROW_JSON, Rule, json_if_rejected, kept, rejected, with_reasons
from surestar.plans import curate, dims, facts
from surestar.sources.audit import ERROR, OK, SKIPPED, AuditRow, audit_frame, observe_marked, observe_rows
from surestar.session import scratch
from surestar.sources.feeds import decoded, encoding_counts, found_encoding, guessed, read_feed
from surestar.sources.store import Buckets, Store

Counts = dict[str, int]


@dataclass(frozen=True)
class Options:
    """Choices of a load: count equal coverage rows once; which version of a person facts point at; canonical spellings
    of master provinces; reject items that no policy names; require claimed >= assessed >= paid; check all facts and
    not only those of the run in the quality report; number of buckets by id of a fact table that does not exist yet (one
    per few hundred megabytes of the history that is expected; the parts of later runs take the same)."""

    dedupe_exact: bool = False
    person_version: str = "first"
    province_aliases: Mapping[str, Sequence[str]] | None = None
    items_need_policy: bool = False
    amount_order: bool = False
    full_report: bool = False
    buckets: int = 16


FACT_IDS = {"fact_policy": "policy_id", "fact_claim": "claim_id"}

# Curations that read dates.
DATED = ("clients", "policies", "assessments", "payments", "agents", "claims")


@dataclass
class Load:
    """One run: where it reads, where it writes, and the steps done so far."""

    spark: SparkSession
    feeds_folder: str
    store: Store
    as_of: dt.date
    run_id: str
    geography: DataFrame | None = None
    feeds: dict[str, schemas.FeedSpec] = field(default_factory=lambda: {spec.name: spec for spec in schemas.FEEDS})
    options: Options = field(default_factory=lambda: Options())
    audit: list[AuditRow] = field(default_factory=list)
    failed: set[str] = field(default_factory=set)
    written: set[str] = field(default_factory=set)

    def step(self, name: str, makes: str, needs: list[str], run: Callable[[], Counts]) -> None:
        started = dt.datetime.now(dt.timezone.utc)
        status, message, counts = OK, None, {}
        stale = [t for t in needs if t.startswith("raw_") and t not in self.written]
        lacking = [t for t in needs if t in self.failed or not self.store.has(t)]
        if lacking:
            status, message = SKIPPED, f"missing input: {', '.join(lacking)}"
            self.failed.add(makes)
        else:
            try:
                with scratch(self.spark):
                    counts = dict(run())
                notes = [f"{k}: {v}" for k, v in counts.items() if k not in ("rows_in", "rows_out", "rows_rejected") and v]
                notes += [f"the feed did not come, {t} is of an earlier run" for t in stale]
                message = "; ".join(notes) or None
            except FileNotFoundError as error:
                # A feed that did not come leaves the raw table of an earlier run in place.
                status, message = SKIPPED, str(error)
            except Exception as error:  # the run goes on; dependants are skipped and the audit says why
                status, message = ERROR, f"{type(error).__name__}: {error}"
                self.failed.add(makes)
        ended = dt.datetime.now(dt.timezone.utc)
        seen = (counts.get(c) for c in ("rows_in", "rows_out", "rows_rejected"))
        self.audit.append(AuditRow(started, ended, name, *seen, status, message))

    # Tables

    def raw(self, name: str) -> DataFrame:
        """A feed as it came, in the encoding that was found while it was stored."""
        table = f"raw_{name}"
        found = (self.store.notes(table) or {}).get("decode")
        return decoded(self.store.read(table), found) if found else self.store.read(table)

    def curated(self, name: str) -> DataFrame:
        """Kept rows of a curated feed; fraud indicators come rolled up to one row per claim."""
        marked = self.store.read(f"curated_{name}")
        return curate.fraud_flags(marked) if name == "fraud_indicators" else kept(marked)

    def dimension(self, name: str) -> DataFrame:
        return self.store.read(name, schemas.DIMENSIONS[name])

    def fact(self, name: str) -> DataFrame:
        """Rows of other runs; repeating a run replaces its own part."""
        return self.store.read_appended(name, schemas.FACTS[name], before=self.run_id)

    # Steps

    def ingest(self, spec: schemas.FeedSpec) -> Counts:
        feed = read_feed(self.spark, self.feeds_folder, spec)
        if feed is None:
            raise FileNotFoundError(f"{spec.file} not found")
        if spec.encoding:
            return self._write(f"raw_{spec.name}", *observe_rows(feed, *curate.coerced_counts(feed, spec.name)))
        counts = curate.coerced_counts(feed, spec.name, lambda name: guessed(F.col(name)))
        df, seen = observe_rows(feed, *counts, *encoding_counts(feed))
        counts = self._write(f"raw_{spec.name}", df, seen, lambda: {"decode": found_encoding(seen.get)})
        return counts | {"encoding": found_encoding(counts)}

    def curate(self, name: str, parents: list[str]) -> Counts:
        raw = self.raw(name)
        known = [self.curated(parent) for parent in parents]
        dates = {"dates": self.feeds[name].date_formats} if name in DATED else {}
        if name == "clients":
            marked = curate.clients(raw, self.as_of, self.geography, self.options.province_aliases, **dates)
        elif name == "coverages":
            marked = curate.coverages(raw, *known, dedupe_exact=self.options.dedupe_exact)
        elif name == "items" and self.options.items_need_policy:
            # Policies come later in the order of the feeds, so the raw ones decide.
            named = self.raw("policies").select(clean_reference(F.col("id_objeto_asegurado")).alias("id_objeto_asegurado"))
            marked = curate.items(raw, named)
        else:
            marked = getattr(curate, name)(raw, *known, **dates)
        return self._write(f"curated_{name}", *observe_marked(marked))

    def high_water(self, name: str) -> dict:
        """Highest key of a dimension, and the start of its latest version, as noted when it was written; empty if they weren't."""
        if not self.store.has(name):
            return {"highest": 0}
        noted = self.store.notes(name) or {}
        known = {k: noted[k] for k in ("highest", "latest") if k in noted}
        if known.get("latest"):
            known["latest"] = dt.date.fromisoformat(known["latest"])
        return known

    def highest_fact(self, name: str) -> int:
        """Highest key that any run has given out; facts are scanned only if a part has no notes."""
        noted = self.store.part_notes(name)
        if all(n and "highest" in n for n in noted.values()):
            return max([0, *(n["highest"] for n in noted.values())])
        return max_key(self.store.read_appended(name, schemas.FACTS[name]), "sk")

    def load_dimension(self, name: str, make: Callable[..., DataFrame]) -> Counts:
        df = make(self.dimension(name), **self.high_water(name))
        real = F.col("sk") != UNKNOWN_SK
        latest = [F.max(F.when(real, F.col("valid_from"))).alias("latest")] if "valid_from" in df.columns else []
        rules = schemas.constraints(name)
        highest = F.coalesce(F.max(F.when(real, F.col("sk"))), F.lit(0)).alias("highest")
        df, seen = observe_rows(df, highest, *latest, *q.rule_counters(rules, real))

        def noted() -> dict:
            known = {k: seen.get[k] for k in ("highest", "latest") if seen.get.get(k) is not None}
            return {**known, "violations": q.violations(rules, seen.get)}

        counts = self._write(name, df, seen, noted)
        return {"rows_out": counts["rows_out"]}

    def add_unknown(self, name: str) -> Counts:
        table = self.dimension(name)
        if not table.where(F.col("sk") == UNKNOWN_SK).isEmpty():
            return {"rows_out": 0}
        noted = self.store.notes(name)
        self.store.replace(name, scd.ensure_unknown_member(table, "sk", schemas.UNKNOWN_MEMBERS[name]), noted and (lambda: noted))
        return {"rows_out": 1}

    def load_fact(self, name: str, key: str, new_rows: DataFrame, more: list[Rule]) -> Counts:
        """Check the declared constraints, keep the violating rows out, number and append the others.

        The rules and the rejected rows see the amounts before they are cast. Rows that an earlier try of this run has
        loaded keep their keys.
        """
        columns = [c for c in new_rows.columns if not c.startswith("_")]
        marked = with_reasons(new_rows, [*schemas.constraints(name), *more])
        marked = marked.withColumn(ROW_JSON, json_if_rejected(columns))
        counts = self._write(f"new_{name}", *observe_marked(marked))
        good = facts.as_stored(kept(self.store.read(f"new_{name}")).select(*columns), name)
        own = self.store.read_part(name, self.run_id, schemas.FACTS[name])
        again, fresh = facts.keep_keys(good, key, own)
        highest = self.highest_fact(name)
        numbered = facts.number_new(fresh, key, highest)
        rules = report_rules(name)
        every = numbered.unionByName(again.select(*numbered.columns))
        every, seen = observe_rows(every, *q.new_key_counts("sk", highest), *q.rule_counters(rules))
        noted = self.store.part_notes(name)
        earlier = noted.get(self.run_id) or {}
        number = next((n["buckets"][1] for n in noted.values() if n and "buckets" in n), self.options.buckets)


        def notes() -> dict:
            return {**q.noted_keys(seen.get, earlier, highest), "violations": q.violations(rules, seen.get)}

        self.store.append(name, every, self.run_id, notes, Buckets(key, number))
        return counts

    def _write(self, table: str, df: DataFrame, seen: Observation, notes: Callable[[], dict] | None = None) -> Counts:
        self.store.replace(table, df, notes)
        self.written.add(table)
        return seen.get

    def append_quarantine(self, tables: list[tuple[str, str]]) -> Counts:
        """Rejected rows of what this run has written; tables of earlier runs have been counted there."""
        parts = [rejected(self.store.read(t), source, self.run_id) for t, source in tables if t in self.written]
        if not parts:
            return {"rows_out": 0}
        df, seen = observe_rows(reduce(DataFrame.unionByName, parts))
        self.store.append("quarantine", df, self.run_id)
        return seen.get


FEED_ORDER = (
    ("clients", []),
    ("agents", []),
    ("policies", ["clients", "agents"]),
    ("adjusters", []),
    ("items", []),
    ("claims", ["policies", "clients", "adjusters", "items"]),
    ("assessments", ["claims", "adjusters"]),
    ("payments", ["claims", "clients", "policies"]),
    ("coverages", ["policies"]),
    ("fraud_indicators", ["claims"]),
)


def full_load(
    spark: SparkSession,
    feeds_folder: str,
    warehouse: str,
    as_of: dt.date,
    run_id: str,
    geography: DataFrame | None = None,
    calendar: tuple[dt.date, dt.date] = (schemas.CALENDAR_START, schemas.CALENDAR_END),
    feeds: Sequence[schemas.FeedSpec] = schemas.FEEDS,
    options: Options | None = None,
) -> DataFrame:
    """Run everything and return the audit rows of this run, which are also appended to the store.

    ``feeds`` says how the extracts are written (date formats, line breaks in cells, and an encoding where it is not to be found
    out); ``options`` are the choices of the load. Repeating a run gives its facts the keys they had.
    """
    specs = {spec.name: spec for spec in feeds}
    load = Load(spark, feeds_folder, Store(spark, warehouse), as_of, run_id, geography, specs, options or Options())
    try:
        return _run(load, calendar, feeds)
    finally:
        load.store.release()


def _run(load: Load, calendar: tuple[dt.date, dt.date], feeds: Sequence[schemas.FeedSpec]) -> DataFrame:
    begun = dt.datetime.now(dt.timezone.utc)
    for spec in feeds:
        load.step(f"ingest {spec.name}", f"raw_{spec.name}", [], lambda spec=spec: load.ingest(spec))
    for name, parents in FEED_ORDER:
        needs = [f"raw_{name}", *[f"curated_{parent}" for parent in parents]]
        load.step(f"curate {name}", f"curated_{name}", needs, lambda n=name, p=parents: load.curate(n, p))

    for name, needs, make in _dimension_steps(load, calendar):
        load.step(f"load {name}", name, needs, lambda n=name, m=make: load.load_dimension(n, m))
    for name in schemas.DIMENSIONS:
        load.step(f"unknown member {name}", name, [name], lambda n=name: load.add_unknown(n))

    _fact_steps(load)
    sources = [(f"curated_{name}", name) for name, _ in FEED_ORDER]
    sources += [("new_fact_policy", "fact_policy"), ("new_fact_claim", "fact_claim")]
    load.step("quarantine", "quarantine", [], lambda: load.append_quarantine(sources))
    every = [*schemas.DIMENSIONS, *schemas.FACTS]
    load.step("quality report", "dq_report", every, lambda: _append_quality_report(load))

    # A feed that no step reads may be absent.
    unread = {f"ingest {spec.name}" for spec in feeds} - {f"ingest {name}" for name, _ in FEED_ORDER}
    worst = next((s for s in (ERROR, SKIPPED) if any(r.status == s for r in load.audit if r.step not in unread)), OK)
    done = dt.datetime.now(dt.timezone.utc)
    load.audit.append(AuditRow(begun, done, "full load", None, None, None, worst))
    audit = audit_frame(load.spark, load.audit)
    load.store.append("audit", audit, load.run_id)
    return audit


def _dimension_steps(
    load: Load, calendar: tuple[dt.date, dt.date]
) -> list[tuple[str, list[str], Callable[[DataFrame], DataFrame]]]:
    c = load.curated

    def persons(existing: DataFrame, **water) -> DataFrame:
        own = dims.person_input(c("clients"), load.dimension("dim_location"))
        known = [(existing, "person_id"), (own, "person_id")]
        others = dims.third_parties(c("claims"), "id_receptor_pago", known)
        return dims.load_persons(existing, dims.with_third_parties(own, others), load.as_of, **water)

    return [
        ("dim_agent", ["curated_agents"], lambda old, **known: dims.load_agents(old, dims.agent_input(c("agents")), **known)),
        ("dim_date", [], lambda old, **known: dims.load_dates(old, dims.date_dimension(load.spark, *calendar), **known)),
        ("dim_adjuster", ["curated_adjusters"],
         lambda old, **known: dims.load_adjusters(old, dims.adjuster_input(c("adjusters")), **known)),
        ("dim_item", ["curated_items"], lambda old, **known: dims.load_items(old, dims.item_input(c("items")), **known)),
        ("dim_plan", ["curated_policies"], lambda old, **known: dims.load_plans(old, dims.plan_input(c("policies")), **known)),
        ("dim_claim_type", ["curated_claims"],
         lambda old, **known: dims.load_claim_types(old, dims.claim_type_input(c("claims")), **known)),
        ("dim_location", ["curated_clients", "curated_items"],
         lambda old, **known: dims.load_locations(old, dims.location_input(c("clients"), c("items")), **known)),
        ("dim_person", ["curated_clients", "curated_claims", "dim_location"], persons),
    ]


def _fact_steps(load: Load) -> None:
    c, d = load.curated, load.dimension

    def policies() -> Counts:
        names = ("dim_agent", "dim_item", "dim_plan", "dim_location", "dim_date", "dim_person")
        rows = facts.fact_policy(
            c("policies"), c("coverages"), c("items"), **{n: d(n) for n in names}, existing=load.fact("fact_policy"),
            person_version=load.options.person_version,
        )
        return load.load_fact("fact_policy", "policy_id", rows, [])

    def claims() -> Counts:
        names = ("dim_item", "dim_location", "dim_date", "dim_person", "dim_adjuster", "dim_claim_type")
        all_policies = load.store.read_appended("fact_policy", schemas.FACTS["fact_policy"])
        rows = facts.fact_claim(
            c("claims"), c("assessments"), c("payments"), c("fraud_indicators"), c("items"), all_policies,
            **{n: d(n) for n in names}, existing=load.fact("fact_claim"), person_version=load.options.person_version,
        )
        more = [Rule("open_date <= close_date", F.col("_dates_ok"))]
        if load.options.amount_order:
            more.append(q.descending(("claimed", "assessed", "paid")))
        return load.load_fact("fact_claim", "claim_id", rows, more)

    def overpaid() -> Counts:
        flagged = facts.overpaid(load.store.read("new_fact_claim")).where("is_overpaid")
        df, seen = observe_rows(flagged.select("claim_id", "policy_sk", "paid", F.col("_insured_sum").alias("insured_sum")))
        load.store.append("overpaid_claims", df, load.run_id)
        return seen.get

    policy_needs = ["curated_policies", "curated_coverages", "curated_items", "dim_agent", "dim_item", "dim_plan",
                    "dim_location", "dim_date", "dim_person"]
    claim_needs = ["curated_claims", "curated_assessments", "curated_payments", "curated_fraud_indicators",
                   "curated_items", "fact_policy", "dim_item", "dim_location", "dim_date", "dim_person",
                   "dim_adjuster", "dim_claim_type"]
    load.step("load fact_policy", "fact_policy", policy_needs, policies)
    load.step("load fact_claim", "fact_claim", claim_needs, claims)
    load.step("overpaid claims", "overpaid_claims", ["new_fact_claim", "fact_claim"], overpaid)


def _append_quality_report(load: Load) -> Counts:
    """Declared constraints over the stored star; members with key -1 are exempt from row rules.

    Facts never change once they are loaded, so those of this run are checked; ``full_report`` checks all of them. Their
    parents are looked for in whole tables.
    """
    tables = {name: load.dimension(name) for name in schemas.DIMENSIONS}
    parents = tables | {name: load.store.read_appended(name, schema) for name, schema in schemas.FACTS.items()}
    own = {name: load.store.read_part(name, load.run_id, schema) for name, schema in schemas.FACTS.items()}
    tables = parents if load.options.full_report else tables | own
    reports = [_rule_report(load, name, df) for name, df in tables.items()]
    reports += [q.foreign_key_report(tables[fk.table], fk, parents[fk.parent]) for fk in schemas.FOREIGN_KEYS]
    reports += [q.unique_report(name, df, "sk") for name, df in tables.items()]
    reports += [q.key_interval_report(load.spark, name, load.store.part_notes(name)) for name in schemas.FACTS]
    df, seen = observe_rows(q.combine(reports))
    load.store.append("dq_report", df, load.run_id)
    return seen.get


def report_rules(name: str) -> list[Rule]:
    """What the report counts row by row: the declared constraints and, of facts, keys that were looked up in vain."""
    keys = {"fact_policy": schemas.POLICY_KEYS, "fact_claim": schemas.CLAIM_KEYS}
    return [*schemas.constraints(name), *q.lookups_found(keys.get(name, ()))]


def _rule_report(load: Load, name: str, df: DataFrame) -> DataFrame:
    """From what was counted while the table was written; a table or a part without such notes is scanned."""
    rules = report_rules(name)
    if name in schemas.DIMENSIONS:
        noted = [load.store.notes(name)]
    else:
        noted = [n for run, n in load.store.part_notes(name).items() if load.options.full_report or run == load.run_id]
    counts = [(n or {}).get("violations", {}) for n in noted]
    if counts and all(rule.name in c for c in counts for rule in rules):
        return q.counted_report(load.spark, name, rules, counts)
    return q.rule_report(name, df.where("sk <> -1"), rules)


def build_master_geography(spark: SparkSession, provinces_csv: str, localities_csv: str, target_csv: str) -> DataFrame:
    """Build the master list from two delimited files, write it as CSV and return it."""
    from surestar.sources.feeds import read_csv_any_encoding, write_csv

    master = dims.master_geography(
        read_csv_any_encoding(spark, provinces_csv), read_csv_any_encoding(spark, localities_csv)
    )
    write_csv(master, target_csv)
    return master
