"""The whole job on invented feeds: first load, repeated load, changed load, missing feeds."""

import dataclasses
import datetime as dt
import json
from decimal import Decimal

import pytest

from surestar import schemas
from surestar.operators.rules import REASONS, kept
from surestar.plans import curate
from surestar.plans.full_load import Options, full_load
from surestar.sources.feeds import read_feed
from surestar.sources.store import Store
from tests.feeds import FEEDS, write_feeds

DAY_1, DAY_2 = dt.date(2026, 6, 30), dt.date(2026, 7, 1)

# A client moves, a policy comes with a new client, an item is worth more.
CHANGES = {
    "clientes.csv": [
        ["C1", "José", "Pérez", "Argentina", "Salta", "Salta", "1990-05-01", "Varón", "Self-Employed"],
        ["C20", "Neu", "Neu", "Argentina", "Mendoza", "Maipú", "1970-01-01", "F", "Employed"],
    ],
    "objetos_asegurados.csv": [["O1", "auto", "Peugeot 208", "Villa María", "Córdoba", "", "", "16000", "", "", "", ""]],
    "polizas.csv": [
        ["P20", "C20", "A2", "C20", "O1", "Hogar", "Premium", "x", "Web", "Activa", "2022-02-02", "", "", "10", "", "", "", ""]
    ],
    "garantias.csv": [["P20", "robo", "70", "1"]],
    "partes_accidente.csv": [
        ["E20", "P20", "O1", "S2", "C20", "C20", "2022-03-01", "", "5", "1", "Inundación", "abierto", "hogar"]
    ],
}


@pytest.fixture(scope="module")
def loaded(spark, tmp_path_factory):
    """Three runs into one warehouse: load, the same again, changed feeds."""
    root = tmp_path_factory.mktemp("load")
    warehouse = str(root / "warehouse")
    feeds = write_feeds(root / "feeds")
    states, audits = {}, {}
    runs = [("r1", feeds, DAY_1), ("r2", feeds, DAY_1), ("r3", write_feeds(root / "feeds2", CHANGES), DAY_2)]
    for run_id, folder, day in runs:
        audits[run_id] = {row["step"]: row for row in full_load(spark, folder, warehouse, day, run_id).collect()}
        store = Store(spark, warehouse)
        tables = {name: store.read(name) for name in schemas.DIMENSIONS}
        tables |= {name: store.read_appended(name) for name in schemas.FACTS}
        states[run_id] = {name: [row.asDict() for row in df.collect()] for name, df in tables.items()}
    return states, audits, Store(spark, warehouse)


def by(rows, key):
    return {row[key]: row for row in rows}


def test_steps(loaded):
    _, audits, _ = loaded
    first = audits["r1"]
    assert first["ingest auto"]["status"] == "SKIPPED"
    assert {row["status"] for step, row in first.items() if step not in ("ingest auto", "full load")} == {"OK"}, first
    assert first["full load"]["status"] == "OK", "no step reads the feed that did not come"
    clients = first["curate clients"]
    assert (clients["rows_in"], clients["rows_out"], clients["rows_rejected"]) == (11, 4, 7)
    for name, rows_in, kept_rows in [
        ("agents", 5, 2), ("adjusters", 3, 2), ("policies", 8, 5), ("items", 3, 3), ("claims", 12, 3),
        ("assessments", 5, 2), ("payments", 5, 3), ("coverages", 11, 6), ("fraud_indicators", 5, 3),
    ]:
        row = first[f"curate {name}"]
        assert (name, row["rows_in"], row["rows_out"]) == (name, rows_in, kept_rows)
        assert row["rows_in"] == row["rows_out"] + row["rows_rejected"]


def test_quarantine(loaded):
    _, _, store = loaded
    rows = [r for r in store.read_appended("quarantine").collect() if r["run_id"] == "r1"]
    found = {(r["source"], json.loads(r["row_json"]).get(key)): r["reasons"] for r in rows for key in (
        {"clients": "id_cliente", "agents": "id_agente", "policies": "id_poliza", "claims": "id_parte",
         "payments": "id_pago", "assessments": "id_evaluacion", "fact_policy": "policy_id"}.get(r["source"], "id_poliza"),)}
    assert found[("clients", "C1")] == ["superseded"]
    assert found[("clients", "C4")] == ["age_out_of_range"]
    assert found[("clients", "C5")] == ["age_out_of_range"]
    assert found[("clients", "C6")] == ["foreign_country"]
    assert found[("clients", "C7")] == ["age_out_of_range"]
    assert found[("clients", None)][0] == "missing_key" and found[("clients", "   ")][0] == "missing_key"
    assert found[("agents", "A3")] == ["inactive"]
    assert found[("agents", "A4")] == ["missing_hire_date"]
    assert found[("agents", "A5")] == ["unknown_channel"]
    assert found[("policies", "P4")] == ["unknown_client"]
    assert found[("policies", "P5")] == ["unknown_agent"]
    assert found[("claims", "E3")] == ["closed_before_open"]
    assert found[("claims", "E4")] == ["missing_open_date"]
    assert found[("claims", "E5")] == ["negative_amount"]
    assert found[("claims", "E6")] == ["negative_days"]
    assert found[("claims", "E7")] == ["unknown_policy"]
    assert found[("claims", "E8")] == ["unknown_reporter", "unknown_payee", "unknown_adjuster", "unknown_item"]
    assert found[("claims", "E9")] == ["missing_key"]
    assert found[("payments", "G3")] == ["payee_not_client", "payee_not_insured"]
    assert found[("payments", "G4")] == ["unknown_claim"]
    assert found[("assessments", "V4")] == ["unknown_adjuster"]
    # A premium that is no number becomes 0 and breaks the declared check; no coverage means no insured sum.
    assert "premium > 0" in found[("fact_policy", "P6")]
    assert found[("fact_policy", "P7")] == ["insured_sum not null"]


def test_first_load(loaded):
    tables = loaded[0]["r1"]
    assert {(r["country"], r["province"], r["city"]) for r in tables["dim_location"]} == {
        ("Argentina", "Córdoba", "Villa María"), ("Argentina", "Cordoba", "Villa Maria"), ("Argentina", "Salta", "Salta"),
        ("Argentina", "Santa Fe", "Rosario"), ("N/A", "Desconocido", "Desconocido"),
    }
    people = by(tables["dim_person"], "person_id")
    assert set(people) == {"C1", "C2", "C3", "C8", "N/A"}
    assert (people["C1"]["occupation"], people["C1"]["segment"], people["C1"]["sex"]) == ("Empleado", "Adulto", "M")
    assert people["C3"]["location_sk"] is None and people["C3"]["sex"] == "O"
    assert people["C2"]["segment"] == "Mayor" and people["C8"]["segment"] == "Joven"
    assert {r["plan_category"] for r in tables["dim_plan"]} == {"Basico", "Estandar", "Premium", "Desconocido"}
    assert {r["claim_type"] for r in tables["dim_claim_type"]} == {"COLISION", "ROBO", "Desconocido"}
    assert len(tables["dim_date"]) == 8035 + 1
    policies = by(tables["fact_policy"], "policy_id")
    assert set(policies) == {"P1", "P2", "P3"}
    p1 = policies["P1"]
    # A repeated coverage row counts twice.
    assert (p1["premium"], p1["insured_sum"]) == (Decimal("120.50"), Decimal("2500.25"))
    assert p1["holder_sk"] == people["C1"]["sk"] == p1["insured_sk"] and p1["location_sk"] > 0 and p1["plan_sk"] > 0
    assert by(tables["dim_date"], "sk")[p1["sale_date_sk"]]["date_id"] == 20200229
    p2, p3 = policies["P2"], policies["P3"]
    assert p2["insured_sk"] == -1 and p2["sale_date_sk"] == -1 and p2["location_sk"] == -1 and p2["item_sk"] > 0
    assert p3["plan_sk"] == -1 and p3["item_sk"] == -1 and p3["premium"] == Decimal("75.01")
    claims = by(tables["fact_claim"], "claim_id")
    assert set(claims) == {"E1", "E2", "E1b"}
    e1, e2 = claims["E1"], claims["E2"]
    assert (e1["claimed"], e1["assessed"], e1["paid"]) == (Decimal("900.00"), Decimal("500.00"), Decimal("2600.30"))
    assert e1["is_fraud"] and not e2["is_fraud"] and e1["policy_sk"] == p1["sk"]
    assert e2["claimed"] == 0 and e2["close_date_sk"] is None and e2["payee_sk"] == -1 and e2["adjuster_sk"] == -1
    # Its policy did not get into the fact table.
    assert claims["E1b"]["policy_sk"] == -1


def test_reports(loaded):
    _, _, store = loaded
    overpaid = store.read_appended("overpaid_claims").collect()
    assert {r["claim_id"] for r in overpaid if r["paid"] > r["insured_sum"]} == {"E1"}
    report = store.read_appended("dq_report").collect()
    orphans = {r["rule"]: r["violations"] for r in report if "->" in r["rule"] and r["violations"]}
    assert set(orphans) == {"fact_claim.policy_sk->fact_policy exists"}
    assert all(r["violations"] == 0 for r in report if r["rule"].endswith(" unique"))


def test_second_load_changes_nothing(loaded):
    states, audits, _ = loaded
    for name, rows in states["r1"].items():
        assert sorted(map(str, rows)) == sorted(map(str, states["r2"][name])), name
    assert audits["r2"]["load fact_policy"]["rows_out"] == 0


def test_changed_load(loaded):
    states, _, _ = loaded
    before, after = states["r2"], states["r3"]
    versions = sorted((r for r in after["dim_person"] if r["person_id"] == "C1"), key=lambda r: r["sk"])
    assert [r["is_current"] for r in versions] == [False, True]
    assert versions[0]["valid_to"] == versions[1]["valid_from"] == DAY_2 and versions[1]["valid_to"] is None
    assert versions[0]["location_sk"] != versions[1]["location_sk"]
    for rows in (after["dim_person"],):
        current = [r["person_id"] for r in rows if r["is_current"]]
        assert len(current) == len(set(current))
    assert by(after["dim_item"], "item_id")["O1"]["item_value"] == Decimal("16000.00")
    assert by(after["dim_item"], "item_id")["O1"]["sk"] == by(before["dim_item"], "item_id")["O1"]["sk"]
    # Old members and facts keep their keys, new ones go on after the highest.
    for name, key in (("dim_location", "city"), ("dim_claim_type", "claim_type"), ("fact_policy", "policy_id")):
        old = {r["sk"] for r in before[name]}
        new = {r["sk"] for r in after[name]}
        assert old <= new
        assert sorted(k for k in new if k > 0) == list(range(1, len([k for k in new if k > 0]) + 1))
    for row in before["fact_policy"]:
        assert row in after["fact_policy"]
    claims = by(after["fact_claim"], "claim_id")
    assert claims["E20"]["policy_sk"] == by(after["fact_policy"], "policy_id")["P20"]["sk"]
    # Facts point at the first version of a person.
    assert claims["E1"]["payee_sk"] == versions[0]["sk"]


def load(spark, root, runs, **options):
    """Full loads into one warehouse and the tables after each."""
    store, states = Store(spark, str(root / "wh")), []
    for i, (run_id, changes, day) in enumerate(runs):
        audit = full_load(spark, write_feeds(root / f"feeds{i}", changes), str(root / "wh"), day, run_id, **options)
        tables = {n: store.read_appended(n, s).collect() for n, s in schemas.FACTS.items()}
        states.append((tables, {r["step"]: r for r in audit.collect()}))
    return store, states


def test_repeating_an_earlier_run_keeps_its_keys(spark, tmp_path):
    claim = {**CHANGES, "partes_accidente.csv": [["E21", "P1", "O1", "S2", "C1", "C1", "2022-03-01", "", "5", "1", "Robo", "abierto", "hogar"]]}
    store, states = load(spark, tmp_path, [("r1", None, DAY_1), ("r2", claim, DAY_2), ("r1", None, DAY_2)])
    first, second, third = (by(s[0]["fact_policy"], "policy_id") for s in states)
    assert {k: r["sk"] for k, r in third.items()} == {k: r["sk"] for k, r in second.items()}
    assert {k: r["sk"] for k, r in first.items()}.items() <= {k: r["sk"] for k, r in third.items()}.items()
    claims = by(states[2][0]["fact_claim"], "claim_id")
    assert {k: r["sk"] for k, r in claims.items()} == {r["claim_id"]: r["sk"] for r in states[1][0]["fact_claim"]}
    assert claims["E21"]["policy_sk"] == third["P1"]["sk"]
    orphans = {r["rule"] for r in store.read_appended("dq_report").collect() if "->" in r["rule"] and r["violations"]}
    assert orphans == {"fact_claim.policy_sk->fact_policy exists"}, "only the claim without a loaded policy"
    assert states[1][1]["load fact_policy"]["status"] == "OK"


def test_a_failed_fact_step_adds_no_old_rejects(spark, tmp_path, monkeypatch):
    store, states = load(spark, tmp_path, [("r1", None, DAY_1)])

    def fail(*args, **more):
        raise RuntimeError("x" * 5000)

    from surestar.plans import facts

    monkeypatch.setattr(facts, "fact_policy", fail)
    _, states = load(spark, tmp_path / "again", [], **{})
    audit = full_load(spark, write_feeds(tmp_path / "more"), str(tmp_path / "wh"), DAY_1, "r2")
    steps = {r["step"]: r for r in audit.collect()}
    assert steps["load fact_policy"]["status"] == "ERROR" and len(steps["load fact_policy"]["message"]) > 5000
    rejects = store.read_appended("quarantine").where("source like 'fact_policy'").groupBy("run_id").count().collect()
    assert {r["run_id"] for r in rejects} == {"r1"}


def test_feeds_say_how_they_are_written(spark, tmp_path):
    folder = tmp_path / "feeds"
    write_feeds(folder)
    text = (folder / "clientes.csv").read_text(encoding="utf-8").replace("1990-05-01", "01/05/1990")
    (folder / "clientes.csv").write_bytes(text.encode("latin-1"))
    feeds = [dataclasses.replace(s, encoding="ISO-8859-1", date_formats=("dd/MM/yyyy", "yyyy-MM-dd")) if s.name == "clients" else s for s in schemas.FEEDS]
    audit = full_load(spark, str(folder), str(tmp_path / "wh"), DAY_1, "r1", feeds=feeds)
    notes = {r["step"]: r["message"] for r in audit.collect()}
    store = Store(spark, str(tmp_path / "wh"))
    rows = by(store.read("curated_clients").where("_kept").collect(), "id_cliente")
    assert rows["C1"]["fecha_nacimiento"] == dt.date(1990, 5, 1)
    assert "PEREZ" in rows["C1"]["nombre_completo"] or "PÉREZ" in rows["C1"]["nombre_completo"]
    assert "prima_mensual: no number: 1" in notes["ingest policies"]
    (folder / "clientes.csv").unlink()
    audit = full_load(spark, str(folder), str(tmp_path / "wh"), DAY_1, "r2", feeds=feeds)
    assert "earlier run" in {r["step"]: r["message"] for r in audit.collect()}["curate clients"]


def test_options_of_a_load(spark, tmp_path):
    moved = {"clientes.csv": CHANGES["clientes.csv"], "polizas.csv": CHANGES["polizas.csv"], "garantias.csv": CHANGES["garantias.csv"]}
    options = Options(dedupe_exact=True, person_version="current", items_need_policy=True, amount_order=True, full_report=True)
    later = {**moved, "polizas.csv": [["P30", "C1", "A2", "C1", "O1", "Hogar", "Premium", "x", "Web", "Activa", "2022-02-02", "", "", "10", "", "", "", ""]],
             "garantias.csv": [["P30", "robo", "70", "1"]]}
    store, states = load(spark, tmp_path, [("r1", None, DAY_1), ("r2", later, DAY_2)], options=options)
    policies = by(states[0][0]["fact_policy"], "policy_id")
    assert policies["P1"]["insured_sum"] < Decimal("2500.25"), "a repeated coverage row counts once"
    current = {r["person_id"]: r["sk"] for r in store.read("dim_person").where("is_current").collect()}
    assert by(states[1][0]["fact_policy"], "policy_id")["P30"]["holder_sk"] == current["C1"]
    rejected = store.read_appended("quarantine").where("array_contains(reasons, 'claimed >= assessed >= paid >= 0')")
    assert rejected.count() > 0


def test_missing_feeds_skip_their_dependants(spark, tmp_path):
    folder = tmp_path / "feeds"
    write_feeds(folder)
    (folder / "clientes.csv").unlink()
    (folder / "peritos.csv").write_text("id_perito,nombre\nS1,x\n")
    audit = {r["step"]: r for r in full_load(spark, str(folder), str(tmp_path / "wh"), DAY_1, "r1").collect()}
    assert audit["curate clients"]["status"] == "SKIPPED" and "raw_clients" in audit["curate clients"]["message"]
    assert audit["ingest adjusters"]["status"] == "ERROR" and "apellido" in audit["ingest adjusters"]["message"]
    assert audit["load dim_agent"]["status"] == "OK" and audit["load fact_policy"]["status"] == "SKIPPED"
    assert audit["full load"]["status"] == "ERROR"


def test_repeating_a_run_replaces_its_part(spark, tmp_path):
    store = Store(spark, str(tmp_path))
    store.append("t", spark.range(3), "a")
    store.append("t", spark.range(5), "a")
    store.append("t", spark.range(2), "b")
    assert store.read_appended("t").count() == 7 and store.read_appended("t", before="a").count() == 2
    store.replace("s", spark.range(3))
    again = store.replace("s", store.read("s").union(spark.range(1)))
    assert again.count() == 4 == store.read("s").count()
    with pytest.raises(FileNotFoundError):
        store.read("nothing")
    assert store.read("nothing", "a int").count() == 0


def test_shipped_shapes_of_counts(spark, tmp_path):
    """Kept and rejected rows add up for every feed, whatever the order of files on disk."""
    write_feeds(tmp_path)
    spec = next(s for s in schemas.FEEDS if s.name == "clients")
    raw = read_feed(spark, str(tmp_path), spec)
    marked = curate.clients(raw, DAY_1)
    assert marked.count() == len(FEEDS["clientes.csv"][1])
    assert kept(marked).count() + marked.where(f"size({REASONS}) > 0").count() == marked.count()
