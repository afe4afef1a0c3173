"""Feeds, warehouse tables and their declared constraints."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from surestar.functions.classify import PLAN_LEVELS, SEGMENTS
from surestar.operators import quality as q
from surestar.operators.quality import ForeignKey


@dataclass(frozen=True)
class FeedSpec:
    """A delimited extract: logical name, file name, the columns the jobs need or may use, and how it is written."""

    name: str
    file: str
    required: tuple[str, ...] = ()
    optional: tuple[str, ...] = ()
    encoding: str | None = None  # without one it is found out: UTF-8, or Latin-1 if some row is not
    date_formats: tuple[str, ...] | None = None  # Spark patterns; without them ISO texts are read
    multi_line: bool = False  # cells may hold line breaks; such a file is read by one task


# File and column names of the twelve extracts.
FEEDS = (
    FeedSpec(
        "clients", "clientes.csv",
        ("id_cliente", "nombre", "apellido", "pais", "provincia", "localidad", "fecha_nacimiento", "sexo",
         "situacion_laboral"),
    ),
    FeedSpec(
        "agents", "agentes.csv",
        ("id_agente", "nombre", "apellido", "canal", "fecha_ingreso", "activo"),
        ("sucursal", "zona", "email"),
    ),
    FeedSpec(
        "adjusters", "peritos.csv",
        ("id_perito", "nombre", "apellido", "zona_cobertura"),
        ("especialidad", "matricula", "activo", "fecha_ingreso", "email"),
    ),
    FeedSpec(
        "policies", "polizas.csv",
        ("id_poliza", "id_cliente", "id_agente", "id_asegurado", "id_objeto_asegurado", "cobertura", "fecha_alta",
         "prima_mensual"),
        ("tipo_seguro", "tipo_poliza", "canal_venta", "estado", "vigencia_desde", "vigencia_hasta", "prima_total",
         "customer_lifetime_value", "numero_polizas_cliente", "meses_desde_inicio"),
    ),
    FeedSpec(
        "items", "objetos_asegurados.csv",
        ("id_objeto", "tipo_objeto", "localidad", "provincia", "valor_asegurado"),
        ("descripcion", "marca", "modelo", "valor_inmueble", "superficie_m2", "año_fabricacion", "año_construccion"),
    ),
    FeedSpec("fraud_indicators", "indicadores_fraude.csv", ("id_parte", "confirmado_fraude")),
    FeedSpec("health", "HealthInsurance.csv"),
    FeedSpec("coverages", "garantias.csv", ("id_poliza", "tipo_garantia", "suma_garantizada", "activa")),
    FeedSpec(
        "claims", "partes_accidente.csv",
        ("id_parte", "id_poliza", "id_objeto_asegurado", "id_perito", "id_denunciante", "id_receptor_pago",
         "fecha_apertura", "fecha_cierre", "monto_reclamado", "dias_resolucion", "tipo_siniestro"),
        ("estado", "tipo_seguro"),
    ),
    FeedSpec("auto", "AutoInsurance.csv"),
    FeedSpec(
        "assessments", "evaluaciones_perito.csv",
        ("id_evaluacion", "id_parte", "id_perito", "fecha_visita", "monto_estimado_dano", "requiere_reinspeccion"),
        ("dictamen",),
    ),
    FeedSpec("payments", "pagos_siniestro.csv", ("id_pago", "id_parte", "id_receptor", "monto_pagado", "fecha_pago")),
)

# Calendar range of the date dimension.
CALENDAR_START = dt.date(2005, 1, 1)
CALENDAR_END = dt.date(2026, 12, 31)

# Country of every insured item.
ITEM_COUNTRY = "Argentina"

DIMENSIONS = {
    "dim_location": "sk bigint, country string, province string, city string",
    "dim_person": (
        "sk bigint, person_id string, location_sk bigint, occupation string, segment string, sex string, "
        "valid_from date, valid_to date, is_current boolean, is_third_party boolean"
    ),
    "dim_item": "sk bigint, item_id string, item_type string, item_value decimal(12,2)",
    "dim_agent": "sk bigint, agent_id string, agent_name string",
    "dim_plan": "sk bigint, plan_category string",
    "dim_date": "sk bigint, date_id int, day int, month int, year int",
    "dim_adjuster": "sk bigint, adjuster_id string, adjuster_name string",
    "dim_claim_type": "sk bigint, claim_type string",
}

FACTS = {
    "fact_policy": (
        "sk bigint, policy_id string, holder_sk bigint, insured_sk bigint, sale_date_sk bigint, item_sk bigint, "
        "agent_sk bigint, plan_sk bigint, location_sk bigint, premium decimal(12,2), insured_sum decimal(12,2)"
    ),
    "fact_claim": (
        "sk bigint, claim_id string, policy_sk bigint, open_date_sk bigint, close_date_sk bigint, payee_sk bigint, "
        "adjuster_sk bigint, claim_type_sk bigint, location_sk bigint, is_fraud boolean, claimed decimal(12,2), "
        "assessed decimal(12,2), paid decimal(12,2)"
    ),
}

QUARANTINE = "source string, reasons array<string>, row_json string, run_id string"
AUDIT = (
    "started timestamp, ended timestamp, step string, rows_in bigint, rows_out bigint, rows_rejected bigint, "
    "status string, message string"
)

# Members with key -1.
UNKNOWN_MEMBERS = {
    "dim_agent": {"agent_id": "N/A", "agent_name": "Desconocido"},
    "dim_date": {"date_id": -1, "day": -1, "month": -1, "year": -1},
    "dim_adjuster": {"adjuster_id": "N/A", "adjuster_name": "Desconocido"},
    "dim_item": {"item_id": "N/A", "item_type": "Desconocido", "item_value": 0},
    "dim_plan": {"plan_category": "Desconocido"},
    "dim_claim_type": {"claim_type": "Desconocido"},
    "dim_location": {"country": "N/A", "province": "Desconocido", "city": "Desconocido"},
    "dim_person": {
        "person_id": "N/A", "occupation": "Desconocido", "segment": "Desconocido", "sex": "O", "location_sk": -1,
        "is_third_party": False, "valid_from": dt.date(1900, 1, 1), "valid_to": None, "is_current": True,
    },
}

FOREIGN_KEYS = (
    ForeignKey("dim_person", "location_sk", "dim_location", "sk"),
    ForeignKey("fact_policy", "holder_sk", "dim_person", "sk"),
    ForeignKey("fact_policy", "insured_sk", "dim_person", "sk"),
    ForeignKey("fact_policy", "sale_date_sk", "dim_date", "sk"),
    ForeignKey("fact_policy", "item_sk", "dim_item", "sk"),
    ForeignKey("fact_policy", "agent_sk", "dim_agent", "sk"),
    ForeignKey("fact_policy", "plan_sk", "dim_plan", "sk"),
    ForeignKey("fact_policy", "location_sk", "dim_location", "sk"),
    ForeignKey("fact_claim", "policy_sk", "fact_policy", "sk"),
    ForeignKey("fact_claim", "open_date_sk", "dim_date", "sk"),
    ForeignKey("fact_claim", "close_date_sk", "dim_date", "sk"),
    ForeignKey("fact_claim", "payee_sk", "dim_person", "sk"),
    ForeignKey("fact_claim", "adjuster_sk", "dim_adjuster", "sk"),
    ForeignKey("fact_claim", "claim_type_sk", "dim_claim_type", "sk"),
    ForeignKey("fact_claim", "location_sk", "dim_location", "sk"),
)

POLICY_KEYS = ("holder_sk", "insured_sk", "sale_date_sk", "item_sk", "agent_sk", "plan_sk", "location_sk")
CLAIM_KEYS = ("policy_sk", "open_date_sk", "payee_sk", "adjuster_sk", "claim_type_sk", "location_sk")


def constraints(table: str, amount_order: bool = False) -> list:
    """Declared NOT NULL, CHECK, domain and length rules of a table.

    ``amount_order`` adds the optional rule claimed >= assessed >= paid >= 0.
    """
    rules = {
        "dim_location": [q.max_length(c, 100) for c in ("country", "province", "city")],
        "dim_person": [
            q.max_length("person_id", 20), q.max_length("occupation", 40), q.not_null("segment"), q.not_null("sex"),
            q.in_domain("segment", SEGMENTS), q.in_domain("sex", ("M", "F", "O")), q.max_length("sex", 1),
            q.not_null("valid_from"),
        ],
        "dim_item": [q.max_length("item_id", 20), q.max_length("item_type", 50), q.fits_money("item_value")],
        "dim_agent": [q.max_length("agent_id", 20), q.max_length("agent_name", 100)],
        "dim_plan": [q.not_null("plan_category"), q.in_domain("plan_category", tuple(PLAN_LEVELS))],
        "dim_date": [q.in_range("day", 1, 31), q.in_range("month", 1, 12), q.in_range("year", 2000, 2100)],
        "dim_adjuster": [q.max_length("adjuster_id", 20), q.max_length("adjuster_name", 100)],
        "dim_claim_type": [q.max_length("claim_type", 100)],
        "fact_policy": [
            *[q.not_null(c) for c in (*POLICY_KEYS, "premium", "insured_sum")],
            q.max_length("policy_id", 20), q.positive("premium"), q.positive("insured_sum"),
            q.fits_money("premium"), q.fits_money("insured_sum"),
        ],
        "fact_claim": [
            *[q.not_null(c) for c in (*CLAIM_KEYS, "claimed", "assessed", "paid")],
            q.max_length("claim_id", 20),
            *[q.fits_money(c) for c in ("claimed", "assessed", "paid")],
        ],
    }[table]
    if table == "fact_claim" and amount_order:
        rules = [*rules, q.descending(("claimed", "assessed", "paid"))]
    return rules
