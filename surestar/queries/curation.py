"""The ten curations on dirty stand-ins: all rows, kept and rejected, with their reasons."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.operators.rules import KEPT, REASONS, ROW_JSON, rejected
from surestar.plans import curate
from surestar.queries import base as b
from surestar.queries.base import AS_OF, Query, run_sql, with_parts
from surestar.queries.standins import PARENTS, RAW, parent, raw
from surestar.sources.audit import step_counts


def _shown(marked: DataFrame) -> DataFrame:
    return marked.withColumn("reasons", F.array_join(REASONS, "|")).drop(ROW_JSON, REASONS, KEPT)


def _marked(spark: SparkSession, d: str, name: str) -> DataFrame:
    feed = raw(spark, d, name)
    parents = {
        "policies": ("known_clients", "known_agents"),
        "assessments": ("known_claims", "known_adjusters"),
        "payments": ("known_claims", "known_clients", "known_policies"),
        "claims": ("known_policies", "known_clients", "known_adjusters", "known_items"),
        "coverages": ("known_policies",),
        "fraud_indicators": ("known_claims",),
    }.get(name, ())
    known = [parent(spark, d, p) for p in parents]
    if name == "clients":
        return curate.clients(feed, AS_OF)
    return getattr(curate, name)(feed, *known)


def _curation(name: str):
    def run(spark: SparkSession, d: str) -> DataFrame:
        return _shown(_marked(spark, d, name))

    return run


def curate_fraud(spark: SparkSession, d: str) -> DataFrame:
    return curate.fraud_flags(_marked(spark, d, "fraud_indicators"))


GEOGRAPHY = """
SELECT DISTINCT lower(r_name) || ' ' AS provincia, n_name AS localidad
FROM {nation} JOIN {region} ON n_regionkey = r_regionkey WHERE n_nationkey % 6 <> 0
"""


def geo_check(spark: SparkSession, d: str) -> DataFrame:
    """Clients against a master list that lacks some places; blank places pass."""
    master = run_sql(spark, d, GEOGRAPHY)
    # One spelling of a province is declared an alias, as a user of the option would do.
    return _shown(curate.clients(raw(spark, d, "clients"), AS_OF, master, {"ASIA": ("ASIA.",)}))


def geo_fallback(spark: SparkSession, d: str) -> DataFrame:
    """Rejected by the country rule that stands in for the master list."""
    marked = curate.clients(raw(spark, d, "clients"), AS_OF)
    return marked.where(F.array_contains(REASONS, "foreign_country")).select("id_cliente", "pais")


def coverages_exact(spark: SparkSession, d: str) -> DataFrame:
    """Coverages with repeated rows counted once."""
    feed = run_sql(spark, d, REPEATED_COVERAGES)
    marked = curate.coverages(feed, parent(spark, d, "known_policies"), dedupe_exact=True)
    return _shown(marked)


REPEATED_COVERAGES = """
SELECT o_orderkey * 4 + copy AS _ordinal, 'O' || CAST(o_orderkey AS STRING) AS id_poliza,
       CASE WHEN o_orderkey % 8 = 3 THEN NULL ELSE 'Robo' END AS tipo_garantia,
       CASE WHEN copy < 2 THEN '100' ELSE '200' END AS suma_garantizada,
       CASE WHEN o_orderkey % 9 = 4 AND copy = 1 THEN 'no' WHEN copy = 0 THEN '1' ELSE 'True' END AS activa,
       CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS nota
FROM (SELECT *, 0 AS copy FROM {orders} UNION ALL SELECT *, 1 AS copy FROM {orders}
      UNION ALL SELECT *, 2 AS copy FROM {orders}) AS o
"""


def quarantine(spark: SparkSession, d: str) -> DataFrame:
    """Rejected claims: source, first and all reasons, and two fields taken back out of the stored JSON."""
    rows = rejected(_marked(spark, d, "claims"), "claims", "run-1")
    return rows.select(
        "source",
        "run_id",
        F.get_json_object("row_json", "$.id_parte").alias("id_parte"),
        F.get_json_object("row_json", "$.monto_reclamado").alias("monto_reclamado"),
        F.element_at("reasons", 1).alias("first_reason"),
        F.array_join("reasons", "|").alias("reasons"),
    )


def quarantine_fraud(spark: SparkSession, d: str) -> DataFrame:
    """Rejected fraud indicators are single raw rows, not rolled-up ones."""
    rows = rejected(_marked(spark, d, "fraud_indicators"), "fraud_indicators", "run-1")
    return rows.select(
        F.get_json_object("row_json", "$.id_parte").alias("id_parte"),
        F.get_json_object("row_json", "$.confirmado_fraude").alias("token"),
        F.array_join("reasons", "|").alias("reasons"),
    )


def step_audit(spark: SparkSession, d: str) -> DataFrame:
    steps = ["clients", "policies", "claims"]
    first, *others = [step_counts(name, _marked(spark, d, name)) for name in steps]
    for other in others:
        first = first.unionByName(other)
    return first


# The same in SQL. ``{name}_all`` holds every row of a feed with typed columns and reasons.


def _last(key: str, complete: str) -> str:
    return (
        f"NOT ({complete}) OR _ordinal = max(_ordinal) FILTER ({complete}) OVER (PARTITION BY {key})"
    )


def _feed(name: str, ids: Sequence[str], required: Sequence[str], key: str | None, more: str = "") -> str:
    """Feed with cleaned ids (``i_...``), the completeness of the key and whether it is the last of its key."""
    cleaned = ", ".join(f"{b.sql_reference(c)} AS i_{c}" for c in ids)
    complete = " AND ".join(f"{'i_' + c if c in ids else c} IS NOT NULL" for c in required)
    last = f", {_last('i_' + key, complete)} AS is_last" if key else ""
    return (
        f"SELECT *, {complete} AS complete{last} FROM (SELECT *, {cleaned}{more} FROM ({RAW[name]}) AS feed) AS keyed"
    )


def _client_columns(place: str) -> str:
    first, last = b.sql_canonical("nombre"), b.sql_canonical("apellido")
    return f"""i_id_cliente AS id_cliente, {first} AS nombre, {last} AS apellido,
       {b.sql_full_name(first, last)} AS nombre_completo, pais, {place}, birth AS fecha_nacimiento, age AS edad,
       {b.sql_sex('sexo')} AS sexo, {b.sql_employment('situacion_laboral')} AS situacion_laboral,
       {b.sql_segment('age')} AS segmento_persona"""


_BIRTH = f", {b.sql_date('fecha_nacimiento')} AS birth, (2026 - year({b.sql_date('fecha_nacimiento')}))::INT AS age"
_CLIENT_FEED = _feed("clients", ["id_cliente"], ["id_cliente"], "id_cliente", _BIRTH)
_KEY_RULES = (("missing_key", "complete"), ("superseded", "is_last"))
_AGE_RULE = ("age_out_of_range", "age BETWEEN 18 AND 100")


def _in(column: str, parents: str, key: str) -> str:
    return f"coalesce({column} IN (SELECT {key} FROM {parents} WHERE {key} IS NOT NULL), false)"


def _tolerant(column: str, parents: str, key: str) -> str:
    return f"{column} IS NULL OR {_in(column, parents, key)}"


SQL_PARTS = {
    **PARENTS,
    "clients_feed": _CLIENT_FEED,
    "clients_all": f"""SELECT {_client_columns('provincia, localidad')},
        {b.sql_reasons(*_KEY_RULES, ("foreign_country", "upper(trim(pais)) = 'ARGENTINA'"), _AGE_RULE)} AS reasons
        FROM clients_feed""",
    "agents_all": f"""SELECT i_id_agente AS id_agente, {b.sql_canonical('nombre')} AS nombre,
        {b.sql_canonical('apellido')} AS apellido, {b.sql_canonical('canal')} AS canal,
        {b.sql_canonical('sucursal')} AS sucursal, {b.sql_canonical('zona')} AS zona, {b.sql_canonical('email')} AS email,
        {b.sql_date('fecha_ingreso')} AS fecha_ingreso, upper(trim(activo)) AS activo,
        {b.sql_full_name(b.sql_canonical('nombre'), b.sql_canonical('apellido'))} AS nombre_completo,
        {b.sql_reasons(*_KEY_RULES, ("inactive", "upper(trim(activo)) IN ('TRUE', '1', 'SI', 'SÍ')"),
                       ("missing_hire_date", b.sql_date('fecha_ingreso') + " IS NOT NULL"),
                       ("unknown_channel", b.sql_canonical('canal') + " IN ('SUCURSAL', 'CALL CENTER', 'AGENTE', 'WEB')"))}
        AS reasons FROM ({_feed("agents", ["id_agente"], ["id_agente"], "id_agente")})""",
    "adjusters_all": f"""SELECT i_id_perito AS id_perito, {b.sql_canonical('nombre')} AS nombre,
        {b.sql_canonical('apellido')} AS apellido,
        {b.sql_full_name(b.sql_canonical('nombre'), b.sql_canonical('apellido'))} AS nombre_completo, zona_cobertura,
        {b.sql_reasons(*_KEY_RULES)} AS reasons
        FROM ({_feed("adjusters", ["id_perito"], ["id_perito"], "id_perito")})""",
    "policies_all": f"""SELECT i_id_poliza AS id_poliza, i_id_cliente AS id_cliente, i_id_agente AS id_agente,
        i_id_asegurado AS id_asegurado, i_id_objeto_asegurado AS id_objeto_asegurado,
        {b.sql_canonical('tipo_seguro')} AS tipo_seguro, {b.sql_canonical('cobertura')} AS cobertura,
        {b.sql_canonical('estado')} AS estado, {b.sql_date('fecha_alta')} AS fecha_alta,
        {b.sql_date('vigencia_desde')} AS vigencia_desde, {b.sql_number_or_0('prima_mensual')} AS prima_mensual,
        {b.sql_integer_or_0('numero_polizas_cliente')} AS numero_polizas_cliente,
        {b.sql_reasons(*_KEY_RULES, ("unknown_client", _in("i_id_cliente", "known_clients", "id_cliente")),
                       ("unknown_agent", _in("i_id_agente", "known_agents", "id_agente")))} AS reasons
        FROM ({_feed("policies", ["id_poliza", "id_cliente", "id_agente", "id_asegurado", "id_objeto_asegurado"],
                     ["id_poliza", "id_cliente"], "id_poliza")})""",
    "items_all": f"""SELECT i_id_objeto AS id_objeto, {b.sql_canonical('tipo_objeto')} AS tipo_objeto,
        {b.sql_canonical('descripcion')} AS descripcion, {b.sql_canonical('localidad')} AS localidad,
        {b.sql_canonical('provincia')} AS provincia, {b.sql_canonical('marca')} AS marca,
        {b.sql_number_or_0('valor_asegurado')} AS valor_asegurado,
        {b.sql_number_or_0('superficie_m2', 'DECIMAL(24,6)')} AS superficie_m2,
        {b.sql_reasons(*_KEY_RULES, ("value_too_large", f"try_cast({b.sql_number_or_0('valor_asegurado')} AS DECIMAL(12,2)) IS NOT NULL"))}
        AS reasons FROM ({_feed("items", ["id_objeto"], ["id_objeto"], "id_objeto")})""",
    "coverages_all": f"""SELECT i_id_poliza AS id_poliza,
        upper(substring({b.sql_trim('tipo_garantia')}, 1, 1)) || lower(substring({b.sql_trim('tipo_garantia')}, 2))
        AS tipo_garantia, {b.sql_number_or_0('suma_garantizada')} AS suma_garantizada,
        {b.sql_reasons(("inactive", b.sql_true("activa")), ("missing_key", "complete"),
                       ("unknown_policy", _tolerant("i_id_poliza", "known_policies", "id_poliza")),
                       ("sum_not_positive", b.sql_number_or_0("suma_garantizada") + " > 0"))} AS reasons
        FROM ({_feed("coverages", ["id_poliza"], ["id_poliza", "tipo_garantia", "suma_garantizada"], None)})""",
    "claims_all": f"""SELECT i_id_parte AS id_parte, i_id_poliza AS id_poliza, i_id_objeto_asegurado AS id_objeto_asegurado,
        i_id_perito AS id_perito, i_id_denunciante AS id_denunciante, i_id_receptor_pago AS id_receptor_pago,
        opened AS fecha_apertura, closed AS fecha_cierre, claimed AS monto_reclamado,
        {b.sql_integer_or_0('dias_resolucion')} AS dias_resolucion, {b.sql_canonical('tipo_siniestro')} AS tipo_siniestro,
        {b.sql_canonical('estado')} AS estado, _raw_id, _raw_amount,
        {b.sql_reasons(*_KEY_RULES, ("missing_open_date", "opened IS NOT NULL"),
                       ("closed_before_open", "closed IS NULL OR opened IS NULL OR closed >= opened"),
                       ("negative_amount", "claimed >= 0"), ("negative_days", b.sql_integer_or_0("dias_resolucion") + " >= 0"),
                       ("unknown_policy", _tolerant("i_id_poliza", "known_policies", "id_poliza")),
                       ("unknown_reporter", _tolerant("i_id_denunciante", "known_clients", "id_cliente")),
                       ("unknown_payee", _tolerant("i_id_receptor_pago", "known_clients", "id_cliente")),
                       ("unknown_adjuster", _tolerant("i_id_perito", "known_adjusters", "id_perito")),
                       ("unknown_item", _tolerant("i_id_objeto_asegurado", "known_items", "id_objeto")))} AS reasons
        FROM ({_feed("claims", ["id_parte", "id_poliza", "id_objeto_asegurado", "id_perito", "id_denunciante",
                                "id_receptor_pago"], ["id_parte", "id_poliza"], "id_parte",
                     f", {b.sql_date('fecha_apertura')} AS opened, {b.sql_date('fecha_cierre')} AS closed, "
                     f"{b.sql_number_or_0('monto_reclamado')} AS claimed, id_parte AS _raw_id, "
                     "monto_reclamado AS _raw_amount")})""",
    "assessments_all": f"""SELECT i_id_evaluacion AS id_evaluacion, i_id_parte AS id_parte, i_id_perito AS id_perito,
        {b.sql_date('fecha_visita')} AS fecha_visita, {b.sql_number_or_0('monto_estimado_dano')} AS monto_estimado_dano,
        {b.sql_canonical('dictamen')} AS dictamen,
        CASE WHEN lower(requiere_reinspeccion) = 'true' THEN true WHEN lower(requiere_reinspeccion) = 'false' THEN false END
        AS requiere_reinspeccion,
        {b.sql_reasons(*_KEY_RULES, ("unknown_claim", _in("i_id_parte", "known_claims", "id_parte")),
                       ("unknown_adjuster", _in("i_id_perito", "known_adjusters", "id_perito")))} AS reasons
        FROM ({_feed("assessments", ["id_evaluacion", "id_parte", "id_perito"],
                     ["id_evaluacion", "id_parte", "id_perito"], "id_evaluacion")})""",
    "payments_all": f"""SELECT i_id_pago AS id_pago, i_id_parte AS id_parte, i_id_receptor AS id_receptor,
        {b.sql_number_or_0('monto_pagado')} AS monto_pagado, {b.sql_date('fecha_pago')} AS fecha_pago,
        {b.sql_reasons(*_KEY_RULES, ("unknown_claim", _in("i_id_parte", "known_claims", "id_parte")),
                       ("payee_not_client", _in("i_id_receptor", "known_clients", "id_cliente")),
                       ("payee_not_insured", _in("i_id_receptor", "known_policies", "id_asegurado")))} AS reasons
        FROM ({_feed("payments", ["id_pago", "id_parte", "id_receptor"], ["id_pago", "id_parte", "id_receptor"],
                     "id_pago")})""",
    "fraud_all": f"""SELECT i_id_parte AS id_parte, {b.sql_true('confirmado_fraude')} AS confirmed,
        id_parte AS _raw_id, confirmado_fraude AS _token,
        {b.sql_reasons(("missing_key", "complete"), ("unknown_claim", _in("i_id_parte", "known_claims", "id_parte")))}
        AS reasons FROM ({_feed("fraud_indicators", ["id_parte"], ["id_parte"], None)})""",
}


def _sql(body: str) -> str:
    """The query with the parts it needs in front."""
    needed: list[str] = []

    def add(text: str) -> None:
        for name, part in SQL_PARTS.items():
            if name in text and name not in needed:
                add(part)
                if name not in needed:
                    needed.append(name)

    add(body)
    return with_parts(body, {name: SQL_PARTS[name] for name in needed})


_GEO = f"""
WITH {', '.join(['clients_feed AS (' + b.plain(_CLIENT_FEED) + ')',
                 'master AS (SELECT DISTINCT upper(trim(provincia)) AS p, upper(localidad) AS l FROM ('
                 + b.plain(GEOGRAPHY) + '))'])},
placed AS (
    SELECT *, coalesce({b.sql_id('provincia')}, '') = '' OR coalesce({b.sql_id('localidad')}, '') = '' AS no_place,
           CASE WHEN {b.sql_canonical('provincia')} = 'ASIA.' THEN 'ASIA' ELSE {b.sql_canonical('provincia')} END AS cp,
           {b.sql_canonical('localidad')} AS cl
    FROM clients_feed)
SELECT {_client_columns('CASE WHEN no_place THEN provincia ELSE cp END AS provincia, '
                        'CASE WHEN no_place THEN localidad ELSE cl END AS localidad')},
       {b.sql_reasons(*_KEY_RULES, ("unknown_location", "no_place OR (cp, cl) IN (SELECT (p, l) FROM master)"), _AGE_RULE)}
       AS reasons
FROM placed
"""

_EXACT = f"""
SELECT i_id_poliza AS id_poliza,
       upper(substring(tipo_garantia, 1, 1)) || lower(substring(tipo_garantia, 2)) AS tipo_garantia,
       {b.sql_number_or_0('suma_garantizada')} AS suma_garantizada, nota,
       {b.sql_reasons(("inactive", "active"), ("missing_key", "complete"),
                      ("exact_duplicate", "NOT (active AND complete) OR is_last"),
                      ("unknown_policy", _tolerant("i_id_poliza", "known_policies", "id_poliza")),
                      ("sum_not_positive", b.sql_number_or_0("suma_garantizada") + " > 0"))} AS reasons
FROM (SELECT *, _ordinal = max(_ordinal) FILTER (active AND complete)
             OVER (PARTITION BY id_poliza, tipo_garantia, suma_garantizada, nota) AS is_last
      FROM (SELECT *, id_poliza AS i_id_poliza, {b.sql_true('activa')} AS active,
                   tipo_garantia IS NOT NULL AND suma_garantizada IS NOT NULL AS complete
            FROM ({b.plain(REPEATED_COVERAGES)})))
"""

QUERIES = {
    **{
        f"curate_{name}": Query(_curation(name), _sql(f"SELECT * FROM {name}_all"))
        for name in ("clients", "agents", "adjusters", "policies", "items", "coverages", "assessments", "payments")
    },
    "curate_claims": Query(_curation("claims"), _sql("SELECT * EXCLUDE (_raw_id, _raw_amount) FROM claims_all")),
    "curate_fraud": Query(
        curate_fraud,
        _sql("SELECT id_parte, bool_or(confirmed) AS fraude_flag FROM fraud_all WHERE reasons = '' GROUP BY id_parte"),
    ),
    "curate_coverages_exact": Query(coverages_exact, _sql(_EXACT)),
    "geo_check": Query(geo_check, _GEO),
    "geo_fallback": Query(
        geo_fallback, _sql("SELECT id_cliente, pais FROM clients_all WHERE contains(reasons, 'foreign_country')")
    ),
    "quarantine": Query(
        quarantine,
        _sql("""SELECT 'claims' AS source, 'run-1' AS run_id, _raw_id AS id_parte, _raw_amount AS monto_reclamado,
                       split_part(reasons, '|', 1) AS first_reason, reasons
                FROM claims_all WHERE reasons <> ''"""),
    ),
    "quarantine_fraud": Query(
        quarantine_fraud,
        _sql("SELECT _raw_id AS id_parte, _token AS token, reasons FROM fraud_all WHERE reasons <> ''"),
    ),
    "step_audit": Query(
        step_audit,
        _sql(" UNION ALL ".join(
            f"SELECT '{name}' AS step, count(*) AS rows_in, count_if(reasons = '')::BIGINT AS rows_out, "
            f"count_if(reasons <> '')::BIGINT AS rows_rejected FROM {name}_all"
            for name in ("clients", "policies", "claims")
        )),
    ),
}
