"""The whole star on the stand-ins: dimensions, both facts, the incremental load and the flagship report."""

from __future__ import annotations

import datetime as dt
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.operators import scd
from surestar.operators.keys import keys_in_order, max_key
from surestar.operators.refint import anti
from surestar.plans import dims, facts
from surestar.queries import base as b
from surestar.queries.base import AS_OF, Query, plain, with_parts
from surestar.queries.dimensions import LOCATION_SQL, PERSON_LOCATION_SQL, empty
from surestar.queries.standins import CLEAN, clean
from surestar.schemas import DIMENSIONS, UNKNOWN_MEMBERS
from surestar.session import materialise

# The driver tables start earlier than the calendar of the insurer.
CALENDAR = (dt.date(1995, 1, 1), dt.date(2026, 12, 31))


class Star:
    """Dimensions for a first load, with unknown members, and the curated inputs."""

    def __init__(self, spark: SparkSession, d: str, calendar: tuple[dt.date, dt.date] = CALENDAR):
        self.curated = {name: clean(spark, d, name) for name in CLEAN}
        self.calendar = calendar
        self.spark = spark
        self._made: dict[str, DataFrame] = {}

    def prepare(self, *names: str) -> None:
        """Make dimensions at the same time; each is a few small jobs that leave most cores idle."""
        first = [n for n in names if n != "dim_person" and n not in self._made]
        if "dim_person" in names and "dim_location" not in (*first, *self._made):
            first.append("dim_location")
        with ThreadPoolExecutor(len(DIMENSIONS)) as pool:
            list(pool.map(self.dim, first))

    def dim(self, name: str) -> DataFrame:
        if name not in self._made:
            loaded = getattr(self, f"_{name}")(empty(self.spark, name))
            self._made[name] = scd.ensure_unknown_member(loaded, "sk", UNKNOWN_MEMBERS[name])
        return self._made[name]

    def _dim_agent(self, existing: DataFrame) -> DataFrame:
        return dims.load_agents(existing, dims.agent_input(self.curated["agents"]))

    def _dim_adjuster(self, existing: DataFrame) -> DataFrame:
        return dims.load_adjusters(existing, dims.adjuster_input(self.curated["adjusters"]))

    def _dim_item(self, existing: DataFrame) -> DataFrame:
        return dims.load_items(existing, dims.item_input(self.curated["items"]))

    def _dim_plan(self, existing: DataFrame) -> DataFrame:
        return dims.load_plans(existing, dims.plan_input(self.curated["policies"]))

    def _dim_claim_type(self, existing: DataFrame) -> DataFrame:
        return dims.load_claim_types(existing, dims.claim_type_input(self.curated["claims"]))

    def _dim_date(self, existing: DataFrame) -> DataFrame:
        return dims.load_dates(existing, dims.date_dimension(self.spark, *self.calendar))

    def _dim_location(self, existing: DataFrame) -> DataFrame:
        return dims.load_locations(existing, dims.location_input(self.curated["clients"], self.curated["items"]))

    def _dim_person(self, existing: DataFrame) -> DataFrame:
        persons = dims.person_input(self.curated["clients"], self.dim("dim_location"))
        others = dims.third_parties(self.curated["claims"], "id_receptor_pago", [(persons, "person_id")])
        return dims.load_persons(existing, dims.with_third_parties(persons, others), AS_OF)

    def new_policies(self, existing: DataFrame | None = None) -> DataFrame:
        wanted = ("dim_agent", "dim_item", "dim_plan", "dim_location", "dim_date", "dim_person")
        self.prepare(*wanted)
        c = self.curated
        return facts.fact_policy(
            c["policies"], c["coverages"], c["items"], **{n: self.dim(n) for n in wanted}, existing=existing
        )

    def checked_policies(self) -> DataFrame:
        """Numbered policies with the amounts as curated, which is what rules look at."""
        ids = self.curated["policies"].select(F.col("id_poliza").alias("policy_id"))
        return facts.number_new(self.new_policies(), "policy_id", ids=ids)

    def policies(self) -> DataFrame:
        return facts.as_stored(self.checked_policies(), "fact_policy")

    def new_claims(self, fact_policy: DataFrame, existing: DataFrame | None = None) -> DataFrame:
        wanted = ("dim_item", "dim_location", "dim_date", "dim_person", "dim_adjuster", "dim_claim_type")
        self.prepare(*wanted)
        c = self.curated
        return facts.fact_claim(
            c["claims"], c["assessments"], c["payments"], c["fraud_flags"], c["items"], fact_policy,
            **{n: self.dim(n) for n in wanted}, existing=existing,
        )


def fact_policy(spark: SparkSession, d: str) -> DataFrame:
    return Star(spark, d).policies()


def fact_claim(spark: SparkSession, d: str) -> DataFrame:
    star = Star(spark, d)
    star.prepare(*DIMENSIONS)
    claims = facts.as_stored(star.new_claims(star.policies()).select(*facts.CLAIM_COLUMNS), "fact_claim")
    ids = star.curated["claims"].select(F.col("id_parte").alias("claim_id"))
    return facts.number_new(claims, "claim_id", ids=ids)


def incremental_fact(spark: SparkSession, d: str) -> DataFrame:
    """Second batch: policies that were loaded before are left out and the keys go on."""
    star = Star(spark, d)
    loaded = star.curated["policies"].where("prima_mensual < 250000").select(F.col("id_poliza").alias("policy_id"))
    loaded = keys_in_order(loaded, ["policy_id"], "sk")
    ids = star.curated["policies"].select(F.col("id_poliza").alias("policy_id"))
    rows = facts.as_stored(star.new_policies(loaded), "fact_policy")
    return facts.number_new(rows, "policy_id", max_key(loaded, "sk"), anti(ids, ["policy_id"], loaded))


def overpayment(spark: SparkSession, d: str) -> DataFrame:
    star = Star(spark, d)
    flagged = facts.as_stored(facts.overpaid(star.new_claims(star.policies())), "fact_claim")
    return flagged.select("claim_id", "policy_sk", "paid", F.col("_insured_sum").alias("insured_sum"), "is_overpaid")


def date_lookup_miss(spark: SparkSession, d: str) -> DataFrame:
    """Sale dates before the calendar have key -1, the others are found."""
    star = Star(spark, d)
    return star.new_policies().groupBy((F.col("sale_date_sk") == -1).alias("is_missing")).agg(F.count("*").alias("policies"))


def loss_ratio(policies: DataFrame, claims: DataFrame, dim_plan: DataFrame, dim_date: DataFrame) -> DataFrame:
    """Premium, paid sum and their ratio per plan and sale year.

    Claims are summed per policy before they meet the policies, so the join is one row per policy.
    """
    paid = claims.groupBy("policy_sk").agg(F.sum("paid").alias("paid"), F.count("*").alias("claims"))
    per_policy = policies.select("sk", "plan_sk", "sale_date_sk", "premium").join(
        paid, F.col("sk") == F.col("policy_sk"), "left"
    )
    plans = dim_plan.select(F.col("sk").alias("plan_sk"), "plan_category")
    dates = dim_date.select(F.col("sk").alias("sale_date_sk"), "year")
    # Keys are summed before they are replaced by their texts: the dimensions meet few rows.
    by_key = per_policy.groupBy("plan_sk", "sale_date_sk").agg(
        F.sum("premium").alias("premium"), F.sum("paid").alias("paid"), F.sum("claims").alias("claims"),
        F.count("*").alias("policies"),
    )
    totals = by_key.join(plans, "plan_sk").join(dates, "sale_date_sk").groupBy("plan_category", "year").agg(
        F.sum("policies").alias("policies"),
        F.coalesce(F.sum("claims"), F.lit(0)).alias("claims"),
        F.sum("premium").cast("decimal(38,2)").alias("premium"),
        F.coalesce(F.sum("paid"), F.lit(0)).cast("decimal(38,2)").alias("paid"),
    )
    ratio = F.col("paid").cast("double") / F.col("premium").cast("double")
    return totals.withColumn("loss_ratio", ratio.cast("decimal(18,4)"))


def loss_ratio_by_plan_year(spark: SparkSession, d: str) -> DataFrame:
    star = Star(spark, d)
    star.prepare(*DIMENSIONS)
    policies = materialise(star.policies())
    return loss_ratio(policies, star.new_claims(policies), star.dim("dim_plan"), star.dim("dim_date"))


def claims_by_type_and_country(spark: SparkSession, d: str) -> DataFrame:
    """Claim facts read through three dimensions."""
    star = Star(spark, d)
    claims = star.new_claims(star.policies())
    by_key = claims.groupBy("claim_type_sk", "location_sk", "adjuster_sk").agg(
        F.count("*").alias("n"), F.count_if("is_fraud").alias("fraud"), F.sum("claimed").alias("claimed"),
        F.sum("assessed").alias("assessed"),
    )
    joined = reduce(
        lambda df, part: df.join(part[0].select(F.col("sk").alias(part[1]), part[2]), part[1]),
        [
            (star.dim("dim_claim_type"), "claim_type_sk", "claim_type"),
            (star.dim("dim_location"), "location_sk", "country"),
            (star.dim("dim_adjuster"), "adjuster_sk", "adjuster_name"),
        ],
        by_key,
    )
    return joined.groupBy("claim_type", "country", "adjuster_name").agg(
        F.sum("n").alias("claims"),
        F.sum("fraud").alias("fraud"),
        F.sum("claimed").cast("decimal(38,2)").alias("claimed"),
        F.sum("assessed").cast("decimal(38,2)").alias("assessed"),
    )


def _numbered(order: str, columns: str, source: str, unknown: str) -> str:
    return f"SELECT row_number() OVER (ORDER BY {order}) AS sk, {columns} FROM {source} UNION ALL SELECT -1, {unknown}"


def _stored(*amounts: str) -> str:
    return ", ".join(f"try_cast({c} AS DECIMAL(12,2)) AS {c}" for c in amounts)


SQL_PARTS = {
    **{f"c_{name}": plain(text) for name, text in CLEAN.items()},
    "dim_location": f"{LOCATION_SQL} UNION ALL SELECT -1, 'N/A', 'Desconocido', 'Desconocido'",
    "dim_agent": _numbered("id_agente", "id_agente AS agent_id, nombre_completo AS agent_name", "c_agents",
                           "'N/A', 'Desconocido'"),
    "dim_adjuster": _numbered("id_perito", "id_perito AS adjuster_id, nombre_completo AS adjuster_name", "c_adjusters",
                              "'N/A', 'Desconocido'"),
    "dim_item": _numbered("id_objeto", "id_objeto AS item_id, tipo_objeto AS item_type, "
                          "valor_asegurado::DECIMAL(12,2) AS item_value", "c_items", "'N/A', 'Desconocido', 0"),
    "dim_plan": _numbered(
        "plan_category", "plan_category",
        f"(SELECT DISTINCT {b.sql_plan('cobertura')} AS plan_category FROM c_policies) WHERE plan_category IS NOT NULL",
        "'Desconocido'"),
    "dim_claim_type": _numbered("claim_type", "claim_type",
                                "(SELECT DISTINCT tipo_siniestro AS claim_type FROM c_claims WHERE tipo_siniestro IS NOT NULL)",
                                "'Desconocido'"),
    "dim_date": f"""SELECT row_number() OVER (ORDER BY x) AS sk, {b.sql_date_key('x')} AS date_id, day(x)::INT AS day,
        month(x)::INT AS month, year(x)::INT AS year
        FROM (SELECT unnest(generate_series(DATE '1995-01-01', DATE '2026-12-31', INTERVAL 1 DAY))::DATE AS x)
        UNION ALL SELECT -1, -1, -1, -1, -1""",
    "dim_person": f"""SELECT row_number() OVER (ORDER BY person_id) AS sk, person_id, location_sk, occupation, segment, sex,
        DATE '2026-06-30' AS valid_from, NULL::DATE AS valid_to, true AS is_current, is_third_party FROM (
            {PERSON_LOCATION_SQL} UNION ALL
            SELECT DISTINCT id_receptor_pago, NULL, NULL, NULL, NULL, true FROM c_claims
            WHERE id_receptor_pago NOT IN (SELECT id_cliente FROM c_clients))
        UNION ALL SELECT -1, 'N/A', -1, 'Desconocido', 'Desconocido', 'O', DATE '1900-01-01', NULL, true, false""",
    "item_keys": f"""SELECT item_id, dim_item.sk AS item_sk, l.sk AS location_sk FROM dim_item LEFT JOIN c_items ON item_id = id_objeto
        LEFT JOIN (SELECT province, city, max(sk) AS sk FROM dim_location WHERE sk <> -1 GROUP BY ALL) l
        ON l.province = ({b.sql_junk('c_items.provincia')}) AND l.city = ({b.sql_junk('c_items.localidad')})""",
    "policy_rows": f"""SELECT id_poliza AS policy_id, coalesce(h.sk, -1) AS holder_sk, coalesce(i.sk, -1) AS insured_sk,
        coalesce(t.sk, -1) AS sale_date_sk, coalesce(k.item_sk, -1) AS item_sk, coalesce(a.sk, -1) AS agent_sk,
        coalesce(p.sk, -1) AS plan_sk, coalesce(k.location_sk, -1) AS location_sk,
        prima_mensual AS premium, g.insured_sum
        FROM c_policies c
        LEFT JOIN (SELECT id_poliza, sum(suma_garantizada) AS insured_sum FROM c_coverages GROUP BY 1) g USING (id_poliza)
        LEFT JOIN dim_person h ON h.person_id = id_cliente LEFT JOIN dim_person i ON i.person_id = id_asegurado
        LEFT JOIN dim_date t ON t.date_id = {b.sql_date_key('fecha_alta')}
        LEFT JOIN item_keys k ON k.item_id = id_objeto_asegurado LEFT JOIN dim_agent a ON a.agent_id = id_agente
        LEFT JOIN dim_plan p ON p.plan_category = ({b.sql_plan('cobertura')})""",
    "checked_policy": "SELECT row_number() OVER (ORDER BY md5(policy_id), policy_id) AS sk, * FROM policy_rows",
    "fact_policy": f"SELECT * REPLACE ({_stored('premium', 'insured_sum')}) FROM checked_policy",
    "claim_rows": f"""SELECT id_parte AS claim_id, coalesce(f.sk, -1) AS policy_sk, coalesce(o.sk, -1) AS open_date_sk,
        z.sk AS close_date_sk, coalesce(h.sk, -1) AS payee_sk, coalesce(a.sk, -1) AS adjuster_sk,
        coalesce(y.sk, -1) AS claim_type_sk, coalesce(k.location_sk, -1) AS location_sk,
        coalesce(x.fraude_flag, false) AS is_fraud, monto_reclamado AS claimed, coalesce(e.s, 0) AS assessed,
        coalesce(g.s, 0) AS paid,
        f.insured_sum AS policy_insured_sum
        FROM c_claims c
        LEFT JOIN (SELECT id_parte, sum(monto_estimado_dano) AS s FROM c_assessments GROUP BY 1) e USING (id_parte)
        LEFT JOIN (SELECT id_parte, sum(monto_pagado) AS s FROM c_payments GROUP BY 1) g USING (id_parte)
        LEFT JOIN c_fraud_flags x USING (id_parte)
        LEFT JOIN fact_policy f ON f.policy_id = id_poliza
        LEFT JOIN dim_date o ON o.date_id = {b.sql_date_key('fecha_apertura')}
        LEFT JOIN dim_date z ON z.date_id = {b.sql_date_key('fecha_cierre')}
        LEFT JOIN dim_person h ON h.person_id = id_receptor_pago LEFT JOIN dim_adjuster a ON a.adjuster_id = id_perito
        LEFT JOIN dim_claim_type y ON y.claim_type = tipo_siniestro
        LEFT JOIN item_keys k ON k.item_id = id_objeto_asegurado""",
    "checked_claim": """SELECT row_number() OVER (ORDER BY md5(claim_id), claim_id) AS sk, * EXCLUDE (policy_insured_sum)
        FROM claim_rows""",
    "fact_claim": f"SELECT * REPLACE ({_stored('claimed', 'assessed', 'paid')}) FROM checked_claim",
}


def sql_on_star(body: str) -> str:
    """The query with the whole star in front; unused parts cost nothing."""
    return with_parts(body, SQL_PARTS)


QUERIES = {
    "fact_policy": Query(fact_policy, sql_on_star("SELECT * FROM fact_policy")),
    "fact_claim": Query(fact_claim, sql_on_star("SELECT * FROM fact_claim")),
    "incremental_fact": Query(
        incremental_fact,
        sql_on_star("""SELECT (SELECT count(*) FROM policy_rows WHERE premium < 250000)
                              + row_number() OVER (ORDER BY md5(policy_id), policy_id) AS sk, *
                              REPLACE (try_cast(premium AS DECIMAL(12,2)) AS premium,
                                       try_cast(insured_sum AS DECIMAL(12,2)) AS insured_sum)
                       FROM policy_rows WHERE premium >= 250000"""),
    ),
    "overpayment": Query(
        overpayment,
        sql_on_star("""SELECT claim_id, policy_sk, try_cast(paid AS DECIMAL(12,2)) AS paid, policy_insured_sum AS insured_sum,
                              coalesce(paid > policy_insured_sum, false) AS is_overpaid FROM claim_rows"""),
    ),
    "date_lookup_miss": Query(
        date_lookup_miss,
        sql_on_star("SELECT sale_date_sk = -1 AS is_missing, count(*) AS policies FROM policy_rows GROUP BY 1"),
    ),
    "loss_ratio_by_plan_year": Query(
        loss_ratio_by_plan_year,
        sql_on_star("""SELECT *, (paid::DOUBLE / premium::DOUBLE)::DECIMAL(18,4) AS loss_ratio FROM (
            SELECT plan_category, year, count(*) AS policies, coalesce(sum(n), 0)::BIGINT AS claims,
                   sum(premium) AS premium, coalesce(sum(p), 0)::DECIMAL(38,2) AS paid
            FROM fact_policy f LEFT JOIN (SELECT policy_sk, sum(paid) AS p, count(*) AS n FROM fact_claim GROUP BY 1) c
                 ON c.policy_sk = f.sk
            JOIN dim_plan ON plan_sk = dim_plan.sk JOIN dim_date ON sale_date_sk = dim_date.sk
            GROUP BY plan_category, year)"""),
    ),
    "claims_by_type_and_country": Query(
        claims_by_type_and_country,
        sql_on_star("""SELECT claim_type, country, adjuster_name, count(*) AS claims,
                              count_if(is_fraud)::BIGINT AS fraud, sum(claimed) AS claimed, sum(assessed) AS assessed
            FROM fact_claim f JOIN dim_claim_type t ON claim_type_sk = t.sk JOIN dim_location l ON location_sk = l.sk
            JOIN dim_adjuster a ON adjuster_sk = a.sk GROUP BY ALL"""),
    ),
}
