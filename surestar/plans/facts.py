"""The two fact tables.

New rows are found first (anti-join on the id column alone), so the lookups see only what will be loaded. Details
are summed per parent before they are joined. Item key and item location come from one joined item table, and the
policy key and its insured sum from one policy table, so each costs one join. All dimensions but the person
dimension hold a natural key once (the merges never make a second row for a key), so they are joined as they are;
a person has several versions and is cut down to one first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.functions import classify as cl
from surestar.functions.parse import MONEY, date_key
from surestar.operators.details import left_details, sum_by_key
from surestar.operators.keys import keys_by_hash
from surestar.operators.lookup import first_by_key, lookup, or_unknown
from surestar.operators.refint import anti_key
from surestar.plans.dims import SK, resolve_place

POLICY_COLUMNS = (
    "policy_id", "holder_sk", "insured_sk", "sale_date_sk", "item_sk", "agent_sk", "plan_sk", "location_sk",
    "premium", "insured_sum",
)
CLAIM_COLUMNS = (
    "claim_id", "policy_sk", "open_date_sk", "close_date_sk", "payee_sk", "adjuster_sk", "claim_type_sk",
    "location_sk", "is_fraud", "claimed", "assessed", "paid",
)


def item_keys(items: DataFrame, dim_item: DataFrame, dim_location: DataFrame) -> DataFrame:
    """Per item id its surrogate key and, over the two hops item and place, its location key."""
    places = items.select("id_objeto", "provincia", "localidad")
    placed = resolve_place(places, [F.col("provincia"), F.col("localidad")], dim_location)
    placed = placed.select(F.col("id_objeto").alias("_placed_id"), "location_sk")
    joined = dim_item.join(placed, F.col("item_id") == F.col("_placed_id"), "full_outer")
    return joined.select(
        F.coalesce("item_id", "_placed_id").alias("item_id"), F.col(SK).alias("item_sk"), "location_sk"
    )


def person_keys(dim_person: DataFrame, version: str = "first") -> DataFrame:
    """Key of the first (default) or of the current version of each person."""
    if version == "current":
        return dim_person.where("is_current").groupBy("person_id").agg(F.max(SK).alias(SK))
    return first_by_key(dim_person, ["person_id"], SK)


def fact_policy(
    policies: DataFrame,
    coverages: DataFrame,
    items: DataFrame,
    dim_agent: DataFrame,
    dim_item: DataFrame,
    dim_plan: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    dim_person: DataFrame,
    existing: DataFrame | None = None,
    person_version: str = "first",
) -> DataFrame:
    """Policies not loaded yet, with all keys and measures but without a key of their own.

    Amounts are as curated, so that rules see one that is too large; :func:`as_stored` casts them.
    """
    df = policies.select(
        F.col("id_poliza").alias("policy_id"),
        "id_cliente",
        "id_asegurado",
        "id_agente",
        "id_objeto_asegurado",
        "fecha_alta",
        cl.plan_category(F.col("cobertura")).alias("_plan"),
        F.col("prima_mensual").alias("premium"),
    )
    if existing is not None:
        df = anti_key(df, "policy_id", existing)
    sums = sum_by_key(coverages, "id_poliza", "suma_garantizada", "insured_sum")
    df = left_details(df, "policy_id", sums, "id_poliza", "insured_sum")
    df = lookup(df, [F.col("_plan")], dim_plan, ["plan_category"], {SK: "plan_sk"})
    df = lookup(df, [date_key(F.col("fecha_alta"))], dim_date, ["date_id"],
                {SK: "sale_date_sk"})
    df = lookup(df, [F.col("id_agente")], dim_agent, ["agent_id"], {SK: "agent_sk"},
                spread="policy_id")
    df = lookup(df, [F.col("id_objeto_asegurado")], item_keys(items, dim_item, dim_location), ["item_id"],
                {"item_sk": "item_sk", "location_sk": "location_sk"}, spread="policy_id")
    persons = person_keys(dim_person, person_version)
    for role, column in (("holder_sk", "id_cliente"), ("insured_sk", "id_asegurado")):
        df = lookup(df, [F.col(column)], persons, ["person_id"], {SK: role}, spread="policy_id")
    return df.select(*POLICY_COLUMNS)


def as_stored(df: DataFrame, table: str) -> DataFrame:
    """Cast the amounts to what the warehouse stores; one that is too large becomes null."""
    amounts = {"fact_policy": ("premium", "insured_sum"), "fact_claim": ("claimed", "assessed", "paid")}[table]
    return df.withColumns({name: F.col(name).try_cast(MONEY) for name in amounts})


def claim_details(claims: DataFrame, assessments: DataFrame, payments: DataFrame, flags: DataFrame) -> DataFrame:
    """Claims with assessed and paid sums (null without details) and the fraud flag."""
    assessed = sum_by_key(assessments, "id_parte", "monto_estimado_dano", "assessed")
    paid = sum_by_key(payments, "id_parte", "monto_pagado", "paid")
    df = left_details(claims, "claim_id", assessed, "id_parte", "assessed")
    df = left_details(df, "claim_id", paid, "id_parte", "paid")
    df = left_details(df, "claim_id", flags, "id_parte", "fraude_flag")
    return df.withColumn("is_fraud", F.coalesce("fraude_flag", F.lit(False)))


def fact_claim(
    claims: DataFrame,
    assessments: DataFrame,
    payments: DataFrame,
    flags: DataFrame,
    items: DataFrame,
    fact_policy: DataFrame,
    dim_item: DataFrame,
    dim_location: DataFrame,
    dim_date: DataFrame,
    dim_person: DataFrame,
    dim_adjuster: DataFrame,
    dim_claim_type: DataFrame,
    existing: DataFrame | None = None,
    person_version: str = "first",
) -> DataFrame:
    """Claims not loaded yet, with all keys and measures.

    Two more columns serve reports and are dropped before the load: ``_insured_sum`` of the policy and
    ``_dates_ok`` (open date not after close date).
    """
    df = claims.select(
        F.col("id_parte").alias("claim_id"), "id_poliza", "id_perito", "id_receptor_pago", "id_objeto_asegurado",
        "tipo_siniestro", "fecha_apertura", "fecha_cierre", "monto_reclamado",
    )
    if existing is not None:
        df = anti_key(df, "claim_id", existing)
    df = claim_details(df, assessments, payments, flags)
    df = lookup(df, [date_key(F.col("fecha_apertura"))], dim_date, ["date_id"], {SK: "open_date_sk"})
    df = lookup(df, [date_key(F.col("fecha_cierre"))], dim_date, ["date_id"], {SK: "close_date_sk"}, default=None)
    df = lookup(df, [F.col("tipo_siniestro")], dim_claim_type, ["claim_type"],
                {SK: "claim_type_sk"})
    df = lookup(df, [F.col("id_perito")], dim_adjuster, ["adjuster_id"],
                {SK: "adjuster_sk"}, spread="claim_id")
    df = lookup(df, [F.col("id_objeto_asegurado")], item_keys(items, dim_item, dim_location), ["item_id"],
                {"location_sk": "location_sk"}, spread="claim_id")
    df = lookup(df, [F.col("id_receptor_pago")], person_keys(dim_person, person_version), ["person_id"],
                {SK: "payee_sk"}, spread="claim_id")
    # The load never makes a second row for a policy, so the table is joined as it is.
    policy = fact_policy.select("policy_id", F.col(SK).alias("policy_sk"), "insured_sum")
    df = lookup(df, [F.col("id_poliza")], policy, ["policy_id"],
                {"policy_sk": "policy_sk", "insured_sum": "_insured_sum"}, default=None, spread="claim_id")
    return df.withColumns({
        "policy_sk": or_unknown(F.col("policy_sk")),
        "claimed": F.col("monto_reclamado"),
        "assessed": F.coalesce("assessed", F.lit(0)),
        "paid": F.coalesce("paid", F.lit(0)),
        "_dates_ok": F.col("fecha_cierre").isNull() | (F.col("fecha_apertura") <= F.col("fecha_cierre")),
    }).select(*CLAIM_COLUMNS, "_insured_sum", "_dates_ok")


def is_overpaid() -> Column:
    return F.coalesce(F.col("paid") > F.col("_insured_sum"), F.lit(False))


def overpaid(df: DataFrame) -> DataFrame:
    """Add the flag: paid more than the insured sum of the policy. A report; the fraud flag is left alone."""
    return df.withColumn("is_overpaid", is_overpaid())


def keep_keys(df: DataFrame, natural_key: str, own: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows that an earlier try of the same run has numbered, with those keys, and the rows that are new."""
    numbered = own.select(F.col(natural_key).alias("_known"), SK)
    joined = df.join(numbered, F.col(natural_key) == F.col("_known"), "left").drop("_known")
    return joined.where(F.col(SK).isNotNull()), joined.where(F.col(SK).isNull()).drop(SK)


def number_new(
    df: DataFrame, natural_key: str, highest: int = 0, ids: DataFrame | None = None
) -> DataFrame:
    """Give new fact rows their surrogate keys, after the highest one given out.

    ``ids`` holds the same natural keys and is cheaper to scan than ``df``.
    """
    return keys_by_hash(df, natural_key, SK, highest, ids)
