"""Input of each dimension, made from curated tables, and the dimension updates."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.functions import classify as cl
from surestar.functions import text as t
from surestar.functions.parse import MONEY, clean_reference, date_key
from surestar.operators import scd
from surestar.operators.lookup import last_by_key, lookup
from surestar.operators.refint import anti
from surestar.schemas import CALENDAR_END, CALENDAR_START, ITEM_COUNTRY

SK = "sk"
PERSON_TRACKED = ("occupation", "segment", "sex", "location_sk")


# Calendar


def calendar(days: DataFrame) -> DataFrame:
    """Date attributes for a frame with a ``day`` column of dates."""
    day = F.col("day")
    return days.select(
        date_key(day).alias("date_id"),
        F.day(day).alias("day"),
        F.month(day).alias("month"),
        F.year(day).alias("year"),
    )


def date_range(bounds: DataFrame) -> DataFrame:
    """One row per day of the closed range (first, last) held by a one-row frame."""
    return bounds.select(F.explode(F.sequence("first", "last", F.expr("interval 1 day"))).alias("day"))


def date_dimension(
    spark: SparkSession, start: dt.date = CALENDAR_START, end: dt.date = CALENDAR_END
) -> DataFrame:
    """Date attributes of every day from start to end."""
    bounds = spark.range(1).select(F.lit(start).alias("first"), F.lit(end).alias("last"))
    return calendar(date_range(bounds))


def load_dates(existing: DataFrame, days: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.insert_new_members(existing, days, ["date_id"], SK, highest)


# Dimensions with overwritten attributes


def agent_input(agents: DataFrame) -> DataFrame:
    return agents.select(F.col("id_agente").alias("agent_id"), F.col("nombre_completo").alias("agent_name"))


def load_agents(existing: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.scd1_merge(existing, incoming, "agent_id", ["agent_name"], SK, highest)


def adjuster_input(adjusters: DataFrame) -> DataFrame:
    return adjusters.select(F.col("id_perito").alias("adjuster_id"), F.col("nombre_completo").alias("adjuster_name"))


def load_adjusters(existing: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.scd1_merge(existing, incoming, "adjuster_id", ["adjuster_name"], SK, highest)


def item_input(items: DataFrame) -> DataFrame:
    """Values are cast to what the dimension stores, so that a comparison with it is exact.

    Curation has rejected items whose value is too large for it.
    """
    return items.select(
        F.col("id_objeto").alias("item_id"),
        F.col("tipo_objeto").alias("item_type"),
        F.col("valor_asegurado").try_cast(MONEY).alias("item_value"),
    )


def load_items(existing: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.scd1_merge(existing, incoming, "item_id", ["item_type", "item_value"], SK, highest)


# Dimensions that only grow


def _distinct_cleaned(df: DataFrame, raw: str, clean: Callable[[Column], Column], name: str) -> DataFrame:
    """Distinct texts of a column after cleaning, without null; each different raw text is cleaned once and not once per row.

    Both aggregates count, since Spark leaves out a ``distinct`` that another one follows. Nulls are sought by the counts, since Spark
    pushes a filter on a cleaned text below the aggregates, down to the rows.
    """
    raws = df.groupBy(F.col(raw).alias("_raw")).agg(F.count("*").alias("_rows"))
    cleaned = raws.select(clean(F.col("_raw")).alias(name), "_rows")
    known = F.sum(F.when(F.col(name).isNotNull(), F.col("_rows"))).alias("_known")
    return cleaned.groupBy(name).agg(known).where("_known > 0").select(name)


def plan_input(policies: DataFrame) -> DataFrame:
    """Distinct plan categories of the coverage levels; unknown levels have none."""
    levels = policies.select("cobertura").distinct()
    plans = levels.select(cl.plan_category(F.col("cobertura")).alias("plan_category"))
    return plans.where("plan_category is not null").distinct()


def load_plans(existing: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.insert_new_members(existing, incoming, ["plan_category"], SK, highest)


def claim_type_input(claims: DataFrame) -> DataFrame:
    return _distinct_cleaned(claims, "tipo_siniestro", t.trim_all, "claim_type")


def load_claim_types(existing: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.insert_new_members(existing, incoming, ["claim_type"], SK, highest)


# Locations

LOCATION = ("country", "province", "city")


def clean_location(country: Column, province: Column, city: Column) -> list[Column]:
    """The three location texts as every user of the location dimension has to clean them."""
    return [t.clean_junk(c).alias(name) for c, name in zip((country, province, city), LOCATION)]


def location_input(clients: DataFrame, items: DataFrame) -> DataFrame:
    """Distinct locations of clients and items; province and city have to be known.

    Raw texts are made distinct first, so that a text is cleaned once and not once per client.
    """
    of_clients = clients.select(
        F.col("pais").alias("country"), F.col("provincia").alias("province"), F.col("localidad").alias("city")
    )
    of_items = items.select(
        F.lit(ITEM_COUNTRY).alias("country"), F.col("provincia").alias("province"), F.col("localidad").alias("city")
    )
    raw = of_clients.unionByName(of_items).distinct()
    both = raw.select(*clean_location(*map(F.col, LOCATION)))
    # Texts that differ in case only are one member.
    keys = [t.location_key(F.col(name)).alias(f"_{name}") for name in LOCATION]
    members = both.groupBy(*keys).agg(*[F.min(name).alias(name) for name in LOCATION]).select(*LOCATION)
    # A filter on the values of the aggregate is not pushed below the distinct raw texts.
    return members.where("province is not null and city is not null")


def load_locations(existing: DataFrame, incoming: DataFrame, highest: int | None = None) -> DataFrame:
    return scd.insert_new_members(existing, incoming, list(LOCATION), SK, highest)


def location_by_place(locations: DataFrame) -> DataFrame:
    """(province, city) in compared form with the highest key, for lookups that know no country."""
    known = locations.where(F.col(SK) != -1).select(
        t.location_key(F.col("province")).alias("province_key"), t.location_key(F.col("city")).alias("city_key"), SK
    )
    return last_by_key(known, ["province_key", "city_key"], SK)


def place_keys(province: Column, city: Column) -> list[Column]:
    """Compared form of raw location texts, matching :func:`location_by_place`."""
    return [t.location_key(t.clean_junk(province)), t.location_key(t.clean_junk(city))]


def _join_raw(df: DataFrame, raw: list[Column], resolved: DataFrame) -> DataFrame:
    """Left join to a table of distinct raw texts ``_r0, _r1, ...`` and their ``location_sk``; null equals null."""
    same = F.lit(True)
    for i, c in enumerate(raw):
        same = same & c.eqNullSafe(F.col(f"_r{i}"))
    return df.join(resolved, same, "left").select(*df.columns, "location_sk")


def _distinct_raw(df: DataFrame, raw: list[Column]) -> DataFrame:
    return df.select(*[c.alias(f"_r{i}") for i, c in enumerate(raw)]).distinct()


def resolve_place(df: DataFrame, raw: list[Column], locations: DataFrame) -> DataFrame:
    """Add ``location_sk`` by raw (province, city); null for an unknown place."""
    texts = _distinct_raw(df, raw)
    found = lookup(
        texts,
        place_keys(F.col("_r0"), F.col("_r1")),
        location_by_place(locations),
        ["province_key", "city_key"],
        {SK: "location_sk"},
        default=None,
    )
    return _join_raw(df, raw, found)


# Persons


def resolve_location(df: DataFrame, raw: list[Column], locations: DataFrame) -> DataFrame:
    """Add ``location_sk`` by raw (country, province, city); null equals null, so nothing fans out.

    Distinct raw texts are cleaned and looked up; the rows only meet the result.
    """
    known = locations.where(F.col(SK) != -1).groupBy(
        *[t.location_key(F.col(name)).alias(f"_d_{name}") for name in LOCATION]
    ).agg(F.min(SK).alias("location_sk"))
    texts = _distinct_raw(df, raw)
    cleaned = clean_location(*[F.col(f"_r{i}") for i in range(len(LOCATION))])
    texts = texts.select("*", *cleaned)
    same = F.lit(True)
    for name in LOCATION:
        same = same & t.location_key(F.col(name)).eqNullSafe(F.col(f"_d_{name}"))
    found = texts.join(known, same, "left").select(*[f"_r{i}" for i in range(len(LOCATION))], "location_sk")
    return _join_raw(df, raw, found)


def person_input(clients: DataFrame, locations: DataFrame) -> DataFrame:
    """Clients as persons, one row each, with their location key."""
    located = resolve_location(
        clients.select("id_cliente", "pais", "provincia", "localidad", "situacion_laboral", "segmento_persona", "sexo"),
        [F.col("pais"), F.col("provincia"), F.col("localidad")],
        locations,
    )
    return located.select(
        F.col("id_cliente").alias("person_id"),
        "location_sk",
        F.col("situacion_laboral").alias("occupation"),
        F.col("segmento_persona").alias("segment"),
        F.col("sexo").alias("sex"),
        F.lit(False).alias("is_third_party"),
    )


def third_parties(payees: DataFrame, payee: str, known: list[tuple[DataFrame, str]]) -> DataFrame:
    """Payees that are no known person, as persons without attributes."""
    ids = _distinct_cleaned(payees, payee, clean_reference, "person_id")
    union = None
    for persons, column in known:
        part = persons.select(F.col(column).alias("person_id"))
        union = part if union is None else union.union(part)
    fresh = anti(ids, ["person_id"], union.distinct())
    nothing = F.lit(None).cast("string")
    return fresh.select(
        "person_id",
        F.lit(None).cast("bigint").alias("location_sk"),
        nothing.alias("occupation"),
        nothing.alias("segment"),
        nothing.alias("sex"),
        F.lit(True).alias("is_third_party"),
    )


def with_third_parties(persons: DataFrame, others: DataFrame) -> DataFrame:
    return persons.unionByName(others, allowMissingColumns=True)


def load_persons(
    existing: DataFrame, incoming: DataFrame, as_of: dt.date, highest: int | None = None, latest: dt.date | None = None
) -> DataFrame:
    return scd.scd2_merge(existing, incoming, "person_id", PERSON_TRACKED, as_of, SK, highest, latest)


# Master geography


def master_geography(provinces: DataFrame, localities: DataFrame) -> DataFrame:
    """Distinct canonical (provincia, localidad) pairs of provinces (id, nombre) and localities."""
    joined = localities.select("provincia_id", F.col("nombre").alias("_locality")).join(
        provinces.select("id", F.col("nombre").alias("_province")), F.col("provincia_id") == F.col("id")
    )
    return joined.select(
        t.canonical(F.col("_province")).alias("provincia"), t.canonical(F.col("_locality")).alias("localidad")
    ).distinct()
