"""Dimension merges and dimension inputs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.operators import details, keys, scd
from surestar.plans import dims
from surestar.queries import base as b
from surestar.queries.base import AS_OF, Query, plain, run_sql, table
from surestar.queries.standins import CLEAN, clean
from surestar.schemas import DIMENSIONS, UNKNOWN_MEMBERS
from surestar.sources.store import empty_table

# An item dimension loaded before, and the items of today: some are new, some changed, some gone.
OLD_ITEMS = """
SELECT p_partkey * 2 + 1 AS sk, 'P' || CAST(p_partkey AS STRING) AS item_id,
       CASE WHEN p_partkey % 7 <> 0 THEN p_type END AS item_type,
       CAST(CASE WHEN p_partkey % 5 = 0 THEN p_retailprice + 1 ELSE p_retailprice END AS DECIMAL(12,2)) AS item_value
FROM {part} WHERE p_partkey % 3 <> 0
UNION ALL
SELECT p_partkey * 2 + 2, 'gone ' || CAST(p_partkey AS STRING), p_type, CAST(0 AS DECIMAL(12,2)) FROM {part}
WHERE p_partkey % 11 = 0
UNION ALL
SELECT CAST(-1 AS BIGINT), 'N/A', 'Desconocido', CAST(0 AS DECIMAL(12,2))
"""
NEW_ITEMS = """
SELECT 'P' || CAST(p_partkey AS STRING) AS item_id,
       CASE WHEN p_partkey % 7 <> 0 THEN CASE WHEN p_partkey % 13 = 1 THEN NULL ELSE p_type END END AS item_type,
       CAST(p_retailprice AS DECIMAL(12,2)) AS item_value
FROM {part}
"""

# A person dimension with history, and the persons of today.
OLD_PERSONS = """
SELECT c_custkey * 2 + 1 AS sk, 'C' || CAST(c_custkey AS STRING) AS person_id, CAST(c_nationkey AS BIGINT) AS location_sk,
       CASE WHEN c_custkey % 5 = 0 THEN 'Other' ELSE c_mktsegment END AS occupation, 'Adulto' AS segment,
       CASE WHEN c_custkey % 8 <> 0 THEN 'F' END AS sex, DATE '2020-01-01' AS valid_from,
       CASE WHEN c_custkey % 4 = 1 THEN DATE '2023-05-01' END AS valid_to, c_custkey % 4 <> 1 AS is_current,
       false AS is_third_party
FROM {customer} WHERE c_custkey % 3 <> 0
UNION ALL
SELECT c_custkey * 2 + 2, 'C' || CAST(c_custkey AS STRING), CAST(c_nationkey AS BIGINT), c_mktsegment, 'Adulto',
       CASE WHEN c_custkey % 8 <> 0 THEN 'F' END, DATE '2023-05-01', CAST(NULL AS DATE), true, false
FROM {customer} WHERE c_custkey % 3 <> 0 AND c_custkey % 4 = 1
"""
NEW_PERSONS = """
SELECT 'C' || CAST(c_custkey AS STRING) AS person_id, CAST(c_nationkey AS BIGINT) AS location_sk,
       c_mktsegment AS occupation, CASE WHEN c_custkey % 9 = 2 THEN 'Mayor' ELSE 'Adulto' END AS segment,
       CASE WHEN c_custkey % 8 <> 0 THEN 'F' END AS sex, false AS is_third_party
FROM {customer}
"""

OLD_KINDS = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY p_brand, p_type) AS BIGINT) AS sk, p_brand, p_type
FROM (SELECT DISTINCT p_brand, CASE WHEN p_type <> 'SMALL' THEN p_type END AS p_type FROM {part}
      WHERE p_size % 2 = 0 AND p_type <> 'SMALL') AS k
"""
NEW_KINDS = "SELECT DISTINCT p_brand, CASE WHEN p_type <> 'SMALL' THEN p_type END AS p_type FROM {part}"


def empty(spark: SparkSession, name: str) -> DataFrame:
    return empty_table(spark, DIMENSIONS[name])


def date_dim(spark: SparkSession, d: str) -> DataFrame:
    """Calendar over all order and ship dates, with the policies sold per day."""
    sold = table(spark, d, "orders").select(F.col("o_orderdate").cast("date").alias("day"))
    shipped = table(spark, d, "lineitem").select(F.col("l_shipdate").cast("date").alias("day"))
    bounds = sold.unionByName(shipped).agg(F.min("day").alias("first"), F.max("day").alias("last"))
    calendar = keys.keys_in_order(dims.calendar(dims.date_range(bounds)), ["date_id"], "sk")
    per_day = sold.groupBy(dims.date_key(F.col("day")).alias("sold_id")).agg(F.count("*").alias("policies"))
    return details.left_details(calendar, "date_id", per_day, "sold_id", "policies")


def scd1_state(spark: SparkSession, d: str) -> DataFrame:
    return dims.load_items(run_sql(spark, d, OLD_ITEMS), run_sql(spark, d, NEW_ITEMS))


def scd1_changes(spark: SparkSession, d: str) -> DataFrame:
    old, new = run_sql(spark, d, OLD_ITEMS), run_sql(spark, d, NEW_ITEMS)
    return scd.scd1_status(old, new, "item_id", ["item_type", "item_value"], "sk")


def scd1_pairs(spark: SparkSession, d: str) -> DataFrame:
    old, new = run_sql(spark, d, OLD_ITEMS), run_sql(spark, d, NEW_ITEMS)
    return scd.scd1_pairs(old, new, "item_id", ["item_type", "item_value"], "sk")


def insert_new_members(spark: SparkSession, d: str) -> DataFrame:
    """Composite natural key with nulls."""
    return scd.insert_new_members(run_sql(spark, d, OLD_KINDS), run_sql(spark, d, NEW_KINDS), ["p_brand", "p_type"], "sk")


def scd2_state(spark: SparkSession, d: str) -> DataFrame:
    return dims.load_persons(run_sql(spark, d, OLD_PERSONS), run_sql(spark, d, NEW_PERSONS), AS_OF)


def scd2_changes(spark: SparkSession, d: str) -> DataFrame:
    old, new = run_sql(spark, d, OLD_PERSONS), run_sql(spark, d, NEW_PERSONS)
    compared = scd.scd2_status(old, new, "person_id", dims.PERSON_TRACKED, "sk")
    return compared.select("person_id", F.col("_sk").alias("old_sk"), "status")


def unknown_members(spark: SparkSession, d: str) -> DataFrame:
    """Added twice, there once."""
    agents = dims.load_agents(empty(spark, "dim_agent"), dims.agent_input(clean(spark, d, "agents")))
    once = scd.ensure_unknown_member(agents, "sk", UNKNOWN_MEMBERS["dim_agent"])
    return scd.ensure_unknown_member(once, "sk", UNKNOWN_MEMBERS["dim_agent"])


def location_dim(spark: SparkSession, d: str) -> DataFrame:
    places = dims.location_input(clean(spark, d, "clients"), clean(spark, d, "items"))
    return dims.load_locations(empty(spark, "dim_location"), places)


def person_location(spark: SparkSession, d: str) -> DataFrame:
    return dims.person_input(clean(spark, d, "clients"), location_dim(spark, d))


def plan_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.load_plans(empty(spark, "dim_plan"), dims.plan_input(clean(spark, d, "policies")))


def claim_type_dim(spark: SparkSession, d: str) -> DataFrame:
    claims = clean(spark, d, "claims").withColumn("tipo_siniestro", F.concat(F.lit(" "), "tipo_siniestro"))
    return dims.load_claim_types(empty(spark, "dim_claim_type"), dims.claim_type_input(claims))


def adjuster_dim(spark: SparkSession, d: str) -> DataFrame:
    return dims.load_adjusters(empty(spark, "dim_adjuster"), dims.adjuster_input(clean(spark, d, "adjusters")))


_COMPARED = f"""
SELECT n.*, o.sk AS old_sk, o.item_type AS old_type, o.item_value AS old_value,
       n.item_type IS DISTINCT FROM o.item_type OR n.item_value IS DISTINCT FROM o.item_value AS changed
FROM ({plain(NEW_ITEMS)}) n LEFT JOIN ({plain(OLD_ITEMS)}) o USING (item_id)
"""

_PERSONS = f"""
WITH o AS ({plain(OLD_PERSONS)}), n AS ({plain(NEW_PERSONS)}),
compared AS (
    SELECT n.*, o.sk AS old_sk,
           CASE WHEN o.sk IS NULL THEN 'new'
                WHEN (n.occupation, n.segment, n.sex, n.location_sk)
                     IS DISTINCT FROM (o.occupation, o.segment, o.sex, o.location_sk) THEN 'changed'
                ELSE 'same' END AS status
    FROM n LEFT JOIN o ON n.person_id = o.person_id AND o.is_current)
"""

LOCATION_SQL = f"""
SELECT row_number() OVER (ORDER BY country NULLS FIRST, province, city) AS sk, country, province, city FROM (
    SELECT min(country) AS country, min(province) AS province, min(city) AS city FROM (
        SELECT {b.sql_junk('pais')} AS country, {b.sql_junk('provincia')} AS province, {b.sql_junk('localidad')} AS city
        FROM ({plain(CLEAN['clients'])})
        UNION ALL
        SELECT 'Argentina', {b.sql_junk('provincia')}, {b.sql_junk('localidad')} FROM ({plain(CLEAN['items'])}))
    WHERE province IS NOT NULL AND city IS NOT NULL GROUP BY upper(country), upper(province), upper(city))
"""

PERSON_LOCATION_SQL = f"""
SELECT c.id_cliente AS person_id, l.sk AS location_sk, c.situacion_laboral AS occupation, c.segmento_persona AS segment,
       c.sexo AS sex, false AS is_third_party
FROM ({plain(CLEAN['clients'])}) c LEFT JOIN ({LOCATION_SQL}) l
ON l.country IS NOT DISTINCT FROM ({b.sql_junk('c.pais')}) AND l.province = ({b.sql_junk('c.provincia')})
   AND l.city = ({b.sql_junk('c.localidad')})
"""

QUERIES = {
    "date_dim": Query(
        date_dim,
        f"""WITH bounds AS (SELECT min(x) AS a, max(x) AS z FROM (
                SELECT o_orderdate::DATE AS x FROM orders UNION ALL SELECT l_shipdate::DATE FROM lineitem)),
            days AS (SELECT unnest(generate_series(a, z, INTERVAL 1 DAY))::DATE AS x FROM bounds)
            SELECT row_number() OVER (ORDER BY x) AS sk, {b.sql_date_key('x')} AS date_id, day(x)::INT AS day,
                   month(x)::INT AS month, year(x)::INT AS year, policies
            FROM days LEFT JOIN (SELECT o_orderdate::DATE AS x, count(*) AS policies FROM orders GROUP BY 1) USING (x)""",
    ),
    "scd1_state": Query(
        scd1_state,
        f"""WITH o AS ({plain(OLD_ITEMS)}), n AS ({plain(NEW_ITEMS)})
            SELECT o.sk, o.item_id, CASE WHEN n.item_id IS NULL THEN o.item_type ELSE n.item_type END AS item_type,
                   CASE WHEN n.item_id IS NULL THEN o.item_value ELSE n.item_value END AS item_value
            FROM o LEFT JOIN n USING (item_id)
            UNION ALL
            SELECT (SELECT max(sk) FROM o) + row_number() OVER (ORDER BY item_id), item_id, item_type, item_value
            FROM n WHERE item_id NOT IN (SELECT item_id FROM o)""",
    ),
    "scd1_changes": Query(
        scd1_changes,
        f"""SELECT item_id, CASE WHEN old_sk IS NULL THEN 'new' WHEN changed THEN 'changed' ELSE 'same' END AS status
            FROM ({_COMPARED})""",
    ),
    "scd1_pairs": Query(
        scd1_pairs,
        f"""SELECT old_sk AS sk, item_id, old_type AS item_type_old, old_value AS item_value_old,
                   item_type AS item_type_new, item_value AS item_value_new, changed
            FROM ({_COMPARED}) WHERE old_sk IS NOT NULL""",
    ),
    "insert_new_members": Query(
        insert_new_members,
        f"""WITH o AS ({plain(OLD_KINDS)}), n AS ({plain(NEW_KINDS)})
            SELECT * FROM o UNION ALL
            SELECT (SELECT max(sk) FROM o) + row_number() OVER (ORDER BY p_brand, p_type NULLS FIRST), p_brand, p_type
            FROM n WHERE NOT EXISTS (SELECT 1 FROM o WHERE o.p_brand = n.p_brand AND o.p_type IS NOT DISTINCT FROM n.p_type)""",
    ),
    "scd2_state": Query(
        scd2_state,
        f"""{_PERSONS}
            SELECT o.* REPLACE (CASE WHEN c.old_sk IS NOT NULL THEN DATE '2026-06-30' ELSE valid_to END AS valid_to,
                                is_current AND c.old_sk IS NULL AS is_current)
            FROM o LEFT JOIN (SELECT old_sk FROM compared WHERE status = 'changed') c ON o.sk = c.old_sk
            UNION ALL BY NAME
            SELECT (SELECT max(sk) FROM o) + row_number() OVER (ORDER BY person_id) AS sk, person_id, location_sk, occupation,
                   segment, sex, DATE '2026-06-30' AS valid_from, NULL::DATE AS valid_to, true AS is_current, is_third_party
            FROM compared WHERE status <> 'same'""",
    ),
    "scd2_changes": Query(scd2_changes, f"{_PERSONS} SELECT person_id, old_sk, status FROM compared"),
    "unknown_members": Query(
        unknown_members,
        f"""SELECT row_number() OVER (ORDER BY id_agente) AS sk, id_agente AS agent_id, nombre_completo AS agent_name
            FROM ({plain(CLEAN['agents'])}) UNION ALL SELECT -1, 'N/A', 'Desconocido'""",
    ),
    "location_dim": Query(location_dim, LOCATION_SQL),
    "person_location": Query(person_location, PERSON_LOCATION_SQL),
    "plan_dim": Query(
        plan_dim,
        f"""SELECT row_number() OVER (ORDER BY plan_category) AS sk, plan_category FROM (
                SELECT DISTINCT {b.sql_plan('cobertura')} AS plan_category FROM ({plain(CLEAN['policies'])}))
            WHERE plan_category IS NOT NULL""",
    ),
    "claim_type_dim": Query(
        claim_type_dim,
        """SELECT row_number() OVER (ORDER BY claim_type) AS sk, claim_type
           FROM (SELECT DISTINCT upper(event_type) AS claim_type FROM events)""",
    ),
    "adjuster_dim": Query(
        adjuster_dim,
        f"""SELECT row_number() OVER (ORDER BY id_perito) AS sk, id_perito AS adjuster_id,
                   nombre_completo AS adjuster_name FROM ({plain(CLEAN['adjusters'])})""",
    ),
}
