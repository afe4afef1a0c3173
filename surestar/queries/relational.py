"""Deduplication, referential filters, detail sums, keys, lookups and set operations."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.functions.parse import MONEY, date_key
from surestar.operators import dedupe, details, keys, lookup, refint
from surestar.plans import dims
from surestar.queries import base as b
from surestar.queries.base import Query, plain, run_sql, table

# References with nulls and with parents that are missing on purpose.
CHILDREN = """
SELECT o_orderkey AS k, CASE WHEN o_orderkey % 7 <> 0 THEN CAST(o_custkey AS STRING) END AS parent_id,
       CAST(o_custkey AS STRING) AS payee_id
FROM {orders}
"""
PARENTS = "SELECT CAST(c_custkey AS STRING) AS id FROM {customer} WHERE c_custkey % 3 <> 0"
OTHER_PARENTS = "SELECT CAST(o_custkey AS STRING) AS id FROM {orders} WHERE o_orderstatus = 'F'"

# Locations with one (province, city) pair in two countries.
PLACES = """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY country NULLS FIRST, n_nationkey) AS BIGINT) AS sk, country, province, city
FROM (
    SELECT 'Argentina' AS country, n_nationkey, r_name AS province, n_name AS city
    FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
    UNION ALL
    SELECT 'Chile', n_nationkey, r_name, n_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
    WHERE n_nationkey % 2 = 0
    UNION ALL
    SELECT NULL, n_nationkey, r_name, n_name FROM {nation} JOIN {region} ON n_regionkey = r_regionkey
    WHERE n_nationkey % 3 = 0
) AS p
"""


def _rows(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_shipdate", F.col("l_extendedprice").cast(MONEY).alias("price")
    ).withColumn("l_shipdate", F.col("l_shipdate").cast("date"))


_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "price"]


def dedupe_keep_last(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.keep_last(_rows(spark, d), ["l_orderkey", "l_linenumber"], _ORDER)


def dedupe_keep_first(spark: SparkSession, d: str) -> DataFrame:
    return dedupe.keep_first(_rows(spark, d), ["l_orderkey", "l_linenumber"], _ORDER)


def dedupe_mark_last(spark: SparkSession, d: str) -> DataFrame:
    """Events in time order: the last one of each user among those with a positive value is flagged."""
    events = table(spark, d, "events").select(
        "user_id", "event_id", F.col("value").cast(MONEY).alias("value"), (F.col("value") >= 5).alias("usable")
    )
    return dedupe.mark_last(events, ["user_id"], "event_id", "usable", "is_last")


def whole_row_dedupe(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").withColumn("known_flag", F.when(F.col("l_returnflag") != "N", F.col("l_returnflag")))
    return dedupe.drop_exact_duplicates(lines, ["l_suppkey", "l_linestatus", "known_flag"])


def ri_semi(spark: SparkSession, d: str) -> DataFrame:
    return refint.semi(run_sql(spark, d, CHILDREN), "parent_id", run_sql(spark, d, PARENTS), "id")


def ri_double_semi(spark: SparkSession, d: str) -> DataFrame:
    once = refint.semi(run_sql(spark, d, CHILDREN), "payee_id", run_sql(spark, d, PARENTS), "id")
    return refint.semi(once, "payee_id", run_sql(spark, d, OTHER_PARENTS), "id")


def ri_null_tolerant(spark: SparkSession, d: str) -> DataFrame:
    return refint.semi_or_null(run_sql(spark, d, CHILDREN), "parent_id", run_sql(spark, d, PARENTS), "id", "k")


def ri_marker(spark: SparkSession, d: str) -> DataFrame:
    return refint.mark_parent(run_sql(spark, d, CHILDREN), "parent_id", run_sql(spark, d, PARENTS), "id", "found", "k")


def anti_new_keys(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part").select("p_partkey", "p_brand")
    return refint.anti(parts, ["p_partkey"], parts.where("p_partkey % 3 <> 0"))


def agg_sum_left(spark: SparkSession, d: str) -> DataFrame:
    lines = table(spark, d, "lineitem").select("l_orderkey", F.col("l_extendedprice").cast(MONEY).alias("price"))
    sums = details.sum_by_key(lines, "l_orderkey", "price", "insured_sum")
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    joined = details.left_details(orders, "o_orderkey", sums, "l_orderkey", "insured_sum")
    return joined.withColumn("insured_sum", F.col("insured_sum").cast("decimal(38,2)"))


def detail_sums(spark: SparkSession, d: str) -> DataFrame:
    """Two detail sums per order; orders without details get 0."""
    lines = table(spark, d, "lineitem").select(
        "l_orderkey", "l_linestatus", F.col("l_extendedprice").cast(MONEY).alias("price"), F.col("l_quantity").cast(MONEY).alias("quantity")
    )
    orders = table(spark, d, "orders").select("o_orderkey")
    assessed = details.sum_by_key(lines, "l_orderkey", "price", "assessed")
    paid = details.sum_by_key(lines.where("l_linestatus = 'F'"), "l_orderkey", "quantity", "paid")
    df = details.left_details(orders, "o_orderkey", assessed, "l_orderkey", "assessed")
    df = details.left_details(df, "o_orderkey", paid, "l_orderkey", "paid")
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(0)).cast("decimal(38,2)") for c in ("assessed", "paid")})


def any_flag(spark: SparkSession, d: str) -> DataFrame:
    """Per customer, whether one of the events is an error; customers without events get false."""
    flags = details.any_by_key(table(spark, d, "events"), "user_id", F.col("event_type") == "error", "is_fraud")
    customers = table(spark, d, "customer").select("c_custkey")
    joined = details.left_details(customers, "c_custkey", flags, "user_id", "is_fraud")
    return joined.withColumn("is_fraud", F.coalesce("is_fraud", F.lit(False)))


def distinct_sorted_keys(spark: SparkSession, d: str) -> DataFrame:
    types = table(spark, d, "events").select("event_type").distinct()
    return keys.keys_in_order(types, ["event_type"], "sk")


def dense_keys(spark: SparkSession, d: str) -> DataFrame:
    customers = table(spark, d, "customer").select("c_name", "c_mktsegment")
    return keys.keys_in_order(customers, ["c_name"], "sk")


def dense_keys_by_hash(spark: SparkSession, d: str) -> DataFrame:
    """Keys for new facts, after the highest key of the facts loaded before."""
    orders = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    loaded = orders.where("o_orderkey % 2 = 0").select((F.col("o_orderkey") + 1).alias("sk"))
    return keys.keys_by_hash(orders.where("o_orderkey % 2 = 1"), "o_orderkey", "sk", keys.max_key(loaded, "sk"))


def _keyed_customers(spark: SparkSession, d: str) -> DataFrame:
    """Two versions of some customers, none of others."""
    customers = table(spark, d, "customer").where("c_custkey % 4 <> 0")
    versions = F.when(F.col("c_custkey") % 5 == 0, F.array(F.lit(1), F.lit(0))).otherwise(F.array(F.lit(0)))
    return customers.select(
        F.col("c_custkey").cast("string").alias("person_id"), "c_custkey", F.explode(versions).alias("v")
    ).select("person_id", (F.col("c_custkey") * 2 + F.col("v") + 1).alias("sk"))


def sk_lookup_default(spark: SparkSession, d: str) -> DataFrame:
    known = lookup.first_by_key(_keyed_customers(spark, d), ["person_id"], "sk")
    children = run_sql(spark, d, CHILDREN).drop("payee_id")
    return lookup.lookup(children, [F.col("parent_id")], known, ["person_id"], {"sk": "holder_sk"}, spread="k")


def sk_lookup_composite(spark: SparkSession, d: str) -> DataFrame:
    """Order -> item -> place -> highest location key of the (province, city) pair."""
    places = run_sql(spark, d, PLACES)
    geography = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    items = table(spark, d, "part").join(geography, F.pmod("p_partkey", F.lit(25)) == F.col("n_nationkey"), "left")
    province = F.concat(F.lit(" "), F.lower("r_name"), F.lit(". "))
    items = items.select("p_partkey", province.alias("province"), F.col("n_name").alias("city"))
    item_places = dims.resolve_place(items, [F.col("province"), F.col("city")], places)
    ordered = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.min("l_partkey").alias("item"))
    orders = table(spark, d, "orders").select("o_orderkey").join(ordered, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    found = lookup.lookup(
        orders.select("o_orderkey", "item"), [F.col("item")], item_places, ["p_partkey"], {"location_sk": "location_sk"}
    )
    return found.select("o_orderkey", "item", "location_sk")


def role_playing_date(spark: SparkSession, d: str) -> DataFrame:
    """Order date and last ship date through one calendar that does not cover all of them."""
    shipped = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.max("l_shipdate").cast("date").alias("shipped"))
    orders = table(spark, d, "orders").select("o_orderkey", F.col("o_orderdate").cast("date").alias("ordered"))
    df = details.left_details(orders, "o_orderkey", shipped, "l_orderkey", "shipped")
    bounds = df.agg(F.add_months(F.min("ordered"), 12).alias("first"), F.max("ordered").alias("last"))
    calendar = keys.keys_in_order(dims.calendar(dims.date_range(bounds)), ["date_id"], "sk")
    df = lookup.lookup(df, [date_key(F.col("ordered"))], calendar, ["date_id"], {"sk": "open_sk"})
    df = lookup.lookup(df, [date_key(F.col("shipped"))], calendar, ["date_id"], {"sk": "close_sk"}, default=None)
    return df.select("o_orderkey", "ordered", "shipped", "open_sk", "close_sk")


def fanout_guard(spark: SparkSession, d: str) -> DataFrame:
    """Customers with country, province and city; the same pair exists in several countries."""
    places = run_sql(spark, d, PLACES)
    geography = table(spark, d, "nation").join(table(spark, d, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    people = table(spark, d, "customer").join(geography, F.col("c_nationkey") == F.col("n_nationkey"))
    country = F.when(F.col("c_custkey") % 5 == 0, "Chile").when(F.col("c_custkey") % 5 != 1, " argentina ")
    people = people.select("c_custkey", country.alias("country"), F.col("r_name").alias("province"), F.col("n_name").alias("city"))
    return dims.resolve_location(people, [F.col("country"), F.col("province"), F.col("city")], places).select("c_custkey", "location_sk")


def union_distinct_location(spark: SparkSession, d: str) -> DataFrame:
    """Nations used by customers or suppliers, by three ways of uniting them."""
    nation = table(spark, d, "nation")

    def used(name: str, prefix: str) -> DataFrame:
        rows = table(spark, d, name)
        return rows.join(nation, F.col(f"{prefix}_nationkey") == F.col("n_nationkey")).select("n_name", "n_regionkey")

    of_customers, of_suppliers = used("customer", "c"), used("supplier", "s")
    distinct = of_customers.unionByName(of_suppliers).dropDuplicates(["n_name", "n_regionkey"])
    keys_only = of_customers.select("n_name").union(of_suppliers.select("n_name")).distinct()
    filled = of_suppliers.select("n_name").distinct().unionByName(distinct, allowMissingColumns=True)
    tagged = [
        distinct.withColumn("way", F.lit("rows")),
        keys_only.withColumns({"n_regionkey": F.lit(None).cast("int"), "way": F.lit("keys")}),
        filled.withColumn("way", F.lit("filled")).select("n_name", "n_regionkey", "way"),
    ]
    return reduce(DataFrame.unionByName, tagged)


def third_parties(spark: SparkSession, d: str) -> DataFrame:
    events = table(spark, d, "events").select(F.col("user_id").cast("string").alias("payee"))
    customers = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("id"))
    known = [(customers.where("c_custkey % 2 = 0"), "id"), (customers.where("c_custkey % 5 = 0"), "id")]
    return dims.third_parties(events, "payee", known)


def master_geography(spark: SparkSession, d: str) -> DataFrame:
    provinces = table(spark, d, "region").select(F.col("r_regionkey").alias("id"), F.concat(F.lit("Córdoba "), "r_name").alias("nombre"))
    localities = table(spark, d, "customer").join(table(spark, d, "nation"), F.col("c_nationkey") == F.col("n_nationkey")).select(
        F.col("n_regionkey").alias("provincia_id"), F.concat(F.lit(" ñandú "), F.lower("n_name")).alias("nombre")
    )
    return dims.master_geography(provinces, localities)


_DEDUPED = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate::DATE AS l_shipdate, l_extendedprice::DECIMAL(12,2) AS price
FROM lineitem
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
                           ORDER BY l_shipdate::DATE {o}, l_partkey {o}, l_suppkey {o}, price {o}) = 1
"""

_PLACE_KEY = f"upper({b.sql_junk('province')}) AS province_key, upper({b.sql_junk('city')}) AS city_key"

QUERIES = {
    "dedupe_keep_last": Query(dedupe_keep_last, _DEDUPED.format(o="DESC")),
    "dedupe_keep_first": Query(dedupe_keep_first, _DEDUPED.format(o="ASC")),
    "dedupe_mark_last": Query(
        dedupe_mark_last,
        """SELECT user_id, event_id, value::DECIMAL(12,2) AS value, value >= 5 AS usable,
                  coalesce(event_id = max(event_id) FILTER (value >= 5) OVER (PARTITION BY user_id), false) AS is_last
           FROM events""",
    ),
    "whole_row_dedupe": Query(
        whole_row_dedupe,
        "SELECT DISTINCT l_suppkey, l_linestatus, nullif(l_returnflag, 'N') AS known_flag FROM lineitem",
    ),
    "ri_semi": Query(
        ri_semi, f"SELECT * FROM ({plain(CHILDREN)}) WHERE parent_id IN (SELECT id FROM ({plain(PARENTS)}))"
    ),
    "ri_double_semi": Query(
        ri_double_semi,
        f"""SELECT * FROM ({plain(CHILDREN)}) WHERE payee_id IN (SELECT id FROM ({plain(PARENTS)}))
            AND payee_id IN (SELECT id FROM ({plain(OTHER_PARENTS)}))""",
    ),
    "ri_null_tolerant": Query(
        ri_null_tolerant,
        f"""SELECT * FROM ({plain(CHILDREN)})
            WHERE parent_id IS NULL OR parent_id IN (SELECT id FROM ({plain(PARENTS)}))""",
    ),
    "ri_marker": Query(
        ri_marker,
        f"""SELECT *, coalesce(parent_id IN (SELECT id FROM ({plain(PARENTS)})), false) AS found
            FROM ({plain(CHILDREN)})""",
    ),
    "anti_new_keys": Query(anti_new_keys, "SELECT p_partkey, p_brand FROM part WHERE p_partkey % 3 = 0"),
    "agg_sum_left": Query(
        agg_sum_left,
        """SELECT o_orderkey, o_custkey, s.insured_sum FROM orders LEFT JOIN (
               SELECT l_orderkey, sum(l_extendedprice::DECIMAL(12,2)) AS insured_sum FROM lineitem GROUP BY 1
           ) s ON o_orderkey = l_orderkey""",
    ),
    "detail_sums": Query(
        detail_sums,
        """SELECT o_orderkey, coalesce(sum(l_extendedprice::DECIMAL(12,2)), 0) AS assessed,
                  coalesce(sum(l_quantity::DECIMAL(12,2)) FILTER (l_linestatus = 'F'), 0) AS paid
           FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY 1""",
    ),
    "any_flag": Query(
        any_flag,
        """SELECT c_custkey, c_custkey IN (SELECT user_id FROM events WHERE event_type = 'error') AS is_fraud
           FROM customer""",
    ),
    "distinct_sorted_keys": Query(
        distinct_sorted_keys,
        "SELECT row_number() OVER (ORDER BY event_type) AS sk, event_type FROM (SELECT DISTINCT event_type FROM events)",
    ),
    "dense_keys": Query(
        dense_keys, "SELECT row_number() OVER (ORDER BY c_name) AS sk, c_name, c_mktsegment FROM customer"
    ),
    "dense_keys_by_hash": Query(
        dense_keys_by_hash,
        """SELECT (SELECT max(o_orderkey) + 1 FROM orders WHERE o_orderkey % 2 = 0)
                  + row_number() OVER (ORDER BY md5(o_orderkey::VARCHAR), o_orderkey) AS sk, o_orderkey, o_custkey
           FROM orders WHERE o_orderkey % 2 = 1""",
    ),
    "sk_lookup_default": Query(
        sk_lookup_default,
        f"""SELECT k, parent_id, CASE WHEN parent_id IS NULL OR parent_id::BIGINT % 4 = 0
                   OR parent_id::BIGINT NOT IN (SELECT c_custkey FROM customer) THEN -1
                   ELSE parent_id::BIGINT * 2 + 1 END AS holder_sk
            FROM ({plain(CHILDREN)})""",
    ),
    "sk_lookup_composite": Query(
        sk_lookup_composite,
        f"""WITH places AS ({plain(PLACES)}),
            known AS (SELECT upper(trim(province)) AS province_key, upper(trim(city)) AS city_key, max(sk) AS location_sk
                      FROM places GROUP BY 1, 2),
            items AS (SELECT p_partkey, {_PLACE_KEY} FROM (
                SELECT p_partkey, ' ' || lower(r_name) || '. ' AS province, n_name AS city FROM part
                LEFT JOIN nation ON p_partkey % 25 = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey)),
            ordered AS (SELECT l_orderkey, min(l_partkey) AS item FROM lineitem GROUP BY 1)
            SELECT o_orderkey, item, coalesce(location_sk, -1) AS location_sk
            FROM orders LEFT JOIN ordered ON o_orderkey = l_orderkey LEFT JOIN items ON item = p_partkey
            LEFT JOIN known USING (province_key, city_key)""",
    ),
    "role_playing_date": Query(
        role_playing_date,
        f"""WITH df AS (SELECT o_orderkey, o_orderdate::DATE AS ordered, max(l_shipdate)::DATE AS shipped
                        FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey GROUP BY ALL),
            days AS (SELECT unnest(generate_series(min(ordered) + INTERVAL 12 MONTH, max(ordered), INTERVAL 1 DAY))::DATE
                     AS day FROM df),
            cal AS (SELECT {b.sql_date_key('day')} AS date_id, row_number() OVER (ORDER BY day) AS sk FROM days)
            SELECT o_orderkey, ordered, shipped, coalesce(a.sk, -1) AS open_sk, c.sk AS close_sk
            FROM df LEFT JOIN cal a ON a.date_id = {b.sql_date_key('ordered')}
            LEFT JOIN cal c ON c.date_id = {b.sql_date_key('shipped')}""",
    ),
    "fanout_guard": Query(
        fanout_guard,
        f"""WITH places AS ({plain(PLACES)})
            SELECT c_custkey, min(sk) AS location_sk
            FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
            LEFT JOIN places ON province = r_name AND city = n_name AND country IS NOT DISTINCT FROM
                (CASE WHEN c_custkey % 5 = 0 THEN 'Chile' WHEN c_custkey % 5 <> 1 THEN 'Argentina' END)
            GROUP BY c_custkey""",
    ),
    "union_distinct_location": Query(
        union_distinct_location,
        """WITH c AS (SELECT n_name, n_regionkey FROM customer JOIN nation ON c_nationkey = n_nationkey),
                s AS (SELECT n_name, n_regionkey FROM supplier JOIN nation ON s_nationkey = n_nationkey),
                u AS (SELECT * FROM c UNION SELECT * FROM s)
           SELECT n_name, n_regionkey, 'rows' AS way FROM u
           UNION ALL SELECT DISTINCT n_name, NULL::INT, 'keys' FROM u
           UNION ALL SELECT DISTINCT n_name, NULL::INT, 'filled' FROM s
           UNION ALL SELECT n_name, n_regionkey, 'filled' FROM u""",
    ),
    "third_parties": Query(
        third_parties,
        """SELECT DISTINCT user_id::VARCHAR AS person_id, NULL::BIGINT AS location_sk, NULL::VARCHAR AS occupation,
                  NULL::VARCHAR AS segment, NULL::VARCHAR AS sex, true AS is_third_party
           FROM events WHERE user_id NOT IN
               (SELECT c_custkey FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 5 = 0)""",
    ),
    "master_geography": Query(
        master_geography,
        """SELECT DISTINCT 'CORDOBA ' || upper(r_name) AS provincia, 'NANDU ' || upper(n_name) AS localidad
           FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    ),
}
