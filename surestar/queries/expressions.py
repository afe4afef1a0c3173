"""Column functions: text, numbers, dates, classifications."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from surestar.functions import classify as cl
from surestar.functions import parse as p
from surestar.functions import text as t
from surestar.operators.rules import Rule, reasons
from surestar.queries import base as b
from surestar.queries.base import AS_OF, Query, plain, run_sql, table

TAB, ZERO_WIDTH = "\t", "\u200b"

DIRTY_PLACES = f"""
SELECT p_partkey AS k,
       CASE p_partkey % 9
            WHEN 0 THEN '  ' || p_name || '. '
            WHEN 1 THEN '{TAB}' || upper(p_name) || '..'
            WHEN 2 THEN p_name || '{ZERO_WIDTH}'
            WHEN 3 THEN 'N/D'
            WHEN 4 THEN ' . '
            WHEN 5 THEN NULL
            WHEN 6 THEN 'o''higgins ' || p_brand
            WHEN 7 THEN 'san-' || p_type || ' 3ra'
            ELSE 'Pendiente.' END AS place
FROM {{part}}
"""

DIRTY_NAMES = """
SELECT s_suppkey AS k,
       CASE WHEN s_suppkey % 3 <> 0 THEN s_name END AS last_name,
       CASE WHEN s_suppkey % 5 <> 0 THEN 'José' END AS first_name
FROM {supplier}
"""

DIRTY_NUMBERS = """
SELECT o_orderkey AS k,
       CASE o_orderkey % 12
            WHEN 0 THEN 'abc' WHEN 1 THEN '1,5' WHEN 2 THEN ' 7 ' WHEN 3 THEN NULL WHEN 4 THEN '' WHEN 5 THEN '1e3'
            WHEN 6 THEN '1e400' WHEN 7 THEN '-.5' WHEN 8 THEN '1d' WHEN 9 THEN 'nan' WHEN 10 THEN '12.345'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS amount
FROM {orders}
"""

DIRTY_DATES = """
SELECT o_orderkey AS k,
       CASE o_orderkey % 13
            WHEN 0 THEN 'ayer' WHEN 1 THEN NULL WHEN 2 THEN '2011' WHEN 3 THEN '2011-02-30'
            WHEN 4 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:20:30'
            WHEN 5 THEN replace(CAST(CAST(o_orderdate AS DATE) AS STRING), '-', '/')
            WHEN 6 THEN ' ' || CAST(CAST(o_orderdate AS DATE) AS STRING) || ' '
            WHEN 7 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:00:00.000'
            WHEN 8 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || 'T10:00:00Z'
            WHEN 9 THEN CAST(CAST(o_orderdate AS DATE) AS STRING) || ' 10:00'
            WHEN 10 THEN '2024-1-5' WHEN 11 THEN '31/01/2024'
            ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS day
FROM {orders}
"""

DIRTY_TOKENS = """
SELECT event_id AS k,
       CASE event_id % 9
            WHEN 0 THEN 'True' WHEN 1 THEN ' 1 ' WHEN 2 THEN 'FALSE' WHEN 3 THEN '0' WHEN 4 THEN NULL
            WHEN 5 THEN 'quizás' WHEN 6 THEN '' WHEN 7 THEN 'true' ELSE event_type END AS token
FROM {events}
"""

FAULTY_EVENTS = """
SELECT event_id AS k,
       CASE WHEN event_id % 50 = 1 THEN NULL WHEN event_id % 50 = 2 THEN '  '
            ELSE ' E' || CAST(event_id AS STRING) || ' ' END AS id,
       CAST(ts AS DATE) AS opened,
       CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST(ts AS DATE) - 3
            ELSE CAST(ts AS DATE) + CAST(event_id % 30 AS INT) END AS closed,
       CAST(CASE WHEN event_id % 41 = 0 THEN -value ELSE value END AS DECIMAL(12,2)) AS amount,
       CASE event_id % 6 WHEN 0 THEN 'Web' WHEN 1 THEN 'call center' WHEN 2 THEN 'Teléfono' WHEN 3 THEN NULL
            WHEN 4 THEN 'Agente' ELSE 'sucursal ' END AS channel,
       CASE event_id % 5 WHEN 0 THEN 'Sí' WHEN 1 THEN 'no' WHEN 2 THEN 'TRUE' WHEN 3 THEN '1' ELSE NULL END AS active
FROM {events}
"""


def canonical_text(spark: SparkSession, d: str) -> DataFrame:
    """Whole texts in canonical form."""
    documents = table(spark, d, "documents").select("doc_id", "text")
    cleaned = t.canonical_columns(documents, ["text", "not_there"])
    return cleaned.select("doc_id", F.col("text").alias("canonical"))


def title_junk_clean(spark: SparkSession, d: str) -> DataFrame:
    places = run_sql(spark, d, DIRTY_PLACES)
    return places.select("k", t.clean_junk(F.col("place")).alias("cleaned"), t.title(F.col("place")).alias("titled"))


def full_name(spark: SparkSession, d: str) -> DataFrame:
    names = run_sql(spark, d, DIRTY_NAMES)
    return names.select("k", t.full_name(F.col("first_name"), F.col("last_name")).alias("full_name"))


def capitalise_type(spark: SparkSession, d: str) -> DataFrame:
    parts = table(spark, d, "part")
    return parts.select("p_partkey", t.capitalise(F.concat(F.lit("  "), "p_type", F.lit(" "))).alias("kind"))


def map_with_null(spark: SparkSession, d: str) -> DataFrame:
    level = t.map_values(
        F.col("o_orderpriority"), {"PREMIUM": ("1-URGENT", "2-HIGH"), "Extendida": ("3-MEDIUM",), "BASICA": ("5-LOW",)}
    )
    return table(spark, d, "orders").select("o_orderkey", cl.plan_category(level).alias("plan_category"))


def map_with_default(spark: SparkSession, d: str) -> DataFrame:
    spelling = F.when(F.col("c_mktsegment") == "HOUSEHOLD", " Mujer ").when(
        F.col("c_mktsegment") == "MACHINERY", "varón"
    ).when(F.col("c_mktsegment") == "FURNITURE", "m").otherwise(F.col("c_mktsegment"))
    return table(spark, d, "customer").select("c_custkey", cl.sex_code(spelling).alias("sex"))


def keyword_class(spark: SparkSession, d: str) -> DataFrame:
    """Ordered keyword classes of part names, and the employment classes of decorated segments."""
    colours = [("warm", ("RED", "ORANGE", "YELLOW")), ("cold", ("BLUE", "GREEN")), ("metal", ("BOLT", "RING"))]
    job = F.element_at(
        F.array(*[F.lit(x) for x in (
            "Unemployed", "self-employed", "Jubilación", "Licencia médica", "inactivo", "Temporary", "  ", "Student",
        )]),
        (F.col("p_partkey") % 8 + 1).cast("int"),
    )
    return table(spark, d, "part").select(
        "p_partkey",
        t.keyword_class(F.col("p_name"), colours, "other").alias("colour_class"),
        cl.employment_class(F.when(F.col("p_partkey") % 11 != 0, job)).alias("employment"),
    )


def lenient_number(spark: SparkSession, d: str) -> DataFrame:
    numbers = run_sql(spark, d, DIRTY_NUMBERS)
    return numbers.select(
        "k",
        p.lenient_number(F.col("amount"), p.MONEY).alias("money"),
        p.lenient_integer(F.col("amount")).alias("whole"),
        p.number_coerced(F.col("amount"), p.MONEY).alias("coerced"),
    )


def lenient_date(spark: SparkSession, d: str) -> DataFrame:
    return p.lenient_dates(run_sql(spark, d, DIRTY_DATES), ["day", "not_there"])


def token_bool(spark: SparkSession, d: str) -> DataFrame:
    return run_sql(spark, d, DIRTY_TOKENS).select("k", p.has_token(F.col("token")).alias("is_true"))


def bool_loose(spark: SparkSession, d: str) -> DataFrame:
    tokens = run_sql(spark, d, DIRTY_TOKENS)
    return tokens.select(
        "k", p.token_flag(F.col("token")).alias("flag"), p.token_unknown(F.col("token")).alias("is_unknown")
    )


def age_segment(spark: SparkSession, d: str) -> DataFrame:
    birth = F.make_date(F.lit(2020) - (F.col("c_custkey") % 110).cast("int"), F.lit(11), F.lit(30))
    age = cl.age_in_year(birth, AS_OF)
    people = table(spark, d, "customer").select("c_custkey", age.alias("age"))
    return people.where(F.col("age").between(cl.MIN_AGE, cl.MAX_AGE)).select(
        "c_custkey", "age", cl.age_segment(F.col("age")).alias("segment")
    )


def filter_rules(spark: SparkSession, d: str) -> DataFrame:
    """Each filter as one column, on events with injected faults."""
    events = run_sql(spark, d, FAULTY_EVENTS)
    clean_id = p.clean_id(F.col("id"))
    channel = t.canonical(F.col("channel"))
    opened, closed = F.col("opened"), F.col("closed")
    rules = [
        Rule("missing_key", clean_id.isNotNull()),
        Rule("negative_amount", F.col("amount") >= 0),
        Rule("closed_before_open", closed.isNull() | (closed >= opened)),
        Rule("inactive", cl.active_agent(F.col("active"))),
        Rule("unknown_channel", channel.isin(*cl.CHANNELS)),
        Rule("missing_close_date", closed.isNotNull()),
    ]
    return events.select(
        "k",
        clean_id.alias("id"),
        *[F.coalesce(rule.holds, F.lit(False)).alias(f"ok_{rule.name}") for rule in rules],
        F.array_join(reasons(rules), "|").alias("reasons"),
    )


def attribute_hash(spark: SparkSession, d: str) -> DataFrame:
    balance = F.when(F.col("c_custkey") % 4 != 0, F.col("c_acctbal").cast(p.MONEY))
    customers = table(spark, d, "customer")
    return customers.select("c_custkey", t.row_hash([F.col("c_name"), F.col("c_nationkey"), balance]).alias("attr_hash"))


def project_rename(spark: SparkSession, d: str) -> DataFrame:
    """Pruned and filtered scan, renamed, with a constant and the load date."""
    return (
        table(spark, d, "orders")
        .where("o_orderstatus = 'F'")
        .drop("o_totalprice", "o_orderpriority")
        .withColumnsRenamed({"o_orderkey": "policy_id", "o_custkey": "holder_id", "o_orderstatus": "state"})
        .withColumns({
            "country": F.lit("Argentina"),
            "is_third_party": F.lit(False),
            "loaded_on": F.lit(AS_OF).cast("date"),
            "sale_date": F.col("o_orderdate").cast("date"),
        })
        .select("policy_id", "holder_id", "state", "country", "is_third_party", "loaded_on", "sale_date")
    )


_FILTERS = [
    ("missing_key", b.sql_id("id") + " IS NOT NULL"),
    ("negative_amount", "amount >= 0"),
    ("closed_before_open", "closed IS NULL OR closed >= opened"),
    ("inactive", "upper(trim(active)) IN ('TRUE', '1', 'SI', 'SÍ')"),
    ("unknown_channel", b.sql_canonical("channel") + " IN ('SUCURSAL', 'CALL CENTER', 'AGENTE', 'WEB')"),
    ("missing_close_date", "closed IS NOT NULL"),
]

QUERIES = {
    "canonical_text": Query(
        canonical_text, f"SELECT doc_id, {b.sql_canonical('text')} AS canonical FROM documents"
    ),
    "title_junk_clean": Query(
        title_junk_clean,
        f"SELECT k, {b.sql_junk('place')} AS cleaned, {b.sql_title('place')} AS titled FROM ({plain(DIRTY_PLACES)})",
    ),
    "full_name": Query(
        full_name, f"SELECT k, {b.sql_full_name('first_name', 'last_name')} AS full_name FROM ({plain(DIRTY_NAMES)})"
    ),
    "capitalise_type": Query(
        capitalise_type,
        "SELECT p_partkey, upper(substring(trim(p_type), 1, 1)) || lower(substring(trim(p_type), 2)) AS kind FROM part",
    ),
    "map_with_null": Query(
        map_with_null,
        """SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'Premium' WHEN '2-HIGH' THEN 'Premium'
                  WHEN '3-MEDIUM' THEN 'Estandar' WHEN '5-LOW' THEN 'Basico' END AS plan_category FROM orders""",
    ),
    "map_with_default": Query(
        map_with_default,
        """SELECT c_custkey, CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'F' WHEN 'MACHINERY' THEN 'M'
                  WHEN 'FURNITURE' THEN 'M' ELSE 'O' END AS sex FROM customer""",
    ),
    "keyword_class": Query(
        keyword_class,
        f"""SELECT p_partkey,
                   CASE WHEN regexp_matches(upper(p_name), 'RED|ORANGE|YELLOW') THEN 'warm'
                        WHEN regexp_matches(upper(p_name), 'BLUE|GREEN') THEN 'cold'
                        WHEN regexp_matches(upper(p_name), 'BOLT|RING') THEN 'metal' ELSE 'other' END AS colour_class,
                   {b.sql_employment('job')} AS employment
            FROM (SELECT *, CASE WHEN p_partkey % 11 <> 0 THEN ['Unemployed', 'self-employed', 'Jubilación',
                         'Licencia médica', 'inactivo', 'Temporary', '  ', 'Student'][p_partkey % 8 + 1] END AS job
                  FROM part)""",
    ),
    "lenient_number": Query(
        lenient_number,
        f"""SELECT k, {b.sql_number_or_0('amount', 'DECIMAL(12,2)')} AS money,
                   {b.sql_integer_or_0('amount')} AS whole,
                   {b.sql_id('amount')} IS NOT NULL AND ({b.sql_number('amount', 'DECIMAL(12,2)')}) IS NULL AS coerced
            FROM ({plain(DIRTY_NUMBERS)})""",
    ),
    "lenient_date": Query(lenient_date, f"SELECT k, {b.sql_date('day')} AS day FROM ({plain(DIRTY_DATES)})"),
    "token_bool": Query(token_bool, f"SELECT k, {b.sql_true('token')} AS is_true FROM ({plain(DIRTY_TOKENS)})"),
    "bool_loose": Query(
        bool_loose,
        f"""SELECT k, CASE WHEN lower(trim(token)) IN ('true', '1') THEN true
                           WHEN lower(trim(token)) IN ('false', '0') THEN false END AS flag,
                   trim(coalesce(token, '')) <> '' AND lower(trim(token)) NOT IN ('true', '1', 'false', '0')
                   AS is_unknown
            FROM ({plain(DIRTY_TOKENS)})""",
    ),
    "age_segment": Query(
        age_segment,
        f"""SELECT c_custkey, age, {b.sql_segment('age')} AS segment
            FROM (SELECT c_custkey, (2026 - (2020 - c_custkey % 110))::INT AS age FROM customer)
            WHERE age BETWEEN 18 AND 100""",
    ),
    "filter_rules": Query(
        filter_rules,
        f"""SELECT k, {b.sql_id('id')} AS id,
                   {', '.join(f'coalesce({holds}, false) AS ok_{name}' for name, holds in _FILTERS)},
                   {b.sql_reasons(*_FILTERS)} AS reasons
            FROM ({plain(FAULTY_EVENTS)})""",
    ),
    "attribute_hash": Query(
        attribute_hash,
        """SELECT c_custkey, md5(concat_ws('|', c_name, c_nationkey::VARCHAR, CASE WHEN c_custkey % 4 <> 0
                  THEN c_acctbal::DECIMAL(12,2)::VARCHAR ELSE '<null>' END)) AS attr_hash FROM customer""",
    ),
    "project_rename": Query(
        project_rename,
        """SELECT o_orderkey AS policy_id, o_custkey AS holder_id, o_orderstatus AS state, 'Argentina' AS country,
                  false AS is_third_party, DATE '2026-06-30' AS loaded_on, o_orderdate::DATE AS sale_date
           FROM orders WHERE o_orderstatus = 'F'""",
    ),
}
