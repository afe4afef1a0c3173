"""Stand-ins for the insurer's tables, as SQL that both engines read alike.

``RAW`` are dirty feeds (text columns and an ordinal) for the curation queries; ``CLEAN`` are curated tables for the
dimension and fact queries. Both cover all rows of the driver tables. Parents have gaps where a query needs references
that do not exist; some amounts and texts are too large, some claims have no policy, no type or a date before the calendar.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from surestar.queries.base import run_sql

TAB = "\t"

RAW = {
    "clients": f"""
SELECT c_custkey * 2 + copy AS _ordinal,
       CASE WHEN c_custkey % 50 = 3 THEN NULL WHEN c_custkey % 50 = 4 THEN '   '
            WHEN c_custkey % 50 = 5 THEN '  C' || CAST(c_custkey AS STRING) || ' '
            ELSE 'C' || CAST(c_custkey AS STRING) END AS id_cliente,
       CASE c_custkey % 4 WHEN 0 THEN ' josé ' WHEN 1 THEN 'Ana-María' WHEN 2 THEN NULL ELSE c_name END AS nombre,
       CASE WHEN copy = 0 THEN 'Anterior' WHEN c_custkey % 6 = 2 THEN NULL WHEN c_custkey % 6 = 3 THEN 'Müller-Núñez'
            ELSE 'Peña ' || CAST(c_custkey AS STRING) END AS apellido,
       CASE WHEN c_custkey % 31 = 0 THEN 'Chile' WHEN c_custkey % 37 = 0 THEN NULL
            WHEN c_custkey % 2 = 0 THEN ' argentina ' ELSE 'Argentina' END AS pais,
       CASE WHEN c_custkey % 29 = 1 THEN NULL WHEN c_custkey % 7 = 1 THEN lower(r_name) || '.' ELSE r_name END AS provincia,
       CASE WHEN c_custkey % 41 = 1 THEN ' ' WHEN c_custkey % 5 = 1 THEN '{TAB}' || n_name ELSE n_name END AS localidad,
       CASE WHEN c_custkey % 43 = 1 THEN 'sin fecha' WHEN c_custkey % 47 = 1 THEN NULL
            WHEN c_custkey % 10 = 9 THEN CAST(2009 - c_custkey % 85 AS STRING) || '/03/09'
            ELSE CAST(2009 - c_custkey % 85 AS STRING) || '-11-30' END AS fecha_nacimiento,
       CASE c_custkey % 9 WHEN 0 THEN 'M' WHEN 1 THEN 'masculino' WHEN 2 THEN 'Hombre' WHEN 3 THEN ' varón'
            WHEN 4 THEN 'F' WHEN 5 THEN 'Femenino' WHEN 6 THEN 'MUJER' WHEN 7 THEN 'x' END AS sexo,
       CASE c_custkey % 10 WHEN 0 THEN 'Employed' WHEN 1 THEN 'Self-Employed' WHEN 2 THEN 'Desempleado'
            WHEN 3 THEN 'RETIRED' WHEN 4 THEN 'Licencia médica' WHEN 5 THEN 'INACTIVO' WHEN 6 THEN 'Temporary'
            WHEN 7 THEN '  ' WHEN 8 THEN NULL ELSE 'Student' END AS situacion_laboral
FROM (SELECT *, 1 AS copy FROM {{customer}}
      UNION ALL SELECT *, 0 AS copy FROM {{customer}} WHERE c_custkey % 20 = 7) AS c
JOIN {{nation}} ON c_nationkey = n_nationkey JOIN {{region}} ON n_regionkey = r_regionkey
""",
    "agents": """
SELECT s_suppkey AS _ordinal,
       CASE WHEN s_suppkey % 30 = 4 THEN NULL ELSE ' A' || CAST(s_suppkey AS STRING) END AS id_agente,
       'Iñés' AS nombre, CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE s_name END AS apellido,
       CASE WHEN s_suppkey % 20 = 9 THEN 'Teléfono' WHEN s_suppkey % 4 = 0 THEN 'Sucursal'
            WHEN s_suppkey % 4 = 1 THEN 'call center' WHEN s_suppkey % 4 = 2 THEN ' Agente' ELSE 'Web' END AS canal,
       'Sucursal Tucumán' AS sucursal, 'Córdoba' AS zona, 'a' || CAST(s_suppkey AS STRING) || '@b.ar' AS email,
       CASE WHEN s_suppkey % 33 = 2 THEN 'n/a' ELSE CAST(2005 + s_suppkey % 17 AS STRING) || '-05-10' END AS fecha_ingreso,
       CASE s_suppkey % 8 WHEN 0 THEN 'True' WHEN 1 THEN '1' WHEN 2 THEN ' si ' WHEN 3 THEN 'SÍ' WHEN 4 THEN 'TRUE'
            WHEN 5 THEN 'False' ELSE 'true' END AS activo
FROM {supplier}
""",
    "adjusters": """
SELECT s_suppkey * 2 + copy AS _ordinal,
       CASE WHEN s_suppkey % 30 = 5 THEN '  ' ELSE 'S' || CAST(s_suppkey AS STRING) || ' ' END AS id_perito,
       CASE WHEN copy = 0 THEN 'viejo' ELSE ' Benjamín' END AS nombre,
       CASE WHEN s_suppkey % 6 = 1 THEN NULL ELSE s_name END AS apellido,
       'Incendio' AS especialidad, n_name AS zona_cobertura, 'False' AS activo
FROM (SELECT *, 1 AS copy FROM {supplier}
      UNION ALL SELECT *, 0 AS copy FROM {supplier} WHERE s_suppkey % 10 = 7) AS s
JOIN {nation} ON s_nationkey = n_nationkey
""",
    "policies": """
SELECT o_orderkey * 2 + copy AS _ordinal,
       CASE WHEN o_orderkey % 200 = 11 THEN NULL WHEN o_orderkey % 200 = 12 THEN ' '
            ELSE 'O' || CAST(o_orderkey AS STRING) END AS id_poliza,
       CASE WHEN o_orderkey % 150 = 13 THEN 'C-none' WHEN o_orderkey % 150 = 14 THEN NULL
            ELSE ' C' || CAST(o_custkey AS STRING) END AS id_cliente,
       'A' || CAST(agent AS STRING) AS id_agente,
       CASE WHEN o_orderkey % 10 <> 0 THEN 'C' || CAST(o_custkey AS STRING) END AS id_asegurado,
       'P' || CAST(item AS STRING) AS id_objeto_asegurado,
       ' Automóvil' AS tipo_seguro,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'premium' WHEN '2-HIGH' THEN 'Premium ' WHEN '3-MEDIUM' THEN 'Extendida'
            WHEN '5-LOW' THEN 'Básica' ELSE 'otra' END AS cobertura,
       o_orderstatus AS estado,
       CASE WHEN o_orderkey % 300 = 14 THEN 'ayer' ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS fecha_alta,
       CAST(CAST(o_orderdate AS DATE) + 30 AS STRING) || ' 00:00:00' AS vigencia_desde,
       CASE WHEN copy = 0 THEN '1.00' WHEN o_orderkey % 250 = 15 THEN 'abc' WHEN o_orderkey % 250 = 16 THEN '1e400'
            ELSE CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS STRING) END AS prima_mensual,
       CASE WHEN o_orderkey % 40 = 1 THEN '2.7' ELSE ' 3 ' END AS numero_polizas_cliente
FROM (SELECT *, 1 AS copy FROM {orders}
      UNION ALL SELECT *, 0 AS copy FROM {orders} WHERE o_orderkey % 25 = 7) AS o
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS item, MIN(l_suppkey) AS agent FROM {lineitem} GROUP BY l_orderkey) AS l
ON o_orderkey = l_orderkey
""",
    "items": """
SELECT p_partkey AS _ordinal,
       CASE WHEN p_partkey % 70 = 6 THEN NULL ELSE 'P' || CAST(p_partkey AS STRING) || ' ' END AS id_objeto,
       lower(p_type) AS tipo_objeto, p_name || ' añejo' AS descripcion,
       CASE WHEN p_partkey % 23 = 0 THEN '-' WHEN p_partkey % 9 = 0 THEN n_name || '.' ELSE n_name END AS localidad,
       r_name AS provincia, p_brand AS marca,
       CASE WHEN p_partkey % 35 = 1 THEN 'mucho' WHEN p_partkey % 45 = 2 THEN '99999999999.00' ELSE CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS STRING) || '4' END
       AS valor_asegurado,
       CAST(p_size AS STRING) || '.5' AS superficie_m2
FROM {part} JOIN {nation} ON p_partkey % 25 = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""",
    "coverages": """
SELECT l_orderkey * 10 + l_linenumber AS _ordinal,
       CASE WHEN (l_orderkey + l_partkey) % 80 = 1 THEN '  ' ELSE ' O' || CAST(l_orderkey AS STRING) END AS id_poliza,
       CASE l_returnflag WHEN 'A' THEN ' rOBO total' WHEN 'N' THEN 'INCENDIO' ELSE 'daños ' END AS tipo_garantia,
       CASE (l_orderkey + l_partkey) % 90 WHEN 1 THEN '-5' WHEN 2 THEN NULL WHEN 3 THEN 'x' WHEN 4 THEN '0'
            ELSE CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING) END AS suma_garantizada,
       CASE (l_partkey + l_suppkey) % 20 WHEN 0 THEN 'False' WHEN 1 THEN ' 1 ' WHEN 2 THEN NULL ELSE 'True' END AS activa
FROM {lineitem}
""",
    "claims": """
SELECT event_id * 2 + copy AS _ordinal,
       'E' || CAST(event_id AS STRING) AS id_parte,
       CASE WHEN event_id % 110 = 1 THEN NULL WHEN event_id % 110 = 2 THEN 'nan'
            ELSE 'O' || CAST(first_order AS STRING) END AS id_poliza,
       CASE WHEN event_id % 90 = 3 THEN 'P-none' WHEN event_id % 90 = 4 THEN '<NA>'
            ELSE 'P' || CAST(item AS STRING) END AS id_objeto_asegurado,
       CASE WHEN event_id % 80 = 5 THEN NULL WHEN event_id % 85 = 6 THEN 'S-none'
            ELSE 'S' || CAST(event_id % 12 AS STRING) END AS id_perito,
       CASE WHEN event_id % 70 = 7 THEN ' ' ELSE 'C' || CAST(user_id AS STRING) END AS id_denunciante,
       CASE WHEN event_id % 75 = 8 THEN 'C-none' ELSE ' C' || CAST(user_id AS STRING) END AS id_receptor_pago,
       CASE WHEN event_id % 120 = 9 THEN 'pronto' ELSE CAST(CAST(ts AS DATE) AS STRING) END AS fecha_apertura,
       CASE WHEN event_id % 4 = 0 THEN NULL WHEN event_id % 97 = 0 THEN CAST(CAST(ts AS DATE) - 3 AS STRING)
            ELSE CAST(CAST(ts AS DATE) + CAST(event_id % 30 AS INT) AS STRING) END AS fecha_cierre,
       CASE WHEN copy = 0 THEN '1' WHEN event_id % 50 = 0 THEN 'abc'
            ELSE CAST(CAST(CASE WHEN event_id % 41 = 0 THEN -value ELSE value END AS DECIMAL(12,2)) AS STRING) END
       AS monto_reclamado,
       CASE WHEN event_id % 65 = 10 THEN '-2' WHEN event_id % 65 = 11 THEN 'x'
            ELSE CAST(event_id % 30 AS STRING) END AS dias_resolucion,
       ' Robó ' || event_type AS tipo_siniestro, 'abierto' AS estado
FROM (SELECT *, 1 AS copy FROM {events}
      UNION ALL SELECT *, 0 AS copy FROM {events} WHERE event_id % 30 = 7) AS e
LEFT JOIN (SELECT o_custkey, MIN(o_orderkey) AS first_order FROM {orders} GROUP BY o_custkey) AS p ON user_id = o_custkey
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS item FROM {lineitem} GROUP BY l_orderkey) AS l ON first_order = l_orderkey
""",
    "assessments": """
SELECT event_id AS _ordinal, 'V' || CAST(event_id AS STRING) AS id_evaluacion,
       CASE WHEN event_id % 60 = 2 THEN NULL ELSE ' E' || CAST(event_id - event_id % 4 AS STRING) END AS id_parte,
       'S' || CAST(event_id % 12 AS STRING) AS id_perito,
       CASE WHEN event_id % 90 = 4 THEN '?' ELSE CAST(CAST(ts AS DATE) + 5 AS STRING) END AS fecha_visita,
       CASE WHEN event_id % 70 = 6 THEN 'n/d'
            ELSE CAST(CAST(CAST(value AS DECIMAL(12,2)) * 0.9 AS DECIMAL(12,2)) AS STRING) END AS monto_estimado_dano,
       'Daño según ' || event_type AS dictamen,
       CASE event_id % 6 WHEN 0 THEN 'False' WHEN 2 THEN 'True' ELSE 'tal vez' END AS requiere_reinspeccion
FROM {events}
""",
    "payments": """
SELECT event_id AS _ordinal, 'G' || CAST(event_id - event_id % 2 AS STRING) AS id_pago,
       'E' || CAST(event_id AS STRING) AS id_parte,
       CASE WHEN event_id % 60 = 3 THEN NULL ELSE 'C' || CAST(user_id AS STRING) END AS id_receptor,
       CAST(CAST(CAST(value AS DECIMAL(12,2)) * 0.8 AS DECIMAL(12,2)) AS STRING) AS monto_pagado,
       CAST(CAST(ts AS DATE) + 40 AS STRING) AS fecha_pago
FROM {events}
""",
    "fraud_indicators": """
SELECT event_id AS _ordinal,
       CASE WHEN event_id % 40 = 1 THEN NULL ELSE ' E' || CAST(event_id - event_id % 3 AS STRING) || ' ' END AS id_parte,
       CASE WHEN event_type = 'error' THEN ' TRUE' WHEN event_type = 'click' THEN '1' WHEN event_type = 'view' THEN NULL
            ELSE 'False' END AS confirmado_fraude
FROM {events}
""",
}

# Parents with gaps, so that some references of the feeds above do not exist.
PARENTS = {
    "known_clients": "SELECT 'C' || CAST(c_custkey AS STRING) AS id_cliente FROM {customer} WHERE c_custkey % 17 <> 0",
    "known_agents": "SELECT 'A' || CAST(s_suppkey AS STRING) AS id_agente FROM {supplier} WHERE s_suppkey % 9 <> 5",
    "known_adjusters": "SELECT 'S' || CAST(s_suppkey AS STRING) AS id_perito FROM {supplier} WHERE s_suppkey % 9 <> 1",
    "known_items": "SELECT 'P' || CAST(p_partkey AS STRING) AS id_objeto FROM {part} WHERE p_partkey % 19 <> 0",
    "known_policies": (
        "SELECT 'O' || CAST(o_orderkey AS STRING) AS id_poliza, CASE WHEN o_orderkey % 10 <> 0 "
        "THEN 'C' || CAST(o_custkey AS STRING) END AS id_asegurado FROM {orders} WHERE o_orderkey % 13 <> 0"
    ),
    "known_claims": "SELECT 'E' || CAST(event_id AS STRING) AS id_parte FROM {events} WHERE event_id % 11 <> 0",
}

CLEAN = {
    "clients": """
SELECT 'C' || CAST(c_custkey AS STRING) AS id_cliente, CASE WHEN c_custkey % 13 <> 0 THEN 'Argentina' END AS pais,
       CASE WHEN c_custkey % 29 <> 1 THEN r_name END AS provincia, n_name || '.' AS localidad,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'Empleado' WHEN 'MACHINERY' THEN 'Jubilado' ELSE 'Other' END
       AS situacion_laboral,
       CASE WHEN c_custkey % 67 = 4 THEN 'Senior' WHEN c_custkey % 3 = 0 THEN 'Joven' WHEN c_custkey % 3 = 1 THEN 'Adulto' ELSE 'Mayor' END AS segmento_persona,
       CASE c_custkey % 2 WHEN 0 THEN 'M' ELSE 'F' END AS sexo
FROM {customer} JOIN {nation} ON c_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""",
    "agents": "SELECT 'A' || CAST(s_suppkey AS STRING) AS id_agente, s_name AS nombre_completo FROM {supplier}",
    "adjusters": "SELECT 'S' || CAST(s_suppkey AS STRING) AS id_perito, s_name AS nombre_completo FROM {supplier}",
    "items": """
SELECT 'P' || CAST(p_partkey AS STRING) AS id_objeto,
       CASE WHEN p_partkey % 47 = 5 THEN p_type || ' ' || repeat('x', 60) ELSE p_type END AS tipo_objeto,
       CAST(p_retailprice AS DECIMAL(20,2)) AS valor_asegurado, r_name AS provincia,
       CASE WHEN p_partkey % 23 = 0 THEN 's/d' ELSE n_name END AS localidad
FROM {part} JOIN {nation} ON p_partkey % 25 = n_nationkey JOIN {region} ON n_regionkey = r_regionkey
""",
    "policies": """
SELECT 'O' || CAST(o_orderkey AS STRING) AS id_poliza, 'C' || CAST(o_custkey AS STRING) AS id_cliente,
       CASE WHEN o_orderkey % 10 <> 0 THEN 'C' || CAST(o_custkey AS STRING) END AS id_asegurado,
       'A' || CAST(agent AS STRING) AS id_agente, 'P' || CAST(item AS STRING) AS id_objeto_asegurado,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'PREMIUM' WHEN '2-HIGH' THEN 'PREMIUM' WHEN '3-MEDIUM' THEN 'EXTENDIDA'
            WHEN '5-LOW' THEN 'BASICA' ELSE 'OTRA' END AS cobertura,
       CAST(o_orderdate AS DATE) AS fecha_alta, CAST(o_totalprice AS DECIMAL(20,2)) AS prima_mensual
FROM {orders}
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS item, MIN(l_suppkey) AS agent FROM {lineitem} GROUP BY l_orderkey) AS l
ON o_orderkey = l_orderkey
""",
    "coverages": """
SELECT 'O' || CAST(l_orderkey AS STRING) AS id_poliza, CAST(CASE WHEN l_orderkey % 59 = 3 THEN 99999999999 ELSE l_extendedprice END AS DECIMAL(20,2)) AS suma_garantizada
FROM {lineitem}
""",
    "claims": """
SELECT 'E' || CAST(event_id AS STRING) AS id_parte,
       CASE WHEN event_id % 37 <> 9 THEN 'O' || CAST(first_order AS STRING) END AS id_poliza,
       'P' || CAST(item AS STRING) AS id_objeto_asegurado,
       CASE WHEN event_id % 3 <> 0 THEN 'S' || CAST(event_id % 12 AS STRING) END AS id_perito,
       CASE WHEN event_id % 60 = 1 THEN 'X' || CAST(user_id AS STRING)
            WHEN event_id % 25 <> 0 THEN 'C' || CAST(user_id AS STRING) END AS id_receptor_pago,
       CASE WHEN event_id % 53 = 5 THEN DATE '1990-01-01' ELSE CAST(ts AS DATE) END AS fecha_apertura,
       CASE WHEN event_id % 83 = 7 THEN CAST(ts AS DATE) - 2
            WHEN event_id % 4 <> 0 THEN CAST(ts AS DATE) + CAST(event_id % 30 AS INT) END AS fecha_cierre,
       CAST(value AS DECIMAL(20,2)) AS monto_reclamado,
       CASE WHEN event_id % 71 <> 3 THEN upper(event_type) END AS tipo_siniestro
FROM {events}
LEFT JOIN (SELECT o_custkey, MIN(o_orderkey) AS first_order FROM {orders} GROUP BY o_custkey) AS p ON user_id = o_custkey
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS item FROM {lineitem} GROUP BY l_orderkey) AS l ON first_order = l_orderkey
""",
    "assessments": """
SELECT 'E' || CAST(event_id - event_id % 4 AS STRING) AS id_parte,
       CAST(CAST(value AS DECIMAL(12,2)) * 0.9 AS DECIMAL(20,2)) AS monto_estimado_dano
FROM {events}
""",
    "payments": """
SELECT 'E' || CAST(event_id - event_id % 2 AS STRING) AS id_parte,
       CAST(CAST(value AS DECIMAL(12,2)) * 0.8 * CASE WHEN event_id % 100 = 0 THEN 100000 ELSE 1 END AS DECIMAL(20,2))
       AS monto_pagado
FROM {events}
""",
    "fraud_flags": """
SELECT 'E' || CAST(event_id * 2 AS STRING) AS id_parte, event_type = 'error' AS fraude_flag FROM {events}
""",
}

# The same rows as ``CLEAN`` gives, joined in an order in which Spark moves fewer of them: policies meet their lines by the text that
# coverages are joined by next, and the item of a client's first policy is found once a client and not once an event.
PLANNED = {
    "policies": """
SELECT id_poliza, 'C' || CAST(o_custkey AS STRING) AS id_cliente,
       CASE WHEN o_orderkey % 10 <> 0 THEN 'C' || CAST(o_custkey AS STRING) END AS id_asegurado,
       'A' || CAST(agent AS STRING) AS id_agente, 'P' || CAST(item AS STRING) AS id_objeto_asegurado,
       CASE o_orderpriority WHEN '1-URGENT' THEN 'PREMIUM' WHEN '2-HIGH' THEN 'PREMIUM' WHEN '3-MEDIUM' THEN 'EXTENDIDA'
            WHEN '5-LOW' THEN 'BASICA' ELSE 'OTRA' END AS cobertura,
       CAST(o_orderdate AS DATE) AS fecha_alta, CAST(o_totalprice AS DECIMAL(20,2)) AS prima_mensual
FROM (SELECT *, 'O' || CAST(o_orderkey AS STRING) AS id_poliza FROM {orders}) AS o
LEFT JOIN (SELECT line_policy, MIN(l_partkey) AS item, MIN(l_suppkey) AS agent
           FROM (SELECT *, 'O' || CAST(l_orderkey AS STRING) AS line_policy FROM {lineitem}) GROUP BY line_policy) AS l
ON id_poliza = line_policy
""",
    "claims": CLEAN["claims"].replace(
        """FROM {events}
LEFT JOIN (SELECT o_custkey, MIN(o_orderkey) AS first_order FROM {orders} GROUP BY o_custkey) AS p ON user_id = o_custkey
LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS item FROM {lineitem} GROUP BY l_orderkey) AS l ON first_order = l_orderkey
""",
        """FROM {events}
LEFT JOIN (SELECT o_custkey, first_order, item
           FROM (SELECT o_custkey, MIN(o_orderkey) AS first_order FROM {orders} GROUP BY o_custkey) AS f
           LEFT JOIN (SELECT l_orderkey, MIN(l_partkey) AS item FROM {lineitem} GROUP BY l_orderkey) AS l
           ON first_order = l_orderkey) AS p
ON user_id = o_custkey
"""),
}


def raw(spark: SparkSession, d: str, name: str) -> DataFrame:
    return run_sql(spark, d, RAW[name])


def parent(spark: SparkSession, d: str, name: str) -> DataFrame:
    return run_sql(spark, d, PARENTS[name])


def clean(spark: SparkSession, d: str, name: str) -> DataFrame:
    return run_sql(spark, d, PLANNED.get(name, CLEAN[name]))
