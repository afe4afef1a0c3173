"""Curation of the ten feeds.

Each function takes a raw feed (text columns plus a unique ordinal) and the parents it refers to, and returns one
*marked* frame: the typed columns, the list of broken rules and, for rejected rows, the row as JSON.
:func:`surestar.operators.rules.kept` and ``rejected`` split it.

Order of the rules: rows without a key go first, then the last row per key wins, and only then are the business
rules applied, so an invalid last row still displaces an earlier valid one. Typed columns are built once, after the
joins, which move the raw columns only; the rules read the typed columns.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from surestar.functions import classify as cl
from surestar.functions import parse as p
from surestar.functions import text as t
from surestar.operators.dedupe import mark_last
from surestar.operators.details import any_by_key
from surestar.operators.refint import mark_all, mark_parent
from surestar.operators.rules import KEPT, REASONS, ROW_JSON, Rule, json_if_rejected, kept, with_reasons
from surestar.sources.feeds import MALFORMED, ORDINAL

MALFORMED_ROW = "malformed_row"
MISSING_KEY = "missing_key"
SUPERSEDED = "superseded"
Formats = Sequence[str] | None


def _feed_columns(raw: DataFrame) -> list[str]:
    return [name for name in raw.columns if name not in (ORDINAL, MALFORMED)]


def _keyed(
    raw: DataFrame,
    ids: Sequence[str],
    required: Sequence[str],
    key: str | None,
    references: Sequence[tuple[str, DataFrame, str, str]] = (),
) -> tuple[DataFrame, list[Rule]]:
    """Add cleaned ids as ``_id_<name>`` and the first rules: row well formed, key present, last row of its key.

    ``references`` add one marker column per (id, parents, parent key, marker); they share their joins with the last row.
    """
    # Two projections, so that each id is trimmed once and not once per use.
    df = raw.withColumns({f"_id_{name}": t.trim_all(F.col(name)) for name in ids})
    df = df.withColumns({f"_id_{name}": p.not_placeholder(F.col(f"_id_{name}")) for name in ids})
    complete = F.lit(True)
    for name in required:
        complete = complete & F.col(f"_id_{name}" if name in ids else name).isNotNull()
    rules = []
    if MALFORMED in raw.columns:  # cells of such a row may stand in the wrong columns, so nothing else is read from it
        whole = F.col(MALFORMED).isNull()
        rules.append(Rule(MALFORMED_ROW, whole))
        df = df.withColumn("_complete", complete & whole)
        rules.append(Rule(MISSING_KEY, ~whole | F.col("_complete")))
    else:
        df = df.withColumn("_complete", complete)
        rules.append(Rule(MISSING_KEY, F.col("_complete")))
    if references:
        named = [(f"_id_{child}", parents, parent_key, marker) for child, parents, parent_key, marker in references]
        df = mark_all(df, ORDINAL, named, (f"_id_{key}", "_complete", "_is_last") if key else None)
    elif key:
        df = mark_last(df, [f"_id_{key}"], ORDINAL, "_complete")
    if key:
        rules.append(Rule(SUPERSEDED, ~F.col("_complete") | F.col("_is_last")))
    return df, rules


def _typed(name: str) -> Column:
    """Typed value of a column, for rules."""
    return F.col(f"_t_{name}")


def _finish(
    df: DataFrame,
    raw: DataFrame,
    rules: Sequence[Rule],
    typed: Mapping[str, Column],
    only: Sequence[str] | None = None,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Feed columns with their typed values, added columns, reasons and the rejected row."""
    feed = _feed_columns(raw)
    names = list(only) if only else [name for name in feed if name not in drop]
    names += [name for name in typed if name not in names]
    valued = df.withColumns({f"_t_{name}": value for name, value in typed.items()})
    marked = with_reasons(valued, rules)
    columns = [_typed(name).alias(name) if name in typed else F.col(f"`{name}`") for name in names]
    texts = [*feed, MALFORMED] if MALFORMED in raw.columns else feed
    return marked.select(*columns, REASONS, KEPT, json_if_rejected(texts).alias(ROW_JSON))


# Columns that each feed reads as numbers and as yes or no.
NUMBERS = {
    "policies": ("prima_mensual", "prima_total", "customer_lifetime_value", "numero_polizas_cliente", "meses_desde_inicio"),
    "assessments": ("monto_estimado_dano",),
    "payments": ("monto_pagado",),
    "items": ("valor_asegurado", "valor_inmueble", "superficie_m2", "año_fabricacion", "año_construccion"),
    "claims": ("monto_reclamado", "dias_resolucion"),
    "coverages": ("suma_garantizada",),
}
TOKENS = {"assessments": ("requiere_reinspeccion",), "coverages": ("activa",), "fraud_indicators": ("confirmado_fraude",)}


def coerced_counts(raw: DataFrame, name: str, cell: Callable[[str], Column] = F.col) -> list[Column]:
    """How many texts of each column are no number, or no known token, as aggregates over a raw feed. ``cell`` gives a column's text."""
    numbers = [c for c in NUMBERS.get(name, ()) if c in raw.columns]
    tokens = [c for c in TOKENS.get(name, ()) if c in raw.columns]
    counts = [F.count_if(p.number_coerced(cell(c))).alias(f"{c}: no number") for c in numbers]
    return counts + [F.count_if(p.token_unknown(cell(c))).alias(f"{c}: unknown token") for c in tokens]


def _present(raw: DataFrame, names: Sequence[str], make: Callable[[Column], Column]) -> dict[str, Column]:
    return {name: make(F.col(name)) for name in names if name in raw.columns}


def clients(
    raw: DataFrame,
    as_of: dt.date,
    geography: DataFrame | None = None,
    province_aliases: Mapping[str, Sequence[str]] | None = None,
    dates: Formats = None,
) -> DataFrame:
    """Clients. ``geography`` is the master list (provincia, localidad); without it the country decides.

    ``province_aliases`` names a master province and the canonical spellings that mean it. ``dates`` are the formats of
    the feed's dates, here and below; without them ISO texts are read.
    """
    df, rules = _keyed(raw, ["id_cliente"], ["id_cliente"], "id_cliente")
    first, last = t.canonical(F.col("nombre")), t.canonical(F.col("apellido"))
    typed = {
        "id_cliente": F.col("_id_id_cliente"),
        "nombre": first,
        "apellido": last,
        "nombre_completo": t.full_name(first, last),
    }
    if geography is None:
        rules.append(Rule("foreign_country", t.location_key(F.col("pais")) == "ARGENTINA"))
    else:
        df = mark_geography(df, "provincia", "localidad", geography, province_aliases)
        rules.append(Rule("unknown_location", F.col("_in_master")))
        typed |= {"provincia": F.col("_province"), "localidad": F.col("_city")}
    birth = p.lenient_date(F.col("fecha_nacimiento"), dates)
    age = cl.age_in_year(birth, as_of)
    rules.append(Rule("age_out_of_range", _typed("edad").between(cl.MIN_AGE, cl.MAX_AGE)))
    typed |= {
        "fecha_nacimiento": birth,
        "edad": age.cast("int"),
        "sexo": cl.sex_code(F.col("sexo")),
        "situacion_laboral": cl.employment_class(F.col("situacion_laboral")),
        "segmento_persona": cl.age_segment(age),
    }
    return _finish(df, raw, rules, typed)


def mark_geography(
    df: DataFrame,
    province: str,
    city: str,
    geography: DataFrame,
    aliases: Mapping[str, Sequence[str]] | None = None,
) -> DataFrame:
    """Add ``_in_master`` and the texts to store; rows without province or city pass unchanged."""
    blank = t.blank_to_null(F.col(province)).isNull() | t.blank_to_null(F.col(city)).isNull()
    wanted = t.canonical(F.col(province))
    if aliases:
        wanted = F.coalesce(t.map_values(wanted, aliases), wanted)
    master = geography.select(
        t.canonical(F.col("provincia")).alias("_m_province"), t.canonical(F.col("localidad")).alias("_m_city")
    ).distinct()
    master = master.withColumn("_master", F.lit(True))
    keyed = df.withColumns({
        "_province": F.when(blank, F.col(province)).otherwise(wanted),
        "_city": F.when(blank, F.col(city)).otherwise(t.canonical(F.col(city))),
        "_blank": blank,
    })
    same = (F.col("_province") == F.col("_m_province")) & (F.col("_city") == F.col("_m_city"))
    joined = keyed.join(master, same, "left")
    known = F.col("_blank") | F.coalesce(F.col("_master"), F.lit(False))
    return joined.select(*df.columns, "_province", "_city", known.alias("_in_master"))


def policies(raw: DataFrame, clients: DataFrame, agents: DataFrame, dates: Formats = None) -> DataFrame:
    ids = ["id_poliza", "id_cliente", "id_agente", "id_asegurado", "id_objeto_asegurado"]
    references = [("id_cliente", clients, "id_cliente", "_client"), ("id_agente", agents, "id_agente", "_agent")]
    df, rules = _keyed(raw, ids, ["id_poliza", "id_cliente"], "id_poliza", references)
    rules += [Rule("unknown_client", F.col("_client")), Rule("unknown_agent", F.col("_agent"))]
    typed = {
        **{name: F.col(f"_id_{name}") for name in ids},
        **_present(raw, ["tipo_seguro", "cobertura", "tipo_poliza", "canal_venta", "estado"], t.canonical),
        **_present(raw, ["fecha_alta", "vigencia_desde", "vigencia_hasta"], lambda c: p.lenient_date(c, dates)),
        **_present(raw, ["prima_mensual", "prima_total"], p.lenient_number),
        **_present(raw, ["customer_lifetime_value"], lambda c: p.lenient_number(c, p.MEASURE)),
        **_present(raw, ["numero_polizas_cliente", "meses_desde_inicio"], p.lenient_integer),
    }
    return _finish(df, raw, rules, typed)


def assessments(raw: DataFrame, claims: DataFrame, adjusters: DataFrame, dates: Formats = None) -> DataFrame:
    ids = ["id_evaluacion", "id_parte", "id_perito"]
    references = [("id_parte", claims, "id_parte", "_claim"), ("id_perito", adjusters, "id_perito", "_adjuster")]
    df, rules = _keyed(raw, ids, ids, "id_evaluacion", references)
    rules += [Rule("unknown_claim", F.col("_claim")), Rule("unknown_adjuster", F.col("_adjuster"))]
    typed = {
        **{name: F.col(f"_id_{name}") for name in ids},
        "fecha_visita": p.lenient_date(F.col("fecha_visita"), dates),
        "monto_estimado_dano": p.lenient_number(F.col("monto_estimado_dano")),
        **_present(raw, ["dictamen"], t.canonical),
        "requiere_reinspeccion": p.token_flag(F.col("requiere_reinspeccion")),
    }
    return _finish(df, raw, rules, typed)


def adjusters(raw: DataFrame) -> DataFrame:
    df, rules = _keyed(raw, ["id_perito"], ["id_perito"], "id_perito")
    first, last = t.canonical(F.col("nombre")), t.canonical(F.col("apellido"))
    typed = {
        "id_perito": F.col("_id_id_perito"),
        "nombre": first,
        "apellido": last,
        "nombre_completo": t.full_name(first, last),
    }
    return _finish(df, raw, rules, typed, only=["id_perito", "nombre", "apellido", "nombre_completo", "zona_cobertura"])


def payments(raw: DataFrame, claims: DataFrame, clients: DataFrame, policies: DataFrame, dates: Formats = None) -> DataFrame:
    """A payee has to be a client and also the insured person of some policy."""
    ids = ["id_pago", "id_parte", "id_receptor"]
    df, rules = _keyed(raw, ids, ids, "id_pago", [
        ("id_parte", claims, "id_parte", "_claim"),
        ("id_receptor", clients, "id_cliente", "_client"),
        ("id_receptor", policies, "id_asegurado", "_insured"),
    ])
    rules += [
        Rule("unknown_claim", F.col("_claim")),
        Rule("payee_not_client", F.col("_client")),
        Rule("payee_not_insured", F.col("_insured")),
    ]
    typed = {
        **{name: F.col(f"_id_{name}") for name in ids},
        "monto_pagado": p.lenient_number(F.col("monto_pagado")),
        "fecha_pago": p.lenient_date(F.col("fecha_pago"), dates),
    }
    return _finish(df, raw, rules, typed, only=[*ids, "monto_pagado", "fecha_pago"])


def items(raw: DataFrame, policies: DataFrame | None = None) -> DataFrame:
    """Insured items. With ``policies``, items that no policy insures are rejected (off by default)."""
    references = [] if policies is None else [("id_objeto", policies, "id_objeto_asegurado", "_policy")]
    df, rules = _keyed(raw, ["id_objeto"], ["id_objeto"], "id_objeto", references)
    if policies is not None:
        rules.append(Rule("no_policy", F.col("_policy")))
    rules.append(Rule("value_too_large", _typed("valor_asegurado").try_cast(p.MONEY).isNotNull()))
    typed = {
        "id_objeto": F.col("_id_id_objeto"),
        **_present(raw, ["tipo_objeto", "descripcion", "localidad", "provincia", "marca", "modelo"], t.canonical),
        **_present(raw, ["valor_asegurado", "valor_inmueble"], p.lenient_number),
        **_present(raw, ["superficie_m2"], lambda c: p.lenient_number(c, p.MEASURE)),
        **_present(raw, ["año_fabricacion", "año_construccion"], p.lenient_integer),
    }
    return _finish(df, raw, rules, typed)


def agents(raw: DataFrame, dates: Formats = None) -> DataFrame:
    df, rules = _keyed(raw, ["id_agente"], ["id_agente"], "id_agente")
    first, last = t.canonical(F.col("nombre")), t.canonical(F.col("apellido"))
    rules += [
        Rule("inactive", cl.active_agent(F.col("activo"))),
        Rule("missing_hire_date", _typed("fecha_ingreso").isNotNull()),
        Rule("unknown_channel", _typed("canal").isin(*cl.CHANNELS)),
    ]
    typed = {
        "id_agente": F.col("_id_id_agente"),
        "nombre": first,
        "apellido": last,
        "canal": t.canonical(F.col("canal")),
        **_present(raw, ["sucursal", "zona", "email"], t.canonical),
        "fecha_ingreso": p.lenient_date(F.col("fecha_ingreso"), dates),
        "activo": F.upper(F.trim("activo")),
        "nombre_completo": t.full_name(first, last),
    }
    return _finish(df, raw, rules, typed)


def claims(
    raw: DataFrame, policies: DataFrame, clients: DataFrame, adjusters: DataFrame, items: DataFrame, dates: Formats = None
) -> DataFrame:
    """Claims. The five references may be absent; one that is given has to exist."""
    ids = ["id_parte", "id_poliza", "id_objeto_asegurado", "id_perito", "id_denunciante", "id_receptor_pago"]
    references = [
        ("id_poliza", policies, "id_poliza", "unknown_policy"),
        ("id_denunciante", clients, "id_cliente", "unknown_reporter"),
        ("id_receptor_pago", clients, "id_cliente", "unknown_payee"),
        ("id_perito", adjusters, "id_perito", "unknown_adjuster"),
        ("id_objeto_asegurado", items, "id_objeto", "unknown_item"),
    ]
    marked = [(name, parents, key, f"_has_{name}") for name, parents, key, _ in references]
    df, rules = _keyed(raw, ids, ["id_parte", "id_poliza"], "id_parte", marked)
    opened, closed = _typed("fecha_apertura"), _typed("fecha_cierre")
    rules += [
        Rule("missing_open_date", opened.isNotNull()),
        Rule("closed_before_open", closed.isNull() | opened.isNull() | (closed >= opened)),
        Rule("negative_amount", _typed("monto_reclamado") >= 0),
        Rule("negative_days", p.lenient_number(F.col("dias_resolucion"), p.MEASURE) >= 0),
    ]
    rules += [Rule(rule, F.col(f"_id_{name}").isNull() | F.col(f"_has_{name}")) for name, _, _, rule in references]
    typed = {
        **{name: F.col(f"_id_{name}") for name in ids},
        "fecha_apertura": p.lenient_date(F.col("fecha_apertura"), dates),
        "fecha_cierre": p.lenient_date(F.col("fecha_cierre"), dates),
        "monto_reclamado": p.lenient_number(F.col("monto_reclamado")),
        "dias_resolucion": p.lenient_integer(F.col("dias_resolucion")),
        **_present(raw, ["tipo_siniestro", "estado", "tipo_seguro"], t.canonical),
    }
    return _finish(df, raw, rules, typed)


def coverages(raw: DataFrame, policies: DataFrame, dedupe_exact: bool = False) -> DataFrame:
    """Insured sums, several per policy. With ``dedupe_exact`` only the last of equal rows is kept."""
    feed = _feed_columns(raw)
    df, rules = _keyed(raw, ["id_poliza"], ["id_poliza", "tipo_garantia", "suma_garantizada"], None)
    rules = [Rule("inactive", p.has_token(F.col("activa"))), *rules]
    if dedupe_exact:
        compared = [f"_same_{name}" for name in feed if name != "activa"]
        # A null in a compared column must equal another null, so the comparison is done on texts.
        df = df.withColumns({f"_same_{n}": F.coalesce(F.col(n), F.lit(t.NULL_SENTINEL)) for n in feed if n != "activa"})
        df = df.withColumn("_usable", F.col("_complete") & p.has_token(F.col("activa")))
        df = mark_last(df, compared, ORDINAL, "_usable")
        rules.append(Rule("exact_duplicate", ~F.col("_usable") | F.col("_is_last")))
    df = mark_parent(df, "_id_id_poliza", policies, "id_poliza", "_policy", spread=ORDINAL)
    rules += [
        Rule("unknown_policy", F.col("_id_id_poliza").isNull() | F.col("_policy")),
        Rule("sum_not_positive", _typed("suma_garantizada") > 0),
    ]
    typed = {
        "id_poliza": F.col("_id_id_poliza"),
        "tipo_garantia": t.capitalise(F.col("tipo_garantia")),
        "suma_garantizada": p.lenient_number(F.col("suma_garantizada")),
    }
    return _finish(df, raw, rules, typed, drop=["activa"])


def fraud_indicators(raw: DataFrame, claims: DataFrame) -> DataFrame:
    """Single indicators, marked; :func:`fraud_flags` rolls the kept ones up."""
    df, rules = _keyed(raw, ["id_parte"], ["id_parte"], None)
    df = mark_parent(df, "_id_id_parte", claims, "id_parte", "_claim", spread=ORDINAL)
    rules.append(Rule("unknown_claim", F.col("_claim")))
    typed = {"id_parte": F.col("_id_id_parte"), "confirmado_fraude": p.has_token(F.col("confirmado_fraude"))}
    return _finish(df, raw, rules, typed, only=["id_parte", "confirmado_fraude"])


def fraud_flags(marked: DataFrame) -> DataFrame:
    """One row per claim: true if at least one of its indicators is confirmed."""
    return any_by_key(kept(marked), "id_parte", F.col("confirmado_fraude"), "fraude_flag")
