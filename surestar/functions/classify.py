"""Classifications with fixed value tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

from surestar.functions.text import canonical, keyword_class, map_values

# Result, then the canonical spellings that lead to it.
SEX_SPELLINGS = {
    "M": ("M", "MASCULINO", "HOMBRE", "VARON"),
    "F": ("F", "FEMENINO", "MUJER"),
}
SEX_DEFAULT = "O"

# Plan category, then the coverage level that maps to it.
PLAN_LEVELS = {
    "Estandar": ("EXTENDIDA",),
    "Basico": ("BASICA",),
    "Premium": ("PREMIUM",),
}

# Employment class and keywords, in the order in which they are tried.
EMPLOYMENT_CLASSES = (
    ("Desempleado", ("UNEMPLOY", "DESEMPL", "SIN TRAB", "DISABL", "INACTIV")),
    ("Jubilado", ("RETIRE", "JUB")),
    ("Licencia medica", ("MEDIC", "LICENCIA", "LEAVE")),
    ("Empleado", ("EMP", "ACTIV")),
)
EMPLOYMENT_DEFAULT = "Other"

# Age limits and the segments between them.
MIN_AGE, MAX_AGE = 18, 100
ADULT_FROM, SENIOR_FROM = 35, 60
SEGMENTS = ("Joven", "Adulto", "Mayor")

# Sales channels an agent may have, and texts that mark an agent as active.
CHANNELS = ("SUCURSAL", "CALL CENTER", "AGENTE", "WEB")
ACTIVE_AGENT_TOKENS = ("TRUE", "1", "SI", "SÍ")


def sex_code(c: Column) -> Column:
    return map_values(canonical(c), SEX_SPELLINGS, SEX_DEFAULT)


def plan_category(level: Column) -> Column:
    """Plan category of a coverage level, null for an unknown level."""
    return map_values(F.upper(level), PLAN_LEVELS)


def employment_class(c: Column) -> Column:
    return keyword_class(c, EMPLOYMENT_CLASSES, EMPLOYMENT_DEFAULT)


def age_in_year(birth: Column, as_of: dt.date) -> Column:
    """Calendar years between the birth year and the year of ``as_of``."""
    return F.lit(as_of.year) - F.year(birth)


def age_segment(age: Column) -> Column:
    young, adult, senior = SEGMENTS
    return F.when(age < ADULT_FROM, young).when(age >= SENIOR_FROM, senior).when(age.isNotNull(), adult)


def active_agent(c: Column) -> Column:
    return F.coalesce(F.upper(F.trim(c)).isin(*ACTIVE_AGENT_TOKENS), F.lit(False))
