"""Tiny invented feeds for all tables, with at least one row per rejection rule."""

from __future__ import annotations

import csv
from pathlib import Path

FEEDS = {
    "clientes.csv": (
        ["Id. Cliente ", "nombre", "apellido", "pais", "provincia", "localidad", "Fecha Nacimiento", "sexo", "situacion laboral"],
        [
            ["C1", "josé", "Pérez", "Argentina", "Córdoba", "Villa María.", "1990-05-01", "Varón", "Employed"],
            ["C1", "José", "Pérez", " argentina ", "Córdoba", "Villa María.", "1990-05-01", "Varón", "Self-Employed"],
            [" C2 ", "Ana", "", "Argentina", "Salta", "\tSalta", "1960-01-31", "mujer", "RETIRED"],
            ["C3", "", "", "Argentina", "", "Rosario", "2001-07-07", "?", ""],
            ["C4", "Kind", "Klein", "Argentina", "Salta", "Salta", "2012-01-01", "F", "Student"],
            ["C5", "Alt", "Alt", "Argentina", "Salta", "Salta", "1901-01-01", "F", "INACTIVO"],
            ["C6", "Pía", "Soto", "Chile", "Salta", "Salta", "1980-01-01", "F", "Temporary"],
            ["C7", "Bad", "Date", "Argentina", "Salta", "Salta", "sin fecha", "F", "Employed"],
            ["", "No", "Id", "Argentina", "Salta", "Salta", "1980-01-01", "F", "Employed"],
            ["   ", "Blank", "Id", "Argentina", "Salta", "Salta", "1980-01-01", "F", "Employed"],
            ["C8", "Young", "Adult", "Argentina", "salta", "SALTA ", "2008-12-31", "hombre", "Licencia médica"],
        ],
    ),
    "agentes.csv": (
        ["id_agente", "nombre", "apellido", "canal", "sucursal", "zona", "fecha_ingreso", "activo", "email"],
        [
            ["A1", "Iñés", "Gómez", "Sucursal", "S1", "Z1", "2010-06-27", "True", "a@b.ar"],
            ["A2", "Raúl", "Ruiz", "call center", "S1", "Z1", "2011-06-27", " sí ", "b@b.ar"],
            ["A3", "In", "Activo", "Web", "S1", "Z1", "2011-06-27", "False", "c@b.ar"],
            ["A4", "Sin", "Fecha", "Web", "S1", "Z1", "", "1", "d@b.ar"],
            ["A5", "Otro", "Canal", "Kiosco", "S1", "Z1", "2011-06-27", "1", "e@b.ar"],
        ],
    ),
    "peritos.csv": (
        ["id_perito", "nombre", "apellido", "especialidad", "zona_cobertura", "matricula", "activo", "fecha_ingreso", "email"],
        [
            ["S1", "Santiago", "Díaz", "Incendio", "CABA", "M1", "True", "2004-10-01", "s@b.ar"],
            ["S2", "", "Paz", "Autos", "Salta", "M2", "False", "2005-10-01", "t@b.ar"],
            ["", "Sin", "Id", "Autos", "Salta", "M3", "True", "2005-10-01", "u@b.ar"],
        ],
    ),
    "polizas.csv": (
        ["id_poliza", "id_cliente", "id_agente", "id_asegurado", "id_objeto_asegurado", "tipo_seguro", "cobertura",
         "tipo_poliza", "canal_venta", "estado", "fecha_alta", "vigencia_desde", "vigencia_hasta", "prima_mensual",
         "prima_total", "customer_lifetime_value", "numero_polizas_cliente", "meses_desde_inicio"],
        [
            ["P1", "C1", "A1", "C1", "O1", "Automóvil", "Básica", "x", "Web", "Activa", "2020-02-29", "2020-03-01",
             "2021-03-01", "100.50", "1206", "2763.519279", "1", "12"],
            ["P2", "C2", "A2", "", "O2", "Hogar", "Extendida", "x", "Web", "Activa", "1999-01-01", "", "", "50", "600",
             "", "2", ""],
            ["P3", "C1", "A1", "C2", "O9", "Hogar", "Oro", "x", "Web", "Activa", "2021-05-05", "", "", "75.005", "", "",
             "", ""],
            ["P4", "C4", "A1", "C1", "O1", "Hogar", "Premium", "x", "Web", "Activa", "2021-05-05", "", "", "75", "", "",
             "", ""],
            ["P5", "C1", "A3", "C1", "O1", "Hogar", "Premium", "x", "Web", "Activa", "2021-05-05", "", "", "75", "", "",
             "", ""],
            ["P6", "C8", "A1", "C8", "O1", "Hogar", "Premium", "x", "Web", "Activa", "2021-05-05", "", "", "gratis", "",
             "", "", ""],
            ["P7", "C8", "A1", "C8", "O1", "Hogar", "Premium", "x", "Web", "Activa", "2021-05-05", "", "", "10", "", "",
             "", ""],
            ["P1", "C1", "A1", "C1", "O1", "Automóvil", "Básica", "x", "Web", "Activa", "2020-02-29", "2020-03-01",
             "2021-03-01", "120.50", "1446", "2763.519279", "1", "12"],
        ],
    ),
    "objetos_asegurados.csv": (
        ["id_objeto", "tipo_objeto", "descripcion", "localidad", "provincia", "marca", "modelo", "valor_asegurado",
         "valor_inmueble", "superficie_m2", "año_fabricacion", "año_construccion"],
        [
            ["O1", "auto", "Peugeot 208", "Villa María", "Córdoba", "Peugeot", "208", "15000.555", "", "", "2019", ""],
            ["O2", "casa", "ladrillo", "n/d", "Salta", "", "", "99999.9", "80000", "120.5", "", "1988"],
            ["O3", "casa", "adobe", "Rosario", "Santa Fe", "", "", "mucho", "x", "", "", "viejo"],
        ],
    ),
    "garantias.csv": (
        ["id_poliza", "tipo_garantia", "suma_garantizada", "activa"],
        [
            ["P1", " rOBO total", "1000", "True"], ["P1", " rOBO total", "1000", "True"], ["P1", "incendio", "500.25", "1"],
            ["P1", "granizo", "900", "False"], ["P2", "robo", "200", "true"], ["P3", "robo", "300", "true"],
            ["P3", "robo", "", "true"], ["P3", "robo", "-1", "true"], ["P3", "robo", "x", "true"],
            ["P99", "robo", "10", "true"], ["P6", "robo", "10", "true"],
        ],
    ),
    "partes_accidente.csv": (
        ["id_parte", "id_poliza", "id_objeto_asegurado", "id_perito", "id_denunciante", "id_receptor_pago", "fecha_apertura",
         "fecha_cierre", "monto_reclamado", "dias_resolucion", "tipo_siniestro", "estado", "tipo_seguro"],
        [
            ["E1", "P1", "O1", "S1", "C1", "C1", "2021-01-10", "2021-02-10", "900", "31", "Colisión", "cerrado", "auto"],
            ["E2", "P2", "", "", "", "", "2021-03-01", "", "garbage", "", "robo ", "abierto", "hogar"],
            ["E3", "P1", "O1", "S1", "C1", "C1", "2021-01-10", "2021-01-01", "1", "1", "robo", "cerrado", "auto"],
            ["E4", "P1", "O1", "S1", "C1", "C1", "", "2021-01-01", "1", "1", "robo", "cerrado", "auto"],
            ["E5", "P1", "O1", "S1", "C1", "C1", "2021-01-10", "", "-1", "1", "robo", "cerrado", "auto"],
            ["E6", "P1", "O1", "S1", "C1", "C1", "2021-01-10", "", "1", "-1", "robo", "cerrado", "auto"],
            ["E7", "P9", "O1", "S1", "C1", "C1", "2021-01-10", "", "1", "1", "robo", "cerrado", "auto"],
            ["E8", "P1", "O7", "S7", "C7", "C7", "2021-01-10", "", "1", "1", "robo", "cerrado", "auto"],
            ["E9", "", "O1", "S1", "C1", "C1", "2021-01-10", "", "1", "1", "robo", "cerrado", "auto"],
            ["E1b", "P6", "O1", "S1", "C8", "C8", "2021-06-10", "2021-06-10", "40", "0", "robo", "cerrado", "auto"],
            ["E10", "P1", "O1", "S1", "C1", "C1", "2021-01-10", "", "5", "1", "robo", "abierto", "auto"],
            ["E10", "P1", "O1", "S1", "C1", "C1", "2021-01-10", "", "-5", "1", "robo", "abierto", "auto"],
        ],
    ),
    "evaluaciones_perito.csv": (
        ["id_evaluacion", "id_parte", "id_perito", "fecha_visita", "monto_estimado_dano", "dictamen", "requiere_reinspeccion"],
        [
            ["V1", "E1", "S1", "2021-01-12", "400.10", "daño", "False"], ["V2", "E1", "S2", "2021-01-13", "99.90", "ok", "True"],
            ["V3", "E99", "S1", "2021-01-12", "1", "x", "True"], ["V4", "E1", "S9", "2021-01-12", "1", "x", "True"],
            ["V5", "E1", "", "2021-01-12", "1", "x", "True"],
        ],
    ),
    "pagos_siniestro.csv": (
        ["id_pago", "id_parte", "id_receptor", "monto_pagado", "fecha_pago"],
        [
            ["G1", "E1", "C1", "2000", "2021-02-01"], ["G2", "E1", "C1", "600.30", "2021-02-02"],
            ["G3", "E1", "C9", "1", "2021-02-02"], ["G4", "E77", "C1", "1", "2021-02-02"],
            ["G5", "E2", "C2", "10", "2021-04-02"],
        ],
    ),
    "indicadores_fraude.csv": (
        ["id_parte", "confirmado_fraude"],
        [[" E1", "False"], ["E1 ", "1"], ["E2", "False"], ["E99", "True"], ["", "True"]],
    ),
    "HealthInsurance.csv": (["a b", "c.d"], [["1", "2"]]),
}


def write_feeds(folder: Path, changes: dict[str, list[list[str]]] | None = None) -> str:
    """Write the feeds; ``changes`` adds rows to some of them. The twelfth feed is left out on purpose."""
    folder.mkdir(parents=True, exist_ok=True)
    for name, (header, rows) in FEEDS.items():
        with open(folder / name, "w", newline="", encoding="utf-8") as file:
            writer = csv.writer(file, lineterminator="\n")
            writer.writerow(header)
            writer.writerows([*rows, *(changes or {}).get(name, [])])
    return str(folder)
