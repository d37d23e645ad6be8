"""The registered queries as DuckDB SQL over the same tables."""

from __future__ import annotations

from workload import fixture_columns as fx

# The tables as they must be, written out: the product's own schemas are not asked.
SCHEMAS = {
    name: dict(column.split() for column in columns.split(","))
    for name, columns in {
        "construcciones": """cod_com integer, cod_mz integer, cod_pr integer, periodo varchar,
            numero_linea integer, cod_calidad integer, cod_destino varchar, cod_material varchar,
            superficie_construida integer, cod_condicion_especial varchar,
            ano_construccion integer""",
        "no_agricola": """cod_com integer, cod_mz integer, cod_pr integer, periodo varchar,
            direccion varchar, avaluo_fiscal_clp bigint, contrib_semestrales_clp bigint,
            cod_destino varchar, avaluo_exento_clp bigint, superficie_total_terreno integer,
            superficie_total_construcciones integer, ano_construccion integer""",
        "nexo_bc": """cod_com integer, cod_mz integer, cod_pr integer, periodo varchar,
            cod_com_bc integer, cod_mz_bc integer, cod_pr_bc integer""",
        "coordenadas": """cod_com integer, cod_mz integer, cod_pr integer, latitud float,
            longitud float""",
        "codigo_comuna_region": """cod_com integer, cod_region integer, comuna varchar,
            region varchar""",
        "codigo_destino": "cod_destino varchar, descripcion_destino varchar, tipo varchar",
        "codigo_material": "cod_material varchar, descripcion_material varchar",
        "precios_transaccionales": """cod_com integer, cod_mz integer, cod_pr integer,
            fecha_escritura date, precio_clp float, precio_uf float""",
        "precios_uf": "date date, uf float",
    }.items()
}

TODAY = "date '2001-06-30'"


def _columns(rules: dict[str, str]) -> str:
    words = fx.DIALECTS["duckdb"]
    return ", ".join(
        f"{e.format(**words) if '{' in e else e} AS {c}" for c, e in rules.items()
    )


# -- raw-shaped views ---------------------------------------------------------------

DAYS = "days AS (SELECT DISTINCT cast(o_orderdate AS date) AS d FROM orders)"
ORDER_BASE = f"base AS (SELECT {_columns(fx.ORDER_KEYS)} FROM orders)"
RAW_SALES = f"""{ORDER_BASE},
once AS (SELECT {_columns(fx.SALES)} FROM base),
raw AS (SELECT * FROM once UNION ALL SELECT * FROM once WHERE right(cod_com, 1) = '7')"""
RAW_RATES = f"""{DAYS}, raw_rates AS (
SELECT {_columns({"date": "cast(d as string)", "uf": fx.RATE})} FROM days WHERE day(d) <> 13)"""
FAULTY_RATES = f"""{DAYS}, raw_rates AS (
SELECT {_columns({"date": "cast(d as string)", "uf": fx.FAULTY_RATE})} FROM days
UNION ALL
SELECT {_columns({"date": "cast(d as string)", "uf": fx.FAULTY_RATE})} FROM days WHERE day(d) = 2
UNION ALL
SELECT {_columns({"date": "cast(d as string)", "uf": fx.NEXT_RATE})} FROM days WHERE day(d) = 1)"""


def _period(periods: bool) -> dict[str, str]:
    return {"periodo": fx.PERIOD if periods else "'2026_1'"}


def _raw_buildings(periods: bool = False) -> str:
    return f"""lines AS (SELECT {_columns(fx.LINE_KEYS)} FROM lineitem),
raw_buildings AS (SELECT {_columns(fx.BUILDINGS | _period(periods))} FROM lines)"""


def _raw_properties(periods: bool = False) -> str:
    return f"""{ORDER_BASE},
raw_properties AS (SELECT {_columns(fx.PROPERTIES | _period(periods))} FROM base)"""


# -- typing -------------------------------------------------------------------------


def _number(c: str) -> str:
    value = f"try_cast(trim({c}) AS double)"
    return f"CASE WHEN isfinite({value}) THEN {value} END"


def _int(c: str) -> str:
    return f"try_cast(trunc(try_cast(trim({c}) AS double)) AS integer)"


def _strict_int(c: str) -> str:
    return (
        f"CASE WHEN regexp_full_match(trim({c}), '[+-]?[0-9]+') "
        f"THEN try_cast(trim({c}) AS integer) END"
    )


def _day(c: str, pattern: str) -> str:
    return f"cast(try_strptime(trim({c}), '{pattern}') AS date)"


ROL = ("cod_com", "cod_mz", "cod_pr")
ROL_LIST = ", ".join(ROL)
PRICES = ("precio_clp", "precio_uf")
RAW_COLUMNS = (*ROL, "fecha_escritura", *PRICES)


def _read(to_int=_int) -> dict[str, str]:
    found = {c: to_int(c) for c in ROL}
    found["fecha_escritura"] = _day("fecha_escritura", "%Y%m%d")
    return found | {c: _number(c) for c in PRICES}


def _typed(to_int=_int) -> str:
    columns = ", ".join(f"{e} AS {c}" for c, e in _read(to_int).items())
    return f"typed AS (SELECT {columns} FROM (SELECT DISTINCT * FROM raw))"


RATES = f"""rates AS (
SELECT {_day("date", "%Y-%m-%d")} AS date, {_number("uf")} AS uf FROM raw_rates)"""
USABLE = f"""usable AS (SELECT * FROM typed WHERE {
    " AND ".join(f"{c} IS NOT NULL" for c in (*ROL, "fecha_escritura"))})"""


def _attached(clp_cap: str, uf_cap: str) -> str:
    return f"""capped AS (SELECT {ROL_LIST}, fecha_escritura,
CASE WHEN precio_clp > 0 {clp_cap} THEN precio_clp END AS precio_clp,
CASE WHEN precio_uf > 0 {uf_cap} THEN precio_uf END AS precio_uf FROM usable),
attached AS (SELECT capped.*, r.uf FROM capped
LEFT JOIN (SELECT DISTINCT date, uf FROM rates) r ON r.date = fecha_escritura)"""


CAPS = ("AND precio_clp <= 40000000000", "AND precio_uf <= 1000000")
FINAL = f"""final AS (SELECT {ROL_LIST}, fecha_escritura,
cast(coalesce(precio_clp, precio_uf * uf) AS float) AS precio_clp,
cast(coalesce(precio_uf, precio_clp / uf) AS float) AS precio_uf FROM attached)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


def _sales(caps=CAPS, to_int=_int) -> str:
    return _with(RAW_SALES, RAW_RATES, _typed(to_int), RATES, USABLE, _attached(*caps), FINAL)


def _counts(conditions: dict[str, str], source: str) -> str:
    figures = ", ".join(
        f"count(*) FILTER (WHERE {cond}) AS {name}" for name, cond in conditions.items()
    )
    return f"SELECT {figures} FROM {source}"


# -- profile ------------------------------------------------------------------------

VALUES = f"""vals AS (SELECT *, {
    ", ".join(f"{e} AS valor_{c}" for c, e in _read().items())} FROM raw)"""


def _blank(c: str) -> str:
    return f"({c} IS NULL OR trim({c}) = '')"


def _controls() -> dict[str, str]:
    day = "valor_fecha_escritura"
    found = {
        "rol_faltante": " OR ".join(_blank(c) for c in ROL),
        "fecha_faltante": _blank("fecha_escritura"),
        "fecha_invalida": f"NOT {_blank('fecha_escritura')} AND {day} IS NULL",
        "fecha_fuera_de_rango": f"year({day}) < 1950 OR {day} > {TODAY}",
        "ambos_precios_faltantes": " AND ".join(_blank(c) for c in PRICES),
        "ambos_precios_sin_valor_numerico": " AND ".join(f"valor_{c} IS NULL" for c in PRICES),
    }
    for c in (*ROL, *PRICES):
        found[f"{c}_faltante"] = _blank(c)
        found[f"{c}_invalido"] = f"NOT {_blank(c)} AND valor_{c} IS NULL"
    for c in ROL:
        found[f"{c}_no_entero"] = f"try_cast(trim({c}) AS double) <> valor_{c}"
    for c in PRICES:
        found[f"{c}_no_positivo"] = f"valor_{c} <= 0"
    return found


def _rows(conditions: dict[str, str], source: str, extra: str = "") -> str:
    return "\nUNION ALL ".join(
        f"SELECT {extra}'{name}' AS control, "
        f"count(*) FILTER (WHERE {cond}) AS registros FROM {source}"
        for name, cond in conditions.items()
    )


NULLS = {c: f"{c} IS NULL" for c in RAW_COLUMNS}
BLANKS = {c: _blank(c) for c in RAW_COLUMNS}
PROFILE = _with(RAW_SALES, VALUES)
POSITIVE = f"""positive AS ({" UNION ALL ".join(
    f"SELECT '{c}' AS precio, valor_{c} AS valor FROM vals WHERE valor_{c} > 0"
    for c in PRICES)})"""
LIMITS = """quartiles AS (SELECT precio, quantile_disc(valor, 0.25) AS q1,
quantile_disc(valor, 0.5) AS mediana, quantile_disc(valor, 0.75) AS q3
FROM positive GROUP BY precio),
limits AS (SELECT *, q3 - q1 AS iqr, q1 - 1.5 * (q3 - q1) AS limite_inferior,
q3 + 1.5 * (q3 - q1) AS limite_superior FROM quartiles)"""
SPREAD = _with(RAW_SALES, VALUES, POSITIVE, LIMITS)
REPEATED = ", ".join(f"valor_{c} AS {c}" for c in (*ROL, "fecha_escritura"))


# -- cadastre -----------------------------------------------------------------------


def _tidy(c: str) -> str:
    return f"nullif(trim({c}), '')"


def _cast_to(table: str, names=None) -> str:
    return ", ".join(
        f"cast({_tidy(name)} AS {kind}) AS {name}"
        for name, kind in SCHEMAS[table].items()
        if names is None or name in names
    )


def _buildings(periods: bool = False) -> str:
    return f"""{_raw_buildings(periods)},
buildings AS (SELECT {_cast_to("construcciones")} FROM raw_buildings)"""


TOTALS = ("superficie_total_construcciones", "ano_construccion")
OWN = [c for c in SCHEMAS["no_agricola"] if c not in TOTALS]
COMMON = ", ".join(
    f"cast({_tidy(c)} AS integer) AS {c}" for c in ("cod_com_bc", "cod_mz_bc", "cod_pr_bc")
)
NO_AGRICOLA = f"""SELECT {", ".join(f"p.{c}" for c in OWN)},
cast(t.superficie_total_construcciones AS integer) AS superficie_total_construcciones,
t.ano_construccion FROM properties p LEFT JOIN totals t USING (periodo, {ROL_LIST})"""


def _properties(periods: bool = False) -> str:
    return f"""{_raw_properties(periods)},
properties AS (SELECT {_cast_to("no_agricola", OWN)}, {COMMON} FROM raw_properties)"""


def _totals(year: str = "ano_construccion > 0") -> str:
    return f"""totals AS (SELECT periodo, {ROL_LIST},
cast(sum(superficie_construida) AS bigint) AS superficie_total_construcciones,
min(ano_construccion) FILTER (WHERE {year}) AS ano_construccion
FROM buildings GROUP BY periodo, {ROL_LIST})"""


def _cadastre(periods: bool = False) -> str:
    return _with(_buildings(periods), _totals(), _properties(periods))


LINK = "coalesce(cod_com_bc <> 0 AND cod_pr < 70000, false)"
NEXO = ", ".join(SCHEMAS["nexo_bc"])


def _lookup(columns: dict[str, str], table: str, source: str) -> str:
    return "SELECT " + ", ".join(
        f"cast({columns[c]} AS {kind}) AS {c}" for c, kind in SCHEMAS[table].items()
    ) + f" FROM {source}"


def _nulled(c: str) -> str:
    return f"CASE WHEN {c} <> '' THEN {c} END AS {c}"


def _hashed(c: str) -> str:
    """A price as the sample's hash spells it."""
    text = f"CAST(CAST(floor({c} * 100) AS bigint) AS varchar)"
    return f"coalesce(length({text}) || ':' || {text}, '-')"


def _described(source: str) -> str:
    return " UNION ALL ".join(
        f"""SELECT '{c}' AS precio, count(valor_{c}) AS registros,
        printf('%.8e', avg(valor_{c})) AS media,
        printf('%.8e', stddev_samp(valor_{c})) AS desviacion,
        min(valor_{c}) AS minimo, max(valor_{c}) AS maximo FROM {source}""" for c in PRICES)


def _summary(sources: dict[str, str]) -> str:
    """Rows, cells that aren't null, and the sum of all whole numbers, per table."""
    found = []
    for table, source in sources.items():
        columns = SCHEMAS[table]
        cells = " + ".join(f"count({c})" for c in columns)
        whole = [c for c, kind in columns.items() if kind in ("integer", "bigint")]
        total = " + ".join(f"coalesce(sum({c}), 0)" for c in whole) or "0"
        found.append(f"SELECT '{table}' AS tabla, count(*) AS registros, {cells} AS celdas, "
                     f"cast({total} AS bigint) AS suma FROM ({source})")
    return " UNION ALL ".join(found)


PENDING = {
    "clp_pendiente": "precio_clp IS NULL",
    "uf_pendiente": "precio_uf IS NULL",
    "ambos_pendientes_conservados": "precio_clp IS NULL AND precio_uf IS NULL",
}


def oracles() -> dict[str, str]:
    sales = _sales()
    typed = _with(RAW_SALES, _typed())
    bad_rol = " OR ".join(f"{c} IS NULL" for c in ROL)
    audits = {
        "clean": {
            "rol_faltante_o_invalido": bad_rol,
            "fecha_faltante_o_invalida": "fecha_escritura IS NULL",
            "filas_eliminadas_por_rol_o_fecha": f"{bad_rol} OR fecha_escritura IS NULL",
            "clp_no_positivo": "precio_clp <= 0",
            "uf_no_positivo": "precio_uf <= 0",
            "ambos_sin_valor_numerico": "precio_clp IS NULL AND precio_uf IS NULL",
        },
        "cap": {
            "uf_sobre_limite_plausible": "precio_uf > 1000000",
            "clp_sobre_limite_plausible": "precio_clp > 40000000000",
        },
        "impute": {
            "transacciones_tras_limpieza": "true",
            "ambos_ausentes_conservados": "precio_clp IS NULL AND precio_uf IS NULL",
            "sin_conversion_diaria": "uf IS NULL",
            "clp_a_imputar": "precio_clp IS NULL AND precio_uf IS NOT NULL AND uf IS NOT NULL",
            "uf_a_imputar": "precio_uf IS NULL AND precio_clp IS NOT NULL AND uf IS NOT NULL",
        },
    }
    found = {
        "precios": sales + "SELECT * FROM final",
        "precios_uncapped": _sales(caps=("", "")) + "SELECT * FROM final",
        "precios_strict_key": _sales(to_int=_strict_int) + "SELECT * FROM final",
        "clean_audit": typed + _counts(audits["clean"], "typed"),
        "cap_audit": _with(RAW_SALES, _typed(), USABLE) + _counts(audits["cap"], "usable"),
        "impute_audit": sales + _counts(audits["impute"], "attached"),
        "sales_audit": sales + "SELECT * FROM " + ", ".join(
            f"({_counts(conditions, source)})" for conditions, source in (
                (audits["clean"], "typed"), (audits["cap"], "usable"),
                (audits["impute"], "attached"), (PENDING, "final"))),
        "pending_audit": sales + _counts(PENDING, "final"),
        "nonfinite_audit": _sales(caps=("", "")) + """SELECT
            count(*) FILTER (WHERE cod_com % 50 = 0 AND precio_clp * 1e38 > 3.4028235677973366e38)
                AS precio_clp,
            count(*) FILTER (WHERE cod_com % 40 = 0) AS precio_uf FROM final""",
        "no_price": sales + _counts(
            {"ambos_precios_pendientes": PENDING["ambos_pendientes_conservados"]}, "final"),
        "uf_reference": _with(RAW_RATES, RATES) + "SELECT DISTINCT date, uf FROM rates",
        "uf_table": _with(RAW_RATES, RATES) + "SELECT date, cast(uf AS float) AS uf FROM rates",
        "uf_invalid": _with(FAULTY_RATES, RATES)
        + "SELECT date, uf FROM rates WHERE date IS NULL OR uf IS NULL OR uf <= 0",
        "uf_conflicts": _with(FAULTY_RATES, RATES)
        + "SELECT date, count(*) AS valores FROM (SELECT DISTINCT date, uf FROM rates) "
        "GROUP BY date HAVING count(*) > 1",
        "side_by_side": PROFILE + "SELECT * FROM vals",
        "row_count": _with(RAW_SALES) + "SELECT count(*) AS registros FROM raw",
        "null_profile": _with(RAW_SALES) + _counts(NULLS, "raw"),
        "blank_profile": _with(RAW_SALES) + _counts(BLANKS, "raw"),
        "controls": PROFILE + _rows(_controls(), "vals"),
        "profile_counts": PROFILE + "\nUNION ALL ".join(
            _rows(conditions, "vals", f"'{group}' AS grupo, ")
            for group, conditions in {
                "total": {"registros": "true"}, "nulos": NULLS,
                "vacios": BLANKS, "controles": _controls(),
            }.items()),
        "exact_duplicate_count": _with(RAW_SALES) + """SELECT cast(sum(n) AS bigint) AS registros,
            count(*) AS unicos, cast(sum(n) - count(*) AS bigint) AS duplicados
            FROM (SELECT count(*) AS n FROM raw GROUP BY ALL)""".replace(
                "GROUP BY ALL", "GROUP BY " + ", ".join(RAW_COLUMNS)),
        "exact_dedup": _with(RAW_SALES) + "SELECT DISTINCT * FROM raw",
        "repeated_keys": PROFILE + f"""SELECT {REPEATED}, count(*) AS registros FROM vals
            GROUP BY 1, 2, 3, 4 HAVING count(*) > 1""",
        "repeated_top": PROFILE + f"""SELECT {REPEATED}, count(*) AS registros FROM vals
            GROUP BY 1, 2, 3, 4 HAVING count(*) > 1 ORDER BY registros DESC,
            1 NULLS FIRST, 2 NULLS FIRST, 3 NULLS FIRST, 4 NULLS FIRST LIMIT 5""",
        "bad_dates": PROFILE + f"""SELECT fecha_escritura FROM vals
            WHERE NOT {_blank("fecha_escritura")} AND valor_fecha_escritura IS NULL""",
        "describe": PROFILE + _described("vals"),
        "describe_plausible": PROFILE + """, plausible AS (SELECT
            CASE WHEN valor_precio_clp > 0 AND valor_precio_clp <= 40000000000
                THEN valor_precio_clp END AS valor_precio_clp,
            CASE WHEN valor_precio_uf > 0 AND valor_precio_uf <= 1000000
                THEN valor_precio_uf END AS valor_precio_uf FROM vals) """
        + _described("plausible"),
        "positive_prices": _with(RAW_SALES, VALUES, POSITIVE)
        + "SELECT precio, valor, count(*) AS n FROM positive GROUP BY precio, valor",
        "iqr": SPREAD + """SELECT precio, q1, q3, iqr, limite_inferior, limite_superior,
            count(*) AS validos,
            count(*) FILTER (WHERE valor < limite_inferior) AS bajo_limite,
            count(*) FILTER (WHERE valor > limite_superior) AS sobre_limite
            FROM positive JOIN limits USING (precio) GROUP BY 1, 2, 3, 4, 5, 6""",
        "box": SPREAD + """SELECT precio, q1, mediana, q3,
            min(valor) FILTER (WHERE valor BETWEEN limite_inferior AND limite_superior)
                AS bigote_inferior,
            max(valor) FILTER (WHERE valor BETWEEN limite_inferior AND limite_superior)
                AS bigote_superior,
            count(*) FILTER (WHERE valor NOT BETWEEN limite_inferior AND limite_superior)
                AS atipicos, count(*) AS validos
            FROM positive JOIN limits USING (precio) GROUP BY 1, 2, 3, 4""",
        "quartiles_approx": _with(RAW_SALES, VALUES, POSITIVE)
        + """SELECT precio, p, count(*) AS validos, true AS dentro_del_error
            FROM positive, (VALUES (cast(0.25 AS double)), (0.5), (0.75)) probs(p)
            GROUP BY precio, p""",
        "quartiles_merged": _with(RAW_SALES, _typed(_int)) + """
            SELECT precio, p, count(*) AS validos, true AS dentro_del_error FROM ("""
        + " UNION ALL ".join(
            f"SELECT '{c}' AS precio FROM typed WHERE {c} > 0" for c in PRICES)
        + """), (VALUES (cast(0.25 AS double)), (0.5), (0.75)) probs(p) GROUP BY precio, p""",
        "tidy_properties": _with(_raw_properties()) + "SELECT " + ", ".join(
            f"{_tidy(c)} AS {c}" for c in (*fx.PROPERTIES, "periodo")) + " FROM raw_properties",
        "construcciones": _with(_buildings()) + "SELECT * FROM buildings",
        "building_totals": _with(_buildings(), _totals()) + "SELECT * FROM totals",
        "building_totals_any_year": _with(_buildings(), _totals("true")) + "SELECT * FROM totals",
        "no_agricola": _cadastre() + NO_AGRICOLA,
        "no_agricola_periods": _cadastre(True) + NO_AGRICOLA,
        "nexo_bc": _with(_properties()) + f"SELECT {NEXO} FROM properties WHERE {LINK}",
        "nexo_bad": _with(_properties()) + f"SELECT {NEXO} FROM properties WHERE NOT {LINK}",
        "with_buildings": _cadastre() + f"""SELECT {ROL_LIST}, periodo, {", ".join(TOTALS)}
            FROM ({NO_AGRICOLA}) WHERE superficie_total_construcciones IS NOT NULL""",
        "period_counts": _with(_buildings(True))
        + "SELECT periodo, count(*) AS registros FROM buildings GROUP BY periodo",
        "foreign_periods": _with(_properties(True))
        + f"SELECT periodo, count(*) AS registros FROM properties "
        f"WHERE periodo <> '{fx.PERIODS[0]}' GROUP BY periodo",
        "coordenadas": _lookup(fx.COORDINATES, "coordenadas", "supplier"),
        "comuna_region": """SELECT n_nationkey AS cod_com, r_regionkey AS cod_region,
            n_name AS comuna, r_name AS region
            FROM nation JOIN region ON n_regionkey = r_regionkey""",
        "destino": _lookup(
            fx.USES, "codigo_destino", "(SELECT DISTINCT o_orderpriority FROM orders)"),
        "material": "SELECT DISTINCT p_brand AS cod_material, p_brand AS descripcion_material "
        "FROM part",
        "csv_prices": _with(RAW_SALES) + "SELECT " + ", ".join(map(_nulled, RAW_COLUMNS))
        + " FROM raw",
        "csv_precios": sales + "SELECT * FROM final",
        "csv_cadastre": _cadastre(True) + NO_AGRICOLA,
        "round_trip": _with(_properties(True)) + f"SELECT {NEXO} FROM properties WHERE {LINK}",
        "empty_period": _with(_properties(True))
        + f"SELECT {NEXO} FROM properties WHERE {LINK} AND periodo <> '{fx.PERIODS[0]}'",
        "table_round_trip": sales + "SELECT * FROM final",
        "sql_head": sales + "SELECT * FROM final ORDER BY " + ", ".join(
            f"{c} NULLS FIRST" for c in RAW_COLUMNS) + " LIMIT 10",
        "sql_counts": _with(_buildings(True), _properties(True),
                            f"links AS (SELECT * FROM properties WHERE {LINK})")
        + " UNION ALL ".join(
            f"SELECT '{name}' AS tabla, periodo, count(*) AS registros FROM {source} "
            f"GROUP BY periodo UNION ALL "
            f"SELECT '{name}', 'total', count(*) FROM {source}"
            for name, source in {"construcciones": "buildings", "no_agricola": "properties",
                                 "nexo_bc": "links"}.items())
        + f" UNION ALL SELECT 'nexo_bc', 'nexos_invalidos', count(*) FROM links WHERE NOT {LINK}",
        "sql_pending": sales + _counts(
            {"ambos_precios_pendientes": PENDING["ambos_pendientes_conservados"]}, "final"),
    }
    found |= {
        "sample": _with(RAW_SALES, VALUES) + f"""SELECT {", ".join(PRICES)} FROM (
            SELECT *, md5('42,' || row_number() OVER (PARTITION BY {", ".join(PRICES)}) || ','
                || {" || ".join(map(_hashed, PRICES))}) AS h
            FROM (SELECT {", ".join(f"valor_{c} AS {c}" for c in PRICES)} FROM vals))
            ORDER BY h, {", ".join(f"{c} NULLS FIRST" for c in PRICES)} LIMIT 1000""",
        "csv_headers": _with(RAW_SALES) + "SELECT " + ", ".join(map(_nulled, RAW_COLUMNS[:-1]))
        + f""", CASE WHEN length(concat({", ".join(RAW_COLUMNS)})) % 3 <> 2 AND {RAW_COLUMNS[-1]} <> ''
            THEN {RAW_COLUMNS[-1]} END AS {RAW_COLUMNS[-1]} FROM raw""",
        "refusals": """SELECT * FROM (VALUES ('destino_ajeno', true), ('periodo_ajeno', true),
            ('nexo_invalido', true), ('tabla_vacia', true), ('fuente_vacia', true),
            ('no_finito', true), ('esquema', true), ('uf_invalida', true),
            ('uf_contradictoria', true), ('correcta', false), ('simultanea', true),
            ('simultanea_aparte', false)) t(caso, rechazado)""",
        "csv_ragged": _with(_raw_buildings(True)) + """SELECT periodo,
            CASE WHEN cast(cod_pr AS bigint) % 97 = 0 THEN 'corta' ELSE 'larga' END AS ancho,
            count(*) AS registros FROM raw_buildings
            WHERE cast(cod_pr AS bigint) % 97 = 0 OR cast(cod_pr AS bigint) % 89 = 0
            GROUP BY 1, 2""",
        "job_prices": sales + _summary({
            "precios_transaccionales": "SELECT * FROM final",
            "precios_uf": "SELECT date, cast(uf AS float) AS uf FROM rates",
            "coordenadas": found["coordenadas"],
            "codigo_comuna_region": found["comuna_region"],
            "codigo_destino": found["destino"],
            "codigo_material": found["material"],
        }),
        "job_publish_recovery": sales + """, n AS (
            SELECT (SELECT count(*) FROM final WHERE cod_pr % 2 = 0) AS pocas,
                   (SELECT count(*) FROM final) AS todas, (SELECT count(*) FROM rates) AS tasas)
            SELECT estado, tabla, CASE WHEN tabla = 'precios_uf' THEN
                CASE WHEN nueva THEN tasas ELSE 1 END ELSE CASE WHEN nueva THEN todas ELSE pocas END
                END AS registros
            FROM n, (VALUES ('antes', false), ('muerta_sin_publicar', false),
                ('muerta_publicada', true), ('recuperada', true)) e(estado, nueva),
                (VALUES ('precios_transaccionales'), ('precios_uf')) t(tabla)""",
        "job_cadastre": _cadastre(True) + _summary({
            "construcciones": "SELECT * FROM buildings",
            "no_agricola": NO_AGRICOLA,
            "nexo_bc": f"SELECT {NEXO} FROM properties WHERE {LINK}",
        }),
        # A text file doesn't tell empty from missing: both are read as null.
        "job_profile_counts": found["profile_counts"].replace(PROFILE, _with(
            RAW_SALES, f"text AS (SELECT {', '.join(map(_nulled, RAW_COLUMNS))} FROM raw)",
            VALUES.replace("FROM raw", "FROM text"))),
        "job_profile_iqr": found["iqr"],
        "job_profile_box": found["box"],
    }
    return {f"q_{name}": sql for name, sql in found.items()}
