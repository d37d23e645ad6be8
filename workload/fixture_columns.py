"""Column rules that give the clean test tables the shape and dirt of raw sources.

Written in the SQL both engines share. `k` is the order key. The few words that
differ between the engines are the placeholders of `DIALECTS`.
"""

from __future__ import annotations

DIALECTS = {
    "spark": {"days": "datediff(d, date '1995-01-01')"},
    "duckdb": {"days": "datediff('day', date '1995-01-01', d)"},
}

# ROL parts of an order key.
COM = "cast(k % 346 as string)"
MZ = "cast(cast((k - k % 346) / 346 as bigint) as string)"
PR = "cast((k * 7919) % 80000 as string)"
YMD = "cast(year(d) * 10000 + month(d) * 100 + day(d) as string)"
MONEY = "cast(cast(o_totalprice as decimal(18,2)) as string)"

ORDER_KEYS = {
    "k": "o_orderkey",
    "d": "cast(o_orderdate as date)",
    "o_custkey": "o_custkey",
    "o_totalprice": "o_totalprice",
    "o_orderstatus": "o_orderstatus",
}

SALES = {
    "cod_com": f"""case when k % 101 = 0 then '' when k % 103 = 0 then 'abc'
        when k % 107 = 0 then concat({COM}, '.0')
        when k % 109 = 0 then concat(' ', {COM}, ' ')
        when k % 157 = 0 then null else {COM} end""",
    "cod_mz": MZ,
    "cod_pr": f"case when k % 163 = 0 then concat({PR}, '.7') else {PR} end",
    "fecha_escritura": f"""case when k % 113 = 0 then cast(d as string)
        when k % 127 = 0 then '' when k % 131 = 0 then '19400101' else {YMD} end""",
    "precio_clp": f"""case when k % 7 = 0 then '0' when k % 11 = 0 then ''
        when k % 137 = 0 then 'NaN' when k % 139 = 0 then '120000000000000'
        else {MONEY} end""",
    "precio_uf": """case when k % 5 = 0 then null when k % 149 = 0 then '-3'
        when k % 151 = 0 then '9700000000000'
        else cast((o_custkey * 37) % 20000 + 1 as string) end""",
}

RATE = "cast(cast(30000 + 1.5 * {days} as decimal(18,2)) as string)"
NEXT_RATE = "cast(cast(30001 + 1.5 * {days} as decimal(18,2)) as string)"
FAULTY_RATE = f"""case when month(d) = 3 and day(d) = 3 then '0'
    when month(d) = 4 and day(d) = 4 then 'x' else {RATE} end"""

LINE_KEYS = {
    "k": "l_orderkey",
    "l_linenumber": "l_linenumber",
    "l_partkey": "l_partkey",
    "l_suppkey": "l_suppkey",
    "l_quantity": "l_quantity",
    "l_returnflag": "l_returnflag",
    "l_linestatus": "l_linestatus",
    "d": "cast(l_shipdate as date)",
}

BUILDINGS = {
    "cod_com": COM,
    "cod_mz": MZ,
    "cod_pr": PR,
    "numero_linea": "cast(l_linenumber as string)",
    "cod_material": "l_returnflag",
    "cod_calidad": "cast(1 + l_partkey % 5 as string)",
    "ano_construccion": "case when l_partkey % 10 = 0 then '0' else cast(year(d) as string) end",
    "superficie_construida": "cast(cast(l_quantity as int) as string)",
    "cod_destino": "l_linestatus",
    "cod_condicion_especial": """case when l_suppkey % 3 = 0 then '  '
        else concat('C', cast(l_suppkey % 9 as string)) end""",
}

PROPERTIES = {
    "cod_com": COM,
    "cod_mz": MZ,
    "cod_pr": PR,
    "direccion": """case when k % 17 = 0 then '   '
        else concat('  CALLE ', cast(o_custkey as string), ' ') end""",
    "avaluo_fiscal_clp": """cast(cast(cast(o_totalprice as decimal(18,2)) * 1000000
        as bigint) as string)""",
    "contrib_semestrales_clp": "cast(o_custkey * 1000003 as string)",
    "cod_destino": "case when k % 19 = 0 then '' else o_orderstatus end",
    "avaluo_exento_clp": "case when k % 3 = 0 then '0' else cast(k * 100000 as string) end",
    "cod_com_bc": f"case when k % 4 = 0 then '0' when k % 4 = 1 then null else {COM} end",
    "cod_mz_bc": f"case when k % 4 = 1 then null else {MZ} end",
    "cod_pr_bc": "case when k % 4 = 1 then null else cast(70000 + k % 9999 as string) end",
    "superficie_total_terreno": "cast(100 + k % 5000 as string)",
}

# Two half-years, by key, so that a property and its buildings share one.
PERIOD = "case when k % 3 = 0 then '2025_2' else '2026_1' end"
PERIODS = ("2025_2", "2026_1")

COORDINATES = {
    "cod_com": "cast(s_nationkey as string)",
    "cod_mz": "cast(s_suppkey as string)",
    "cod_pr": "cast(s_suppkey as string)",
    "latitud": "cast(cast(s_acctbal as decimal(18,2)) as string)",
    "longitud": "cast(cast(-s_acctbal as decimal(18,2)) as string)",
}
USES = {
    "cod_destino": "substring(o_orderpriority, 1, 1)",
    "descripcion_destino": "substring(o_orderpriority, 3)",
    "tipo": "concat('T', substring(o_orderpriority, 1, 1))",
}
