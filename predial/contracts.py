"""The data contract: table schemas, raw file layouts, thresholds and names.

Column names are Spanish because they are what the files and tables carry.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DataType,
    DateType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)


class ContractError(ValueError):
    """Data, schema, path or parameter that breaks the contract."""


TYPES: dict[str, DataType] = {
    "int": IntegerType(),
    "bigint": LongType(),
    "float": FloatType(),
    "date": DateType(),
    "string": StringType(),
}


def _schema(columns: str) -> StructType:
    """Schema from `name type, …`; needs no session, unlike `StructType.fromDDL`."""
    pairs = (column.split() for column in columns.split(","))
    return StructType([StructField(name, TYPES[kind]) for name, kind in pairs])


# ---------------------------------------------------------------------------
# Fixed values. Names, types, order, limits and patterns below must stay as they
# are for the outputs to be right.
# ---------------------------------------------------------------------------

# Property key.
ROL = ("cod_com", "cod_mz", "cod_pr")

PERIOD = "periodo"
PERIOD_PATTERN = r"[0-9]{4}_[12]"

# Output tables, columns in order.
SCHEMAS: dict[str, StructType] = {
    name: _schema(columns)
    for name, columns in {
        "construcciones": """
            cod_com int, cod_mz int, cod_pr int, periodo string, numero_linea int,
            cod_calidad int, cod_destino string, cod_material string,
            superficie_construida int, cod_condicion_especial string,
            ano_construccion int""",
        "no_agricola": """
            cod_com int, cod_mz int, cod_pr int, periodo string, direccion string,
            avaluo_fiscal_clp bigint, contrib_semestrales_clp bigint,
            cod_destino string, avaluo_exento_clp bigint,
            superficie_total_terreno int, superficie_total_construcciones int,
            ano_construccion int""",
        "nexo_bc": """
            cod_com int, cod_mz int, cod_pr int, periodo string,
            cod_com_bc int, cod_mz_bc int, cod_pr_bc int""",
        "precios_transaccionales": """
            cod_com int, cod_mz int, cod_pr int, fecha_escritura date,
            precio_clp float, precio_uf float""",
        "precios_uf": "date date, uf float",
        "coordenadas": """
            cod_com int, cod_mz int, cod_pr int, latitud float, longitud float""",
        "codigo_comuna_region": """
            cod_com int, cod_region int, comuna string, region string""",
        "codigo_destino": """
            cod_destino string, descripcion_destino string, tipo string""",
        "codigo_material": "cod_material string, descripcion_material string",
    }.items()
}

PERIOD_TABLES = ("construcciones", "no_agricola", "nexo_bc")
LOOKUP_TABLES = ("coordenadas", "codigo_comuna_region", "codigo_destino", "codigo_material")

# Raw cadastre files: `|`-separated, no header, trailing separator.
RAW_BUILDINGS = (
    "cod_com", "cod_mz", "cod_pr", "numero_linea", "cod_material", "cod_calidad",
    "ano_construccion", "superficie_construida", "cod_destino",
    "cod_condicion_especial", "campo_extra", "vacia",
)
RAW_PROPERTIES = (
    "cod_com", "cod_mz", "cod_pr", "direccion", "avaluo_fiscal_clp",
    "contrib_semestrales_clp", "cod_destino", "avaluo_exento_clp", "cod_com_bc",
    "cod_mz_bc", "cod_pr_bc", "cod_com_bc2", "cod_mz_bc2", "cod_pr_bc2",
    "superficie_total_terreno", "cod_ubicacion", "cod_com_asoc", "cod_mz_asoc",
    "cod_pr_asoc", "vacia",
)

# Raw headered files whose columns are renamed by position.
RAW_SALES = ("cod_com", "cod_mz", "cod_pr", "fecha_escritura", "precio_clp", "precio_uf")
RAW_COMMUNES = ("cod_com", "cod_region", "comuna", "region")
RAW_USES = ("cod_destino", "descripcion_destino", "tipo")

PRICES = ("precio_clp", "precio_uf")
COMMON_PROPERTY = ("cod_com_bc", "cod_mz_bc", "cod_pr_bc")

SALE_DATE_FORMAT = "yyyyMMdd"
RATE_DATE_FORMAT = "yyyy-MM-dd"
FIRST_YEAR = 1950
CLP_CAP = 40_000_000_000.0
UF_CAP = 1_000_000.0
COMMON_PROPERTY_FROM = 70_000  # cod_pr from here on is itself common property
WHISKER = 1.5
QUARTILE_ERROR = 0.001
SAMPLE_ROWS = 10_000
SAMPLE_SEED = 42

# ---------------------------------------------------------------------------
# End of fixed values.
# ---------------------------------------------------------------------------

POSITIONAL_NAMES = {
    "precios_transaccionales": RAW_SALES,
    "codigo_comuna_region": RAW_COMMUNES,
    "codigo_destino": RAW_USES,
}


def subset(table: str, *, drop: tuple[str, ...] = (), extra: str = "") -> StructType:
    """The schema of `table` without some columns, with others appended."""
    fields = [f for f in SCHEMAS[table] if f.name not in drop]
    return StructType(fields + (_schema(extra).fields if extra else []))


def float_columns(schema: StructType) -> list[str]:
    return [f.name for f in schema if isinstance(f.dataType, FloatType)]
