"""Every registered query: (session, folder of test tables) → DataFrame."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from predial.contracts import (
    PERIOD_TABLES,
    PRICES,
    RAW_BUILDINGS,
    RAW_PROPERTIES,
    RAW_SALES,
    SCHEMAS,
    ContractError,
)
from predial.operators import quantiles, sketches
from predial.operators.casting import check_schema, conform
from predial.operators.counting import count_by
from predial.operators.duplicates import exact_duplicates, most_repeated
from predial.plans import cadastre, jobs, lookups, prices, profile
from predial.plans.publish import publish
from predial.session import configure, scratch_root
from predial.sinks import catalog, commits, guards
from predial.sinks.folders import Folders
from predial.sinks.staging import Stage
from predial.sources.tables import read_period, read_table
from predial.sources.text import (
    WIDTH,
    period_path,
    read_headered,
    read_periods,
    tidy_text,
    width_report,
)
from workload import views
from workload.fixture_columns import PERIODS

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

TODAY = dt.date(2001, 6, 30)  # so that dates after "today" occur and results repeat


def query(function: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(configure(spark), sf_dir)

    QUERIES[f"q_{function.__name__}"] = run
    return run


# -- sales ------------------------------------------------------------------------


def _rates(spark, sf_dir):
    return prices.type_rates(views.raw_rates(spark, sf_dir))


def _typed(spark, sf_dir):
    return prices.type_sales(views.raw_sales(spark, sf_dir))


def _publish_final(spark, sf_dir, label):
    """The finished sale table as a published folder; its rows are computed once."""
    root, name = replaceable_folder(spark, label), "precios_transaccionales"
    publish({name: _final(spark, sf_dir)}, root, root)
    return f"{root}/{name}"


def _final(spark, sf_dir, **options):
    return prices.build_precios(
        views.raw_sales(spark, sf_dir), _rates(spark, sf_dir), **options
    )


@query
def precios(spark, sf_dir):
    return _final(spark, sf_dir)


@query
def precios_uncapped(spark, sf_dir):
    return _final(spark, sf_dir, clp_cap=None, uf_cap=None)


@query
def precios_strict_key(spark, sf_dir):
    return _final(spark, sf_dir, strict_key=True)


@query
def clean_audit(spark, sf_dir):
    return prices.clean_audit(_typed(spark, sf_dir))


@query
def cap_audit(spark, sf_dir):
    return prices.cap_audit(_typed(spark, sf_dir))


@query
def impute_audit(spark, sf_dir):
    rates = _rates(spark, sf_dir)
    dates = prices.check_rates(rates)
    capped = prices.cap_prices(_typed(spark, sf_dir))
    return prices.impute_audit(
        prices.attach_rates(capped, prices.rate_reference(rates), dates)
    )


@query
def pending_audit(spark, sf_dir):
    return prices.pending_audit(_final(spark, sf_dir))


@query
def sales_audit(spark, sf_dir):
    """All four audits in one scan."""
    rates = _rates(spark, sf_dir)
    dates = prices.check_rates(rates)
    return prices.sales_audit(_typed(spark, sf_dir), prices.rate_reference(rates), dates)


@query
def nonfinite_audit(spark, sf_dir):
    """Prices that overflow their type: made huge, by key, after the caps were left out."""
    final = _final(spark, sf_dir, clp_cap=None, uf_cap=None)
    huge = final.withColumns({
        "precio_clp": F.when(F.col("cod_com") % 50 == 0, F.col("precio_clp").cast("double") * 1e38)
        .otherwise(F.col("precio_clp")).cast("float"),
        "precio_uf": F.when(F.col("cod_com") % 40 == 0, float("nan"))
        .otherwise(F.col("precio_uf")).cast("float"),
    })
    return guards.non_finite_audit(huge, "precios_transaccionales")


@query
def no_price(spark, sf_dir):
    return prices.pending_audit(_final(spark, sf_dir)).select(
        F.col("ambos_pendientes_conservados").alias("ambos_precios_pendientes")
    )


# -- daily rate -------------------------------------------------------------------


@query
def uf_reference(spark, sf_dir):
    rates = _rates(spark, sf_dir)
    prices.check_rates(rates)
    return prices.rate_reference(rates)


@query
def uf_table(spark, sf_dir):
    return prices.build_uf(_rates(spark, sf_dir))


def _faulty(spark, sf_dir):
    return prices.type_rates(views.raw_faulty_rates(spark, sf_dir))


@query
def uf_invalid(spark, sf_dir):
    return prices.invalid_rates(_faulty(spark, sf_dir))


@query
def uf_conflicts(spark, sf_dir):
    return prices.conflicting_rates(_faulty(spark, sf_dir))


# -- profile ----------------------------------------------------------------------


def _values(spark, sf_dir):
    return profile.with_values(views.raw_sales(spark, sf_dir))


@query
def side_by_side(spark, sf_dir):
    return _values(spark, sf_dir)


@query
def row_count(spark, sf_dir):
    return views.raw_sales(spark, sf_dir).agg(F.count("*").alias("registros"))


@query
def null_profile(spark, sf_dir):
    return profile.null_profile(views.raw_sales(spark, sf_dir))


@query
def blank_profile(spark, sf_dir):
    return profile.blank_profile(views.raw_sales(spark, sf_dir))


@query
def controls(spark, sf_dir):
    return profile.controls(_values(spark, sf_dir), TODAY)


@query
def profile_counts(spark, sf_dir):
    return profile.profile_counts(_values(spark, sf_dir), TODAY)


@query
def exact_duplicate_count(spark, sf_dir):
    return exact_duplicates(views.raw_sales(spark, sf_dir))


@query
def exact_dedup(spark, sf_dir):
    return views.raw_sales(spark, sf_dir).distinct()


@query
def repeated_keys(spark, sf_dir):
    return profile.repeated_sales(_values(spark, sf_dir))


@query
def repeated_top(spark, sf_dir):
    return most_repeated(profile.repeated_sales(_values(spark, sf_dir)))


@query
def bad_dates(spark, sf_dir):
    return profile.unreadable_dates(_values(spark, sf_dir))


def _prices(spark, sf_dir):
    return profile.read_prices(_values(spark, sf_dir))


def _described(prices_of):
    found = quantiles.describe(prices_of, PRICES)
    for c in ("media", "desviacion"):
        found = found.withColumn(c, F.format_string("%.8e", c))
    return found


@query
def describe(spark, sf_dir):
    return _described(_prices(spark, sf_dir))


@query
def describe_plausible(spark, sf_dir):
    """Without the extreme values, which would hide a wrong mean of the others."""
    return _described(prices.cap_prices(_prices(spark, sf_dir)))


def _exact(spark, sf_dir):
    positive = quantiles.positive_values(_prices(spark, sf_dir), PRICES)
    counts = quantiles.collapse(positive)
    return quantiles.spread(counts, quantiles.fences(quantiles.exact_quantiles(counts)))


@query
def positive_prices(spark, sf_dir):
    return quantiles.collapse(quantiles.positive_values(_prices(spark, sf_dir), PRICES))


@query
def iqr(spark, sf_dir):
    return quantiles.iqr_report(_exact(spark, sf_dir))


@query
def box(spark, sf_dir):
    return quantiles.box_summary(_exact(spark, sf_dir))


def _within_error(positive: DataFrame, found: DataFrame) -> DataFrame:
    """Whether the rank of each quantile found is within the allowed error."""
    ranked = positive.join(F.broadcast(found), "precio").groupBy("precio", "p").agg(
        F.count("*").alias("validos"),
        F.count_if(F.col("valor") < F.col("cuantil")).alias("below"),
        F.count_if(F.col("valor") <= F.col("cuantil")).alias("up_to"),
    )
    slack = F.ceil(F.lit(quantiles.QUARTILE_ERROR) * F.col("validos")) + 1
    rank = F.col("p") * F.col("validos")
    close = (F.col("below") <= rank + slack) & (F.col("up_to") >= rank - slack)
    return ranked.select("precio", "p", "validos", close.alias("dentro_del_error"))


@query
def quartiles_approx(spark, sf_dir):
    """One-pass quartiles, each with proof that its rank is within the allowed error."""
    positive = quantiles.positive_values(_prices(spark, sf_dir), PRICES)
    return _within_error(positive, quantiles.approx_quantiles(positive))


@query
def quartiles_merged(spark, sf_dir):
    """Quartiles from stored sketches of years, delivered in two parts, one year twice."""
    path = replaceable_folder(spark, "sketches")
    sales, year = _typed(spark, sf_dir), F.year("fecha_escritura")
    late = F.coalesce(year >= 1995, F.lit(False))
    for delivered in (~late, late, F.coalesce(year == 1996, F.lit(False))):
        sketches.store_sketches(sketches.part_sketches(sales.filter(delivered), PRICES, year), path)
    found = sketches.merged_quantiles(sketches.read_sketches(spark, path))
    return _within_error(quantiles.positive_values(sales, PRICES), found)


@query
def sample(spark, sf_dir):
    """The very rows, which don't depend on partitioning."""
    values = _values(spark, sf_dir)
    return profile.sample_view(values, max_rows=1000)


def _overlapping(spark, links, root, ours, theirs):
    """A run that began before another one published."""
    since = commits.begin(spark, root)
    for periods, began in ((theirs, None), (ours, since)):
        rows = links.filter(F.col("periodo").isin(*periods))
        publish({"nexo_bc": rows}, root, root, periods, since=began)


@query
def refusals(spark, sf_dir):
    """Each guard on a bad frame made from the tables, and what it says."""
    links = cadastre.build_nexo_bc(_properties(spark, sf_dir, periods=True))
    final = _final(spark, sf_dir)
    first = PERIODS[:1]
    in_first = links.filter(F.col("periodo") == first[0])
    infinite = final.withColumn("precio_clp", (F.col("precio_clp") * F.lit(1e38)).cast("float"))
    attempts = {
        "destino_ajeno": lambda root: publish({"nexo_bc": links}, f"{root}x", root, PERIODS),
        "periodo_ajeno": lambda root: publish({"nexo_bc": links}, root, root, first),
        "nexo_invalido": lambda root: publish(
            {"nexo_bc": in_first.withColumn("cod_pr", F.lit(70_000))}, root, root, first),
        "tabla_vacia": lambda root: publish(
            {"precios_transaccionales": final.filter("cod_com < 0")}, root, root),
        "fuente_vacia": lambda root: guards.check_not_empty(final.filter("cod_com < 0"), "x"),
        "no_finito": lambda root: publish({"precios_transaccionales": infinite}, root, root),
        "esquema": lambda root: publish({"nexo_bc": links.drop("cod_pr")}, root, root, PERIODS),
        "uf_invalida": lambda root: prices.check_rates(_faulty(spark, sf_dir)),
        "uf_contradictoria": lambda root: prices.check_rates(
            _faulty(spark, sf_dir).filter("uf > 0")),
        "correcta": lambda root: publish({"nexo_bc": in_first}, root, root, first),
        "simultanea": lambda root: _overlapping(spark, in_first, root, first, first),
        "simultanea_aparte": lambda root: _overlapping(spark, links, root, first, PERIODS[1:]),
    }
    found = []
    for name, attempt in attempts.items():
        with Stage(spark, "refusals") as stage:
            try:
                attempt(f"{stage.folder}/out")
                found.append((name, False))
            except ContractError:
                found.append((name, True))
    return spark.createDataFrame(found, "caso string, rechazado boolean")


# -- cadastre ---------------------------------------------------------------------


def _buildings(spark, sf_dir, periods=False):
    return cadastre.build_construcciones(tidy_text(views.raw_buildings(spark, sf_dir, periods)))


def _properties(spark, sf_dir, periods=False):
    return cadastre.type_properties(tidy_text(views.raw_properties(spark, sf_dir, periods)))


def _no_agricola(spark, sf_dir, periods=False, positive_only=True):
    totals = cadastre.building_totals(_buildings(spark, sf_dir, periods), positive_only)
    return cadastre.build_no_agricola(_properties(spark, sf_dir, periods), totals)


@query
def tidy_properties(spark, sf_dir):
    return tidy_text(views.raw_properties(spark, sf_dir))


@query
def construcciones(spark, sf_dir):
    return _buildings(spark, sf_dir)


@query
def building_totals(spark, sf_dir):
    return cadastre.building_totals(_buildings(spark, sf_dir))


@query
def building_totals_any_year(spark, sf_dir):
    return cadastre.building_totals(_buildings(spark, sf_dir), positive_only=False)


@query
def no_agricola(spark, sf_dir):
    return _no_agricola(spark, sf_dir)


@query
def no_agricola_periods(spark, sf_dir):
    return _no_agricola(spark, sf_dir, periods=True)


@query
def nexo_bc(spark, sf_dir):
    return cadastre.build_nexo_bc(_properties(spark, sf_dir))


@query
def nexo_bad(spark, sf_dir):
    return guards.bad_links(conform(_properties(spark, sf_dir), SCHEMAS["nexo_bc"]))


@query
def with_buildings(spark, sf_dir):
    return cadastre.with_buildings(_no_agricola(spark, sf_dir))


@query
def period_counts(spark, sf_dir):
    return count_by(_buildings(spark, sf_dir, periods=True), "periodo")


@query
def foreign_periods(spark, sf_dir):
    return guards.foreign_periods(_properties(spark, sf_dir, periods=True), PERIODS[:1])


# -- lookups ----------------------------------------------------------------------


@query
def coordenadas(spark, sf_dir):
    return lookups.build_lookup(views.raw_coordinates(spark, sf_dir), "coordenadas")


@query
def comuna_region(spark, sf_dir):
    return lookups.build_lookup(views.raw_communes(spark, sf_dir), "codigo_comuna_region")


@query
def destino(spark, sf_dir):
    return lookups.build_lookup(views.raw_uses(spark, sf_dir), "codigo_destino")


@query
def material(spark, sf_dir):
    return lookups.build_lookup(views.raw_materials(spark, sf_dir), "codigo_material")


# -- files, sinks, catalog --------------------------------------------------------

KEEP_SPACES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}


def write_text(df: DataFrame, path: str, **options) -> None:
    df.write.options(**KEEP_SPACES, **options).csv(path)


def replaceable_folder(spark: SparkSession, label: str) -> str:
    """A folder of its own for each query and application; a rerun replaces what it left.

    Results read it, so it can't go with the query.
    """
    folder = f"{scratch_root(spark)}/predial/workload/{spark.sparkContext.applicationId}/{label}"
    Stage.at(spark, folder).release()
    return folder


def write_sales(spark: SparkSession, sf_dir: str, label: str = "sales") -> str:
    """Raw sales as a file with the header its source would carry."""
    path = f"{replaceable_folder(spark, label)}/precios_transaccionales.csv"
    titles = [c.upper() for c in RAW_SALES]
    write_text(views.raw_sales(spark, sf_dir).toDF(*titles), path, header=True)
    return path


def write_cadastre(spark: SparkSession, sf_dir: str, label: str = "cadastre") -> str:
    base = replaceable_folder(spark, label)
    buildings = views.raw_buildings(spark, sf_dir, periods=True)
    properties = views.raw_properties(spark, sf_dir, periods=True)
    for period in PERIODS:
        for name, df, shape in (
            ("construcciones", buildings, views.building_file),
            ("no_agricola", properties, views.property_file),
        ):
            rows = shape(df.filter(F.col("periodo") == period))
            write_text(rows, period_path(base, name, period), sep="|")
    return base


@query
def csv_prices(spark, sf_dir):
    return read_headered(spark, write_sales(spark, sf_dir, "csv_prices"), RAW_SALES)


@query
def csv_headers(spark, sf_dir):
    """One folder whose files have two orders of columns, and some lack a column."""
    path = f"{replaceable_folder(spark, 'headers')}/precios_transaccionales.csv"
    raw = views.raw_sales(spark, sf_dir)
    kind = F.length(F.concat(*(F.coalesce(c, F.lit("")) for c in RAW_SALES))) % 3
    for number, columns in enumerate((RAW_SALES, RAW_SALES[::-1], RAW_SALES[:-1])):
        part = raw.filter(kind == number).select(*(F.col(c).alias(c.upper()) for c in columns))
        part.write.options(**KEEP_SPACES, header=True).mode("append").csv(path)
    return read_headered(spark, path, RAW_SALES)


@query
def csv_precios(spark, sf_dir):
    """The flagship job starting from a text file."""
    raw = read_headered(spark, write_sales(spark, sf_dir, "csv_precios"), RAW_SALES)
    return prices.build_precios(raw, _rates(spark, sf_dir))


@query
def csv_cadastre(spark, sf_dir):
    """Properties with totals from two periods of delimited files."""
    base = write_cadastre(spark, sf_dir, "csv_cadastre")
    buildings = read_periods(spark, base, "construcciones", PERIODS, RAW_BUILDINGS, marked=False)
    properties = read_periods(spark, base, "no_agricola", PERIODS, RAW_PROPERTIES, marked=False)
    totals = cadastre.building_totals(cadastre.build_construcciones(buildings))
    return cadastre.build_no_agricola(cadastre.type_properties(properties), totals)


@query
def csv_ragged(spark, sf_dir):
    """Lines too short or too long by key, counted per period by the reading scan."""
    base = replaceable_folder(spark, "ragged")
    raw = views.raw_buildings(spark, sf_dir, periods=True)
    fields = (F.coalesce(F.col(c), F.lit("")) if c in raw.columns else F.lit("") for c in RAW_BUILDINGS)
    whole, number = F.concat_ws("|", *fields), F.col("cod_pr").cast("long")
    line = F.when(number % 97 == 0, F.concat_ws("|", "cod_com", "cod_mz", "cod_pr")).when(
        number % 89 == 0, F.concat(whole, F.lit("|x|y"))
    ).otherwise(whole)
    for period in PERIODS:
        lines = raw.filter(F.col("periodo") == period).select(line.alias("value"))
        lines.write.text(period_path(base, "construcciones", period))
    marked = read_periods(spark, base, "construcciones", PERIODS, RAW_BUILDINGS)
    report = width_report(marked, "periodo")
    return report.withColumnRenamed(WIDTH, "ancho")


# -- the jobs, from text to their tables and reports -----------------------------------


def _summary(spark, root, tables):
    """One row per table: rows, cells that aren't null, and the sum of all whole numbers."""
    found = []
    for name in tables:
        df, schema = spark.read.parquet(f"{root}/{name}"), SCHEMAS[name]
        whole = [f.name for f in schema if f.dataType.simpleString() in ("int", "bigint")]
        cells = sum((F.count(c) for c in schema.names[1:]), F.count(schema.names[0]))
        total = sum((F.coalesce(F.sum(c), F.lit(0)) for c in whole), F.lit(0))
        found.append(df.agg(
            F.lit(name).alias("tabla"), F.count("*").alias("registros"), cells.alias("celdas"),
            total.cast("bigint").alias("suma"),
        ))
    return reduce(DataFrame.unionByName, found)


@query
def job_prices(spark, sf_dir):
    base = replaceable_folder(spark, "job_prices")
    sources = {
        "precios_transaccionales": views.raw_sales(spark, sf_dir),
        "precios_uf": views.raw_rates(spark, sf_dir),
        "coordenadas": views.raw_coordinates(spark, sf_dir),
        "codigo_comuna_region": views.raw_communes(spark, sf_dir),
        "codigo_destino": views.raw_uses(spark, sf_dir),
        "codigo_material": views.raw_materials(spark, sf_dir),
    }
    for name, df in sources.items():
        write_text(df, f"{base}/raw/{name}.csv", header=True)
    jobs.run_prices(spark, f"{base}/raw", f"{base}/out", f"{base}/out")
    return _summary(spark, f"{base}/out", sources)


class _Interrupted(BaseException):
    pass


class _Interrupting(Folders):
    """Renames that end after a few, as if the driver had been killed."""

    def __init__(self, spark: SparkSession, root: str, renames: int):
        super().__init__(spark, root)
        self.left = renames

    def move(self, source: str, target: str) -> bool:
        if self.left == 0:
            raise _Interrupted
        done = super().move(source, target)
        self.left -= done
        return done


@query
def job_publish_recovery(spark, sf_dir):
    """Two tables replaced by runs that are killed before the manifest's rename, and between
    the renames after it: what readers see, and what the next run leaves in the folders."""
    root = f"{replaceable_folder(spark, 'recovery')}/out"
    final, rates = _final(spark, sf_dir), prices.build_uf(_rates(spark, sf_dir))
    names = ("precios_transaccionales", "precios_uf")
    publish({names[0]: final.filter("cod_pr % 2 = 0"), names[1]: rates.limit(1)}, root, root)
    found = []

    def note(state, read):
        found.extend((state, name, read(f"{root}/{name}").count()) for name in names)

    note("antes", lambda path: read_table(spark, path))
    for state, renames in (("muerta_sin_publicar", 0), ("muerta_publicada", 3)):
        try:
            publish({names[0]: final, names[1]: rates}, root, root,
                    folders=_Interrupting(spark, root, renames))
        except _Interrupted:
            note(state, lambda path: read_table(spark, path))
    commits.recover(spark, root)
    note("recuperada", spark.read.parquet)
    return spark.createDataFrame(found, "estado string, tabla string, registros long")


@query
def job_cadastre(spark, sf_dir):
    base = write_cadastre(spark, sf_dir, "job_cadastre")
    jobs.run_cadastre(spark, base, f"{base}/out", f"{base}/out", PERIODS)
    return _summary(spark, f"{base}/out", PERIOD_TABLES)


def _profile_report(spark, sf_dir, name):
    path = write_sales(spark, sf_dir, f"job_profile_{name}")
    output = path.rsplit("/", 1)[0] + "/reports"
    return jobs.run_profile(spark, path, output, TODAY, exact=True)[name]


@query
def job_profile_counts(spark, sf_dir):
    return _profile_report(spark, sf_dir, "counts")


@query
def job_profile_iqr(spark, sf_dir):
    return _profile_report(spark, sf_dir, "iqr")


@query
def job_profile_box(spark, sf_dir):
    return _profile_report(spark, sf_dir, "box")


def publish_cadastre(spark: SparkSession, sf_dir: str) -> str:
    """All three period tables, one of them published twice: the rerun must not add."""
    root = replaceable_folder(spark, "published")
    with Stage(spark, "cadastre") as stage:
        lines = stage.keep(_buildings(spark, sf_dir, periods=True), "lines")
        owned = stage.keep(_properties(spark, sf_dir, periods=True), "owned")
        tables = {
            "construcciones": lines,
            "no_agricola": cadastre.build_no_agricola(owned, cadastre.building_totals(lines)),
            "nexo_bc": cadastre.build_nexo_bc(owned),
        }
        publish(tables, root, root, PERIODS)
        again = tables["nexo_bc"].filter(F.col("periodo") == PERIODS[0])
        publish({"nexo_bc": again}, root, root, PERIODS[:1])
    return root


@query
def round_trip(spark, sf_dir):
    """Written, one period replaced, and both read back."""
    path = replaceable_folder(spark, "round")
    links = cadastre.build_nexo_bc(_properties(spark, sf_dir, periods=True))
    publish({"nexo_bc": links}, path, path, PERIODS)
    first = links.filter(F.col("periodo") == PERIODS[0])
    publish({"nexo_bc": first}, path, path, PERIODS[:1])
    parts = [read_period(spark, f"{path}/nexo_bc", "nexo_bc", p) for p in PERIODS]
    return check_schema(parts[0].unionByName(parts[1]), SCHEMAS["nexo_bc"], "nexo_bc")


@query
def empty_period(spark, sf_dir):
    """One period cleared, the other left alone."""
    path = replaceable_folder(spark, "empty")
    links = cadastre.build_nexo_bc(_properties(spark, sf_dir, periods=True))
    publish({"nexo_bc": links}, path, path, PERIODS)
    publish({"nexo_bc": links.filter(F.lit(False))}, path, path, PERIODS[:1])
    parts = [read_period(spark, f"{path}/nexo_bc", "nexo_bc", p) for p in PERIODS]
    return parts[0].unionByName(parts[1])


@query
def table_round_trip(spark, sf_dir):
    """The sale table overwritten whole and read back through the catalog."""
    path = _publish_final(spark, sf_dir, "table")
    name = catalog.register_table(spark, "predial_ida_vuelta", "precios_transaccionales", path)
    return spark.sql(f"SELECT * FROM {name}")


@query
def sql_head(spark, sf_dir):
    path = _publish_final(spark, sf_dir, "head")
    catalog.register_table(spark, "predial_cabeza", "precios_transaccionales", path)
    return catalog.head(spark, "predial_cabeza", "precios_transaccionales")


@query
def sql_counts(spark, sf_dir):
    """Counts per table and period, and links that break the rule, in SQL on the catalog."""
    root = publish_cadastre(spark, sf_dir)
    database = "predial_conteos"
    found = []
    for name in PERIOD_TABLES:
        catalog.register_table(spark, database, name, f"{root}/{name}")
        found.append(
            catalog.period_counts(spark, database, name).withColumn("tabla", F.lit(name))
        )
        total = catalog.row_count(spark, database, name)
        found.append(total.select(F.lit("total").alias("periodo"), "registros", F.lit(name).alias("tabla")))
    bad = catalog.bad_link_count(spark, database)
    found.append(
        bad.select(
            F.lit("nexos_invalidos").alias("periodo"),
            F.col("nexos_invalidos").alias("registros"),
            F.lit("nexo_bc").alias("tabla"),
        )
    )
    result = found[0]
    for part in found[1:]:
        result = result.unionByName(part)
    return result.select("tabla", "periodo", "registros")


@query
def sql_pending(spark, sf_dir):
    path = _publish_final(spark, sf_dir, "pending")
    catalog.register_table(spark, "predial_pendientes", "precios_transaccionales", path)
    return catalog.pending_count(spark, "predial_pendientes")
