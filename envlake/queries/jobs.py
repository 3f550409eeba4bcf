"""The named jobs from files to result tables, on files written from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.operators import header_drift
from envlake.plans import (
    JOBS,
    JobSpec,
    collect_observations,
    requested_documents,
    run,
    weather_fact,
    written_previews,
)
from envlake.queries.files import CUSTOMER_COLUMNS, RECORD_FIELDS, raw_documents, records_sql
from envlake.queries.inputs import (
    HOURLY_ORDERS_FACT_SQL,
    WEATHER_UNITS_SQL,
    daily_orders,
    daily_value_sql,
    hourly_orders,
    spread,
    table,
    unit_dimension,
    weather_units,
)
from envlake.schemas import AIR_TYPES, MEASURES, RAW_FIELDS
from envlake.sources import (
    CATALOG,
    DatasetSpec,
    inline_table,
    parse_documents,
    read_dataset,
    read_table,
    refresh,
    scratch_dir,
    write_delimited,
)
from envlake.sources.versions import manifest

_AIR_KEYS = [k for k in CATALOG if k.startswith("aire")]
# The air files are folders of one partitioned write.
AIR_CATALOG = {
    **CATALOG,
    **{k: DatasetSpec(f"crudo/fichero={k}.csv", ";", AIR_TYPES) for k in _AIR_KEYS},
}


def write_air_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    """All 13 files in one pass; the orders spread over them by their month and status."""
    names = F.array(*[F.lit(f"{k}.csv") for k in _AIR_KEYS])
    which = F.col("mes") + F.when(F.col("`punto muestreo`").endswith("_F"), 1).otherwise(0)
    (
        hourly_orders(spark, sf_dir)
        .withColumn("fichero", F.element_at(names, which.cast("int")))
        .write.partitionBy("fichero")
        .options(header=True, sep=";", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        .csv(f"{root}/crudo")
    )
    write_delimited(
        unit_dimension(spark, sf_dir), f"{root}/{CATALOG['dim_variable_aire_csv'].path}"
    )


def write_weather_files(spark: SparkSession, sf_dir: str, root: str) -> None:
    daily = CATALOG["aemet_climatologia_diaria"].path
    write_delimited(daily_orders(spark, sf_dir), f"{root}/{daily}", bom=True)
    units = CATALOG["dim_variable_meteo_csv"].path
    write_delimited(weather_units(spark, sf_dir), f"{root}/{units}")


def _output(spark: SparkSession, root: str, name: str) -> DataFrame:
    return read_table(spark, f"{root}/{next(j for j in JOBS if j.name == name).output}")


def _run_and_read(spark: SparkSession, root: str, name: str, catalog: dict) -> DataFrame:
    status = run(spark, root, name, catalog=catalog).first()
    if status.status != "ok":
        raise RuntimeError(f"{name}: {status.status}: {status.detail}")
    return _output(spark, root, name)


def air_history_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "air")
    write_air_files(spark, sf_dir, root)
    return _run_and_read(spark, root, "aire_normalizado", AIR_CATALOG)


_FIRST = _AIR_KEYS[0]  # the file of January, but for orders with status F


def air_history_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact after one of 13 files lost its rows after the tenth of the month and the job ran again.

    Only that file's rows are computed again: the others' parts keep their files.
    """
    root = scratch_dir(spark, "air")
    write_air_files(spark, sf_dir, root)
    _run_and_read(spark, root, "aire_normalizado", AIR_CATALOG)
    job = next(j for j in JOBS if j.name == "aire_normalizado")
    path, aliases = f"{root}/{job.output}", [a for a, k in job.sources.items() if k == _FIRST]

    def others() -> set:
        return {(p["part"], p["folder"]) for p in manifest(spark, path) if p["fuente"] != aliases[0]}

    before = others()
    folder = f"{root}/{AIR_CATALOG[_FIRST].path}"
    write_delimited(read_dataset(spark, root, AIR_CATALOG[_FIRST]).where("dia <= 10"), folder, ";")
    fact = _run_and_read(spark, root, "aire_normalizado", AIR_CATALOG)
    if others() != before:
        raise RuntimeError("parts of unchanged files were written again")
    return fact


def header_drift_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files of the orders of each status: one names a column otherwise, one has two exchanged and one more."""
    root = scratch_dir(spark, "headers")
    orders = table(spark, sf_dir, "orders")
    columns = {
        "F": [F.col("o_orderkey"), F.col("o_custkey"), F.col("o_totalprice")],
        "O": [F.col("o_orderkey"), F.col("o_custkey").alias("cliente"), F.col("o_totalprice").alias(" O_TOTALPRICE")],
        "P": [F.col("o_orderkey"), F.col("o_totalprice"), F.col("o_custkey"), F.lit("x").alias("nota")],
    }
    catalog = {s: DatasetSpec(f"crudo/{s}.csv") for s in columns}
    for s, chosen in columns.items():
        write_delimited(orders.where(F.col("o_orderstatus") == s).select(*chosen), f"{root}/{catalog[s].path}", ";")
    refresh(spark, root, catalog)
    drift = header_drift({s: read_dataset(spark, root, spec) for s, spec in catalog.items()})
    return inline_table(spark, drift, "fichero string, posicion int, esperado string, encontrado string, movida boolean")


def weather_daily_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_dir(spark, "weather")
    write_weather_files(spark, sf_dir, root)
    return _run_and_read(spark, root, "meteo_aemet_normalizado", CATALOG)


def job_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All four jobs where the hourly files are absent, with the rows each wrote."""
    root = scratch_dir(spark, "status")
    write_weather_files(spark, sf_dir, root)
    write_delimited(
        unit_dimension(spark, sf_dir), f"{root}/{CATALOG['dim_variable_aire_csv'].path}"
    )
    status = run(spark, root).select("pipeline", "status")
    written = [
        _output(spark, root, j.name).agg(F.lit(j.name).alias("pipeline"), F.count("*").alias("n"))
        for j in JOBS[1:]
    ]
    return status.join(reduce(DataFrame.union, written), "pipeline", "left")


def sql_defined_job(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job of one's own, given as SQL over the aliases of two staged files."""
    root = scratch_dir(spark, "sql")
    catalog = {
        "clientes": DatasetSpec("crudo/customer.csv", ";", {"c_custkey": "bigint", "c_nationkey": "int"}),
        "naciones": "crudo/nation.csv",
    }
    write_delimited(table(spark, sf_dir, "customer"), f"{root}/crudo/customer.csv", ";")
    write_delimited(table(spark, sf_dir, "nation"), f"{root}/crudo/nation.csv", ";")
    job = JobSpec(
        "clientes_por_nacion",
        {"c": "clientes", "n": "naciones"},
        "SELECT c.c_custkey, c.c_name, n.n_name FROM c LEFT JOIN n ON c.c_nationkey = n.n_nationkey;",
        "salida/clientes.parquet",
    )
    status = run(spark, root, jobs=(job,), catalog=catalog).first()
    if status.status != "ok":
        raise RuntimeError(f"{status.status}: {status.detail}")
    return read_table(spark, status.detail)


def _own_job(spark: SparkSession, root: str) -> tuple[JobSpec, dict]:
    catalog = {"pedidos": DatasetSpec("crudo/orders.csv", ";", {"o_orderkey": "bigint", "o_totalprice": "double"})}
    job = JobSpec("pedidos", {"p": "pedidos"}, "SELECT o_orderkey, o_totalprice FROM p", "salida/pedidos.parquet")
    return job, catalog


def failed_rerun_keeps_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A job that ran, whose source then breaks: its output is that of the first run."""
    root = scratch_dir(spark, "rerun")
    job, catalog = _own_job(spark, root)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", F.col("o_totalprice").cast("string"))
    write_delimited(orders, f"{root}/crudo/orders.csv", ";")
    states = [run(spark, root, jobs=(job,), catalog=catalog).first().status]
    broken = orders.withColumn("o_totalprice", F.lit("no number"))
    write_delimited(broken, f"{root}/crudo/orders.csv", ";")
    states.append(run(spark, root, jobs=(job,), catalog=catalog).first().status)
    if states != ["ok", "failed"]:
        raise RuntimeError(f"unexpected states {states}")
    return read_table(spark, f"{root}/{job.output}")


def job_preview(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first rows by key of what a job wrote from all orders."""
    root = scratch_dir(spark, "preview")
    job, catalog = _own_job(spark, root)
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice")
    write_delimited(orders, f"{root}/crudo/orders.csv", ";")
    status = run(spark, root, jobs=(job,), catalog=catalog)
    return written_previews(spark, status, order={job.name: ["o_orderkey"]})[job.name]


def _stations(customers: DataFrame, *others: F.Column) -> DataFrame:
    """Every customer as a station, dealt by key: its windows and the keys of their documents are not one task's work."""
    return spread(customers.select(F.col("c_custkey").cast("string").alias("indicativo"), *others), "indicativo")


def _collect(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    customers = table(spark, sf_dir, "customer")
    stations = _stations(customers, F.col("c_name").alias("nombre"))
    documents = requested_documents(
        raw_documents(customers, *CUSTOMER_COLUMNS), stations, "2022-01-01", "2022-12-31"
    )
    return collect_observations(
        spark,
        parse_documents(documents, RECORD_FIELDS),
        f"{scratch_dir(spark, 'collected')}/observations.csv",
        stations,
        "2022-01-01",
        "2022-12-31",
    )


def collected_weather_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """From landed documents over the sorted CSV to the weather fact."""
    root = scratch_dir(spark, "chain")
    customers = table(spark, sf_dir, "customer")
    stations = _stations(customers)
    documents = requested_documents(
        raw_documents(customers, *CUSTOMER_COLUMNS), stations, "2022-01-01", "2022-12-31"
    )
    collect_observations(
        spark,
        parse_documents(documents, RAW_FIELDS).withColumn("altitud", F.lit("664")),
        f"{root}/{CATALOG['aemet_climatologia_diaria'].path}",
        stations,
        "2022-01-01",
        "2022-12-31",
    )
    units = CATALOG["dim_variable_meteo_csv"].path
    write_delimited(weather_units(spark, sf_dir), f"{root}/{units}")
    return _run_and_read(spark, root, "meteo_aemet_normalizado", CATALOG)


def raw_weather_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Straight from the documents: trace rain is 0.0 here and NULL after the collector."""
    documents = raw_documents(table(spark, sf_dir, "customer"), *CUSTOMER_COLUMNS)
    return weather_fact(parse_documents(documents), weather_units(spark, sf_dir))


def collected_observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collect(spark, sf_dir)["observations"]


KEY_COLUMNS = 5


def collected_many_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order line has keys that no other record has; only those of many records become columns.

    One row for each record and key that is no column, with all columns.
    """
    lines = table(spark, sf_dir, "lineitem")
    own = F.concat_ws("_", F.lit("k"), "l_orderkey", "l_linenumber")
    record = F.create_map(
        F.lit("fecha"), F.concat(F.lit("2022-03-0"), "l_linenumber"),
        F.lit("indicativo"), F.col("l_suppkey").cast("string"),
        F.lit("bandera"), F.col("l_returnflag"), F.lit("FECHA"), F.col("l_linestatus"),
        own, F.col("l_quantity").cast("int").cast("string"), F.concat(own, F.lit("b")), F.concat(F.lit("o"), "l_orderkey"),
    )
    # records as text before they are brought together: less to shuffle and to hold than as maps
    records = F.array_join(F.collect_list(F.to_json(record)), ",")
    documents = lines.groupBy("l_suppkey").agg(F.concat(F.lit("["), records, F.lit("]")).alias("texto")).select(
        F.concat("l_suppkey", F.lit("_2022_01")).alias("documento"), "texto"
    )
    stations = lines.select(F.col("l_suppkey").cast("string").alias("indicativo")).distinct()
    got = collect_observations(
        spark, parse_documents(documents, ["fecha", "indicativo"]), f"{scratch_dir(spark, 'keys')}/o.csv", stations,
        "2022-01-01", "2022-06-30", key_columns=KEY_COLUMNS,
    )["observations"]
    # three of the five columns are of single records: which, is decided by the keys' order
    single = [c for c in got.columns if c.startswith("k_")]
    own_column = [F.struct(F.lit(c).alias("key"), F.col(c).alias("value")) for c in single]
    rare = F.concat(F.map_entries("otros"), F.filter(F.array(*own_column), lambda e: e["value"].isNotNull())) if single else F.map_entries("otros")
    return got.select("fecha", "indicativo", "bandera", "_FECHA", F.inline(rare).alias("clave", "valor"))


def collected_coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collect(spark, sf_dir)["coverage"].select("indicativo", "n_dias", "dias_esperados", "pct")


def collected_missing_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _collect(spark, sf_dir)["missing_windows"]


QUERIES = {
    "air_history_job": air_history_job,
    "air_history_incremental": air_history_incremental,
    "header_drift": header_drift_query,
    "weather_daily_job": weather_daily_job,
    "job_status": job_status,
    "sql_defined_job": sql_defined_job,
    "failed_rerun_keeps_output": failed_rerun_keeps_output,
    "job_preview": job_preview,
    "collected_weather_fact": collected_weather_fact,
    "raw_weather_fact": raw_weather_fact,
    "collected_observations": collected_observations,
    "collected_coverage": collected_coverage,
    "collected_many_keys": collected_many_keys,
    "collected_missing_windows": collected_missing_windows,
}

_WEATHER_LONG = " UNION ALL ".join(
    f"""SELECT 'S' || CAST(o_custkey AS VARCHAR) AS estacion_id,
               'STATION, ' || CAST(o_custkey AS VARCHAR) AS estacion_nombre,
               o_orderpriority AS provincia, CAST(o_custkey % 2000 AS INT) AS altitud,
               CAST(o_orderdate AS DATE) AS fecha, '{variable}' AS variable_meteo,
               {daily_value_sql(column)} AS valor
        FROM orders"""
    for variable, column in MEASURES.items()
)

_WEATHER = f"""
WITH long AS ({_WEATHER_LONG}), units AS ({WEATHER_UNITS_SQL})
SELECT l.estacion_id, l.estacion_nombre, l.provincia, l.altitud, l.fecha, l.variable_meteo,
       u.uom, l.valor
FROM long l LEFT JOIN units u ON l.variable_meteo = u.variable_meteo
WHERE l.valor IS NOT NULL
"""

SQL = {
    "air_history_job": HOURLY_ORDERS_FACT_SQL,
    "air_history_incremental": f"""
SELECT * FROM ({HOURLY_ORDERS_FACT_SQL})
WHERE NOT (month(fecha) = 1 AND day(fecha) > 10 AND punto_muestreo NOT LIKE '%$_F' ESCAPE '$')
""",
    "header_drift": """
SELECT o_orderstatus AS fichero, posicion, esperado, encontrado, movida
FROM (SELECT DISTINCT o_orderstatus FROM orders), (VALUES
  ('O', 2, 'o_custkey', 'cliente', false), ('P', 2, 'o_custkey', 'o_totalprice', true), ('P', 3, 'o_totalprice', 'o_custkey', true),
  ('P', 4, NULL, 'nota', false)) d(s, posicion, esperado, encontrado, movida)
WHERE s = o_orderstatus
""",
    "weather_daily_job": _WEATHER,
    "job_status": f"""
SELECT 'aire_normalizado' AS pipeline, 'missing input' AS status, NULL::BIGINT AS n
UNION ALL SELECT 'seed_variables_aire', 'ok', count(*) FROM nation
UNION ALL SELECT 'meteo_aemet_normalizado', 'ok', count(*) FROM ({_WEATHER})
UNION ALL SELECT 'seed_variable_meteo', 'ok', count(*) FROM nation
""",
    "sql_defined_job": """
SELECT c_custkey, c_name, n_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
""",
    "failed_rerun_keeps_output": "SELECT o_orderkey, o_totalprice FROM orders",
    "job_preview": "SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_orderkey LIMIT 5",
    "collected_weather_fact": f"""
SELECT indicativo AS estacion_id, nombre AS estacion_nombre, NULL::VARCHAR AS provincia,
       664 AS altitud, CAST(fecha AS DATE) AS fecha, 'precipitacion' AS variable_meteo,
       'NATION_3' AS uom, prec_num AS valor
FROM ({records_sql('customer', *CUSTOMER_COLUMNS)}) WHERE prec_num IS NOT NULL
""",
    "raw_weather_fact": f"""
SELECT indicativo AS estacion_id, nombre AS estacion_nombre, NULL::VARCHAR AS provincia,
       NULL::INT AS altitud, CAST(fecha AS DATE) AS fecha, 'precipitacion' AS variable_meteo,
       'NATION_3' AS uom, CASE WHEN prec = 'Ip' THEN 0.0::DOUBLE ELSE prec_num END AS valor
FROM ({records_sql('customer', *CUSTOMER_COLUMNS)})
""",
    "collected_observations": f"""
SELECT CAST(fecha AS DATE) AS fecha, indicativo, nombre, prec_num AS prec, NULL::DOUBLE AS tmed, nota
FROM ({records_sql('customer', *CUSTOMER_COLUMNS)})
""",
    "collected_many_keys": """
SELECT make_date(2022, 3, l_linenumber) AS fecha, CAST(l_suppkey AS VARCHAR) AS indicativo,
       l_returnflag AS bandera, l_linestatus AS _FECHA,
       'k_' || l_orderkey || '_' || l_linenumber || b AS clave,
       CASE WHEN b = '' THEN CAST(CAST(l_quantity AS INT) AS VARCHAR) ELSE 'o' || l_orderkey END AS valor
FROM lineitem, (VALUES (''), ('b')) v(b)
""",
    "collected_coverage": f"""
WITH n AS (SELECT indicativo, count(*) AS n FROM ({records_sql('customer', *CUSTOMER_COLUMNS)}) GROUP BY indicativo)
SELECT CAST(c_custkey AS VARCHAR) AS indicativo, coalesce(n, 0) AS n_dias, 365 AS dias_esperados,
       100.0::DOUBLE * coalesce(n, 0) / 365 AS pct
FROM customer LEFT JOIN n ON CAST(c_custkey AS VARCHAR) = indicativo
""",
    "collected_missing_windows": """
SELECT CAST(c_custkey AS VARCHAR) AS indicativo, c_name AS nombre, inicio, fin,
       CAST(c_custkey AS VARCHAR) || strftime(inicio, '_%Y_%m') AS documento
FROM customer, (VALUES (DATE '2022-01-01', DATE '2022-06-30'), (DATE '2022-07-01', DATE '2022-12-31'))
     w(inicio, fin)
WHERE c_nationkey <= 7
""",
}
