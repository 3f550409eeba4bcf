"""Sources, staging and sinks, on files that Spark writes from the tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from envlake.functions import from_latin9, to_latin9
from envlake.queries.inputs import spread, table
from envlake.sources import (
    DatasetSpec,
    land_records,
    parse_documents,
    read_dataset,
    read_landed,
    read_raw_documents,
    read_table,
    refresh,
    register_views,
    rejects,
    scratch_dir,
    staged_path,
    write_delimited,
    write_documents,
    write_fact,
)
from envlake.sources.bronze import dataset_status
from envlake.sources.tables import remove_partition
from envlake.sources.versions import file_system

_CUSTOMER_TYPES = {
    "c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
    "c_acctbal": "double", "c_mktsegment": "string",
}


def csv_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Segments with quotes, separators, blanks around, only blanks, line breaks and none.

    They come back through a staged dataset that allows line breaks.
    """
    root = scratch_dir(spark, "csv")
    segment = F.col("c_mktsegment")
    customers = table(spark, sf_dir, "customer").withColumn(
        "c_mktsegment",
        F.when(segment == "HOUSEHOLD", 'HOUSE;"HOLD"')
        .when(segment == "BUILDING", "  BUILDING ")
        .when(segment == "FURNITURE", F.when(F.col("c_nationkey") < 12, "   ").otherwise("FURNI\nTURE"))
        .when(segment != "MACHINERY", segment),
    )
    spec = DatasetSpec("crudo/customer.csv", ";", _CUSTOMER_TYPES, multi_line=True)
    write_delimited(customers, f"{root}/{spec.path}", sep=";", bom=True, multi_line=True)
    refresh(spark, root, {"clientes": spec})
    return read_dataset(spark, root, spec)


def parquet_sink_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{scratch_dir(spark, 'parquet')}/orders.parquet"
    write_fact(table(spark, sf_dir, "orders"), path)
    register_views({"pedidos_escritos": read_table(spark, path)})
    written = spark.sql("SELECT * FROM pedidos_escritos")
    spark.catalog.dropTempView("pedidos_escritos")
    return written


LANDING_START = "1996-03-01"


def json_landing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Some dates are absent, unreadable or before the start; one line is cut short."""
    path = scratch_dir(spark, "landing")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    records = table(spark, sf_dir, "orders").select(
        F.when(F.col("o_orderkey") % 13 == 0, "sin fecha").when(F.col("o_orderkey") % 17 != 0, day).alias("fecha"),
        F.col("o_orderpriority").alias("indicativo"),
        F.col("o_orderkey").cast("string").alias("nombre"),
        F.when(F.col("o_orderstatus") == "F", F.col("o_custkey").cast("string")).alias("prec"),
    )
    land_records(records, path, LANDING_START)
    broken = spark.createDataFrame([('{"fecha": "2000-01-0',)], "value string")
    broken.write.mode("append").text(f"{path}/indicativo=1-URGENT/ventana=2000-01-01")
    return read_landed(spark, path, ["fecha", "indicativo", "nombre", "prec"], rest=False)


RECORD_FIELDS = ["fecha", "indicativo", "nombre", "prec", "tmed"]


def raw_documents(frame: DataFrame, key: str, name: str, amount: str, nation: str) -> DataFrame:
    """Two documents per row of a table; those of nations 0 to 7 are unusable.

    Each holds three records, which lack the keys whose value is NULL and have the date twice, of
    which the second counts. The third has a key, ``nota``, that no list of fields names.
    """

    def record(day: str) -> F.Column:
        number = F.replace(F.col(amount).cast("string"), F.lit("."), F.lit(","))
        return F.struct(
            F.concat("mes", F.lit(f"-{day}")).alias("fecha"),
            F.col(key).cast("string").alias("indicativo"),
            F.col(name).alias("nombre"),
            (F.lit("Ip") if day == "02" else number).alias("prec"),
            F.when(F.lit(day) == "03", "Ip").alias("tmed"),
            F.when(F.lit(day) == "03", F.col(name)).alias("nota"),
        )

    good = F.to_json(F.array(record("01"), record("02"), record("03")))
    good = F.replace(good, F.lit('{"fecha":'), F.lit('{"fecha":"1999-12-31","fecha":'))
    text = (
        F.when(F.col(nation) == 0, F.expr("left(good, length(good) - 5)"))
        .when(F.col(nation) == 1, "[]")
        .when(F.col(nation) == 2, '{"estado": 404, "fecha": "2022-01-01"}')
        .when(F.col(nation) == 3, "<html>error</html>")
        .when(F.col(nation) == 4, F.concat("good", F.lit(" "), "good"))
        .when(F.col(nation) == 5, F.concat("good", F.lit(', {"x": 1}]')))
        .when(F.col(nation) == 6, F.translate("good", '"', "'"))
        .when(F.col(nation) == 7, F.concat("good", F.lit(", "), "good"))
        .otherwise(F.col("good"))
    )
    return (
        spread(frame.select(key, name, amount, nation), key)
        .withColumn("mes", F.explode(F.array(F.lit("2022-01"), F.lit("2022-07"))))
        .withColumn("good", good)
        .select(
            F.concat_ws("_", key, F.replace("mes", F.lit("-"), F.lit("_"))).alias("documento"),
            text.alias("texto"),
        )
    )


def records_sql(table_name: str, key: str, name: str, amount: str, nation: str) -> str:
    """The records of all usable documents."""
    return f"""
SELECT concat_ws('_', CAST({key} AS VARCHAR), replace(mes, '-', '_')) AS documento,
       CAST({key} AS VARCHAR) AS documento_estacion,
       CAST(mes || '-01' AS DATE) AS documento_mes, mes || '-' || dd AS fecha,
       CAST({key} AS VARCHAR) AS indicativo, {name} AS nombre,
       CASE WHEN dd = '02' THEN 'Ip' ELSE replace(CAST({amount} AS VARCHAR), '.', ',') END AS prec,
       CASE WHEN dd = '03' THEN 'Ip' END AS tmed, CASE WHEN dd = '03' THEN {name} END AS nota,
       CASE WHEN dd <> '02' THEN {amount} END AS prec_num
FROM {table_name}, (VALUES ('2022-01'), ('2022-07')) m(mes), (VALUES ('01'), ('02'), ('03')) d(dd)
WHERE {nation} > 7
"""


SUPPLIER_COLUMNS = ("s_suppkey", "s_name", "s_acctbal", "s_nationkey")
CUSTOMER_COLUMNS = ("c_custkey", "c_name", "c_acctbal", "c_nationkey")


def json_raw_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per document, as documents are landed, many in a folder."""
    path = scratch_dir(spark, "documents")
    write_documents(raw_documents(table(spark, sf_dir, "supplier"), *SUPPLIER_COLUMNS), path, folders=16)
    return _with_note(read_raw_documents(spark, path, RECORD_FIELDS))


def _with_note(records: DataFrame) -> DataFrame:
    """The one key outside the list as a column."""
    return records.withColumn("nota", F.try_element_at("otros", F.lit("nota"))).drop("otros")


def json_documents_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of a table."""
    documents = raw_documents(table(spark, sf_dir, "customer"), *CUSTOMER_COLUMNS)
    return _with_note(parse_documents(documents, RECORD_FIELDS))


def latin9_decode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All texts as ISO-8859-15 files and back; other characters become ``?``."""
    path = scratch_dir(spark, "latin9")
    documents = table(spark, sf_dir, "documents").select("doc_id", _marked_text())
    (
        documents.withColumn("text", to_latin9(F.col("text")))
        .write.option("encoding", "ISO-8859-1")
        .json(path)
    )
    landed = (
        spark.read.schema("doc_id bigint, text string")
        .options(encoding="ISO-8859-1", lineSep="\n", mode="FAILFAST")
        .json(path)
    )
    return landed.select("doc_id", from_latin9(F.col("text")).alias("text"))


# Some letters of the texts stand in for characters that only ISO-8859-15 has.
_PLAIN, _SPECIAL = "KQWXZkqw", "€ŠšŽžŒœŸ"


def _marked_text() -> F.Column:
    representable = F.regexp_replace("text", "[^\\u0000-\\u00a3\\u00a5\\u00a7\\u00a9-\\u00b3\\u00b5-\\u00b7\\u00b9-\\u00bb\\u00bf-\\u00ff]", "?")
    return F.translate(representable, _PLAIN, _SPECIAL).alias("text")


_BRONZE_CATALOG = {
    "clientes": DatasetSpec("crudo/customer.csv", ";", _CUSTOMER_TYPES),
    "proveedores": DatasetSpec("crudo/supplier.csv", ",", {"s_suppkey": "bigint"}),
    "pedidos": DatasetSpec("crudo/orders.csv", ";", {"o_orderkey": "bigint"}),
    "piezas": "crudo/part.parquet",
    "lineas": DatasetSpec("crudo/lineitem.csv", ";", {"l_orderkey": "bigint"}),
    "ausente": "crudo/absent.csv",
}


_ODD_NAMES = ("a+b.csv", "50%.csv", "ñ x.csv")


def _put_file(frame: DataFrame, folder: str, name: str) -> None:
    """One CSV file of a given name."""
    spark = frame.sparkSession
    made = f"{scratch_dir(spark, 'file')}/f"
    write_delimited(frame.coalesce(1), made, ";")
    files, at = file_system(spark, made)
    (part,) = [f.getPath() for f in files.listStatus(at) if f.getPath().getName().startswith("part-")]
    path = spark._jvm.org.apache.hadoop.fs.Path(folder, name)
    files.mkdirs(path.getParent())
    files.delete(path, False)
    files.rename(part, path)


def _bronze_root(spark: SparkSession, sf_dir: str) -> str:
    """One staged dataset, one rewritten since, one never staged, one as Parquet, and one of many
    files: since it was staged, one of them changed, one was cut to its header and some went."""
    root = scratch_dir(spark, "bronze")
    write_delimited(table(spark, sf_dir, "customer"), f"{root}/crudo/customer.csv", ";")
    write_delimited(table(spark, sf_dir, "supplier"), f"{root}/crudo/supplier.csv", ",")
    write_fact(table(spark, sf_dir, "part"), f"{root}/crudo/part.parquet")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_quantity", "l_linenumber")
    folder = f"{root}/crudo/lineitem.csv"
    lines.where("l_linenumber not in (2, 3)").write.partitionBy("l_linenumber").csv(folder, sep=";", header=True)
    two, three = (lines.where(F.col("l_linenumber") == n).drop("l_linenumber") for n in (2, 3))
    for i, name in enumerate(_ODD_NAMES):
        _put_file(two.where(F.col("l_orderkey") % len(_ODD_NAMES) == i), f"{folder}/l_linenumber=2", name)
    _put_file(three, f"{folder}/l_linenumber=3", "parte.csv")
    refresh(spark, root, _BRONZE_CATALOG, ["clientes", "proveedores", "lineas"])
    changed = lines.where("l_linenumber = 1").select("l_orderkey", F.lit(0.5).alias("l_quantity"))
    write_delimited(changed, f"{folder}/l_linenumber=1", ";")
    _put_file(three.limit(0), f"{folder}/l_linenumber=3", "parte.csv")
    remove_partition(spark, folder, "l_linenumber", "2")
    write_delimited(table(spark, sf_dir, "supplier"), f"{root}/crudo/supplier.csv", ",")
    write_delimited(table(spark, sf_dir, "orders"), f"{root}/crudo/orders.csv", ";")
    return root


def bronze_stale_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_status(spark, _bronze_root(spark, sf_dir), _BRONZE_CATALOG)


def partial_copy_is_restaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A copy of a part of the rows, whose write did not end, is not read as the dataset."""
    root = scratch_dir(spark, "partial")
    customers = table(spark, sf_dir, "customer")
    spec = _BRONZE_CATALOG["clientes"]
    write_delimited(customers, f"{root}/{spec.path}", ";")
    cut = customers.where("c_custkey < 10").write
    cut.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(
        staged_path(f"{root}/{spec.path}")
    )
    refresh(spark, root, {"clientes": spec})
    return read_dataset(spark, root, spec)


def bronze_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per dataset once the stale ones are staged again."""
    root = _bronze_root(spark, sf_dir)
    again = refresh(spark, root, _BRONZE_CATALOG)
    counts = [
        read_dataset(spark, root, _BRONZE_CATALOG[key]).agg(
            F.lit(key).alias("dataset"),
            F.lit(key in again).alias("convertido"),
            F.count("*").alias("n"),
        )
        for key in ("clientes", "proveedores", "pedidos", "piezas", "lineas")
    ]
    return reduce(DataFrame.union, counts)


def parts_are_restaged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of a dataset of many files, after one changed, one was emptied and some went."""
    root = _bronze_root(spark, sf_dir)
    refresh(spark, root, _BRONZE_CATALOG, ["lineas"])
    rows = read_dataset(spark, root, _BRONZE_CATALOG["lineas"])
    return rows.withColumn("l_quantity", F.col("l_quantity").cast("double"))


_LENIENT = DatasetSpec(
    "crudo/orders.csv", ";", {"o_orderkey": "bigint", "o_totalprice": "double", "o_orderdate": "date", "o_orderstatus": "string"},
    max_rejects=1 << 40,
)


def _with_bad_cells(spark: SparkSession, sf_dir: str) -> str:
    """Orders as a staged file in which some prices and some days do not fit their types."""
    root = scratch_dir(spark, "rejects")
    price, day = F.col("o_totalprice").cast("string"), F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.when(F.col("o_orderkey") % 97 == 1, F.replace(price, F.lit("."), F.lit(","))).otherwise(price).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 89 == 2, F.lit("31/12")).when(F.col("o_orderkey") % 5 != 0, day).alias("o_orderdate"),
        "o_orderstatus",
    )
    write_delimited(orders, f"{root}/{_LENIENT.path}", ";")
    refresh(spark, root, {"pedidos": _LENIENT})
    return root


def rejected_cells_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cells that do not fit, with the order that their line begins with."""
    found = rejects(spark, _with_bad_cells(spark, sf_dir), _LENIENT)
    return found.select(F.substring_index("linea", ";", 1).cast("bigint").alias("o_orderkey"), "columna", "texto")


def rows_without_rejected_cells(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of that file; cells that do not fit are NULL."""
    return read_dataset(spark, _with_bad_cells(spark, sf_dir), _LENIENT)


QUERIES = {
    "rejected_cells": rejected_cells_query,
    "rows_without_rejected_cells": rows_without_rejected_cells,
    "csv_roundtrip": csv_roundtrip,
    "parquet_sink_roundtrip": parquet_sink_roundtrip,
    "json_landing": json_landing,
    "json_raw_scan": json_raw_scan,
    "json_documents_parse": json_documents_parse,
    "latin9_decode": latin9_decode,
    "bronze_stale_files": bronze_stale_files,
    "bronze_refresh": bronze_refresh,
    "partial_copy_is_restaged": partial_copy_is_restaged,
    "parts_are_restaged": parts_are_restaged,
}

SQL = {
    "rejected_cells": """
SELECT o_orderkey, 'o_totalprice' AS columna, replace(CAST(o_totalprice AS VARCHAR), '.', ',') AS texto
FROM orders WHERE o_orderkey % 97 = 1
UNION ALL SELECT o_orderkey, 'o_orderdate', '31/12' FROM orders WHERE o_orderkey % 89 = 2
""",
    "rows_without_rejected_cells": """
SELECT o_orderkey, CASE WHEN o_orderkey % 97 <> 1 THEN o_totalprice END AS o_totalprice,
       CASE WHEN o_orderkey % 89 <> 2 AND o_orderkey % 5 <> 0 THEN CAST(o_orderdate AS DATE) END AS o_orderdate, o_orderstatus
FROM orders
""",
    "csv_roundtrip": """
SELECT c_custkey, c_name, c_nationkey, c_acctbal,
       CASE c_mktsegment WHEN 'HOUSEHOLD' THEN 'HOUSE;"HOLD"' WHEN 'MACHINERY' THEN NULL
            WHEN 'BUILDING' THEN '  BUILDING '
            WHEN 'FURNITURE' THEN CASE WHEN c_nationkey < 12 THEN '   ' ELSE 'FURNI' || chr(10) || 'TURE' END
            ELSE c_mktsegment END AS c_mktsegment
FROM customer
""",
    "parquet_sink_roundtrip": "SELECT * FROM orders",
    "json_landing": f"""
WITH d AS (
  SELECT *, CASE WHEN o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0 AND o_orderdate >= DATE '{LANDING_START}'
                 THEN greatest(make_date(year(o_orderdate), CASE WHEN month(o_orderdate) <= 6 THEN 1 ELSE 7 END, 1),
                               DATE '{LANDING_START}') END AS w
  FROM orders)
SELECT CASE WHEN o_orderkey % 13 = 0 THEN 'sin fecha'
            WHEN o_orderkey % 17 <> 0 THEN strftime(o_orderdate, '%Y-%m-%d') END AS fecha,
       o_orderpriority AS indicativo, CAST(o_orderkey AS VARCHAR) AS nombre,
       CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey AS VARCHAR) END AS prec,
       strftime(w, '%Y-%m-%d') AS ventana, o_orderpriority || strftime(w, '_%Y_%m') AS documento
FROM d
""",
    "json_raw_scan": f"""
SELECT * EXCLUDE (prec_num) FROM ({records_sql('supplier', *SUPPLIER_COLUMNS)})
""",
    "json_documents_parse": f"""
SELECT * EXCLUDE (prec_num) FROM ({records_sql('customer', *CUSTOMER_COLUMNS)})
""",
    "latin9_decode": f"""
SELECT doc_id, translate(regexp_replace(text,
         '[^\\x{{0000}}-\\x{{00a3}}\\x{{00a5}}\\x{{00a7}}\\x{{00a9}}-\\x{{00b3}}\\x{{00b5}}-\\x{{00b7}}\\x{{00b9}}-\\x{{00bb}}\\x{{00bf}}-\\x{{00ff}}]',
         '?', 'g'), '{_PLAIN}', '{_SPECIAL}') AS text
FROM documents
""",
    "bronze_stale_files": """
SELECT * FROM (VALUES ('clientes', 'fresh'), ('proveedores', 'stale'), ('pedidos', 'unstaged'),
                      ('piezas', 'fresh'), ('lineas', 'stale'), ('ausente', 'absent')) t(dataset, state)
""",
    "partial_copy_is_restaged": "SELECT * FROM customer",
    "parts_are_restaged": """
SELECT l_orderkey, CASE l_linenumber WHEN 1 THEN 0.5 ELSE l_quantity END AS l_quantity, l_linenumber
FROM lineitem WHERE l_linenumber NOT IN (2, 3)
""",
    "bronze_refresh": """
SELECT 'clientes' AS dataset, false AS convertido, count(*) AS n FROM customer
UNION ALL SELECT 'proveedores', true, count(*) FROM supplier
UNION ALL SELECT 'pedidos', true, count(*) FROM orders
UNION ALL SELECT 'piezas', false, count(*) FROM part
UNION ALL SELECT 'lineas', true, count(*) FROM lineitem WHERE l_linenumber NOT IN (2, 3)
""",
}
