"""Sources and sinks, each written to or read from the shared folder."""

import uuid

from pyspark.sql import functions as F

from catalogue.base import panel, query
from riskloom.operators.sets import union_all
from riskloom.session import shared_dir
from riskloom.sources import tables as T
from riskloom.sources.staging import raw_ddl


def _folder(star, label: str) -> str:
    return f"{shared_dir(star.spark)}/riskloom/{label}-{uuid.uuid4().hex}"


def _csv_copy(star, names, sep=",", decimal="."):
    folder = _folder(star, "csv")
    for name in names:
        T.write_csv(star.table(name), f"{folder}/{name}", sep, decimal)
    return folder


@query(
    "src01_load_metadata",
    """SELECT 'customer' AS table_name, count(*) AS row_count, 5 AS column_count, ',' AS separator FROM customer
       UNION ALL SELECT 'supplier', count(*), 4, ',' FROM supplier""",
)
def load_metadata(star):
    folder = _csv_copy(star, ["customer", "supplier"])
    files = {"customer": "customer", "supplier": "supplier", "forecast": "forecast"}
    _, metadata = T.load_tables(star.spark, folder, files, required=["customer", "supplier"])
    return metadata


@query("src03_read_registry", "SELECT 'customer' AS table_name, count(*) AS row_count FROM customer UNION ALL SELECT 'orders', count(*) FROM orders")
def read_registry(star):
    T.register_views({n: star.table(n) for n in ("customer", "orders")}, "registry_")
    found = T.read_registry(star.spark, {"customer": ("", "registry_customer"), "orders": ("", "registry_orders")})
    return T.load_metadata(found).select("table_name", "row_count")


@query("src04_head_rows")
def head_rows(star):
    return T.head_rows(star.table("orders"), 100)


@query(
    "src05_typed_ingest",
    """SELECT o_orderkey, CASE WHEN o_orderkey % 7 > 0 THEN o_custkey END AS customer_id, o_totalprice AS price,
              CASE WHEN o_orderkey % 5 > 0 THEN CAST(o_orderdate AS DATE) END AS day, o_orderkey % 2 = 0 AS even FROM orders""",
    rounded="price",
)
def typed_ingest(star):
    typed, _ = T.coerce_typed(_noisy_orders(star), _TYPES)
    return typed


@query(
    "src05_bad_values",
    """SELECT 'customer_id' AS column_name, count(*) AS bad_values, array_to_string(list(DISTINCT o_orderkey || '.5' ORDER BY o_orderkey || '.5')[1:5], ' | ') AS examples
       FROM orders WHERE o_orderkey % 7 = 0
       UNION ALL SELECT 'day', count(*), array_to_string(list(DISTINCT strftime(o_orderdate, '%d/%m/%Y') ORDER BY strftime(o_orderdate, '%d/%m/%Y'))[1:5], ' | ')
       FROM orders WHERE o_orderkey % 5 = 0""",
)
def bad_values(star):
    _, bad = T.coerce_typed(_noisy_orders(star), _TYPES)
    return bad.withColumn("examples", F.concat_ws(" | ", "examples"))


_TYPES = {"o_orderkey": "bigint", "customer_id": "bigint", "price": "double", "day": "date", "even": "boolean"}


def _noisy_orders(star):
    k, day = F.col("o_orderkey"), F.col("o_orderdate").cast("date")
    return star.table("orders").select(
        k.cast("string").alias("o_orderkey"),
        F.when(k % 7 == 0, F.concat(k.cast("string"), F.lit(".5"))).otherwise(F.concat(F.col("o_custkey").cast("string"), F.lit(".0")))
        .alias("customer_id"),
        F.translate(F.format_string("%.2f", "o_totalprice"), ".", ",").alias("price"),
        F.when(k % 5 == 0, F.date_format(day, "dd/MM/yyyy")).otherwise(day.cast("string")).alias("day"),
        F.when(k % 2 == 0, "True").otherwise("no").alias("even"),
    )


@query("src06_csv_round_trip", "SELECT c_custkey, c_name, c_nationkey, c_acctbal, c_mktsegment FROM customer", rounded="c_acctbal")
def csv_round_trip(star):
    folder = _csv_copy(star, ["customer"])
    return T.read_csv(star.spark, f"{folder}/customer", star.table("customer").schema)


@query(
    "src07_decimal_comma_csv",
    "SELECT s_suppkey, s_name, s_nationkey, s_acctbal FROM supplier", rounded="s_acctbal",
)
def decimal_comma_csv(star):
    folder = _csv_copy(star, ["supplier"], ";", ",")
    raw = T.read_csv(star.spark, f"{folder}/supplier", sep=";")
    types = {"s_suppkey": "bigint", "s_nationkey": "int", "s_acctbal": "double"}
    return T.enforce_typed(raw, types)


@query("src08_overwrite_table", "SELECT 'orders_copy' AS table_name, count(*) AS source_rows, count(*) AS stored_rows, TRUE AS passed FROM orders")
def overwrite_table(star):
    star.spark.sql(f"CREATE DATABASE IF NOT EXISTS riskloom_sink LOCATION '{_folder(star, 'db')}'")
    name = f"riskloom_sink.orders_{uuid.uuid4().hex}"
    return T.overwrite_table(star.table("orders"), name).withColumn("table_name", F.lit("orders_copy"))


@query("src09_positional_append", "SELECT p_brand, count(*) * 2 AS row_count FROM part GROUP BY 1")
def positional_append(star):
    star.spark.sql(f"CREATE DATABASE IF NOT EXISTS riskloom_sink LOCATION '{_folder(star, 'db')}'")
    target = f"riskloom_sink.part_{uuid.uuid4().hex}"
    star.table("part").write.saveAsTable(target)
    T.register_views({"import_part": star.table("part")})
    T.append_table(star.spark, "import_part", target)
    return star.spark.table(target).groupBy("p_brand").agg(F.count(F.lit(1)).alias("row_count"))


@query("src10_raw_tables")
def raw_tables(star):
    """Raw table definitions, filled from the order tables where they have a source."""
    database = f"raw_{uuid.uuid4().hex[:8]}"
    T.create_raw_tables(star.spark, raw_ddl(), database)
    reps = star.reps.select(
        F.col("sales_rep_id").cast("int"), F.concat(F.lit("REP-"), "sales_rep_id"), "region_id", "seniority",
        F.col("annual_quota_eur").cast("decimal(18,2)"),
    )
    reps.write.insertInto(f"{database}.sales_reps")
    counts = [
        star.spark.table(f"{database}.{t}").agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(t).alias("table_name"), "row_count")
        for t in raw_ddl()
    ]
    return union_all(*counts)


@query("src11_views", "SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1")
def views(star):
    T.register_views({"orders": star.table("orders")}, "staging_")
    return star.spark.sql("SELECT o_orderstatus, count(*) AS n FROM staging_orders GROUP BY o_orderstatus")


@query("src12_json_report", "SELECT count(*) AS panel_rows, sum(units_sold) AS units FROM t_panel", rounded="units")
def json_report(star):
    report = panel(star).agg(F.count(F.lit(1)).alias("panel_rows"), F.sum("units_sold").alias("units"))
    path = T.write_json_report(report, _folder(star, "report"))
    return star.spark.read.schema("panel_rows long, units double").json(path)


@query("src13_exact_sample")
def exact_sample(star):
    return T.sample_n(star.table("orders"), 1000, "o_orderkey")
