import tempfile

import pytest
from pyspark.sql import functions as F

from riskloom.session import materialize, shared_dir
from riskloom.sources import staging as ST, tables as T


def folder():
    return tempfile.mkdtemp(prefix="riskloom-test-")


def test_csv_tables_and_missing_files(spark):
    base = folder()
    df = spark.createDataFrame([(1, 2.5, "x"), (2, None, "y")], "id int, amount double, label string")
    T.write_csv(df, f"{base}/a")
    tables, meta = T.load_tables(spark, base, {"a": "a", "b": "b"}, required=["a"])
    assert set(tables) == {"a"} and meta.first().row_count == 2
    with pytest.raises(FileNotFoundError, match="b, c"):
        T.load_tables(spark, base, {"a": "a", "b": "b", "c": "c"})
    T.write_csv(df, f"{base}/comma", ";", ",")
    raw = T.read_csv(spark, f"{base}/comma", sep=";")
    assert {r.amount for r in raw.collect()} == {"2,5", None}
    assert T.enforce_typed(raw, {"id": "int", "amount": "double"}).agg(F.sum("amount")).first()[0] == 2.5


def test_typed_ingest_reports_bad_values(spark):
    df = spark.createDataFrame(
        [("1", "yes", "2024-01-01"), ("2.0", "maybe", "2024-13-01"), ("3.5", "", None), ("x", "False", "01.02.2024")],
        "n string, b string, d string",
    )
    types = {"n": "int", "b": "boolean", "d": "date"}
    typed, bad = T.coerce_typed(df, types)
    assert [r.n for r in typed.collect()] == [1, 2, None, None]
    found = {r.column_name: (r.bad_values, r.examples) for r in bad.collect()}
    assert found == {"n": (2, ["3.5", "x"]), "b": (1, ["maybe"]), "d": (2, ["01.02.2024", "2024-13-01"])}
    with pytest.raises(ValueError, match="maybe"):
        T.enforce_typed(df, types)


def test_staging(spark):
    raw = spark.createDataFrame(
        [(" 7 ", " sku-1 ", "Decline ", "x", "0.3"), ("bad", None, "New", "2021", None)],
        "product_id string, sku string, lifecycle_stage string, launch_year string, target_margin_pct string",
    )
    rows = ST.stage_products(raw).collect()
    assert (rows[0].product_id, rows[0].sku, rows[0].is_declining_product, rows[0].launch_year) == (7, "SKU-1", 1, None)
    assert (rows[1].product_id, rows[1].is_new_product, rows[1].launch_year) == (None, 1, 2021)
    assert set(ST.STAGERS) == set(ST.SPECS) and "`date` date" in ST.raw_ddl()["sales"]
    stages = spark.createDataFrame([("closed won ", "2024-01-01", "2024-01-31")], "stage string, created_date string, expected_close_date string")
    assert ST.stage_opportunities(stages).select("days_to_close", "is_closed_won").first() == (30, 1)


def test_sample_is_reproducible(spark):
    df = spark.range(1000)
    a = sorted(r.id for r in T.sample_n(df, 100, "id").collect())
    b = sorted(r.id for r in T.sample_n(df.repartition(7), 100, "id").collect())
    assert a == b and len(a) == 100


def test_materialize_uses_the_shared_folder(spark):
    assert shared_dir(spark)
    df = materialize(spark.range(5).withColumn("x", F.col("id") * 2), "t")
    assert df.count() == 5 and df.columns == ["id", "x"]


def test_overwrite_counts_what_it_writes_and_runs_the_source_once(spark):
    runs = spark.sparkContext.accumulator(0)

    def rows(batches):
        for b in batches:
            runs.add(b.num_rows)
            yield b

    source = spark.range(100).mapInArrow(rows, "id long")
    spark.sql(f"CREATE DATABASE IF NOT EXISTS once LOCATION '{folder()}'")
    row = T.overwrite_table(source, "once.t").first()
    assert (row.table_name, row.source_rows, row.stored_rows, row.passed) == ("once.t", 100, 100, True) and runs.value == 100
    assert T.overwrite_table(source.where("id < 0"), "once.t").first().source_rows == 0
