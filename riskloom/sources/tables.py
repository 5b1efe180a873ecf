"""Table sources and sinks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F
from pyspark.sql.types import StructType

from riskloom.functions.cleaning import decimal_comma, parse_bool
from riskloom.operators.sets import union_all
from riskloom.session import shared_dir


# --- reading ---------------------------------------------------------------

def _exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def read_csv(spark: SparkSession, path: str, schema: StructType | str | None = None, sep: str = ",") -> DataFrame:
    """CSV with a header. Without a schema every column is text, so no inference pass is made."""
    reader = spark.read.option("header", True).option("sep", sep).option("encoding", "UTF-8")
    return (reader.schema(schema) if schema is not None else reader).csv(path)


def load_tables(
    spark: SparkSession,
    directory: str,
    files: Mapping[str, str],
    required: Sequence[str] | None = None,
    schemas: Mapping[str, StructType | str] | None = None,
    sep: str = ",",
) -> tuple[dict[str, DataFrame], DataFrame]:
    """Named CSV tables and their load metadata.

    All missing required files are listed in one error; absent optional files
    are left out.
    """
    wanted = set(files if required is None else required)
    paths = {name: f"{directory.rstrip('/')}/{file}" for name, file in files.items()}
    found = {name: path for name, path in paths.items() if _exists(spark, path)}
    lost = sorted(files[name] for name in wanted - set(found))
    if lost:
        raise FileNotFoundError(f"missing files in {directory}: {', '.join(lost)}")
    tables = {name: read_csv(spark, path, (schemas or {}).get(name), sep) for name, path in found.items()}
    return tables, load_metadata(tables, sep)


def load_metadata(tables: Mapping[str, DataFrame], sep: str = ",") -> DataFrame:
    """Rows, columns and separator per table; one count per table in a single union."""
    parts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), "row_count", F.lit(len(df.columns)).alias("column_count"),
            F.lit(sep).alias("separator"),
        )
        for name, df in tables.items()
    ]
    return union_all(*parts)


def read_registry(
    spark: SparkSession, registry: Mapping[str, tuple[str, str]], jdbc: Mapping[str, str] | None = None,
    partitions: Mapping[str, tuple[str, int, int, int]] | None = None,
) -> dict[str, DataFrame]:
    """Relational tables by (schema, table): from the catalog, or over JDBC when connection options are given.

    ``partitions`` maps a name to (column, lower, upper, count) so that a large
    table is read by several tasks.
    """
    out = {}
    for name, (schema, table) in registry.items():
        if jdbc is None:
            out[name] = spark.table(f"{schema}.{table}" if schema else table)
            continue
        reader = spark.read.format("jdbc").options(**jdbc).option("dbtable", f"{schema}.{table}")
        if partitions and name in partitions:
            column, lower, upper, count = partitions[name]
            reader = (
                reader.option("partitionColumn", column).option("lowerBound", lower)
                .option("upperBound", upper).option("numPartitions", count)
            )
        out[name] = reader.load()
    return out


def head_rows(df: DataFrame, n: int = 10) -> DataFrame:
    """Preview of n rows."""
    return df.limit(n)


def sample_n(df: DataFrame, n: int, key: str | Sequence[str], seed: int = 42) -> DataFrame:
    """Exactly n rows (or all when fewer), the same ones on every run: lowest seeded key hashes."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.orderBy(F.xxhash64(*keys, F.lit(seed)), *keys).limit(n)


# --- typed ingest ------------------------------------------------------------

def _typed(column: str, kind: str):
    """Value of a text column as ``kind``; null when it does not fit."""
    text = F.trim(F.col(column).cast("string"))
    number = F.regexp_replace(text, ",", ".")
    if kind in ("int", "bigint", "smallint"):
        exact = number.try_cast("decimal(38,6)")
        return F.when(exact == F.floor(exact), exact.try_cast(kind))
    if kind == "boolean":
        accepted = F.lower(text).isin("true", "1", "yes", "false", "0", "no")
        return F.when(accepted, parse_bool(text))
    if kind == "date":
        return F.when(text.rlike(r"^\d{4}-\d{2}-\d{2}$"), text.try_cast("date"))
    if kind.startswith("decimal") or kind == "double":
        value = number.try_cast(kind)
        return F.when(~F.isnan(value), value) if kind == "double" else value
    return text.try_cast(kind)


def coerce_typed(df: DataFrame, types: Mapping[str, str]) -> tuple[DataFrame, DataFrame]:
    """Typed rows, and (column_name, bad_values, examples) for values that do not fit their type.

    Empty text counts as missing. Examples are at most five distinct values,
    taken from already counted (column, value) pairs.
    """
    typed = df.select(*[_typed(c, types[c]).alias(c) if c in types else F.col(c) for c in df.columns])
    marks = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.when(
                (F.length(F.trim(F.col(c).cast("string"))) > 0) & _typed(c, t).isNull(), F.col(c).cast("string")
            ).alias("value"),
        )
        for c, t in types.items()
    ]
    pairs = df.select(F.inline(F.filter(F.array(*marks), lambda s: s["value"].isNotNull()))).groupBy(
        "column_name", "value"
    ).agg(F.count(F.lit(1)).alias("n"))
    # the five smallest values come from min() rounds, so no column's values are collected
    bad = pairs.groupBy("column_name").agg(F.sum("n").alias("bad_values"))
    rest, cells = pairs, []
    for i in range(5):
        low = rest.groupBy("column_name").agg(F.min("value").alias(f"_e{i}"))
        bad = bad.join(low, "column_name", "left")
        rest = rest.join(low, "column_name").where(F.col("value") > F.col(f"_e{i}")).select("column_name", "value")
        cells.append(F.col(f"_e{i}"))
    bad = bad.select("column_name", "bad_values", F.array_compact(F.array(*cells)).alias("examples"))
    return typed, bad


def enforce_typed(df: DataFrame, types: Mapping[str, str]) -> DataFrame:
    """Typed rows, or one error that names the offending columns and values."""
    typed, bad = coerce_typed(df, types)
    problems = bad.collect()  # at most one row per column
    if problems:
        raise ValueError("; ".join(f"{r.column_name}: {r.bad_values} bad, e.g. {r.examples}" for r in problems))
    return typed


def bad_values(df: DataFrame, raw: str, parsed, limit: int = 10) -> DataFrame:
    """Distinct raw values that are present but could not be parsed."""
    return df.where(F.col(raw).isNotNull() & parsed.isNull()).select(
        F.col(raw).cast("string").alias("value")
    ).distinct().orderBy("value").limit(limit)


def require_parsed(df: DataFrame, raw: str, parsed, out: str) -> DataFrame:
    """Adds the parsed column, or raises with at most ten unreadable values."""
    failed = [r.value for r in bad_values(df, raw, parsed).collect()]
    if failed:
        raise ValueError(f"{raw} contains unreadable values: {failed}")
    return df.withColumn(out, parsed)


def numeric_or_default(df: DataFrame, column: str, default: float | None = None):
    """Lenient number; the default stands in only when the column itself is absent."""
    if column not in df.columns:
        return F.lit(default).cast("double")
    value = F.col(column).cast("string").try_cast("double")
    return F.when(~F.isnan(value), value)


def select_existing(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """The wanted columns that exist, in the wanted order."""
    return df.select(*[c for c in columns if c in df.columns])


# --- writing ---------------------------------------------------------------

def write_csv(df: DataFrame, path: str, sep: str = ",", decimal: str = ".") -> str:
    """Header CSV written by all tasks; with a decimal comma fractional columns are rendered as text."""
    out = df
    if decimal == ",":
        fractional = [
            f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "decimal")
        ]
        out = df.withColumns({c: decimal_comma(c) for c in fractional}) if fractional else df
    out.write.mode("overwrite").option("header", True).option("sep", sep).option("encoding", "UTF-8").csv(path)
    return path


def overwrite_table(df: DataFrame, name: str) -> DataFrame:
    """Replace a catalog table and compare row counts: (table_name, source_rows, stored_rows, passed).

    The source's rows are counted by the write itself, so it runs once, and a source
    that changes from run to run is compared with what was written.
    """
    seen = Observation(f"rows written to {name}")
    df.observe(seen, F.count(F.lit(1)).alias("source_rows")).write.mode("overwrite").saveAsTable(name)
    stored = df.sparkSession.table(name).agg(F.count(F.lit(1)).alias("stored_rows"))
    return stored.select(
        F.lit(name).alias("table_name"), F.lit(seen.get["source_rows"]).cast("long").alias("source_rows"), "stored_rows"
    ).withColumn("passed", F.col("source_rows") == F.col("stored_rows"))


def append_table(spark: SparkSession, source: str, target: str) -> None:
    """Positional INSERT INTO target SELECT * FROM source."""
    spark.table(source).write.insertInto(target)


def write_json_report(report: DataFrame, path: str) -> str:
    """Small report frame as JSON lines."""
    report.coalesce(1).write.mode("overwrite").json(path)
    return path


def create_raw_tables(spark: SparkSession, schemas: Mapping[str, str], database: str = "raw") -> list[str]:
    """Drop and create empty parquet tables from DDL column lists."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database} LOCATION '{shared_dir(spark)}/{database}.db'")
    names = []
    for table, columns in schemas.items():
        name = f"{database}.{table}"
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.sql(f"CREATE TABLE {name} ({columns}) USING parquet")
        names.append(name)
    return names


def register_views(tables: Mapping[str, DataFrame], prefix: str = "") -> list[str]:
    """Create-or-replace temporary views."""
    names = []
    for name, df in tables.items():
        df.createOrReplaceTempView(f"{prefix}{name}")
        names.append(f"{prefix}{name}")
    return names
