"""Session settings and the shared folder used to cut lineage."""

from __future__ import annotations

import tempfile
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession

_LOCAL_DIRS: dict[str, str] = {}


def build_session(app_name: str = "riskloom", master: str | None = None, **conf: str) -> SparkSession:
    """Session with adaptive execution and skew handling on; other keys may be overridden."""
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.parquet.filterPushdown": "true",
    }
    settings.update(conf)
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder named by ``spark.checkpoint.dir``.

    Only a local-mode session without that setting gets a temporary folder; on
    a cluster a machine-local folder would be lost with its executor, so the
    setting is required there.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = spark.sparkContext.applicationId
    if app not in _LOCAL_DIRS:
        _LOCAL_DIRS[app] = tempfile.mkdtemp(prefix="riskloom-")
    return _LOCAL_DIRS[app]


def materialize(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Used between stages that are read more than once. A parquet table keeps
    column pruning, filter pushdown and size statistics for the next stage, and
    lost executors re-read it instead of recomputing the lineage.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/riskloom/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def materialize_all(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """Write independent tables as concurrent jobs, so that small ones do not wait for each other."""
    with ThreadPoolExecutor(max_workers=max(1, len(tables))) as pool:
        return dict(zip(tables, pool.map(lambda item: materialize(item[1], item[0]), tables.items())))


def dealt(df: DataFrame, *keys: str, mb: int = 3, most: int = 16) -> DataFrame:
    """``df`` exchanged by ``keys`` to so many partitions that each sorts in memory.

    Small inputs take the session's number of partitions, which adaptive
    execution may coalesce. Larger ones get one per ``mb`` of their size in the
    plan's statistics, up to ``most`` times the session's number.
    """
    spark = df.sparkSession
    usual = int(spark.conf.get("spark.sql.shuffle.partitions"))
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    wanted = min(-(-size // (mb << 20)), most * usual)
    return df.repartition(wanted, *keys) if wanted > usual else df.repartition(*keys)
