"""Spark session and shared scratch space."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

_local_dirs: dict[str, str] = {}
_TIDY = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def build_session(app: str = "ledgerlens", master: str | None = None, **conf) -> SparkSession:
    """Session with adaptive execution on; the cluster's own settings win where it has them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        **conf,
    }.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """Folder all executors see: ``spark.checkpoint.dir``, or a temp folder in local mode only."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    if context.applicationId not in _local_dirs:
        _local_dirs[context.applicationId] = tempfile.mkdtemp(prefix="ledgerlens-")
    return _local_dirs[context.applicationId]


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path in the shared folder."""
    app = spark.sparkContext.applicationId
    return f"{shared_dir(spark)}/ledgerlens/{app}/{name}-{uuid.uuid4().hex}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back.

    Cuts the lineage, survives executor loss, and gives the readers real file sizes to plan with.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def tidied(spark: SparkSession):
    """Queries that run inside remove their shuffle files when they end, not when the driver next collects garbage.

    The setting holds for the whole session meanwhile, so this is not for use in threads.
    """
    before = spark.conf.get(_TIDY, None)
    spark.conf.set(_TIDY, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_TIDY)
        else:
            spark.conf.set(_TIDY, before)


def settled(df: DataFrame, name: str) -> DataFrame:
    """``materialise``, after which the table is all that is left of the write on disk: see ``tidied``."""
    with tidied(df.sparkSession):
        return materialise(df, name)


def drop(*tables: DataFrame) -> None:
    """Removes tables that ``materialise`` wrote, once every reader is through: results that are read later must
    not depend on them. Other tables are left alone."""
    for df in tables:
        spark = df.sparkSession
        names = df.inputFiles()
        folder = names[0].rsplit("/", 1)[0] if names else ""
        if f"/ledgerlens/{spark.sparkContext.applicationId}/" not in folder:
            continue
        jvm = spark.sparkContext._jvm
        path = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(path, True)


def broadcast_if_small(df: DataFrame) -> DataFrame:
    """``df`` written once, so that Spark knows its size in bytes before it plans the join: up to
    ``spark.sql.autoBroadcastJoinThreshold`` it is broadcast, above that the join is a shuffle."""
    return materialise(df, "side")
