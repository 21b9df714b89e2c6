"""Session set-up, and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app_name: str = "reviewlens", master: str | None = None, **conf) -> SparkSession:
    """A session with adaptive execution on; a cluster's own settings win over ours."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # split hot keys also where that costs one more shuffle
        "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
        "spark.sql.session.timeZone": "UTC",
        **{key.replace("__", "."): str(value) for key, value in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """Folder every executor can reach: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own, which
    goes when Python ends.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get(_OWN_ROOT, None)
    if root:
        return root
    if not spark.conf.get("spark.master", "").startswith("local"):
        raise RuntimeError("Set spark.checkpoint.dir to a folder that all executors share")
    root = tempfile.mkdtemp(prefix="reviewlens-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    spark.conf.set(_OWN_ROOT, root)
    return root


_OWN_ROOT = "reviewlens.checkpoint.dir"


def shared_path(spark: SparkSession, name: str) -> str:
    """A new, unused path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _stages(spark: SparkSession) -> str:
    """The session's database of stage tables; its files are below the shared folder."""
    name = spark.conf.get(_STAGES, None)
    if not name:
        name = f"reviewlens_{uuid.uuid4().hex}"
        spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_path(spark, 'stages')}'")
        spark.conf.set(_STAGES, name)
    return name


_STAGES = "reviewlens.stages"


def materialize(df: DataFrame) -> DataFrame:
    """The rows as a table in the shared folder, written once.

    Later jobs read columns from there instead of replaying the lineage, a lost
    executor costs no recomputation, and joins see the true size of the rows.
    The table stays until ``release_stages``.
    """
    spark = df.sparkSession
    name = f"{_stages(spark)}.stage_{uuid.uuid4().hex}"
    df.write.format("parquet").saveAsTable(name)
    return spark.table(name)


def spread(scan: DataFrame) -> DataFrame:
    """A scan dealt out to all cores where its files have fewer parts than there are cores.

    Work on texts costs far more than moving them; a table of many parts stays
    as it is.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    return scan.repartition(cores) if scan.rdd.getNumPartitions() < cores else scan


def release_stages(spark: SparkSession) -> None:
    """Drop all stage tables of the session with their files; results that read them must be written before."""
    name = spark.conf.get(_STAGES, None)
    if name:
        spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")
        spark.conf.unset(_STAGES)
